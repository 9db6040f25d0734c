"""Queries over the checklist corpus, its logs and its metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lectern.functions import coerce, rules, text as tx
from lectern.operators import merge, publish, report, search, store
from lectern.plans.registry import Registry
from lectern.schema import AVAILABILITY, CHECKLIST_COLUMNS, CONFIDENCE, LIST_COLUMNS
from lectern.session import read_table

REGISTRY = Registry()
query = REGISTRY.add

# SQL that the oracles share
STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


def strip_sql(c: str) -> str:
    return STRIP.format(c)


def id_sql(c: str = "pmcid") -> str:
    return f"case when upper({strip_sql(c)}) like 'PMC%' then upper({strip_sql(c)}) else 'PMC' || upper({strip_sql(c)}) end"


def availability_sql(c: str) -> str:
    word = f"translate(lower({strip_sql(c)}), '_ ', '--')"
    return f"case when {word} in ({', '.join(map(repr, AVAILABILITY))}) then {word} else 'not-stated' end"


def confidence_sql(c: str) -> str:
    word = f"lower({strip_sql(c)})"
    return f"case when {word} in ({', '.join(map(repr, CONFIDENCE))}) then {word} else 'unclear' end"


def or_unspecified_sql(c: str, label: str = "unspecified") -> str:
    return f"coalesce(nullif({strip_sql(c)}, ''), '{label}')"


LATEST = f"""
latest as (
  select * exclude (rn, pmcid, id, year), id as pmcid, coalesce(year, '') as year
  from (select *, {id_sql()} as id, row_number() over (partition by {id_sql()} order by rec_id desc) as rn from checklists where pmcid is not null) where rn = 1
)
"""


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last delivered record of each paper, under its tidy id; a null year is blank."""
    rows = read_table(spark, sf_dir, "checklists").withColumn("pmcid", coerce.pmcid(F.col("pmcid"))).withColumn("year", F.coalesce("year", F.lit("")))
    return store.last_of_key(rows, "pmcid", "rec_id")


# counts and reports


@query(f"with {LATEST} select count(*) as n, count_if(ehr_used) as n_ehr, count_if(not ehr_used) as n_no_ehr, (100 * count_if(ehr_used)) // count(*) as percent_ehr from latest")
def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.headline(latest(spark, sf_dir))


COUNTED = {
    "data_availability": (lambda c: coerce.availability(c), availability_sql),
    "confidence": (lambda c: coerce.confidence(c), confidence_sql),
    "source_format": (lambda c: F.coalesce(c, F.lit("text")), lambda c: f"coalesce({c}, 'text')"),
    "model": (lambda c: coerce.or_unspecified(c), or_unspecified_sql),
    "study_design": (lambda c: coerce.or_unspecified(c), or_unspecified_sql),
    "exposure_domain": (lambda c: coerce.or_unspecified(c), or_unspecified_sql),
    "year": (lambda c: coerce.or_unspecified(c), or_unspecified_sql),
}


def _counted(column: str) -> None:
    value, value_sql = COUNTED[column]

    @query(f"with {LATEST} select {value_sql(column)} as {column}, count(*) as n from latest group by 1", name=f"count_by_{column}")
    def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report.counts(latest(spark, sf_dir), value(F.col(column)), column)


for _column in COUNTED:
    _counted(_column)

SHARE = "round_even(100.0 * n / sum(n) over (), 1)"


@query(f"with {LATEST}, c as (select {or_unspecified_sql('data_source_type')} as data_source_type, count(*) as n from latest group by 1) select data_source_type, n, {SHARE} as percent from c")
def share_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.shares(latest(spark, sf_dir), coerce.or_unspecified(F.col("data_source_type")), "data_source_type")


@query(f"with {LATEST}, y as (select nullif({strip_sql('year')}, '') as y from latest) select coalesce(min(y), '') as first, coalesce(max(y), '') as last, count(distinct y) as n_distinct from y")
def year_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.span(latest(spark, sf_dir), "year")


@query(f"with {LATEST} select distinct year from latest where year <> ''")
def distinct_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(spark, sf_dir).filter("year <> ''").select("year").distinct().orderBy("year")


@query(f"with {LATEST} select model from (select model, count(*) as n, min({{'y': year, 'p': pmcid}}) as f from latest where {strip_sql('model')} <> '' group by 1) order by n desc, f limit 1")
def mode_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.most_common(latest(spark, sf_dir), "model", ["year", "pmcid"])


def top_sql(column: str, k: int) -> str:
    return f"""with {LATEST}, e as (select year, pmcid, unnest({column}) as v, generate_subscripts({column}, 1) as i from latest)
select value, n from (select lower({strip_sql('v')}) as value, count(*) as n, min({{'y': year, 'p': pmcid, 'i': i}}) as f from e where v is not null group by 1) order by n desc, f limit {k}"""


@query(top_sql("pathologies_diseases", 20))
def top_diseases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.top_first_seen(latest(spark, sf_dir), F.col("pathologies_diseases"), 20, ["year", "pmcid"])


@query(top_sql("captured_features", 20))
def top_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.top_first_seen(latest(spark, sf_dir), F.col("captured_features"), 20, ["year", "pmcid"])


@query(f"with {LATEST} select left(s, 40) as data_source_type, n from (select {or_unspecified_sql('data_source_type')} as s, count(*) as n, min({{'y': year, 'p': pmcid}}) as f from latest group by 1) order by n desc, f limit 12")
def top_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.top_values(latest(spark, sf_dir), "data_source_type", 12, ["year", "pmcid"], 40)


@query(f"with {LATEST}, d as (select unnest([1, 2, 3, 4]) as place, unnest(['high', 'medium', 'low', 'unclear']) as confidence) select place, d.confidence, count(l.pmcid) as n from d left join latest l on d.confidence = {confidence_sql('l.confidence')} group by all")
def confidence_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.histogram(latest(spark, sf_dir), coerce.confidence(F.col("confidence")), CONFIDENCE, "confidence")


@query(f"with {LATEST} select pmcid, year, left(coalesce(nullif(array_to_string(pathologies_diseases, '; '), ''), '—'), 60) as diseases, left(coalesce(nullif(data_source_type, ''), '—'), 30) as source from latest where ehr_used")
def ehr_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = search.find(latest(spark, sf_dir), ehr_used=True)
    diseases = F.coalesce(F.nullif(F.array_join("pathologies_diseases", "; "), F.lit("")), F.lit("—"))
    return rows.select("pmcid", "year", F.left(diseases, F.lit(60)).alias("diseases"), F.left(F.coalesce(F.nullif(F.col("data_source_type"), F.lit("")), F.lit("—")), F.lit(30)).alias("source"))


def clip_sql(c: str, width: int) -> str:
    cell = strip_sql(f"replace({c}, '|', '/')")
    head = f"left({cell}, {width})"
    cut = rf"case when contains({head}, ' ') then regexp_replace({head}, ' [^ ]*$', '') else {head} end"
    return rf"case when length({cell}) <= {width} then case when {cell} = '' then '—' else {cell} end else regexp_replace({cut}, '[ ,;:.-]+$', '') || '…' end"


@query(
    f"""with {LATEST} select row_number() over (order by year, pmcid) as no, pmcid, year, case when ehr_used then '✓' else '' end as ehr,
  {clip_sql("coalesce(nullif(array_to_string(pathologies_diseases[1:3], '; '), ''), '—')", 50)} as diseases,
  {clip_sql("coalesce(nullif(data_source_type, ''), '—')", 30)} as source, {clip_sql("coalesce(summary, '')", 110)} as summary from latest"""
)
def numbered_checklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.checklist_lines(latest(spark, sf_dir))


# catalogue searches


def text_sql(columns: list[str]) -> str:
    return "lower(" + " || ' ' || ".join(f"coalesce(array_to_string({c}, ' '), '')" if c in LIST_COLUMNS else f"coalesce({c}, '')" for c in columns) + ")"


FINDS = {
    "ehr": ({"ehr_used": True}, "ehr_used"),
    "no_ehr": ({"ehr_used": False}, "not coalesce(ehr_used, false)"),
    "disease": ({"disease": "Asthma"}, "len(list_filter(pathologies_diseases, lambda x: contains(lower(coalesce(x, '')), 'asthma'))) > 0"),
    "exposure": ({"exposure": "smoke"}, "contains(lower(coalesce(exposure_domain, '')), 'smoke')"),
    "query": ({"query": "wheeze"}, f"contains({text_sql(['title', 'summary'])}, 'wheeze')"),
    "design": ({"design": "cohort"}, "contains(lower(coalesce(study_design, '')), 'cohort')"),
    "source": ({"data_source": "registry"}, "contains(lower(coalesce(data_source_type, '')), 'registry')"),
    "confidence": ({"confidence": "HIGH"}, "lower(confidence) = 'high'"),
    "combined": ({"ehr_used": True, "disease": "eczema", "confidence": "high"}, "ehr_used and len(list_filter(pathologies_diseases, lambda x: contains(lower(coalesce(x, '')), 'eczema'))) > 0 and lower(confidence) = 'high'"),
}


def _find(name: str) -> None:
    filters, where = FINDS[name]

    @query(f"with {LATEST} select year, pmcid, title from latest where {where}", name=f"catalog_find_{name}")
    def found(spark: SparkSession, sf_dir: str) -> DataFrame:
        return search.find(latest(spark, sf_dir), **filters).select("year", "pmcid", "title")


for _name in FINDS:
    _find(_name)

VACCINE = f"regexp_matches({text_sql(['title', 'summary', 'exposure_domain'])}, 'vacc|immuniz|immunis')"
SEARCH_BOX = {"vaccines": ("Vaccines ", VACCINE), "records": ("EHR", "ehr_used"), "text": ("Asthma", f"contains({text_sql(search.SEARCHED)}, 'asthma')"), "blank": ("  ", "true")}


def _box(name: str) -> None:
    words, where = SEARCH_BOX[name]

    @query(f"with {LATEST} select year, pmcid from latest where {where}", name=f"search_{name}")
    def found(spark: SparkSession, sf_dir: str) -> DataFrame:
        return search.web_search(latest(spark, sf_dir), words).select("year", "pmcid")


for _name in SEARCH_BOX:
    _box(_name)


@query(f"with {LATEST} select year, pmcid from latest where data_availability = 'public-repository' and contains({text_sql(search.SITE_SEARCHED)}, 'lead')")
def site_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.site_search(latest(spark, sf_dir), "public", "lead").select("year", "pmcid")


@query(f"with {LATEST} select count(*) as n from latest where {VACCINE}")
def vaccine_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest(spark, sf_dir)
    return rows.filter(search.vaccine_like(rows)).agg(F.count(F.lit(1)).alias("n"))


# coercion


@query(f"select rec_id, {id_sql()} as pmcid from checklists")
def normalise_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "checklists").select("rec_id", coerce.pmcid(F.col("pmcid")).alias("pmcid"))


@query(f"select rec_id, {availability_sql('data_availability')} as data_availability, {confidence_sql('confidence')} as confidence from checklists")
def coerce_enums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "checklists").select("rec_id", coerce.availability(F.col("data_availability")).alias("data_availability"), coerce.confidence(F.col("confidence")).alias("confidence"))


@query(
    """select raw_id, case when w in ('true', 'yes', 'y', '1', 't', 'used') then true when w in ('false', 'no', 'n', '0', 'f', 'not used') then false end as ehr_used
from (select raw_id, lower(trim(json_extract_string(payload, '$.ehr_used'))) as w from raw_checklists where json_valid(payload))"""
)
def coerce_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.operators.drift import readable

    raw = read_table(spark, sf_dir, "raw_checklists").select("raw_id", readable(F.col("payload")).alias("m")).filter("m is not null")
    return raw.select("raw_id", coerce.boolean(F.try_variant_get(F.try_element_at("m", F.lit("ehr_used")), "$", "string")).alias("ehr_used"))


def clean_list_sql(c: str) -> str:
    return f"array_to_string(list_filter(list_transform(coalesce({c}, []), lambda x: {strip_sql('x')}), lambda x: x <> ''), ' | ') as {c}"


@query(f"select rec_id, {', '.join(map(clean_list_sql, LIST_COLUMNS))} from checklists")
def coerce_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "checklists").select("rec_id", *[F.array_join(coerce.list_of(F.col(c)), " | ").alias(c) for c in LIST_COLUMNS])


@query(
    f"""with {LATEST} select count(*) as n, count_if(title is null) as no_title, count_if(ehr_evidence is null) as no_evidence, count_if(summary is null) as no_summary,
  count_if(title is not null and ehr_used is not null and ehr_evidence is not null and summary is not null and source_format in ('pdf', 'xml', 'text')) as valid from latest"""
)
def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest(spark, sf_dir)
    checked = store.validated(rows)
    return checked.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("title").isNull()).alias("no_title"), F.count_if(F.col("ehr_evidence").isNull()).alias("no_evidence"), F.count_if(F.col("summary").isNull()).alias("no_summary"), F.count_if(F.col("reject").isNull()).alias("valid"))


@query(f"with {LATEST} select pmcid, len(data_accession_links) as links, {availability_sql('data_availability')} as data_availability from latest where len(data_accession_links) > 0 and {availability_sql('data_availability')} <> 'public-repository'")
def audit_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latest(spark, sf_dir).withColumn("data_availability", coerce.availability(F.col("data_availability")))
    return rows.filter("size(data_accession_links) > 0 and data_availability <> 'public-repository'").select("pmcid", F.size("data_accession_links").alias("links"), "data_availability")


# the store

COMPARED = [c for c in CHECKLIST_COLUMNS if c != "pmcid"]


def as_text(columns: list[str]) -> list[Column]:
    """The columns, lists joined with bars between."""
    return [F.array_join(c, " | ").alias(c) if c in LIST_COLUMNS else F.col(c) for c in columns]


def as_text_sql(columns: list[str]) -> str:
    return ", ".join(f"array_to_string({c}, ' | ') as {c}" if c in LIST_COLUMNS else c for c in columns)


DELIVERIES = f"""
tidy as (select rec_id, {id_sql()} as pmcid, {", ".join(COMPARED)} from checklists where pmcid is not null),
half as (select max(rec_id) / 2 as h from tidy),
base as (select * exclude (rn) from (select *, row_number() over (partition by pmcid order by rec_id desc) as rn from tidy where rec_id <= (select h from half)) where rn = 1),
batch as (select * exclude (rn) from (select *, row_number() over (partition by pmcid order by rec_id desc) as rn from tidy where rec_id > (select h from half)) where rn = 1),
plan as (
  select coalesce(n.pmcid, b.pmcid) as pmcid, {", ".join(f"case when n.pmcid is null then b.{c} else n.{c} end as {c}" for c in COMPARED)},
    case when n.pmcid is null then 'keep' when b.pmcid is null then 'insert'
      when {" and ".join(f"b.{c} is not distinct from n.{c}" for c in COMPARED)} then 'same' else 'update' end as action
  from base b full join batch n on b.pmcid = n.pmcid
)
"""


def _deliveries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The store after the first half of the deliveries, and the second half as a batch."""
    rows = read_table(spark, sf_dir, "checklists").filter("pmcid is not null").select("rec_id", coerce.pmcid(F.col("pmcid")).alias("pmcid"), *COMPARED)
    half = rows.agg((F.max("rec_id") / 2).alias("h")).scalar()
    keep = lambda part: store.last_of_key(part, "pmcid", "rec_id").drop("rec_id")
    return keep(rows.filter(F.col("rec_id") <= half)), keep(rows.filter(F.col("rec_id") > half))


@query(f"with {DELIVERIES} select pmcid, action from plan")
def upsert_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.upsert_plan(*_deliveries(spark, sf_dir), "pmcid").select("pmcid", "action")


@query(f"with {DELIVERIES} select action, count(*) as n from plan group by 1")
def upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.counts(store.upsert_plan(*_deliveries(spark, sf_dir), "pmcid"), F.col("action"), "action")


@query(f"with {DELIVERIES} select {as_text_sql(CHECKLIST_COLUMNS)} from plan")
def upsert_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.upsert_plan(*_deliveries(spark, sf_dir), "pmcid").select(*as_text(CHECKLIST_COLUMNS))


@query(f"with {DELIVERIES}, p as (select b.* exclude (summary, confidence), case when n.pmcid is null then b.summary else n.summary end as summary, case when n.confidence is null then b.confidence else n.confidence end as confidence from base b left join batch n on b.pmcid = n.pmcid) select {as_text_sql(CHECKLIST_COLUMNS)} from p")
def partial_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patches of two columns, one of them only where it says something."""
    base, batch = _deliveries(spark, sf_dir)
    present = F.filter(F.array(F.lit("summary"), F.when(F.col("confidence").isNotNull(), F.lit("confidence"))), lambda x: x.isNotNull())
    return merge.patch(base, batch.withColumn("present", present), "pmcid", ["summary", "confidence"]).select(*as_text(CHECKLIST_COLUMNS))


@query(f"with {DELIVERIES} select {as_text_sql(CHECKLIST_COLUMNS)} from base where pmcid not in (select {id_sql()} from log_excluded) and pmcid not in (select pmcid from batch)")
def delete_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, batch = _deliveries(spark, sf_dir)
    gone = batch.select("pmcid").unionByName(read_table(spark, sf_dir, "log_excluded").select(coerce.pmcid(F.col("pmcid")).alias("pmcid")))
    return store.delete(base, gone, "pmcid").select(*as_text(CHECKLIST_COLUMNS))


@query(f"with {DELIVERIES} select {as_text_sql(CHECKLIST_COLUMNS)} from (select * from base union all by name select * from batch where pmcid not in (select pmcid from base))")
def insert_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, batch = _deliveries(spark, sf_dir)
    return store.insert(base, store.delete(batch, base, "pmcid"), "pmcid").select(*as_text(CHECKLIST_COLUMNS))


@query(f"with {LATEST}, m as (select model from (select model, count(*) as n, min({{'y': year, 'p': pmcid}}) as f from latest where {strip_sql('model')} <> '' group by 1) order by n desc, f limit 1) select row_number() over (order by year, pmcid) as no, count(*) over () as n, coalesce((select model from m), '') as batch_model, {as_text_sql(CHECKLIST_COLUMNS)} from latest")
def batch_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of the batch file in their order, with its size and model."""
    return store.batch_rows(latest(spark, sf_dir).select(*CHECKLIST_COLUMNS)).select("no", "n", "batch_model", *as_text(CHECKLIST_COLUMNS))


# logs and metadata

TIDY_LOG = f"log as (select {id_sql()} as pmcid, {strip_sql('title')} as title, coalesce({strip_sql('year')}, '') as year, journal, authors from log_papers)"


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "log_papers")
    return rows.select(coerce.pmcid(F.col("pmcid")).alias("pmcid"), coerce.strip(F.col("title")).alias("title"), F.coalesce(coerce.strip(F.col("year")), F.lit("")).alias("year"), "journal", "authors")


@query(
    """select distinct 'PMC' || uid as pmcid, coalesce(title, 'N/A') as title, coalesce(source, 'N/A') as journal, left(coalesce(pubdate, ''), 4) as year,
  array_to_string(list_transform(authors[1:2], lambda a: coalesce(a.name, '')), ', ') as authors, array_to_string(pubtype, ' ') as pubtype from paper_metadata"""
)
def metadata_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "paper_metadata")
    names = F.transform(F.slice("authors", 1, 2), lambda a: F.coalesce(a["name"], F.lit("")))
    return rows.select(F.concat(F.lit("PMC"), "uid").alias("pmcid"), F.coalesce("title", F.lit("N/A")).alias("title"), F.coalesce("source", F.lit("N/A")).alias("journal"), F.left(F.coalesce("pubdate", F.lit("")), F.lit(4)).alias("year"), F.array_join(names, ", ").alias("authors"), F.array_join("pubtype", " ").alias("pubtype")).distinct()


ROUTE = rf"""case when regexp_matches(coalesce(title, 'N/A'), '{rules.REVIEW_TITLE}') or contains(coalesce(array_to_string(pubtype, ' '), ''), 'Review') then 'review'
  when regexp_matches(coalesce(title, 'N/A'), '{rules.EPIGENOME_TITLE}') and not contains(lower(title), 'environment-wide') and not contains(lower(title), 'exposome') then 'epigenome'
  when regexp_matches(coalesce(title, 'N/A'), '{rules.CONFERENCE_TITLE}') or lower(coalesce(source, 'N/A')) in ({", ".join(map(repr, rules.CONFERENCE_JOURNALS))}) then 'conference' else 'ok' end"""


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "paper_metadata")
    return rows.select("uid", rules.route(F.col("title"), F.col("source"), F.array_join("pubtype", " ")).alias("route"))


@query(f"select uid, {ROUTE} as route from paper_metadata")
def route_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir)


@query(f"select route, count(*) as n from (select {ROUTE} as route from paper_metadata) where route <> 'ok' group by 1")
def exclusion_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.counts(_routed(spark, sf_dir).filter("route <> 'ok'"), F.col("route"), "route")


@query(f"select lower({strip_sql('reason')}) as reason, count(distinct {id_sql()}) as n from log_excluded group by 1")
def excluded_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "log_excluded").select(F.lower(coerce.strip(F.col("reason"))).alias("reason"), coerce.pmcid(F.col("pmcid")).alias("pmcid")).distinct()
    return report.counts(rows, F.col("reason"), "reason")


def bucket_sql(table: dict[str, list[str]]) -> str:
    whens = []
    for label, patterns in table.items():
        tests = []
        for p in patterns:
            if "(?!" in p:  # DuckDB has no lookahead: hide what it excludes, then look for the rest
                tests.append(r"regexp_matches(regexp_replace(lower(title), 'smok(e|ing)\s+(cessation|quit)', ' ', 'g'), 'smok')")
            else:
                tests.append(f"regexp_matches(lower(title), '{p}')")
        whens.append(f"when {' or '.join(tests)} then '{label}'")
    return f"case {' '.join(whens)} else '{rules.OTHER}' end"


@query(f"with {TIDY_LOG} select distinct pmcid, title, {bucket_sql(rules.EXPOSURE_BUCKETS)} as exposure, {bucket_sql(rules.OUTCOME_BUCKETS)} as outcome from log")
def bucket_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.col("title")
    return _log(spark, sf_dir).select("pmcid", "title", rules.first_bucket(title, rules.EXPOSURE_BUCKETS).alias("exposure"), rules.first_bucket(title, rules.OUTCOME_BUCKETS).alias("outcome")).distinct()


@query(
    f"""with {TIDY_LOG}, one as (select pmcid, max({{'y': year, 't': title}}) as r from log group by 1), b as (select pmcid, r.y as year, r.t as title from one)
select bucket, row_number() over (partition by bucket order by year, pmcid) as pos, pmcid from (select *, {bucket_sql(rules.EXPOSURE_BUCKETS)} as bucket from b)"""
)
def bucket_id_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every id of each bucket with its place there."""
    one = _log(spark, sf_dir).groupBy("pmcid").agg(F.max(F.struct("year", "title")).alias("r")).select("pmcid", "r.*")
    labels = [*rules.EXPOSURE_BUCKETS, rules.OTHER]
    return report.bucket_ids(one, rules.first_bucket(F.col("title"), rules.EXPOSURE_BUCKETS), ["year", "pmcid"], labels).drop("place")


@query(
    f"""with {TIDY_LOG}, one as (select pmcid, max({{'y': year, 't': title}}) as r from log group by 1), b as (select pmcid, r.y as year, {bucket_sql(rules.EXPOSURE_BUCKETS).replace('title', 'r.t')} as bucket from one),
p as (select *, (row_number() over (partition by bucket order by year, pmcid) - 1) // 10000 + 1 as part from b)
select bucket, part, count(*) as n, string_agg(pmcid, ', ' order by year, pmcid) as ids from p group by 1, 2"""
)
def bucket_id_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of bucket_id_lists in lines of at most 10,000."""
    one = _log(spark, sf_dir).groupBy("pmcid").agg(F.max(F.struct("year", "title")).alias("r")).select("pmcid", "r.*")
    labels = [*rules.EXPOSURE_BUCKETS, rules.OTHER]
    return report.id_parts(one, rules.first_bucket(F.col("title"), rules.EXPOSURE_BUCKETS), ["year", "pmcid"], labels).drop("place")


@query(
    f"""with {TIDY_LOG}, ids as (select distinct pmcid from log), m as (select 'PMC' || uid as pmcid, max(title) as title, max(left(pubdate, 4)) as year from paper_metadata group by 1)
select ids.pmcid, coalesce(m.title, ids.pmcid) as title, coalesce(m.year, '') as year, m.pmcid is not null as has_metadata from ids left join m using (pmcid)"""
)
def files_with_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _log(spark, sf_dir).select("pmcid").distinct()
    meta = read_table(spark, sf_dir, "paper_metadata").groupBy(F.concat(F.lit("PMC"), "uid").alias("pmcid")).agg(F.max("title").alias("title"), F.max(F.left("pubdate", F.lit(4))).alias("year")).withColumn("known", F.lit(True))
    return ids.join(meta, "pmcid", "left").select("pmcid", F.coalesce("title", "pmcid").alias("title"), F.coalesce("year", F.lit("")).alias("year"), F.coalesce("known", F.lit(False)).alias("has_metadata"))


@query(f"with {TIDY_LOG} select distinct pmcid from log where pmcid not in (select {id_sql()} from checklists where pmcid is not null)")
def missing_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = read_table(spark, sf_dir, "checklists").filter("pmcid is not null").select(coerce.pmcid(F.col("pmcid")).alias("pmcid")).distinct()
    return _log(spark, sf_dir).select("pmcid").distinct().join(done, "pmcid", "left_anti")


STATUS = f"lower({strip_sql('status')})"


@query(f"with {TIDY_LOG} select distinct pmcid, title from log where pmcid in (select {id_sql()} from paper_results where {STATUS} = 'ok')")
def downloaded_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = read_table(spark, sf_dir, "paper_results").filter(F.lower(coerce.strip(F.col("status"))) == "ok").select(coerce.pmcid(F.col("pmcid")).alias("pmcid")).distinct()
    return _log(spark, sf_dir).select("pmcid", "title").distinct().join(ok, "pmcid", "left_semi")


@query(f"with {LATEST}, {TIDY_LOG}, x as (select pmcid from latest where source_format = 'xml') select format, count(*) as n from (select distinct log.pmcid, case when x.pmcid is null then 'PDF' else 'XML' end as format from log left join x using (pmcid)) group by 1")
def format_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    xml = latest(spark, sf_dir).filter("source_format = 'xml'").select("pmcid", F.lit(True).alias("xml"))
    marked = _log(spark, sf_dir).select("pmcid").distinct().join(xml, "pmcid", "left")
    return report.counts(marked, F.when(F.col("xml"), "XML").otherwise("PDF"), "format")


@query(f"with {TIDY_LOG} select distinct pmcid from log where pmcid not in (select 'PMC' || uid from paper_metadata where uid is not null) and pmcid not in (select {id_sql()} from log_excluded)")
def resume_or_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_uid = read_table(spark, sf_dir, "paper_metadata").select(F.concat(F.lit("PMC"), "uid").alias("pmcid"))
    by_id = read_table(spark, sf_dir, "log_excluded").select(coerce.pmcid(F.col("pmcid")).alias("pmcid"))
    return _log(spark, sf_dir).select("pmcid").distinct().join(by_uid, "pmcid", "left_anti").join(by_id, "pmcid", "left_anti")


@query(f"with everything as (select {id_sql()} as pmcid, {strip_sql('title')} as title, 'papers' as list, 1 as place from log_papers union all select {id_sql()}, {strip_sql('title')}, 'excluded', 2 from log_excluded) select pmcid, title, min(place) as place from everything group by 1, 2")
def union_distinct_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = lambda name, place: read_table(spark, sf_dir, name).select(coerce.pmcid(F.col("pmcid")).alias("pmcid"), coerce.strip(F.col("title")).alias("title"), F.lit(place).alias("place"))
    return one("log_papers", 1).unionByName(one("log_excluded", 2)).groupBy("pmcid", "title").agg(F.min("place").alias("place"))


@query(rf"with {TIDY_LOG} select row_number() over (order by year, pmcid, title, coalesce(journal, ''), coalesce(authors, '')) as no, year, pmcid, replace(title, '|', '\|') as title from (select distinct * from log)")
def numbered_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _log(spark, sf_dir).distinct().withColumn("j", F.coalesce("journal", F.lit(""))).withColumn("a", F.coalesce("authors", F.lit("")))
    return report.numbered(rows, ["year", "pmcid", "title", "j", "a"]).select("no", "year", "pmcid", tx.escape_bars(F.col("title")).alias("title"))


@query(rf"with {TIDY_LOG} select distinct pmcid, left(regexp_replace({strip_sql(r"regexp_replace(title, '[^\w\s-]', '', 'g')")}, '\s+', '_', 'g'), 80) as stem from log")
def file_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(spark, sf_dir).select("pmcid", tx.file_stem(F.col("title")).alias("stem")).distinct()


@query(f"with {LATEST} select {as_text_sql(publish.SITE_COLUMNS)} from latest")
def site_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.site_records(latest(spark, sf_dir)).select(*as_text(publish.SITE_COLUMNS))


@query(
    f"""with {TIDY_LOG}, {LATEST}, one as (select pmcid, max({{'y': year, 't': title, 'j': coalesce(journal, '')}}) as r from log group by 1), b as (select pmcid, r.y as year, r.t as title, r.j as journal from one)
select row_number() over (order by b.year, b.pmcid) as no, b.pmcid, b.year, replace(b.journal, '|', chr(92) || '|') as journal, replace(b.title, '|', chr(92) || '|') as title,
  {bucket_sql(rules.EXPOSURE_BUCKETS).replace("title", "b.title")} as exposure, {bucket_sql(rules.OUTCOME_BUCKETS).replace("title", "b.title")} as outcome,
  case when b.pmcid in (select pmcid from latest where source_format = 'xml') then 'XML' else 'PDF' end as format from b"""
)
def paper_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = _log(spark, sf_dir).withColumn("journal", F.coalesce("journal", F.lit(""))).groupBy("pmcid").agg(F.max(F.struct("year", "title", "journal")).alias("r")).select("pmcid", "r.*")
    return publish.inventory(one, latest(spark, sf_dir).filter("source_format = 'xml'"))


@query(f"select distinct {id_sql()} as pmcid, {strip_sql('title')} as title from log_papers union select {id_sql()}, {strip_sql('title')} from log_excluded")
def merged_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = lambda name: read_table(spark, sf_dir, name).select(coerce.pmcid(F.col("pmcid")).alias("pmcid"), coerce.strip(F.col("title")).alias("title"))
    return publish.merged_list(one("log_papers"), one("log_excluded"), one("log_papers"))


INVENTORY = f"""{TIDY_LOG}, {LATEST}, one as (select pmcid, max({{'y': year, 't': title, 'j': coalesce(journal, '')}}) as r from log group by 1), b as (select pmcid, r.y as year, r.t as title, r.j as journal from one),
inv as (select row_number() over (order by b.year, b.pmcid) as no, b.pmcid, b.year, replace(b.journal, '|', chr(92) || '|') as journal, replace(b.title, '|', chr(92) || '|') as title,
  {bucket_sql(rules.EXPOSURE_BUCKETS).replace("title", "b.title")} as exposure, {bucket_sql(rules.OUTCOME_BUCKETS).replace("title", "b.title")} as outcome,
  case when b.pmcid in (select pmcid from latest where source_format = 'xml') then 'XML' else 'PDF' end as format from b)"""


def _head_sql(section: int, title: str, columns: list[str]) -> str:
    return f"select {section} as section, unnest([0, 1, 2, 3]) as place, unnest({report.table_head(title, columns)!r}) as line"


def _bucket_lines_sql(section: int, bucket: str, labels: list[str]) -> str:
    rows = f"select list_position({labels!r}, {bucket}) as place, {bucket} as b, (row_number() over (partition by {bucket} order by no) - 1) // 10000 as part, no, pmcid from inv"
    parts = f"select place, b, part, count(*) as n, string_agg(pmcid, ', ' order by no) as ids from ({rows}) group by all"
    return f"{_head_sql(section, f'By {bucket}', [bucket, 'n', 'ids'])} union all select {section}, row_number() over (order by place, part) + 3, '| ' || b || ' | ' || n || ' | ' || ids || ' |' from ({parts})"


_INV = ["no", "pmcid", "year", "journal", "title", "exposure", "outcome", "format"]


@query(
    f"""with {INVENTORY}
select 1 as section, unnest([0, 1, 2]) as place, unnest(['# Papers of the corpus', '', (select '> ' || count(*) || ' papers: ' || count_if(format = 'PDF') || ' PDF, ' || count_if(format = 'XML') || ' XML, ' || coalesce(min(nullif(year, '')), '') || '–' || coalesce(max(nullif(year, '')), '') || '; 0 abstracts only, 0 excluded.' from inv)]) as line
union all {_head_sql(2, "Inventory", _INV)} union all select 2, no + 3, '| ' || concat_ws(' | ', {", ".join(f"coalesce(cast({c} as varchar), '')" for c in _INV)}) || ' |' from inv
union all {_bucket_lines_sql(3, "exposure", [*rules.EXPOSURE_BUCKETS, rules.OTHER])}
union all {_bucket_lines_sql(4, "outcome", [*rules.OUTCOME_BUCKETS, rules.OTHER])}"""
)
def paper_summary_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of the inventory document with its place."""
    one = _log(spark, sf_dir).withColumn("journal", F.coalesce("journal", F.lit(""))).groupBy("pmcid").agg(F.max(F.struct("year", "title", "journal")).alias("r")).select("pmcid", "r.*")
    return publish.paper_summary(one, latest(spark, sf_dir).filter("source_format = 'xml'"))


@query(
    f"""with {LATEST}, {TIDY_LOG}, ids as (select pmcid, min(title) as title from log group by 1),
s as (select {id_sql()} as pmcid, bool_or({f"lower({strip_sql('status')})"} in ('ok', 'skipped')) as found, bool_or({f"lower({strip_sql('status')})"} = 'ok') as genuine from paper_results group by 1),
a as (select ids.pmcid, ids.title, coalesce(l.source_format, 'pdf') as format, coalesce(s.found, false) as found, coalesce(s.genuine, false) as genuine from ids left join s using (pmcid) left join latest l using (pmcid))
select unnest(case when found and genuine then case when format = 'xml' then ['downloaded', 'xml_only'] else ['downloaded'] end when found then ['abstract_only'] else ['failed'] end) as list, substring(pmcid, 4) as uid, pmcid, title from a"""
)
def download_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lists of a download run: a paper with an ok chunk is genuine, one with skipped ones only was found but is no full text."""
    status = F.lower(coerce.strip(F.col("status")))
    told = read_table(spark, sf_dir, "paper_results").groupBy(coerce.pmcid(F.col("pmcid")).alias("pmcid")).agg(F.bool_or(status.isin("ok", "skipped")).alias("found"), F.bool_or(status == "ok").alias("genuine"))
    ids = _log(spark, sf_dir).groupBy("pmcid").agg(F.min("title").alias("title"))
    attempts = ids.join(told, "pmcid", "left").join(latest(spark, sf_dir).select("pmcid", F.coalesce("source_format", F.lit("pdf")).alias("format")), "pmcid", "left")
    return publish.outcomes(attempts.withColumn("uid", F.substring("pmcid", 4, 100)).withColumn("format", F.coalesce("format", F.lit("pdf"))))


# point reads and small columns


@query(f"with {LATEST} select {as_text_sql(CHECKLIST_COLUMNS)} from latest where pmcid = (select min(pmcid) from latest)")
def get_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of one paper, asked for in lower case: the first one."""
    key = read_table(spark, sf_dir, "checklists").agg(F.min(coerce.pmcid(F.col("pmcid")))).first()[0] or ""
    return search.get(latest(spark, sf_dir), f" {key.lower()} ").select(*as_text(CHECKLIST_COLUMNS))


@query(f"with {LATEST} select pmcid, title from latest where pmcid in (select distinct {id_sql()} as p from log_papers order by p limit 5) order by pmcid limit 3")
def selected_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of given ids in order, at most three of them: what a run over a selection reads."""
    keys = [r.pmcid for r in _log(spark, sf_dir).select("pmcid").distinct().orderBy("pmcid").limit(5).collect()]
    return search.select_keys(latest(spark, sf_dir), [k[3:] for k in keys], 3).select("pmcid", "title")


@query("select rec_id, array_to_string(list_transform(data_accession_links, lambda x: regexp_replace(x, 'ftp://', 'https://')), ' | ') as links from checklists where data_accession_links is not null")
def https_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "checklists").filter("data_accession_links is not null")
    return rows.select("rec_id", F.array_join(F.transform("data_accession_links", tx.https), " | ").alias("links"))


@query(f"with {LATEST} select pmcid, '<h1>' || coalesce(title, '') || '</h1> ' || pmcid || ' (' || year || ') ' || pmcid as page from latest")
def filled_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = tx.fill_template(F.lit("<h1>%%TITLE%%</h1> %%ID%% (%%YEAR%%) %%ID%%"), {"TITLE": F.coalesce("title", F.lit("")), "ID": F.col("pmcid"), "YEAR": F.col("year")})
    return latest(spark, sf_dir).select("pmcid", page.alias("page"))


@query("select raw_id, list_has_all(json_keys(payload), ['title', 'year', 'summary']) as complete from raw_checklists where json_valid(payload) and json_type(payload) = 'OBJECT'")
def complete_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a record has the fields that a reader needs."""
    from lectern.operators.drift import readable

    rows = read_table(spark, sf_dir, "raw_checklists").select("raw_id", readable(F.col("payload")).alias("m")).filter("m is not null")
    return rows.select("raw_id", publish.has_all(F.map_keys("m"), ["title", "year", "summary"]).alias("complete"))


@query("select rec_id, title as words from checklists where title is not null")
def search_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of a search box from the address of its page, encoded as browsers do."""
    rows = read_table(spark, sf_dir, "checklists").filter("title is not null")
    address = F.concat(F.lit("http://localhost/search?q="), F.url_encode("title"), F.lit("&page=2"))
    return rows.select("rec_id", publish.search_words(address).alias("words"))


# processing results

DEDUPED = f"r as (select result_id, min({id_sql()}) as pmcid, min(coalesce(nullif({STATUS}, ''), 'unknown')) as status, max(attempt) as attempt, min(recorded_at) as recorded_at, min(chunk_no) as chunk_no from paper_results group by result_id)"


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a result; re-sent ones meet on the map side first."""
    rows = read_table(spark, sf_dir, "paper_results")
    status = coerce.or_unspecified(F.lower(F.col("status")), "unknown")
    return rows.groupBy("result_id").agg(F.min(coerce.pmcid(F.col("pmcid"))).alias("pmcid"), F.min(status).alias("status"), F.max("attempt").alias("attempt"), F.min("recorded_at").alias("recorded_at"), F.min("chunk_no").alias("chunk_no"))


@query(f"with {DEDUPED} select status, count(*) as n from r group by 1")
def run_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.counts(_results(spark, sf_dir), F.col("status"), "status")


@query(f"with {DEDUPED} select pmcid, chunk_no, max_by(status, {{'a': attempt, 'r': result_id}}) as status from r group by 1, 2")
def last_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _results(spark, sf_dir).groupBy("pmcid", "chunk_no").agg(F.max_by("status", F.struct("attempt", "result_id")).alias("status"))


@query(f"with {DEDUPED} select cast(recorded_at as date) as day, status, count(*) as n from r group by 1, 2")
def daily_tallies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _results(spark, sf_dir).groupBy(F.to_date("recorded_at").alias("day"), "status").agg(F.count(F.lit(1)).alias("n"))


@query("select count_if(json_valid(payload)) as n, count_if(not json_valid(payload)) as failures from raw_checklists")
def parse_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.operators.drift import readable

    good = readable(F.col("payload")).isNotNull()
    return read_table(spark, sf_dir, "raw_checklists").agg(F.count_if(good).alias("n"), F.count_if(~good).alias("failures"))


# searches by rule


def words_sql(c: str) -> str:
    return f"' ' || trim(regexp_replace(lower({c}), '[^a-z0-9]+', ' ', 'g')) || ' '"


def any_sql(words: str, terms: list[str]) -> str:
    return "(" + " or ".join(f"contains({words}, '{rules.phrase(t)}')" for t in terms) + ")"


def search_sql(s: rules.Search) -> str:
    wanted = [any_sql("both_words", g) for g in [*s.groups, rules.PEDIATRIC]] + [any_sql("title_words", g) for g in s.title_groups]
    return " and ".join([*wanted, f"not {any_sql('both_words', [*rules.NEGATIVE, *s.barred])}"])


@query(
    "select rec_id, array_to_string(list_sort(list_distinct(list_filter(["
    + ", ".join(f"case when {search_sql(s)} then {s.tier} end" for s in rules.SEARCHES)
    + "], lambda x: x is not null))), ',') as tiers from (select rec_id, "
    + words_sql("coalesce(title, '')") + " as title_words, " + words_sql("concat_ws(' ', coalesce(title, ''), summary)") + " as both_words from checklists)"
)
def boolean_query_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rules.with_tiers(read_table(spark, sf_dir, "checklists").select("rec_id", "title", "summary"), "title", "summary")
    return rows.select("rec_id", F.array_join(F.col("tiers").cast("array<string>"), ",").alias("tiers"))


@query(
    "select uid, array_to_string(list_sort(list_distinct(list_filter(["
    + ", ".join(f"case when {search_sql(s)} and not list_has_any(coalesce(pubtype, []), {rules.NEGATIVE_TYPES!r}) then {s.tier} end" for s in rules.SEARCHES)
    + "], lambda x: x is not null))), ',') as tiers from (select uid, pubtype, "
    + words_sql("coalesce(title, '')") + " as title_words, title_words as both_words from paper_metadata)"
)
def metadata_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiers by title, papers of barred publication types left without any."""
    rows = read_table(spark, sf_dir, "paper_metadata").select("uid", "title", F.lit(None).cast("string").alias("body"), "pubtype")
    return rules.with_tiers(rows, "title", "body", pubtype="pubtype").select("uid", F.array_join(F.col("tiers").cast("array<string>"), ",").alias("tiers"))


HITS = (
    "hits as (select pmcid, unnest(list_filter([" + ", ".join(f"case when {search_sql(s)} then {i} end" for i, s in enumerate(rules.SEARCHES, 1))
    + "], lambda x: x is not null)) as search from (select " + id_sql() + " as pmcid, " + words_sql("coalesce(title, '')") + " as title_words, " + words_sql("concat_ws(' ', coalesce(title, ''), summary)")
    + " as both_words from checklists where pmcid is not null))"
)


def _search_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "checklists").filter("pmcid is not null").select(coerce.pmcid(F.col("pmcid")).alias("pmcid"), "title", "summary")
    return rules.search_hits(rows, "title", "summary")


@query(f"with {HITS} select search, count(distinct pmcid) as n from hits group by 1")
def search_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers that each of the searches finds."""
    return _search_hits(spark, sf_dir).groupBy("search").agg(F.countDistinct("pmcid").alias("n"))


@query(f"with {HITS} select pmcid, count(distinct search) as n_searches, min(search) as first_search from hits group by 1")
def search_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The different papers of all searches, with how many found each and which was first."""
    return _search_hits(spark, sf_dir).groupBy("pmcid").agg(F.countDistinct("search").alias("n_searches"), F.min("search").alias("first_search"))


def queries() -> dict:
    return dict(REGISTRY.queries)


def oracle_sql() -> dict[str, str]:
    return dict(REGISTRY.sql)
