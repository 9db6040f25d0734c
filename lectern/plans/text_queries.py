"""Queries that exercise the text functions over documents, statements and small fixtures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.functions import coerce, jsonfix, rules, text as tx
from lectern.operators import merge
from lectern.plans import availability
from lectern.plans.corpus_queries import confidence_sql, id_sql, strip_sql
from lectern.plans.registry import Registry
from lectern.session import read_table
from lectern.sources import fulltext

REGISTRY = Registry()
query = REGISTRY.add

def fixture(spark: SparkSession, ddl: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, ddl)


def values_sql(columns: str, rows: list[tuple]) -> str:
    cell = lambda v: "null" if v is None else str(v) if isinstance(v, (int, float, bool)) else "'" + v.replace("'", "''") + "'"
    return f"(values {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) t({columns})"


def extract_all_sql(c: str, patterns: list[str]) -> str:
    return "list_concat(" + ", ".join(f"regexp_extract_all({c}, '{p}', 1)" for p in patterns) + ")"


def unwrap_sql(c: str) -> str:
    return rf"regexp_replace(regexp_replace({c}, '(\w)\s*-\s*\n\s*(\w)', '\1-\2', 'g'), '-\s*\n\s*', '', 'g')"


def ordered_distinct_sql(c: str) -> str:
    return f"list_filter({c}, lambda x, i: list_position({c}, x) = i)"


#: Identifiers in the statements of the test tables.
DEPOSITS = [r"\b(phs\d{6}(?:\.v\d+\.p\d+)?)\b", r"\b(GSE\d{4,})\b", r"\b(PRJ[A-Z]{2}\d{4,})\b", r"\b(E-[A-Z]{4}-\d+)\b", r"(https?://[^\s)]*[^\s).,;])", r"(doi:10\.\d+/[a-z]+\.\d+)"]


@query(f"with l as (select rec_id, {extract_all_sql('data_availability_statement', tx.ACCESSIONS)} as l from checklists where data_availability_statement is not null) select rec_id, array_to_string({ordered_distinct_sql('l')}, ' | ') as links from l")
def accession_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "checklists").filter("data_availability_statement is not null")
    return rows.select("rec_id", F.array_join(tx.accession_links(F.col("data_availability_statement")), " | ").alias("links"))


@query(f"with l as (select rec_id, {extract_all_sql('data_availability_statement', DEPOSITS)} as l from checklists where data_availability_statement is not null) select rec_id, array_to_string({ordered_distinct_sql('l')}, ' | ') as links from l where len(l) > 0")
def deposit_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "checklists").filter("data_availability_statement is not null")
    found = F.array_distinct(F.concat(*[F.regexp_extract_all("data_availability_statement", F.lit(p), F.lit(1)) for p in DEPOSITS]))
    return rows.select("rec_id", found.alias("l")).filter("size(l) > 0").select("rec_id", F.array_join("l", " | ").alias("links"))


LINK_TEXTS = [
    (1, "Files at https://github.com/lab-one/early-\n life-rations and GSE12345."),
    (2, "Deposited in dbGaP phs001234.v1.p1; ENA: PRJEB45678."),
    (3, "See https://zenodo.org/records/998877 , https://doi.org/10.5281/zenodo.55443"),
    (4, "PRJ|12345 and PRJNA99887 in ArrayExpress E-MTAB-1234"),
    (5, "a-\nb-\nc"),
    (6, "nothing here"),
    (7, ""),
]


@query(rf"with l as (select id, {unwrap_sql('body')} as body from {values_sql('id, body', LINK_TEXTS)}), m as (select *, {extract_all_sql('body', tx.ACCESSIONS)} as l from l) select id, body, array_to_string({ordered_distinct_sql('l')}, ' | ') as links from m")
def wrap_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture(spark, "id int, body string", LINK_TEXTS)
    return rows.select("id", tx.unwrap(F.col("body")).alias("body"), F.array_join(tx.accession_links(F.col("body")), " | ").alias("links"))


@query(rf"with l as (select doc_id, {unwrap_sql('text')} as body from documents), m as (select *, {extract_all_sql('body', tx.ACCESSIONS)} as l from l) select doc_id, md5(body) as digest, array_to_string({ordered_distinct_sql('l')}, ' | ') as links from m")
def wrap_repair_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "documents")
    return rows.select("doc_id", F.md5(tx.unwrap(F.col("text"))).alias("digest"), F.array_join(tx.accession_links(F.col("text")), " | ").alias("links"))


AT = f"instr(text, regexp_extract(text, '{tx.AVAILABILITY_HEADING}'))"


@query(f"select doc_id, md5(case when regexp_matches(text, '{tx.AVAILABILITY_HEADING}') then substring(text, greatest({AT} - 200, 1), 6000) else right(text, 6000) end) as digest from documents")
def da_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", F.md5(tx.availability_window(F.col("text"))).alias("digest"))


WINDOWS = f"""t as (select cast(doc_id as varchar) as doc_id, coalesce({strip_sql('text')}, '') as t from documents),
w as (select doc_id, case when regexp_matches(t, '{tx.AVAILABILITY_HEADING}') then substring(t, greatest(instr(t, regexp_extract(t, '{tx.AVAILABILITY_HEADING}')) - 200, 1), 6000) else right(t, 6000) end as w from t),
l as (select *, {extract_all_sql(unwrap_sql('w'), tx.ACCESSIONS)} as l from w)"""


@query(
    rf"""with {WINDOWS} select doc_id, case when len(l) > 0 then 'public-repository' end as data_availability, case when len(l) > 0 then array_to_string({ordered_distinct_sql('l')}, ' | ') end as links,
  case when len(l) > 0 then coalesce(nullif(left({strip_sql(f"regexp_extract(w, '{tx.EVIDENCE}')")}, 300), ''), 'Data deposited in a public repository.') end as statement, case when len(l) > 0 then 'patterns' else 'none' end as told_by from l"""
)
def availability_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan without a model, over every document: what the patterns alone tell."""
    papers = read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("pmcid"), F.lit("").alias("title"), F.lit("").alias("year"), "text")
    found = availability.scan(papers)
    return found.select(F.col("pmcid").alias("doc_id"), "data_availability", F.array_join("data_accession_links", " | ").alias("links"), F.col("data_availability_statement").alias("statement"), "told_by")


@query(
    rf"""with l as (select *, {extract_all_sql(unwrap_sql("coalesce(data_availability_statement, '')"), tx.ACCESSIONS)} as found from checklists)
select rec_id, case when len(found) > 0 then 'public-repository' else data_availability end as data_availability,
  array_to_string(case when len(found) > 0 then {ordered_distinct_sql("list_concat(coalesce(data_accession_links, []), found)")} else data_accession_links end, ' | ') as links from l"""
)
def links_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record after the identifiers in its own statement are added to what it says."""
    made = merge.with_links_found(F.col("data_accession_links"), F.col("data_availability"), F.col("data_availability_statement"), F.coalesce("data_availability_statement", F.lit("")))
    return read_table(spark, sf_dir, "checklists").select("rec_id", made.alias("m")).select("rec_id", "m.data_availability", F.array_join("m.data_accession_links", " | ").alias("links"))


@query(rf"select doc_id, left({strip_sql(f"regexp_extract(text, '{tx.EVIDENCE}')")}, 300) as evidence from documents where regexp_matches(text, '{tx.EVIDENCE}')")
def evidence_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select("doc_id", tx.evidence(F.col("text")).alias("evidence")).filter("evidence is not null")


CHUNKS = f"""with d as (select doc_id, {strip_sql('text')} as t from documents),
c as (select doc_id, t, unnest(range(0, greatest(cast(ceil((length(t) - 4000) / 3400.0) as int), 0) + 1)) as piece from d)"""


@query(f"{CHUNKS} select doc_id, piece, length(substring(t, piece * 3400 + 1, 4000)) as n_chars, md5(substring(t, piece * 3400 + 1, 4000)) as digest from c")
def chunk_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = read_table(spark, sf_dir, "documents").select("doc_id", F.posexplode(tx.chunks(F.col("text"))).alias("piece", "t"))
    return pieces.select("doc_id", F.col("piece").cast("long").alias("piece"), F.length("t").cast("long").alias("n_chars"), F.md5("t").alias("digest"))


@query(f"{CHUNKS} select count(*) as pieces, count(distinct doc_id) as documents, max(piece) + 1 as most from c")
def chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = read_table(spark, sf_dir, "documents").select("doc_id", F.size(tx.chunks(F.col("text"))).alias("n"))
    return pieces.agg(F.sum("n").alias("pieces"), F.countDistinct("doc_id").alias("documents"), F.max("n").cast("long").alias("most"))


def says_sql(c: str) -> str:
    return f"{strip_sql(c)} <> '' and lower({strip_sql(c)}) <> 'n/a'"


def first_said_sql(c: str) -> str:
    return f"coalesce(min_by({strip_sql(c)}, rec_id) filter (where {says_sql(c)}), '') as {c}"


def union_sql(c: str) -> str:
    flat = f"flatten(list({c} order by rec_id) filter (where {c} is not null))"
    clean = f"list_filter(list_transform(coalesce({flat}, []), lambda x: {strip_sql('x')}), lambda x: x <> '')"
    return f"array_to_string({ordered_distinct_sql(clean)}, ' | ') as {c}"


MERGED_TEXTS = ["summary", "study_design", "data_source_type", "population", "exposure_domain"]
MERGED_LISTS = ["key_findings", "captured_features", "pathologies_diseases", "limitations"]


@query(
    f"""select {id_sql()} as pmcid, coalesce(bool_or(ehr_used), false) as ehr_used,
  coalesce(nullif(left(string_agg({strip_sql('ehr_evidence')}, ' ' order by rec_id) filter (where {says_sql('ehr_evidence')}), 500), ''), 'n/a') as ehr_evidence,
  {', '.join(map(first_said_sql, MERGED_TEXTS))}, {', '.join(map(union_sql, MERGED_LISTS))},
  ['unclear', 'low', 'medium', 'high'][max(list_position(['unclear', 'low', 'medium', 'high'], {confidence_sql('confidence')}))] as confidence
from checklists where pmcid is not null group by 1"""
)
def chunk_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read_table(spark, sf_dir, "checklists").filter("pmcid is not null").withColumn("pmcid", coerce.pmcid(F.col("pmcid")))
    out = merge.merge_chunks(parts, "pmcid", "rec_id", flag="ehr_used", evidence="ehr_evidence", texts=MERGED_TEXTS, lists=MERGED_LISTS, confidence="confidence")
    return out.select(*[F.array_join(c, " | ").alias(c) if c in MERGED_LISTS else F.col(c) for c in out.columns])


@query()
def json_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "raw_checklists").select(F.col("raw_id").alias("id"), jsonfix.salvaged_json("payload").alias("found"))


PROSE = [
    (1, '* `data_availability`: "public-repository"\n* links: GSE12345 and https://zenodo.org/records/77\n"The data were deposited in a public archive."'),
    (2, "data_availability: not stated"),
    (3, "data_availability: in-house, GSE99999"),
    (4, "nothing to say"),
]


REPLIES = [
    (1, 'Sure:\n```json\n{"a": 1}\n```\nDone.', '{"a": 1}'),
    (2, 'noise {"a": {"b": 2}} trailing', '{"a": {"b": 2}}'),
    (3, '{"a": 1} and {"a": 2, "b": 3}', '{"a": 2, "b": 3}'),
    (4, '{"a": {"b": 1}', '{"a": {"b": 1}}'),
    (5, '{"a": 1, ', '{"a": 1}'),
    (6, "garbage", None),
    (7, None, None),
]


@query(f"select id, found from {values_sql('id, reply, found', REPLIES)}")
def salvaged_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies in prose, cut off and fenced, against the objects they hold."""
    return fixture(spark, "id int, reply string, found string", REPLIES).select("id", jsonfix.salvaged_json("reply").alias("found"))


TOLD = [(1, "public-repository", "GSE12345 | https://zenodo.org/records/77", "The data were deposited in a public archive."), (2, "not-stated", "", ""), (3, "in-house", "", ""), (4, None, None, None)]


@query(f"select * from {values_sql('id, data_availability, links, data_availability_statement', TOLD)}")
def availability_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = fixture(spark, "id int, reply string", PROSE).select("id", jsonfix.availability_reply(F.col("reply")).alias("r"))
    return told.select("id", "r.data_availability", F.array_join("r.data_accession_links", " | ").alias("links"), "r.data_availability_statement")


MEMBERS = [
    ("a.tgz", 0, "x/main.pdf", 900),
    ("a.tgz", 1, "x/main_supp1.pdf", 5000),
    ("a.tgz", 2, "x/other.pdf", 900),
    ("a.tgz", 3, "x/data.csv", 9000),
    ("b.tgz", 0, "fig1.pdf", 10),
    ("c.tgz", 0, "notes.PDF", 10),
    ("d.tgz", 0, "paper.pdf", 1),
]


@query(rf"select path, arg_max(name, {{'s': size, 'p': -pos}}) as name, max(size) as size from {values_sql('path, pos, name, size', MEMBERS)} where name like '%.pdf' and not regexp_matches(regexp_extract(name, '[^/]*$'), '{tx.SUPPLEMENTARY}') group by 1")
def tar_main_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fulltext.main_member(fixture(spark, "path string, pos int, name string, size long", MEMBERS))


OFFERS = [("PMC1", "pdf", "u1"), ("PMC1", "xml", "u2"), ("PMC2", "tgz", "u3"), ("PMC3", "xml", "u4"), ("PMC4", "pdf", None), ("PMC4", "xml", "u5")]


@query(f"with o as (select * from {values_sql('pmcid, kind, value', OFFERS)}), k as (select unnest(['PMC1', 'PMC2', 'PMC3', 'PMC4', 'PMC5']) as pmcid) select k.pmcid, arg_min(kind, list_position(['pdf', 'tgz', 'xml'], kind)) filter (where value is not null) as found_by, arg_min(value, list_position(['pdf', 'tgz', 'xml'], kind)) filter (where value is not null) as value from k left join o using (pmcid) group by 1")
def oa_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    offers = fixture(spark, "pmcid string, kind string, value string", OFFERS)
    ask = lambda kind: (kind, lambda keys: keys.join(offers.filter(F.col("kind") == kind), "pmcid").select("pmcid", "value"))
    keys = fixture(spark, "pmcid string", [(f"PMC{i}",) for i in range(1, 6)])
    return fulltext.cascade(keys, "pmcid", [ask("pdf"), ask("tgz"), ask("xml")])


TITLES = [
    (1, "Prenatal smoking and asthma"),
    (2, "Smoking cessation and lung function"),
    (3, "DDT and growth"),
    (4, "Lead and PM2.5"),
    (5, "ACEs in youth"),
    (6, None),
    (7, "Thyroid and pesticide"),
]


@query(
    f"""select id, case when title is null then '{rules.OTHER}' when regexp_matches(regexp_replace(lower(title), 'smok(e|ing)\\s+(cessation|quit)', ' ', 'g'), 'smok|air pollution|ozone') then 'Air pollution'
  when regexp_matches(lower(title), '\\blead\\b|metals?') then 'Metals / lead' when regexp_matches(lower(title), 'pesticide') then 'Chemicals / EDC' when regexp_matches(lower(title), 'prenatal') then 'Prenatal / perinatal' else '{rules.OTHER}' end as bucket from {values_sql('id, title', TITLES)}"""
)
def bucket_fixture_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, "id int, title string", TITLES).select("id", rules.first_bucket(F.col("title"), rules.EXPOSURE_BUCKETS).alias("bucket"))


@query("select rec_id, replace(replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') as html, replace(title, '|', '\\|') as cell from checklists where title is not null")
def escaped_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.col("title")
    return read_table(spark, sf_dir, "checklists").filter("title is not null").select("rec_id", tx.escape_html(title).alias("html"), tx.escape_bars(title).alias("cell"))


PATHS = [("/a/2020_PMC7145790_Some_title.pdf",), ("/b/PMC12.v2.xml",), ("/c/no-number.txt",), ("rel_PMC9_PMC10.pdf",)]


@query(rf"select path, coalesce(nullif(regexp_extract(stem, 'PMC\d+'), ''), stem) as pmcid, case when lower(suffix) in ('pdf', 'xml') then lower(suffix) else 'text' end as format from (select path, regexp_replace(regexp_extract(path, '[^/]*$'), '\.[^.]*$', '') as stem, regexp_extract(path, '\.([^./]*)$', 1) as suffix from {values_sql('path', PATHS)})")
def paths_to_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.sources.files import file_format

    return fixture(spark, "path string", PATHS).select("path", tx.pmcid_in_path(F.col("path")).alias("pmcid"), file_format(F.col("path")).alias("format"))


CELLS = [(1, "short"), (2, "a | b"), (3, "one two three four five six"), (4, "unbroken" * 4), (5, "   "), (6, None), (7, "ends with comma, then more")]


@query(
    rf"""select id, case when length(cell) <= 20 then case when cell = '' then '—' else cell end
  else regexp_replace(case when contains(left(cell, 20), ' ') then regexp_replace(left(cell, 20), ' [^ ]*$', '') else left(cell, 20) end, '[ ,;:.-]+$', '') || '…' end as cell
from (select id, {strip_sql("replace(body, '|', '/')")} as cell from {values_sql('id, body', CELLS)})"""
)
def clip_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture(spark, "id int, body string", CELLS).select("id", tx.clip(F.col("body"), 20).alias("cell"))


@query(
    rf"""select rec_id, case when length(cell) <= 110 then case when cell = '' then '—' else cell end
  else regexp_replace(case when contains(left(cell, 110), ' ') then regexp_replace(left(cell, 110), ' [^ ]*$', '') else left(cell, 110) end, '[ ,;:.-]+$', '') || '…' end as cell
from (select rec_id, {strip_sql("replace(summary, '|', '/')")} as cell from checklists)"""
)
def clip_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "checklists").select("rec_id", tx.clip(F.col("summary"), 110).alias("cell"))


def queries() -> dict:
    return dict(REGISTRY.queries)


def oracle_sql() -> dict[str, str]:
    return dict(REGISTRY.sql)
