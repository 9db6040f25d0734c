"""Queries of the training-data operators, each over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.functions import coerce
from lectern.llm import canonical, duplicates, frequency, language, mixing, packing, tokens, truncation
from lectern.session import durable, read_table

TYPED_FIELDS = ["exposure_domain", "study_design", "data_source_type"]


def _p1_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = read_table(spark, sf_dir, "canonical_terms")
    values = canonical.typed_values(read_table(spark, sf_dir, "checklists"), TYPED_FIELDS)
    return canonical.map_values(canonical.without_exact(values, terms), terms)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p1_mapped(spark, sf_dir).select("rec_id", "field", "term_id")


def p1_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.unmatched_report(_p1_mapped(spark, sf_dir))


CUT_FIELDS = ["summary", "data_availability_statement", "ehr_evidence"]


def _p2_truncated(rows: DataFrame) -> DataFrame:
    return truncation.truncated(rows, CUT_FIELDS, record=coerce.pmcid(F.col("pmcid")))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p2_truncated(read_table(spark, sf_dir, "checklists")).select(F.col("id").alias("rec_id"), "field")


def p2_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "checklists")
    return truncation.shares(rows, _p2_truncated(rows), CUT_FIELDS).withColumnRenamed("source", "feed")


def p2_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "checklists")
    return truncation.limits(durable(truncation.open_texts(truncation.texts_of(rows, CUT_FIELDS, "rec_id", "feed"), CUT_FIELDS))).withColumnRenamed("source", "feed")


TERM_FIELDS = ["pathologies_diseases", "captured_features"]


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_terms(spark, sf_dir).filter("mark is not null").select("field", "term", "mark")


def p3_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "checklists")
    counts = frequency.term_counts(rows, TERM_FIELDS)
    return frequency.marked(counts, rows).select("field", "term", "occurrences", F.col("n_records").alias("n_rows"), "mark")


#: Columns of a checklists row that tell of its delivery, not of the record.
DELIVERY = {"rec_id", "feed", "delivered_at"}


def _p5_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "checklists")
    return durable(duplicates.record_keys(rows, [c for c in rows.columns if c not in DELIVERY], "rec_id"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.copies(_p5_keys(spark, sf_dir)).select(F.col("first_id").alias("first_rec_id"), F.col("copy_id").alias("copy_rec_id"))


def p5_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.groups(_p5_keys(spark, sf_dir)).select(F.col("first_id").alias("rec_id"), "n_copies")


def _p6_packed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, int]]:
    sizes = packing.capacities(read_table(spark, sf_dir, "container_sizes"))
    return packing.pack(read_table(spark, sf_dir, "documents"), sizes), sizes


def p6_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p6_packed(spark, sf_dir)[0]


def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill_report(*_p6_packed(spark, sf_dir))


def p6_placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in every container set: whole, its pieces follow one another and only a longer text has several; fits, in containers no fuller than full."""
    packed, sizes = _p6_packed(spark, sf_dir)
    return packing.placements(packed, sizes)


def _p7(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Draws, budgets and the queue."""
    sizes = mixing.kept_sizes(tokens.with_tokens(read_table(spark, sf_dir, "documents"), keep=["doc_id", "source"]))
    queue = mixing.queued(sizes)
    budget = mixing.budgets(queue, read_table(spark, sf_dir, "mix_targets"))
    return mixing.mixed(queue, budget), budget, queue


def p7_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _p7(spark, sf_dir)[0].withColumnRenamed("id", "doc_id")


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.shares(*_p7(spark, sf_dir)[:2])


def p7_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every target: its repeats kept, its mix within the budget, its share of the budget met within a text or two."""
    return mixing.within(*_p7(spark, sf_dir))


def _p8_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").withColumnRenamed("lang", "label")
    return language.identify(documents, language.fitted(documents, label="label"), keep=["label"])


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.mislabelled(_p8_labelled(spark, sf_dir), "label")


def p8_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = _p8_labelled(spark, sf_dir)
    return labelled.select("doc_id", F.col("lang").alias("doc_lang"), F.col("confidence").alias("doc_confidence"), F.posexplode("segments").alias("segment", "s")).select("doc_id", "doc_lang", "doc_confidence", "segment", "s.*")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": p1_found,
        "p1_unmatched": p1_unmatched,
        "p2_found": p2_found,
        "p2_shares": p2_shares,
        "p2_limits": p2_limits,
        "p3_found": p3_found,
        "p3_terms": p3_terms,
        "p5_found": p5_found,
        "p5_records": p5_records,
        "p6_packed": p6_packed,
        "p6_fill": p6_fill,
        "p6_placed": p6_placed,
        "p7_mixed": p7_mixed,
        "p7_shares": p7_shares,
        "p7_within": p7_within,
        "p8_found": p8_found,
        "p8_segments": p8_segments,
    }


BLANKS = r"[\s\x0B\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"

P3_TERMS = f"""
with entries as (
  select 'pathologies_diseases' as field, rec_id, unnest(pathologies_diseases) as entry from checklists
  union all
  select 'captured_features', rec_id, unnest(captured_features) from checklists
), tidy as (
  select field, rec_id, trim(regexp_replace(lower(entry), '{BLANKS}', ' ', 'g')) as term from entries
), counted as (
  select field, term, count(*) as occurrences, count(distinct rec_id) as n_rows from tidy where term <> '' group by all
)
select field, term, occurrences, n_rows,
  case when n_rows < 3 then 'rare' when 20 * n_rows > (select count(*) from checklists) then 'common' end as mark
from counted
"""


def _plain_sql(text: str) -> str:
    return f"lower(regexp_replace(upper({text}), '[^\\p{{L}}\\p{{N}}]+', '', 'g'))"


def _p5_sql() -> str:
    texts = "title year ehr_evidence summary study_design data_source_type population exposure_domain data_availability data_availability_statement confidence source_format model pmcid".split()
    lists = "key_findings captured_features pathologies_diseases limitations data_accession_links".split()
    columns = [f"{_plain_sql(c)} as {c}" for c in texts] + ["ehr_used"]
    columns += [f"list_sort(list_filter(list_transform({c}, lambda x: {_plain_sql('x')}), lambda x: x <> '')) as {c}" for c in lists]
    return f"""
with plain as (select rec_id, {", ".join(columns)} from checklists),
grouped as (
  select min(rec_id) as first_rec_id, count(*) as n_copies, list(rec_id) as members
  from plain group by {", ".join([*texts, "ehr_used", *lists])}
)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p3_found": f"select field, term, mark from ({P3_TERMS}) where mark is not null",
        "p3_terms": P3_TERMS,
        "p5_found": _p5_sql() + "select first_rec_id, copy_rec_id from (select first_rec_id, unnest(members) as copy_rec_id from grouped) where copy_rec_id <> first_rec_id",
        "p5_records": _p5_sql() + "select first_rec_id as rec_id, n_copies from grouped",
        "p6_placed": "select container_set, doc_id, true as whole, true as fits from documents, container_sizes",
        "p7_within": "select mix_name, lower(trim(source)) as source, true as repeats_kept, true as budget_kept, true as share_met from mix_targets",
    }
