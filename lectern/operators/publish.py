"""What is published from the corpus: site records, a static page, the inventory, merged logs, a rebuilt batch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lectern.functions import rules, text as tx
from lectern.operators import report, store
from lectern.operators.search import ordered
from lectern.session import durable

#: Columns that the site shows. Fixed values.
SITE_COLUMNS = ["pmcid", "title", "year", "ehr_used", "summary", "pathologies_diseases", "exposure_domain", "data_source_type", "study_design", "data_availability", "data_accession_links", "confidence"]


def site_records(df: DataFrame) -> DataFrame:
    """The site's columns in canonical order; a column that is missing is null."""
    return ordered(df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in SITE_COLUMNS]))


def site_page(df: DataFrame, template: str) -> DataFrame:
    """(place, line): the template with its records as JSON, one a line, their number and their years; see store.write_envelope.

    Lines are numbered over ranges, so no task holds all records. Closing tags inside the JSON are broken so that they
    end no script. The template holds %%DATA%% once.
    """
    made = durable(site_records(df))
    told = made.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.min(F.nullif("year", F.lit(""))), F.lit("")).alias("first"), F.coalesce(F.max(F.nullif("year", F.lit(""))), F.lit("")).alias("last"))
    before, _, after = template.partition("%%DATA%%")
    fill = lambda text: tx.fill_template(F.lit(text), {"COUNT": F.col("n").cast("string"), "FIRST": F.col("first"), "LAST": F.col("last")})
    rows = report.numbered(made, ["year", "pmcid"])
    text = F.replace(F.to_json(F.struct(*SITE_COLUMNS)), F.lit("</"), F.lit("<\\/"))
    total = told.select("n").scalar()
    body = rows.select(F.col("no").cast("long").alias("place"), F.concat(text, F.when(F.col("no") < total, ",").otherwise("")).alias("line"))
    ends = told.select(F.posexplode(F.array(F.concat(fill(before), F.lit("[")), F.concat(F.lit("]"), fill(after)))).alias("i", "line"), "n")
    return body.unionByName(ends.select(F.when(F.col("i") == 0, F.lit(0).cast("long")).otherwise(F.col("n") + 1).alias("place"), "line"))


def inventory(papers: DataFrame, xml_only: DataFrame) -> DataFrame:
    """no, pmcid, year, journal, title, exposure, outcome, format of every paper; bars in cells are escaped."""
    marked = papers.join(xml_only.select("pmcid", F.lit(True).alias("_xml")), "pmcid", "left")
    title = F.col("title")
    cells = marked.select("pmcid", "year", tx.escape_bars(F.coalesce("journal", F.lit(""))).alias("journal"), tx.escape_bars(title).alias("title"), rules.first_bucket(title, rules.EXPOSURE_BUCKETS).alias("exposure"), rules.first_bucket(title, rules.OUTCOME_BUCKETS).alias("outcome"), F.when(F.col("_xml"), "XML").otherwise("PDF").alias("format"))
    return report.numbered(cells, ["year", "pmcid"]).select("no", *cells.columns)


def paper_summary(papers: DataFrame, xml_only: DataFrame, abstract_only: int = 0, excluded: int = 0, title: str = "Papers of the corpus") -> DataFrame:
    """(section, place, line) of the inventory document, to be written in that order (see write_lines).

    A heading with counts and years, the inventory, and the papers of each exposure and outcome bucket. Buckets with more
    than 10,000 papers take several lines, so no line and no task holds a whole bucket.
    """
    rows = durable(inventory(papers, xml_only))
    top = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("format") == "XML").alias("xml"), F.coalesce(F.min(F.nullif("year", F.lit(""))), F.lit("")).alias("first"), F.coalesce(F.max(F.nullif("year", F.lit(""))), F.lit("")).alias("last"))
    said = F.array(F.lit(f"# {title}"), F.lit(""), F.format_string("> %d papers: %d PDF, %d XML, %s–%s; %d abstracts only, %d excluded.", "n", F.col("n") - F.col("xml"), "xml", "first", "last", F.lit(abstract_only), F.lit(excluded)))
    lines = top.select(F.lit(1).alias("section"), F.posexplode(said).alias("place", "line")).withColumn("place", F.col("place").cast("long"))
    names = ["no", "pmcid", "year", "journal", "title", "exposure", "outcome", "format"]
    lines = lines.unionByName(report.table_lines(rows, names, report.table_head("Inventory", names), 2, ["no"]))
    for section, (bucket, table) in enumerate((("exposure", rules.EXPOSURE_BUCKETS), ("outcome", rules.OUTCOME_BUCKETS)), 3):
        parts = report.id_parts(rows.drop("title"), F.col(bucket), ["no"], [*table, rules.OTHER])
        lines = lines.unionByName(report.table_lines(parts, ["bucket", "n", "ids"], report.table_head(f"By {bucket}", [bucket, "n", "ids"]), section, ["place", "part"]))
    return lines


def write_lines(lines: DataFrame, folder: str) -> None:
    """The lines of a document as text files whose names follow its order."""
    lines.repartitionByRange("section", "place").sortWithinPartitions("section", "place").select("line").write.mode("overwrite").text(folder)


def merged_list(*parts: DataFrame) -> DataFrame:
    """The rows of lists one after the other, each different row once, where it came first: (place, columns)."""
    placed = [p.withColumn("_list", F.lit(i)).withColumn("_row", F.monotonically_increasing_id()) for i, p in enumerate(parts)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), placed)
    columns = [c for c in rows.columns if c not in ("_list", "_row")]
    first = rows.groupBy(*columns).agg(F.min(F.struct("_list", "_row")).alias("_first"))
    return first.orderBy("_first").select(*columns)


def merged_keys(base: Column, fresh: Column) -> Column:
    """Two maps as one; where both have a key, the value of the fresh one counts, null included."""
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.coalesce(F.map_contains_key(fresh, k), F.lit(False))), fresh)


def outcomes(attempts: DataFrame) -> DataFrame:
    """(list, uid, pmcid, title): the lists of a download run that each attempt goes to.

    attempts has uid, pmcid, title, format, found (any bytes) and genuine (a full text). A genuine one is downloaded, if
    XML also xml_only; one that was found but is no full text is abstract_only, the rest failed. Nulls count as false.
    """
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    kept = F.when(F.col("format") == "xml", F.array(F.lit("downloaded"), F.lit("xml_only"))).otherwise(F.array(F.lit("downloaded")))
    lists = F.when(yes("found") & yes("genuine"), kept).when(yes("found"), F.array(F.lit("abstract_only"))).otherwise(F.array(F.lit("failed")))
    return attempts.select(F.explode(lists).alias("list"), "uid", "pmcid", "title")


def changed(base: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Rows of the batch that the store lacks or has otherwise."""
    return store.upsert_plan(base, batch, key).filter(F.col("action").isin("insert", "update"))


def rebuild(shelf: store.SnapshotStore, records: DataFrame) -> tuple[int, int, int]:
    """Import read_records into the store, unreadable and invalid files left out: (inserted, updated, left out).

    Records whose file is gone stay in the store.
    """
    checked = durable(_checked(records))
    left_out = checked.filter("_bad").count()
    inserted, updated = shelf.import_records(checked.filter("not _bad").drop("_bad", "reject"))
    return inserted, updated, left_out


def _checked(records: DataFrame) -> DataFrame:
    """validated records of good files and a row of nulls for each unreadable one, all with _bad."""
    good = store.validated(records.filter("_corrupt_record is null"))
    lost = records.filter("_corrupt_record is not null").select(F.lit("unreadable").alias("reject"))
    return good.unionByName(lost, allowMissingColumns=True).withColumn("_bad", F.col("reject").isNotNull())


def has_all(present: Column, fields: list[str]) -> Column:
    """Whether a list of present fields has all of those given."""
    return F.size(F.array_except(F.array(*map(F.lit, fields)), present)) == 0


def search_words(url: Column) -> Column:
    """The text of the parameter q of an address, '' if there is none."""
    return F.coalesce(F.url_decode(F.parse_url(url, F.lit("QUERY"), F.lit("q"))), F.lit(""))
