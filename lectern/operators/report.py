"""Report queries: grouped counts, first-seen top lists, fixed histograms, inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.functions import coerce, text as tx
from lectern.session import durable


def headline(df: DataFrame) -> DataFrame:
    """n, n_ehr, n_no_ehr and the whole percent of ehr (null for no rows); a null flag is in neither count."""
    n = F.count(F.lit(1))
    ehr = F.count_if("ehr_used")
    return df.agg(n.alias("n"), ehr.alias("n_ehr"), F.count_if(~F.col("ehr_used")).alias("n_no_ehr"), F.floor(F.try_divide(100 * ehr, n)).cast("long").alias("percent_ehr"))


def counts(df: DataFrame, key: Column, name: str) -> DataFrame:
    return df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def shares(df: DataFrame, key: Column, name: str) -> DataFrame:
    """Counts with their percent of all, largest first, then by lower-cased key."""
    counted = counts(df, key, name)
    # summed over the groups, whose exchange is read again: the rows are not
    return counted.withColumn("percent", tx.percent(F.col("n"), counted.agg(F.sum("n")).scalar())).orderBy(F.desc("n"), F.lower(name), name)


def span(df: DataFrame, column: str) -> DataFrame:
    """First and last value that is not blank ('' if none) and how many there are."""
    value = F.nullif(coerce.strip(F.col(column)), F.lit(""))
    return df.agg(F.coalesce(F.min(value), F.lit("")).alias("first"), F.coalesce(F.max(value), F.lit("")).alias("last"), F.countDistinct(value).alias("n_distinct"))


def top_first_seen(df: DataFrame, entries: Column, k: int, order: list[str], name: str = "value") -> DataFrame:
    """The k most frequent entries; of equal counts, the one seen first in order and place in the list comes first.

    Counts occurrences. Each group carries the least (order, place), so no global window is needed.
    """
    each = df.select(*order, F.posexplode(entries).alias("_pos", "_v"))
    counted = each.groupBy(F.lower(coerce.strip(F.col("_v"))).alias(name)).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*order, "_pos")).alias("_first"))
    return counted.filter(F.col(name).isNotNull()).orderBy(F.desc("n"), "_first").limit(k).drop("_first")


def top_values(df: DataFrame, column: str, k: int, order: list[str], width: int | None = None) -> DataFrame:
    """The k most frequent values of a text column, blank ones as unspecified, first seen first."""
    value = coerce.or_unspecified(F.col(column))
    counted = df.groupBy(value.alias(column)).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*order)).alias("_first"))
    out = counted.orderBy(F.desc("n"), "_first").limit(k).drop("_first")
    return out.withColumn(column, F.left(column, F.lit(width))) if width else out


def histogram(df: DataFrame, value: Column, domain: list[str], name: str) -> DataFrame:
    """Counts of every value of a fixed domain in its order, zero where there is none."""
    rows = df.sparkSession.createDataFrame([(i, v) for i, v in enumerate(domain, 1)], f"place int, {name} string")
    return F.broadcast(rows).join(counts(df, value, name), name, "left").select("place", name, F.coalesce("n", F.lit(0)).alias("n")).orderBy("place")


def numbered(df: DataFrame, order: list[str], name: str = "no") -> DataFrame:
    """Rows numbered from 1 in a total order, without gathering them: ranges are counted, then numbered inside."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id())
    kept = durable(ranged)
    sizes = kept.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return kept.withColumn("_i", inside).join(before, "_part").withColumn(name, F.col("_i") + F.col("_before")).drop("_i", "_before", "_part")


def checklist_lines(df: DataFrame) -> DataFrame:
    """One row a record: no, pmcid, year, ehr, diseases, source, summary as table cells; cells are made before rows are numbered."""
    diseases = F.array_join(F.slice(F.coalesce("pathologies_diseases", F.array().cast("array<string>")), 1, 3), "; ")
    cells = df.select("pmcid", "year", F.when(F.col("ehr_used"), "✓").otherwise("").alias("ehr"), tx.clip(F.coalesce(F.nullif(diseases, F.lit("")), F.lit("—")), 50).alias("diseases"), tx.clip(F.coalesce(F.nullif(F.col("data_source_type"), F.lit("")), F.lit("—")), 30).alias("source"), tx.clip(F.coalesce("summary", F.lit("")), 110).alias("summary"))
    return numbered(cells, ["year", "pmcid"]).select("no", *cells.columns)


def ehr_rows(df: DataFrame) -> DataFrame:
    """pmcid, year, diseases, source, title of the records that use health records, as table cells in canonical order."""
    cell = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("—"))
    used = df.filter(F.col("ehr_used") == F.lit(True))
    return used.select("pmcid", "year", F.left(cell(F.array_join("pathologies_diseases", "; ")), F.lit(60)).alias("diseases"), F.left(cell(F.col("data_source_type")), F.lit(30)).alias("source"), tx.clip(F.coalesce("title", F.lit("")), 70).alias("title")).orderBy("year", "pmcid")


def table_lines(df: DataFrame, columns: list[str], head: list[str], section: int, order: list[str]) -> DataFrame:
    """(section, place, line): a titled table's lines, places from 0, rows numbered over ranges; made of any number of rows."""
    cells = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), F.lit(" |"))
    body = numbered(df.select(*dict.fromkeys([*order]), cells.alias("line")), order, "_no")
    top = df.sparkSession.createDataFrame([(section, i, x) for i, x in enumerate(head)], "section int, place long, line string")
    return top.unionByName(body.select(F.lit(section).alias("section"), (F.col("_no") + len(head) - 1).alias("place"), "line"))


def table_head(title: str, columns: list[str]) -> list[str]:
    return [f"## {title}", "", "| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]


def console_table(df: DataFrame, most: int = 50) -> str:
    """The first rows as a table for a terminal, in columns of equal width; says how many more there are."""
    rows = [["" if v is None else str(v) for v in r] for r in df.limit(most + 1).collect()]
    shown = rows[:most]
    widths = [max([len(c), *(len(r[i]) for r in shown)]) for i, c in enumerate(df.columns)]
    line = lambda cells: "  ".join(c.ljust(w) for c, w in zip(cells, widths, strict=True)).rstrip()
    return "\n".join([line(df.columns), line(["-" * w for w in widths]), *map(line, shown), *(["more rows follow"] if len(rows) > most else [])])


def bucket_ids(df: DataFrame, bucket: Column, order: list[str], labels: list[str]) -> DataFrame:
    """(place, bucket, pos, pmcid): every id of each bucket, numbered from 1 in order; buckets by their place in labels, 0 for others.

    Rows are numbered over ranges of all buckets in turn and counted from the bucket's first, so no task holds a bucket.
    """
    place = F.coalesce(F.array_position(F.array(*map(F.lit, labels)), F.col("bucket")), F.lit(0)).cast("int")
    tagged = df.select(*dict.fromkeys([*order, "pmcid"]), bucket.alias("bucket")).withColumn("place", place)
    rows = numbered(tagged, ["place", "bucket", *order], "_no")
    first = rows.groupBy("bucket").agg(F.min("_no").alias("_first")).withColumnRenamed("bucket", "_b")
    met = rows.join(F.broadcast(first), F.col("bucket").eqNullSafe(F.col("_b")))
    return met.select("place", "bucket", (F.col("_no") - F.col("_first") + 1).cast("long").alias("pos"), "pmcid")


def id_parts(df: DataFrame, bucket: Column, order: list[str], labels: list[str], part_ids: int = 10_000) -> DataFrame:
    """(place, bucket, part, n, ids): the ids of bucket_ids joined, in numbered lines of at most part_ids."""
    rows = bucket_ids(df, bucket, order, labels).withColumn("part", F.floor((F.col("pos") - 1) / part_ids + 1).cast("long"))
    ids = F.transform(F.array_sort(F.collect_list(F.struct("pos", "pmcid"))), lambda x: x["pmcid"])
    return rows.groupBy("place", "bucket", "part").agg(F.count(F.lit(1)).alias("n"), F.array_join(ids, ", ").alias("ids"))


def markdown_table(head: list[str], rows: list[tuple]) -> str:
    """A table of a small result."""
    lines = ["| " + " | ".join(head) + " |", "|" + "---|" * len(head)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in rows])


def summary_markdown(df: DataFrame, title: str = "Summary of the corpus") -> str:
    """The summary report as one text, for a corpus that fits a file; table_lines makes tables of any size."""
    top = headline(df).first()
    years = span(df, "year").first()
    order = ["year", "pmcid"]
    parts = [f"# {title}", f"{top['n']} records, {years['first']}–{years['last']}; {top['n_ehr']} of {top['n']} ({top['percent_ehr'] or 0}%) use health records."]
    parts += ["## Papers that use health records", markdown_table(["PMCID", "Year", "Diseases", "Source", "Title"], [tuple(r) for r in ehr_rows(df).collect()])]
    for name, column in (("Diseases", "pathologies_diseases"), ("Features", "captured_features")):
        parts += [f"## {name}", markdown_table([name, "n"], [tuple(r) for r in top_first_seen(df, F.col(column), 20, order).collect()])]
    levels = histogram(df, coerce.confidence(F.col("confidence")), ["high", "medium", "low", "unclear"], "confidence").collect()
    parts += ["## Confidence", markdown_table(["Confidence", "n"], [(r["confidence"], r["n"]) for r in levels])]
    sources = top_values(df, "data_source_type", 12, order, 40).collect()
    parts += ["## Sources", markdown_table(["Source", "n"], [tuple(r) for r in sources])]
    return "\n\n".join(parts) + "\n"
