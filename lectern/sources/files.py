"""Readers of checklist files, batches, logs, metadata and full texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lectern.functions import text as tx
from lectern.operators.store import envelope, last_of_key, write_envelope
from lectern.schema import batch_schema, checklist_schema
from lectern.session import durable

LOG_LISTS = {"papers": "struct<pmcid:string,title:string,journal:string,year:string,authors:string>", "excluded": "struct<pmcid:string,title:string,reason:string>", "abstract_only": "struct<pmcid:string,title:string>", "failed": "struct<pmcid:string,title:string>", "downloaded": "string", "xml_only": "string"}
METADATA_DDL = "uid string, title string, source string, pubdate string, authors array<struct<name:string>>, pubtype array<string>"


def discover(spark: SparkSession, folder: str) -> DataFrame:
    """(path, pmcid, format, length) of the PDF and XML files of a folder, by id."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{pdf,xml}").load(folder)
    return files.select("path", tx.pmcid_in_path(F.col("path")).alias("pmcid"), file_format(F.col("path")).alias("format"), "length").orderBy("pmcid", "path")


def file_format(path: Column) -> Column:
    """pdf, xml or text, by the suffix."""
    suffix = F.lower(F.regexp_extract(path, r"\.([^./]*)$", 1))
    return F.when(suffix.isin("pdf", "xml"), suffix).otherwise("text")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Checklist records of a folder of one-object JSON files, other suffixes ignored, plus path and _corrupt_record for unreadable ones."""
    schema = checklist_schema().add("_corrupt_record", "string")
    texts = spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True)
    return texts.select(F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r"), F.col("_metadata.file_path").alias("path")).select("r.*", "path")


def parse_failures(records: DataFrame) -> DataFrame:
    """(n, failures) of read_records."""
    kept = records.select("path", F.col("_corrupt_record").isNotNull().alias("bad"))
    return kept.agg(F.count_if(~F.col("bad")).alias("n"), F.count_if("bad").alias("failures"))


def read_batch(spark: SparkSession, path: str) -> DataFrame:
    """Records of a batch file {n, model, summaries[]} or a bare list of records."""
    both = spark.read.text(path, wholetext=True).select(F.from_json("value", batch_schema()).alias("b"), F.from_json("value", f"array<{checklist_schema().simpleString()}>").alias("a"))
    return both.select(F.inline(F.coalesce("b.summaries", "a")))


def read_batch_lines(spark: SparkSession, path: str) -> DataFrame:
    """Records of a batch file that write_batch made, one a line, so that a file of any size is read by many tasks."""
    lines = spark.read.text(path).filter(F.col("value").startswith("{") & ~F.col("value").endswith("["))
    return lines.select(F.from_json(F.regexp_replace("value", ",$", ""), checklist_schema()).alias("r")).select("r.*")


def write_log(lists: dict[str, DataFrame], folder: str) -> None:
    """A download log as JSON lines, a folder a list; for logs too large for one document."""
    for name, rows in lists.items():
        rows.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{folder}/{name}")


def read_log_lists(spark: SparkSession, folder: str, lists: list[str]) -> dict[str, DataFrame]:
    """The lists of write_log."""
    columns = {name: (kind[7:-1] if kind.startswith("struct") else "uid:string" if name == "downloaded" else "pmcid:string").replace(":", " ") for name, kind in LOG_LISTS.items()}
    return {name: spark.read.schema(columns[name]).json(f"{folder}/{name}") for name in lists}


def read_log(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """One frame a list of a download log; lists that are missing, and an empty file, give empty frames."""
    ddl = ", ".join(f"{name} array<{kind}>" for name, kind in LOG_LISTS.items())
    log = spark.read.text(path, wholetext=True).select(F.from_json("value", ddl).alias("l"))
    out = {}
    for name, kind in LOG_LISTS.items():
        rows = log.select(F.explode(f"l.{name}").alias("r"))
        out[name] = rows.select("r.*") if kind.startswith("struct") else rows.withColumnRenamed("r", "uid" if name == "downloaded" else "pmcid")
    return out


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """One row an id, the last of repeats."""
    rows = spark.read.schema(METADATA_DDL).json(path).withColumn("_at", F.monotonically_increasing_id())
    return last_of_key(rows, "uid", "_at").drop("_at")


def write_records(df: DataFrame, folder: str, buckets: int = 64) -> None:
    """JSON lines in folders by a hash of the id, buckets of them; nulls are written, so every column comes back."""
    bucket = F.pmod(F.xxhash64("pmcid"), F.lit(buckets)).cast("int")
    df.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").option("ignoreNullFields", "false").json(folder)


def read_record_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Checklist records written by write_records."""
    return spark.read.schema(checklist_schema()).json(folder).select(*checklist_schema().fieldNames())


def write_batch(df: DataFrame, *paths: str) -> None:
    """The batch file of df at every path; it is made once."""
    lines = durable(envelope(df))
    for path in paths:
        write_envelope(lines, path)


def split_write(df: DataFrame, test: Column, kept: Callable[[DataFrame], None], dropped: Callable[[DataFrame], None]) -> None:
    """Write rows that pass and rows that don't (null counts as not) to two sinks, reading df once."""
    from lectern.session import cached

    marked = cached(df.withColumn("_ok", F.coalesce(test, F.lit(False))))
    try:
        kept(marked.filter("_ok").drop("_ok"))
        dropped(marked.filter("not _ok").drop("_ok"))
    finally:
        marked.unpersist()


def one_record(file: dict | None = None, text: dict | None = None, flags: dict | None = None) -> dict:
    """A record from a file, a JSON text and flags; later ones win, flags that are None say nothing."""
    return {**(file or {}), **(text or {}), **{k: v for k, v in (flags or {}).items() if v is not None}}
