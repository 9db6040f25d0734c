"""A keyed store of records: immutable snapshots, validated writes, upsert."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lectern.functions import coerce
from lectern.operators.search import ordered
from lectern.schema import CHECKLIST_COLUMNS, LIST_COLUMNS, REQUIRED, SOURCE_FORMATS, checklist_schema
from lectern.session import durable


def validated(df: DataFrame) -> DataFrame:
    """Records coerced to the schema, in its column order, plus reject: why a record is invalid, null if it is valid.

    Missing optional columns get their defaults. ehr_used may be boolean or text.
    """
    have = set(df.columns)
    get = lambda c: F.col(c) if c in have else F.lit(None).cast("string")
    out: dict[str, Column] = {}
    for c in CHECKLIST_COLUMNS:
        if c == "pmcid":
            out[c] = coerce.pmcid(get(c))
        elif c == "ehr_used":
            out[c] = coerce.boolean(get(c).cast("string"))
        elif c in LIST_COLUMNS:
            out[c] = coerce.list_of(get(c).cast("array<string>")) if c in have and dict(df.dtypes)[c].startswith("array") else coerce.list_of_text(get(c))
        elif c == "data_availability":
            out[c] = coerce.availability(get(c))
        elif c == "confidence":
            out[c] = coerce.confidence(get(c))
        elif c == "source_format":
            out[c] = F.coalesce(get(c), F.lit("text"))
        elif c in REQUIRED:
            out[c] = get(c)
        else:
            out[c] = F.coalesce(get(c), F.lit(""))
    made = df.select(*[e.alias(c) for c, e in out.items()])
    why = [F.when(F.col(c).isNull(), F.lit(f"{c} is missing or invalid")) for c in REQUIRED] + [F.when(~F.col("source_format").isin(SOURCE_FORMATS), F.lit("source_format is invalid"))]
    return made.withColumn("reject", F.coalesce(*why))


def last_of_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key by order, which must differ between different rows of a key; rows without key are dropped.

    One aggregate a column, so that columns nobody reads later are not read from the files either. Combined on the map
    side, so a hot key costs a row a task.
    """
    rest = [c for c in df.columns if c not in (key, order)]
    newest = df.filter(F.col(key).isNotNull()).groupBy(key).agg(*[F.max_by(c, order).alias(c) for c in rest], F.max(order).alias(order))
    return newest.select(*df.columns)


def upsert_plan(base: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The full outer join of store and batch with action: keep, insert, update (only if different) or same.

    Both have the same columns and unique keys. Columns come from the batch for insert and update, else from base.
    """
    columns = [c for c in base.columns if c != key]
    b = base.select(F.col(key), F.struct(*columns).alias("_old"))
    n = batch.select(F.col(key), F.struct(*columns).alias("_new"))
    both = b.join(n, key, "full_outer")
    action = F.when(F.col("_new").isNull(), "keep").when(F.col("_old").isNull(), "insert").when(F.col("_old").eqNullSafe(F.col("_new")), "same").otherwise("update")
    return both.select(key, F.coalesce("_new", "_old").alias("_r"), action.alias("action")).select(key, *[F.col(f"_r.{c}").alias(c) for c in columns], "action")


def insert(base: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """base and batch; a key of the batch that the store has, or that repeats, raises when the result is read."""
    known = base.select(key, F.lit(1).alias("_n"))
    twice = batch.select(key, F.lit(1).alias("_n")).unionByName(known).groupBy(key).agg(F.sum("_n").alias("_n"))
    checked = batch.join(twice, key).withColumn(key, F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("already exists: "), F.col(key)))).otherwise(F.col(key))).drop("_n")
    return base.unionByName(checked.select(*base.columns))


def delete(base: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return base.join(keys.select(key), key, "left_anti")


def most_common(df: DataFrame, column: str, order: list[str]) -> DataFrame:
    """The most common value that is not blank, of equal ones the first in order; one row, '' if there is none."""
    counted = df.filter(coerce.strip(F.col(column)) != "").groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*order)).alias("first"))
    first = counted.orderBy(F.desc("n"), "first").limit(1)
    return first.agg(F.coalesce(F.first("value"), F.lit("")).alias(column))


class Conflict(RuntimeError):
    """Another writer committed since the store was read."""


class SnapshotStore:
    """Records under a folder of any file system that Spark knows: a base, deltas of what changed, and numbered commits.

    A commit file lists the base and the deltas of one version and is made only if no file of that number exists, so of
    two writers that read the same version one gets Conflict. A change writes the changed records only; every COMPACT_AT
    deltas are merged into a new base. Readers of an older version are not disturbed.
    """

    COMPACT_AT = 8

    def __init__(self, spark: SparkSession, path: str, key: str = "pmcid"):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _commit_file(self, version: int):
        return self._hadoop.Path(f"{self.path}/commits/{version:012d}.json")

    def version(self) -> int:
        """The number of the last commit, 0 before the first."""
        folder = self._hadoop.Path(f"{self.path}/commits")
        if not self._fs.exists(folder):
            return 0
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return max((int(n[:12]) for n in names if re.fullmatch(r"\d{12}\.json", n)), default=0)

    def _parts(self, version: int) -> list[str]:
        """The base and the deltas of a version, oldest first."""
        if not version:
            return []
        stream = self._fs.open(self._commit_file(version))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["parts"]
        finally:
            stream.close()

    def read(self, version: int | None = None) -> DataFrame:
        """The records of a version, the current one by default; none before the first commit."""
        parts = self._parts(self.version() if version is None else version)
        if not parts:
            return self.spark.createDataFrame([], checklist_schema())
        base = self.spark.read.parquet(f"{self.path}/{parts[0]}")
        if len(parts) == 1:
            return base
        rows = base.withColumns({"_at": F.lit(0), "_gone": F.lit(False)})
        for place, part in enumerate(parts[1:], 1):
            rows = rows.unionByName(self.spark.read.parquet(f"{self.path}/{part}").withColumn("_at", F.lit(place)))
        newest = rows.groupBy(self.key).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in (self.key, "_at")]), "_at").alias("_r"))
        return newest.filter("not _r._gone").select(*[F.col(self.key) if c == self.key else F.col(f"_r.{c}").alias(c) for c in base.columns])

    def commit(self, changed: DataFrame, version: int, removed: DataFrame | None = None) -> DataFrame:
        """The store after changed records replace or join those of version, and those of the keys in removed leave it."""
        parts = self._parts(version)
        delta = changed.withColumn("_gone", F.lit(False))
        if removed is not None:
            delta = delta.unionByName(removed.select(self.key).withColumn("_gone", F.lit(True)), allowMissingColumns=True)
        name = f"delta-{uuid.uuid4().hex}" if parts else f"base-{uuid.uuid4().hex}"
        (delta if parts else delta.filter("not _gone").drop("_gone")).write.parquet(f"{self.path}/{name}")
        self._publish([*parts, name], version)
        if len(parts) >= self.COMPACT_AT:
            self.compact()
        return self.read()

    def compact(self) -> None:
        """Merge the current version into a base of its own; a writer that was faster leaves it as it is."""
        version = self.version()
        name = f"base-{uuid.uuid4().hex}"
        self.read(version).write.parquet(f"{self.path}/{name}")
        try:
            self._publish([name], version)
        except Conflict:
            self._fs.delete(self._hadoop.Path(f"{self.path}/{name}"), True)

    def _publish(self, parts: list[str], version: int) -> None:
        """Make the commit file after version; Conflict if there is one."""
        try:
            stream = self._fs.create(self._commit_file(version + 1), False)
        except Exception as error:
            if self._fs.exists(self._commit_file(version + 1)):
                raise Conflict(f"version {version} is no longer the current one") from error
            raise
        stream.write(json.dumps({"parts": parts}).encode())
        stream.close()

    def list_all(self) -> DataFrame:
        return ordered(self.read())

    def get(self, key: str) -> DataFrame:
        return self.read().filter(F.col(self.key) == coerce.pmcid(F.lit(key)))

    def _valid(self, df: DataFrame) -> DataFrame:
        checked = validated(df)
        bad = checked.filter("reject is not null").select(self.key, "reject").first()
        if bad:
            raise ValueError(f"{bad[0]}: {bad[1]}")
        return checked.drop("reject")

    def add(self, df: DataFrame) -> DataFrame:
        """Insert valid records; ValueError for an invalid one or a key that exists."""
        version = self.version()
        fresh = self._valid(df)
        known = fresh.join(self.read(version).select(self.key), self.key, "left_semi").first()
        twice = fresh.groupBy(self.key).count().filter("count > 1").first()
        if known or twice:
            raise ValueError(f"already exists: {(known or twice)[self.key]}")
        return self.commit(fresh, version)

    def update(self, key: str, **changes: object) -> DataFrame:
        """Merge changes into one record and validate the whole; KeyError if it is missing, ValueError for another key."""
        version = self.version()
        name = self.spark.range(1).select(coerce.pmcid(F.lit(key))).first()[0]
        row = self.read(version).filter(F.col(self.key) == name).first()
        if row is None:
            raise KeyError(name)
        merged = row.asDict() | changes
        if merged[self.key] != row[self.key]:
            raise ValueError("the key of a record can't change")
        text = {k: (str(v).lower() if k == "ehr_used" and v is not None else v) for k, v in merged.items()}
        kinds = ", ".join(f"{f.name} {'string' if f.name == 'ehr_used' else f.dataType.simpleString()}" for f in checklist_schema())
        return self.commit(self._valid(self.spark.createDataFrame([tuple(text[f.name] for f in checklist_schema())], kinds)), version)

    def delete(self, key: str) -> bool:
        """Whether a record was removed."""
        version = self.version()
        found = self.read(version).filter(F.col(self.key) == coerce.pmcid(F.lit(key)))
        if found.first() is None:
            return False
        self.commit(found.limit(0), version, removed=found)
        return True

    def import_records(self, df: DataFrame, order: str | None = None) -> tuple[int, int]:
        """Insert new and replace different records; (inserted, updated). The last of a repeated key counts.

        The plan is worked out once and only what differs is written.
        """
        version = self.version()
        if order:
            df = last_of_key(df.withColumn(self.key, coerce.pmcid(F.col(self.key))), self.key, order).drop(order)
        changed = durable(upsert_plan(self.read(version), self._valid(df), self.key).filter(F.col("action").isin("insert", "update")))
        counts = {r["action"]: r["count"] for r in changed.groupBy("action").count().collect()}
        if counts:
            self.commit(changed.drop("action"), version)
        return counts.get("insert", 0), counts.get("update", 0)

    def export(self, *paths: str) -> int:
        """Write the batch file to every path, made and validated once; ValueError for an invalid record. The number of records."""
        records = durable(self._valid(self.read()))
        lines = durable(envelope(records))
        for path in paths:
            write_envelope(lines, path)
        return records.count()

    def stats(self) -> dict[str, int]:
        row = self.read().agg(F.count(F.lit(1)).alias("n"), F.count_if("ehr_used").alias("ehr"), F.count_if(~F.col("ehr_used")).alias("no_ehr")).first()
        return row.asDict()


def batch_rows(df: DataFrame) -> DataFrame:
    """(no, n, model, record columns): the records of a batch in canonical order, each with the batch's size and model."""
    from lectern.operators.report import numbered

    rows = numbered(df, ["year", "pmcid"])
    n = rows.agg(F.count(F.lit(1))).scalar()
    return rows.select("no", n.alias("n"), most_common(df, "model", ["year", "pmcid"]).select(F.col("model").alias("_m")).scalar().alias("batch_model"), *df.columns)


def envelope(df: DataFrame) -> DataFrame:
    """(place, line): the batch file {n, model, summaries[]} with one record a line, in order of place.

    Lines are numbered over ranges, so no task holds the catalogue; written in order they make one JSON document.
    """
    rows = batch_rows(df)
    record = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    body = rows.select(F.col("no").cast("long").alias("place"), F.concat(record, F.when(F.col("no") < F.col("n"), ",").otherwise("")).alias("line"))
    head = df.agg(F.count(F.lit(1)).alias("n")).select(F.col("n"), most_common(df, "model", ["year", "pmcid"]).select(F.col("model").alias("_m")).scalar().alias("m"))
    said = F.to_json(F.struct("n", F.col("m").alias("model")))
    first = head.select(F.lit(0).cast("long").alias("place"), F.concat(F.left(said, F.length(said) - 1), F.lit(',"summaries":[')).alias("line"))
    last = head.select((F.col("n") + 1).alias("place"), F.lit("]}").alias("line"))
    return first.unionByName(body).unionByName(last)


def write_envelope(lines: DataFrame, path: str) -> None:
    """One file of the lines in order: ranges are sorted apart and written one after the other, row by row."""
    lines.repartitionByRange("place").sortWithinPartitions("place").select("line").coalesce(1).write.mode("overwrite").text(path)
