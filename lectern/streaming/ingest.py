"""Streams of deliveries: parsing, dropping re-sent rows, running tallies, upserts into a store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lectern.functions import coerce
from lectern.operators.store import SnapshotStore


def table_stream(spark: SparkSession, path: str, schema: str, files_a_batch: int = 1000) -> DataFrame:
    """Parquet files of a folder as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)


def without_resent(results: DataFrame, key: str = "result_id", at: str = "recorded_at", late: str = "2 days") -> DataFrame:
    """Rows whose key did not come before within the watermark; state is dropped with it."""
    return results.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def tallies(results: DataFrame, at: str = "recorded_at", window: str = "1 day", late: str = "2 days") -> DataFrame:
    """(start, status, n) by time window, closed when the watermark passes."""
    status = coerce.or_unspecified(F.lower(F.col("status")), "unknown")
    return results.withWatermark(at, late).groupBy(F.window(at, window), status.alias("status")).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "status", "n")


def upsert_stream(records: DataFrame, store: SnapshotStore, checkpoint: str, order: str, on_batch: Callable[[int, int, int], None] | None = None) -> StreamingQuery:
    """Upsert each micro-batch into the store; a batch that is run again changes nothing."""

    def merge(batch: DataFrame, number: int) -> None:
        inserted, updated = store.import_records(batch, order=order)
        if on_batch:
            on_batch(number, inserted, updated)

    return records.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
