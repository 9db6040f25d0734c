import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

from datetime import datetime, timedelta

from test_store import records

from lectern.operators.store import SnapshotStore
from lectern.streaming import ingest


def test_upserts_are_incremental(spark, tmp_path):
    landing = str(tmp_path / "in")
    store = SnapshotStore(spark, str(tmp_path / "store"))
    schema = records(spark).selectExpr("*", "1L as rec_id").schema
    told = []

    def deliver(*rows):
        records(spark, *[{k: v for k, v in r.items() if k != "rec_id"} for r in rows]).selectExpr("*", f"{rows[0]['rec_id']}L as rec_id").write.mode("append").parquet(landing)
        stream = spark.readStream.schema(schema).parquet(landing)
        ingest.upsert_stream(stream, store, str(tmp_path / "state"), "rec_id", lambda n, i, u: told.append((i, u))).awaitTermination()

    deliver({"pmcid": "1", "rec_id": 1})
    deliver({"pmcid": "1", "summary": "new", "rec_id": 2}, {"pmcid": "2", "rec_id": 2})
    assert told == [(1, 0), (1, 1)] and store.get("1").first().summary == "new"


def test_resent_rows_and_tallies(spark, tmp_path):
    start = datetime(2021, 1, 1)
    rows = [(1, " OK", start), (1, "ok", start), (2, None, start), (3, "failed", start + timedelta(days=9))]
    spark.createDataFrame(rows, "result_id long, status string, recorded_at timestamp").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = ingest.table_stream(spark, str(tmp_path / "in"), "result_id long, status string, recorded_at timestamp")
    query = ingest.without_resent(stream).writeStream.format("memory").queryName("resent").start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("resent").count() == 3
    query = ingest.tallies(stream).writeStream.format("memory").queryName("tallied").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    assert {(r.status, r.n) for r in spark.table("tallied").collect()} == {("ok", 2), ("unknown", 1)}
