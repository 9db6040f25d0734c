import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from oracles import both

from lectern.plans import catalogue

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, data, name):
    mine, theirs = both(spark, data, QUERIES[name], SQL[name])
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark, data):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 20
    assert set(QUERIES) <= set(__spark_entry__.queries())


def test_buckets_list_all_their_ids(spark):
    from pyspark.sql import functions as F

    from lectern.operators import report

    df = spark.range(10_060).select(F.format_string("PMC%06d", "id").alias("pmcid"), F.lit("2020").alias("year"), F.when(F.col("id") < 10_050, "hot").otherwise("cold").alias("b"))
    wanted = {"hot": [f"PMC{i:06}" for i in range(10_050)], "cold": [f"PMC{i:06}" for i in range(10_050, 10_060)]}
    rows = report.bucket_ids(df, F.col("b"), ["year", "pmcid"], ["hot", "cold"]).orderBy("place", "pos").collect()
    assert [(r.bucket, r.pos, r.pmcid) for r in rows] == [(b, i, x) for b in ("hot", "cold") for i, x in enumerate(wanted[b], 1)]
    parts = report.id_parts(df, F.col("b"), ["year", "pmcid"], ["hot", "cold"], 1000).orderBy("place", "part").collect()
    assert [(r.bucket, r.part, r.n) for r in parts] == [*[("hot", i, 1000) for i in range(1, 11)], ("hot", 11, 50), ("cold", 1, 10)]
    assert [x for r in parts for x in r.ids.split(", ")] == wanted["hot"] + wanted["cold"]
