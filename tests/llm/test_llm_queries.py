import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
from oracles import both  # noqa: E402

from lectern.llm import queries as q  # noqa: E402

QUERIES, SQL = q.queries(), q.oracle_sql()
COLUMNS = {
    "p1_found": [("rec_id", "bigint"), ("field", "string"), ("term_id", "bigint")],
    "p2_found": [("rec_id", "bigint"), ("field", "string")],
    "p3_found": [("field", "string"), ("term", "string"), ("mark", "string")],
    "p5_found": [("first_rec_id", "bigint"), ("copy_rec_id", "bigint")],
    "p8_found": [("doc_id", "bigint"), ("lang", "string")],
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, data, name):
    mine, theirs = both(spark, data, QUERIES[name], SQL[name])
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, data, name):
    # the smallest tables have too few cut texts to show a limit
    df = QUERIES[name](spark, data.replace("sf0.001", "sf0.01") if name == "p2_limits" else data)
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_are_those_asked_for(spark, data, name):
    assert QUERIES[name](spark, data).dtypes == COLUMNS[name]
