import random
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import frequency


@settings(deadline=None, max_examples=60)
@given(st.lists(st.lists(st.sampled_from("abcd"), max_size=5), max_size=30), st.integers(1, 7), st.integers(1, 6))
def test_last_seen_counters_equal_sets(records, batch, drain_every):
    """Against sets a record, with records split over batches and counters passed on at any time."""
    flat = [(i, t) for i, own in enumerate(records) for t in own]
    seen, occurrences, in_records = frequency.LastSeen(), Counter(), Counter()

    def collect(current):
        for term, (n, r, _) in seen.drain(current).items():
            occurrences[term] += n
            in_records[term] += r

    for k, at in enumerate(range(0, len(flat), batch)):
        part = flat[at : at + batch]
        seen.add(pa.array([t for _, t in part]), np.array([i for i, _ in part], np.int64))
        if k % drain_every == 0:
            collect(part[-1][0])
    collect(-1)
    assert occurrences == Counter(t for _, t in flat)
    assert +in_records == Counter(t for own in records for t in set(own))


def brute(rows):
    occurrences, records = Counter(), Counter()
    for own in rows:
        tidy = [t for t in (" ".join(x.lower().split()) for x in own or [] if x is not None) if t]
        occurrences.update(tidy)
        records.update(set(tidy))
    return {t: (n, records[t]) for t, n in occurrences.items()}


def test_against_brute_force_with_a_hot_term(spark):
    r = random.Random(2)
    rows = [[r.choice(["Hot", " hot ", "a  b", "c", "d", None, " ", "x" * 3000]) for _ in range(r.randrange(6))] if i % 7 else None for i in range(2000)]
    df = spark.createDataFrame([(i, x, "extra", 1) for i, x in enumerate(rows)], "id int, f array<string>, term string, occurrences int").repartition(5)
    for most in (2, 1000):
        got = {x.term: (x.occurrences, x.n_records) for x in frequency.term_counts(df, ["f"], max_counters=most).collect()}
        assert got == brute(rows)


def test_rows_of_one_record_may_lie_apart(spark):
    rows = [(1, ["a", "a"]), (2, ["a"]), (1, ["a", "b"]), (None, ["b"]), (None, ["b"])]
    df = spark.createDataFrame(rows, "id int, f array<string>").repartition(4)
    got = {x.term: (x.occurrences, x.n_records) for x in frequency.term_counts(df, ["f"], record_col="id").collect()}
    assert got == {"a": (4, 2), "b": (3, 2)}


def test_marks(spark):
    df = spark.createDataFrame([(["often"] + (["seldom"] if i < 2 else ["some"] if i < 5 else []),) for i in range(100)], "f array<string>")
    got = {r.term: r.mark for r in frequency.marked(frequency.term_counts(df, ["f"]), df).collect()}
    assert got == {"often": "common", "seldom": "rare", "some": None}


def test_text_columns_and_empty_tables(spark):
    df = spark.createDataFrame([("A",), ("a ",), (None,), ("",)], "f string")
    assert [tuple(r) for r in frequency.term_counts(df, ["f"]).collect()] == [("f", "a", 2, 2)]
    empty = frequency.term_counts(df.limit(0), ["f"])
    assert empty.count() == 0 and frequency.marked(empty, df.limit(0)).count() == 0
