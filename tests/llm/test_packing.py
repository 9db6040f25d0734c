import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.llm import packing, tokens


def check(sizes, capacity, bins):
    """Every item is placed whole and once, in order of its pieces, and no container is overfull."""
    placed = defaultdict(list)
    for items in bins:
        assert sum(x[3] for x in items) <= capacity
        for key, piece, start, n in items:
            placed[key].append((piece, start, n))
    for key, size in sizes:
        pieces = sorted(placed.pop(key))
        assert [p for p, _, _ in pieces] == list(range(len(pieces)))
        assert sum(n for *_, n in pieces) == size and len(pieces) == max(1, -(-size // capacity))
        at = 0
        for _, start, n in pieces:
            assert start == at
            at += n
    assert not placed


@settings(deadline=None, max_examples=200)
@given(st.lists(st.integers(0, 60), max_size=60), st.integers(1, 25), st.integers(1, 8))
def test_placed_whole_and_once(sizes, capacity, most_open):
    keyed = list(enumerate(sizes))
    check(keyed, capacity, packing.pack_all(keyed, capacity, most_open))


def test_best_fit_by_definition():
    """Against a plain list of open containers: the tightest that fits takes an item, the fullest closes first."""
    r = random.Random(1)
    packer, open_, closed = packing.Packer(50, 4), [], []
    for i in range(2000):
        n = r.randrange(1, 51)
        got = [sorted(x[3] for x in items) for _, items in packer.add((i, 0, 0, n))]
        want = []
        fitting = [b for b in open_ if sum(b) + n <= 50]
        if fitting:
            tight = max(sum(b) for b in fitting)
            bin_ = [b for b in fitting if sum(b) == tight][-1]
            open_.remove(bin_)
        else:
            if len(open_) >= 4:
                full = max(sum(b) for b in open_)
                first = [b for b in open_ if sum(b) == full][-1]
                open_.remove(first)
                want.append(sorted(first))
            bin_ = []
        bin_ = [*bin_, n]
        if sum(bin_) == 50:
            want.append(sorted(bin_))
        else:
            open_.append(bin_)
        assert sorted(map(sum, got)) == sorted(map(sum, want))
        closed += got
    assert closed


def test_little_room_is_left():
    r = random.Random(2)
    sizes = [(i, min(2000, int(r.lognormvariate(5, 1)) + 1)) for i in range(20_000)]
    for capacity in (512, 2048):
        bins = packing.pack_all(sizes, capacity)
        assert sum(n for _, n in sizes) / (len(bins) * capacity) > 0.985


def test_a_capacity_must_hold_something():
    with pytest.raises(ValueError):
        packing.Packer(0)


def test_pack_a_table(spark):
    texts = ["one two three", None, "", "word " * 5000, "one two three", "a"]
    df = spark.createDataFrame([(i % 5, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, container_set string").coalesce(2)
    placed = packing.pack(df, {"s": 64, "l": 512}).cache()
    assert placed.groupBy("container_set", "container_id").sum("tokens").filter("`sum(tokens)` > 64 and container_set = 's' or `sum(tokens)` > 512").count() == 0
    want = sum(tokens.count_tokens(texts, tokens.encoding().encode_ordinary))
    assert {r[0]: r[1] for r in placed.groupBy("container_set").sum("tokens").collect()} == {"s": want, "l": want}
    assert placed.filter("container_set = 'l' and piece = 0").count() == len(texts)
    assert packing.pack(df.limit(0), {"s": 64}).count() == 0
    report = {r.container_set: r for r in packing.fill_report(placed, {"s": 64, "l": 512}).collect()}
    assert report["s"].containers >= report["s"].fewest_possible and 0 < report["s"].used_share <= 1


def test_pack_by_a_size_column(spark):
    df = spark.createDataFrame([("a", 5), ("b", None), ("c", -3), ("d", 25)], "k string, n int")
    got = sorted((r.k, r.piece, r.tokens) for r in packing.pack(df, {"s": 10}, id_col="k", text=None, size="n").collect())
    assert got == [("a", 0, 5), ("b", 0, 0), ("c", 0, 0), ("d", 0, 10), ("d", 1, 10), ("d", 2, 5)]


def test_capacities(spark):
    df = spark.createDataFrame([("a", 5), ("a", 7), (None, 3), ("b", None), ("c", 0)], "container_set string, capacity_tokens int")
    assert packing.capacities(df) == {"a": 7}
    with pytest.raises(ValueError):
        packing.capacities(df, most=0)


def test_pieces_are_token_ranges_that_join_again():
    encode = tokens.encoding()
    text = "Größe und Ökologie 😀 " * 40
    ids = encode.encode_ordinary(text)
    pieces = [x for b in packing.pack_all([("t", len(ids))], 17) for x in b]
    parts = [ids[s : s + n] for _, _, s, n in sorted(pieces, key=lambda x: x[1])]
    assert b"".join(encode.decode_bytes(p) for p in parts).decode() == text
