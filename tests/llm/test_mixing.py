import random

import pytest

from lectern.llm import mixing


def sizes(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, tokens long")


@pytest.fixture(scope="module")
def library(spark):
    r = random.Random(3)
    rows = [(i, r.choice(["big", "Big ", "big", "small", "tiny"]), r.randrange(1, 400)) for i in range(4000)]
    return sizes(spark, rows)


def test_running_sums_against_sorting(spark, library):
    for bucket_rows in (50, 10_000):
        got = mixing.queued(library, bucket_rows=bucket_rows).collect()
        assert len(got) == 4000
        for source in ("big", "small", "tiny"):
            own = sorted((r for r in got if r.source == source), key=lambda r: r.so_far)
            total = 0
            for r in own:
                total += r.tokens
                assert r.so_far == total
    one, two = (({(r.id, r.so_far) for r in mixing.queued(library, bucket_rows=b).collect()}) for b in (50, 10_000))
    assert one == two


def test_shares_meet_targets_within_repeats(spark, library):
    targets = spark.createDataFrame([("m", "BIG", 0.5, 1), ("m", "small", 0.3, 4), ("m", "tiny", 0.2, 2), ("n", "tiny", 1.0, 3)], "mix_name string, source string, target_share double, max_repeats int")
    queue = mixing.queued(library).cache()
    budget = mixing.budgets(queue, targets).cache()
    draws = mixing.mixed(queue, budget).cache()
    for r in mixing.shares(draws, budget).collect():
        assert abs(r.reached_share - r.target_share) < 0.005
    each = draws.groupBy("mix_name", "source", "id").count()
    assert each.join(targets.selectExpr("mix_name", "lower(source) as source", "max_repeats"), ["mix_name", "source"]).filter("count > max_repeats").count() == 0
    # the budget is the largest that every source can meet
    held = {r.source: r.source_tokens for r in budget.collect()}
    most = int(min(held["big"] / 0.5, 4 * held["small"] / 0.3, 2 * held["tiny"] / 0.2))
    assert {r.budget for r in budget.filter("mix_name = 'm'").collect()} == {most}
    assert draws.filter("mix_name = 'n'").count() == 3 * library.filter("source = 'tiny'").count()
    ordered = [r.finish for r in mixing.in_order(draws.filter("mix_name = 'm'"), 3).collect()]
    assert ordered == sorted(ordered)


def test_every_prefix_of_the_mix_keeps_the_shares(spark, library):
    targets = spark.createDataFrame([("m", "big", 0.7, 1), ("m", "tiny", 0.3, 1)], "mix_name string, source string, target_share double, max_repeats int")
    queue = mixing.queued(library)
    draws = mixing.mixed(queue, mixing.budgets(queue, targets)).orderBy("finish").collect()
    big = total = 0
    for i, r in enumerate(draws):
        big, total = big + r.tokens * (r.source == "big"), total + r.tokens
        if i > 300:
            assert abs(big / total - 0.7) < 0.02


def test_a_total_that_is_too_large_is_reported(spark):
    queue = mixing.queued(sizes(spark, [(1, "a", 10), (2, "b", 10)]))
    targets = spark.createDataFrame([("m", "a", 0.5, 1), ("m", "b", 0.5, 3), ("m", "none", 0.1, 1)], "mix_name string, source string, target_share double, max_repeats int")
    budget = mixing.budgets(queue, targets, total_tokens=60)
    got = {r.source: (r.tokens, r.draws, r.turns) for r in mixing.shares(mixing.mixed(queue, budget), budget).collect()}
    assert got == {"a": (10, 1, 1), "b": (30, 3, 3), "none": (0, 0, 0)}


def test_nulls_blanks_and_empty_tables(spark):
    queue = mixing.queued(sizes(spark, [(1, None, 5), (2, "a", None), (3, "a", 0), (None, "a", 5), (4, "a", 5), (4, "a", 5)]))
    assert sorted(r.so_far for r in queue.collect()) == [5, 10, 15]
    targets = spark.createDataFrame([(None, "a", 1.0, 1), ("m", None, 1.0, 1), ("m", "a", None, 1), ("n", "a", 1.0, None), ("o", "a", 1.0, 1), ("o", "a", 0.5, 1)], "mix_name string, source string, target_share double, max_repeats int")
    budget = mixing.budgets(queue, targets)
    assert [(r.mix_name, r.target_share, r.budget) for r in budget.collect()] == [("o", 1.0, 15)]
    empty = mixing.queued(sizes(spark, [(1, "a", 1)]).limit(0))
    nothing = mixing.budgets(empty, targets)
    assert mixing.mixed(empty, nothing).count() == 0 and mixing.shares(mixing.mixed(empty, nothing), nothing).first().reached_share == 0.0
    with pytest.raises(ValueError):
        mixing.MAX_TARGETS, kept = 2, mixing.MAX_TARGETS
        try:
            mixing.budgets(queue, targets)
        finally:
            mixing.MAX_TARGETS = kept


def test_the_mix_comes_in_order_and_ends_at_the_budget(spark, library):
    targets = spark.createDataFrame([("m", "big", 0.5, 9), ("m", "small", 0.3, 9), ("m", "tiny", 0.2, 9), ("k", "tiny", 1.0, 9)], "mix_name string, source string, target_share double, max_repeats int")
    queue = mixing.queued(library)
    for total in (1, 5_000, 123_456):
        draws = [r for r in mixing.mixed(queue, mixing.budgets(queue, targets, total_tokens=total)).collect()]
        assert [(r.mix_name, r.finish) for r in draws] == sorted((r.mix_name, r.finish) for r in draws)
        for mix in ("k", "m"):
            own = [r.tokens for r in draws if r.mix_name == mix]
            # never over the budget, and short of it by less than the next draw
            assert 0 <= total - sum(own) < 400
