"""Mix sources to target shares of size: weighted fair queueing.

The documents of a source are shuffled by a hash; each pass over the source is another turn of the queue. A draw's
virtual finish time is the tokens of its source so far, its own included, divided by the source's target share.
Draws in order of finish time give every source its share at any moment, and the mix ends at the total budget.
Running sums are taken over hash buckets of a bounded number of documents, so no task holds a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.session import durable

#: Documents a hash bucket of the running sum, on average.
BUCKET_ROWS = 50_000
#: Most targets; they are sent to every task.
MAX_TARGETS = 10_000


def source_name(column: Column) -> Column:
    """A source without case and blanks around."""
    return F.lower(F.trim(column))


def queued(sizes: DataFrame, *, id_col: str = "doc_id", source: str = "source", tokens: str = "tokens", seed: int = 17, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(id, source, tokens, so_far): each document with the tokens of its source up to it, in shuffled order.

    Null sources, null tokens and sizes below 1 are left out: they add nothing to any share. Ties of the shuffle
    go by id; rows with the same id are told apart by tokens only and may swap places.
    """
    rows = sizes.select(F.col(f"`{id_col}`").alias("id"), source_name(F.col(f"`{source}`")).alias("source"), F.col(f"`{tokens}`").cast("long").alias("tokens")).filter("source is not null and tokens > 0")
    shuffled = rows.withColumn("place", F.xxhash64(F.lit(seed), F.col("id").cast("string")))
    buckets = F.greatest(F.lit(1), F.ceil(F.lit(rows.count() / bucket_rows))).cast("long")
    # the place's leading part, from 0 on: buckets follow one another in order of place
    scaled = F.least(F.floor((F.col("place").cast("double") / F.lit(2.0**64) + 0.5) * buckets), buckets - 1)
    placed = shuffled.withColumn("bucket", scaled)
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy("source", "bucket").agg(F.sum("tokens").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0))).drop("n")
    inside = Window.partitionBy("source", "bucket").orderBy("place", "id", "tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return placed.withColumn("within", F.sum("tokens").over(inside)).join(before, ["source", "bucket"]).select("id", "source", "tokens", (F.col("before") + F.col("within")).alias("so_far"))


def budgets(queue: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """(mix_name, source, target_share, max_repeats, source_tokens, budget) of every target.

    A mix's budget is total_tokens, or the largest total at which every source that has tokens still meets its
    share within its repeats. Targets without share, repeats or name are left out; a source listed twice in a
    mix counts once, with the larger share.
    """
    few = targets.limit(MAX_TARGETS + 1).count()
    if few > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} targets")
    clean = targets.select("mix_name", source_name(F.col("source")).alias("source"), "target_share", F.col("max_repeats").cast("long").alias("max_repeats")).filter("mix_name is not null and source is not null and target_share > 0 and max_repeats > 0")
    once = clean.groupBy("mix_name", "source").agg(F.max(F.struct("target_share", "max_repeats")).alias("t")).select("mix_name", "source", "t.*")
    held = queue.groupBy("source").agg(F.sum("tokens").alias("source_tokens"))
    sized = once.join(held, "source", "left").withColumn("source_tokens", F.coalesce("source_tokens", F.lit(0)))
    reach = F.when(F.col("source_tokens") > 0, F.col("source_tokens") * F.col("max_repeats") / F.col("target_share"))
    most = F.floor(F.min(reach).over(Window.partitionBy("mix_name"))).cast("long")
    return sized.withColumn("budget", F.lit(total_tokens).cast("long") if total_tokens is not None else F.coalesce(most, F.lit(0).cast("long")))


def mixed(queue: DataFrame, budget: DataFrame) -> DataFrame:
    """(mix_name, source, id, turn, tokens, finish): the draws of every mix in order; turn counts the passes over a source from 1.

    Draws are range-sorted by mix and finish time and a mix ends before the draw by which its running sum would exceed
    the budget. No source is drawn from beyond its share of the
    budget but for a draw that began before, so what a source lacks for a given total isn't made up by others.
    The targets, one row a source and mix, are few and go to every task; turns are made after the join.
    """
    turns = budget.filter("source_tokens > 0").withColumn("last", F.least(F.col("max_repeats"), F.ceil(F.col("budget") * F.col("target_share") / F.col("source_tokens")))).filter("last > 0")
    plan = turns.select("mix_name", "source", "target_share", "source_tokens", "budget", "last")
    drawn = queue.join(F.broadcast(plan), "source").withColumn("turn", F.explode(F.sequence(F.lit(1).cast("long"), F.col("last"))))
    finish = ((F.col("turn") - 1) * F.col("source_tokens") + F.col("so_far")) / F.col("target_share")
    begun = drawn.withColumn("finish", finish).filter(F.col("finish") - F.col("tokens") / F.col("target_share") < F.col("budget"))
    return _cut(in_order(begun.select("mix_name", "source", "id", F.col("turn").cast("int").alias("turn"), "tokens", "finish")), budget)


def _cut(ordered: DataFrame, budget: DataFrame) -> DataFrame:
    """The draws of range-sorted mixes up to their budgets, in that order: one range of a mix holds its end, the others are in or out whole."""
    ranged = durable(ordered.withColumn("_part", F.spark_partition_id()))
    ahead = Window.partitionBy("mix_name").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("mix_name", "_part").agg(F.sum("tokens").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
    sizes = sizes.join(F.broadcast(budget.groupBy("mix_name").agg(F.max("budget").alias("_budget"))), "mix_name").filter("_before < _budget").withColumn("_whole", F.col("_before") + F.col("_n") <= F.col("_budget"))
    sizes = durable(sizes)
    place = F.struct("finish", "source", "id")
    inside = Window.partitionBy("mix_name").orderBy("finish", "source", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ranged.join(F.broadcast(sizes.filter("not _whole")), ["mix_name", "_part"]).withColumn("_sum", F.col("_before") + F.sum("tokens").over(inside)).filter("_sum <= _budget")
    last = ends.groupBy("mix_name", "_part").agg(F.max(place).alias("_last"))
    kept = sizes.select("mix_name", "_part", "_whole").join(F.broadcast(last), ["mix_name", "_part"], "left")
    return ranged.join(F.broadcast(kept), ["mix_name", "_part"]).filter(F.col("_whole") | (place <= F.col("_last"))).select(ordered.columns)


def shares(draws: DataFrame, budget: DataFrame) -> DataFrame:
    """(mix_name, source, target_share, reached_share, tokens, draws, turns, source_tokens, budget) of every target, drawn from or not."""
    own = draws.groupBy("mix_name", "source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("draws"), F.max("turn").alias("turns"))
    each = budget.join(own, ["mix_name", "source"], "left").fillna(0, ["tokens", "draws", "turns"])
    total = F.sum("tokens").over(Window.partitionBy("mix_name"))
    return each.select("mix_name", "source", "target_share", F.when(total > 0, F.col("tokens") / total).otherwise(0.0).alias("reached_share"), "tokens", "draws", "turns", "source_tokens", "budget")


def within(draws: DataFrame, budget: DataFrame, queue: DataFrame) -> DataFrame:
    """(mix_name, source, repeats_kept, budget_kept, share_met) of every target, for checking a mix.

    share_met: the tokens drawn are the target's share of the budget, but for two texts no longer than the longest of the
    mix's sources.
    """
    top = F.broadcast(budget.select("source").distinct()).join(queue.groupBy("source").agg(F.max("tokens").alias("_top")), "source")
    longest = budget.join(top, "source").groupBy("mix_name").agg(F.max("_top").alias("_longest")).join(draws.groupBy("mix_name").agg(F.sum("tokens").alias("_total")), "mix_name", "left")
    own = draws.groupBy("mix_name", "source").agg(F.sum("tokens").alias("_own"), F.max("turn").alias("_turns"))
    each = budget.join(longest, "mix_name", "left").join(own, ["mix_name", "source"], "left").fillna(0, ["_longest", "_total", "_own", "_turns"])
    off = F.abs(F.col("_own") - F.col("target_share") * F.col("budget"))
    return each.select("mix_name", "source", (F.col("_turns") <= F.col("max_repeats")).alias("repeats_kept"), (F.col("_total") <= F.col("budget")).alias("budget_kept"), (off <= 2 * F.col("_longest")).alias("share_met"))


def in_order(draws: DataFrame, partitions: int | None = None) -> DataFrame:
    """The draws range-sorted by mix and finish time, for writing the mix in order."""
    parts = [] if partitions is None else [partitions]
    return draws.repartitionByRange(*parts, "mix_name", "finish", "source", "id").sortWithinPartitions("mix_name", "finish", "source", "id")


def kept_sizes(sizes: DataFrame) -> DataFrame:
    """Token counts written once to the shared folder: they cost far more than all that follows."""
    return durable(sizes)
