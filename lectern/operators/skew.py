"""Joins that stand a key held by a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Keys that are joined by broadcast; any other key holds at most one in HOT_KEYS of all rows.
HOT_KEYS = 1000


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], values: list[str], weight: str, hot_keys: int = HOT_KEYS) -> DataFrame:
    """rows left-joined to table, whose keys are unique and whose column weight says how many rows a key meets.

    The hot_keys heaviest keys go to every task, so their rows never move. A row that has met such a key gets a key of
    its own in the shuffle of the rest and crowds no partition. Null keys meet nothing.
    """
    top = table.orderBy(F.desc(weight), *keys).limit(hot_keys).select(*keys, *[F.col(v).alias(f"_hot_{v}") for v in values], F.lit(True).alias("_met"))
    met = rows.join(F.broadcast(top), keys, "left")
    # a lone key: the first one's place is taken by a hash of the whole row, the flag keeps it from meeting by chance
    spread = met.withColumn("_k", F.when(F.col("_met"), F.xxhash64(*[F.col(c) for c in rows.columns])).otherwise(F.xxhash64(*keys))).withColumn("_own", F.coalesce("_met", F.lit(False)))
    rest = table.select(F.xxhash64(*keys).alias("_k"), F.lit(False).alias("_own"), *[F.col(k).alias(f"_t_{k}") for k in keys], *[F.col(v).alias(f"_t_{v}") for v in values])
    same = (spread["_k"] == rest["_k"]) & (spread["_own"] == rest["_own"])
    for k in keys:
        same = same & (spread[k] == rest[f"_t_{k}"])
    joined = spread.join(rest, same, "left")
    return joined.select(*[spread[c] for c in rows.columns], *[F.coalesce(F.col(f"_hot_{v}"), F.col(f"_t_{v}")).alias(v) for v in values])
