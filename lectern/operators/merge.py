"""Merging: patches onto records, chunk extracts into one, scan results into records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.functions import coerce, text as tx

RANK = ["unclear", "low", "medium", "high"]


def patch(base: DataFrame, changes: DataFrame, key: str, columns: list[str], present: str = "present") -> DataFrame:
    """base with the columns that a change names in its list present taken from it, null included.

    One change a key; keys that base lacks are ignored (see store.update for an error).
    """
    c = changes.select(F.col(key).alias("_key"), F.col(present).alias("_present"), *[F.col(x).alias(f"_{x}") for x in columns if x in changes.columns])
    joined = base.join(c, F.col(key) == F.col("_key"), "left")
    return joined.select(*[F.when(F.array_contains("_present", x), F.col(f"_{x}")).otherwise(F.col(x)).alias(x) if f"_{x}" in c.columns and x in columns else F.col(x) for x in base.columns])


def merge_chunks(parts: DataFrame, key: str, order: str, *, flag: str, evidence: str, texts: list[str], lists: list[str], confidence: str, evidence_chars: int = 500) -> DataFrame:
    """One record a key from ordered partial extracts; order differs between the parts of a key.

    The flag holds if any part's does; evidence is what parts say, joined and cut (n/a if nothing); a text is the
    first that says something; a list the union in order; confidence the highest. However many parts a key has, a group
    holds its different entries, each with its first place, and as much evidence as is kept.
    """
    says = lambda c: coerce.strip(F.col(c)).isNotNull() & (coerce.strip(F.col(c)) != "") & (F.lower(coerce.strip(F.col(c))) != "n/a")
    rank = F.array_position(F.array(*map(F.lit, RANK)), coerce.confidence(F.col(confidence)))
    out = parts.groupBy(key).agg(
        F.coalesce(F.bool_or(flag), F.lit(False)).alias(flag),
        *[F.coalesce(F.min_by(F.when(says(c), coerce.strip(F.col(c))), F.when(says(c), F.col(order))), F.lit("")).alias(c) for c in texts],
        F.element_at(F.array(*map(F.lit, RANK)), F.max(rank).cast("int")).alias(confidence),
    )
    # a part adds a character and a blank at least, so no more parts than half the characters can be seen
    first = Window.partitionBy(key).orderBy(order)
    said = parts.filter(says(evidence)).select(key, F.col(order).alias("_o"), F.left(coerce.strip(F.col(evidence)), F.lit(evidence_chars)).alias("_v"), F.row_number().over(first).alias("_n")).filter(F.col("_n") <= evidence_chars // 2 + 1)
    told = said.groupBy(key).agg(F.left(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_o", "_v"))), lambda x: x["_v"]), " "), F.lit(evidence_chars)).alias("_said"))
    out = out.join(told, key, "left").withColumn(evidence, F.coalesce("_said", F.lit("n/a"))).drop("_said")
    if lists:
        tagged = F.array(*[F.struct(F.lit(c).alias("c"), F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x, i: F.struct(coerce.strip(x).alias("v"), i.alias("i"))).alias("e")) for c in lists])
        each = parts.select(key, F.col(order).alias("_o"), F.explode(tagged).alias("_l")).select(key, "_o", "_l.c", F.explode("_l.e").alias("_e")).filter("_e.v <> ''")
        firsts = each.groupBy(key, "c", F.col("_e.v").alias("v")).agg(F.min(F.struct("_o", "_e.i")).alias("f"))
        in_order = lambda c: F.transform(F.array_sort(F.collect_list(F.when(F.col("c") == c, F.struct("f", "v")))), lambda x: x["v"])
        unions = firsts.groupBy(key).agg(*[in_order(c).alias(c) for c in lists])
        out = out.join(unions, key, "left").withColumns({c: F.coalesce(F.col(c), F.array().cast("array<string>")) for c in lists})
    return out.select(key, flag, evidence, *texts, *lists, confidence)


def with_links_found(links: Column, availability: Column, statement: Column, window: Column, found: Column | None = None) -> Column:
    """A scan result after links plainly in the text are added: any of them makes the data public. found: those links, if known."""
    extra = tx.accession_links(window) if found is None else found
    some = F.size(extra) > 0
    return F.struct(
        F.when(some, "public-repository").otherwise(availability).alias("data_availability"),
        F.when(some, F.array_union(F.coalesce(links, F.array().cast("array<string>")), extra)).otherwise(links).alias("data_accession_links"),
        F.when(some & availability.isNull(), F.coalesce(tx.evidence(window), F.lit("Data deposited in a public repository."))).otherwise(statement).alias("data_availability_statement"),
    )
