"""Schemas that drift between files: lifespans of columns, every change, one consistent table.

The footer of a file is the set of (key, JSON type) that its readable payloads show. Footers are gathered with
map-side combining, files of a producer are numbered by a range-partitioned running count, and a file is set
against the one before it by shifting footers one number on, so that no task holds all files of a producer.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.functions import coerce
from lectern.session import durable

#: Keys under which producers are known to send a column, beside spellings that differ only in case or separators.
ALIASES: dict[str, list[str]] = {
    "year": ["pub_year", "publication_year"],
    "ehr_used": ["uses_ehr"],
    "pathologies_diseases": ["conditions", "diseases"],
    "confidence": ["conf"],
    "data_availability": ["availability", "da_category"],
    "data_accession_links": ["accessions", "links", "accession_links"],
    "model": ["llm", "extractor", "model_name"],
}


#: Words that producers hang on a column's name.
SUFFIXES = ["", "name", "level", "value", "category", "list", "text"]


#: Commas that part the entries of a list written as a text. Terms: any but those inside a number, a name like 2,4-D or brackets.
#: Links: one before a blank or an identifier, for others may belong to a URL. Sentences (key_findings, limitations) have none.
TERM_COMMA = r"(?:(?<![0-9]),|,(?![0-9]))(?![^()]*\))"
LINK_COMMA = r",(?=\s|(?i:https?://|doi:|10\.[0-9]|phs[0-9]|GSE[0-9]|PRJ[A-Z]{2}[0-9]|E-[A-Z]{4}-[0-9]))"
COMMAS = {"pathologies_diseases": TERM_COMMA, "captured_features": TERM_COMMA, "data_accession_links": LINK_COMMA}


def bare(key: str) -> str:
    """A key without case and separators."""
    return re.sub(r"[^0-9a-z]", "", key.lower())


def known_keys(columns: list[str], aliases: dict[str, list[str]] | None = None) -> dict[str, str]:
    """Bare key -> column: the columns, their aliases, and either with one of SUFFIXES; a column's own name comes first."""
    table = ALIASES if aliases is None else aliases
    known = {bare(c): c for c in columns}
    for column in columns:
        for other in table.get(column, []):
            known.setdefault(bare(other), column)
    for key, column in list(known.items()):
        for suffix in SUFFIXES:
            known.setdefault(key + suffix, column)
    return known


def _spelled(key: Column) -> Column:
    return F.regexp_replace(F.lower(key), "[^0-9a-z]", "")


def column_of(key: Column, columns: list[str], aliases: dict[str, list[str]] | None = None) -> Column:
    """The column that a key holds values of, or the key itself."""
    known = known_keys(columns, aliases)
    pairs = [F.lit(x) for pair in known.items() for x in pair]
    found = F.element_at(F.create_map(*pairs), _spelled(key)) if pairs else F.lit(None)
    return F.coalesce(found, key)


def readable(payload: Column) -> Column:
    """The payload's JSON object as a map of variants; null when it is damaged or no object."""
    whole = F.when(payload.rlike(r"\}\s*$"), payload)
    return F.try_variant_get(F.try_parse_json(whole), "$", "map<string,variant>")


def json_type(value: Column) -> Column:
    """string, whole, fraction, boolean, object, array<...>, other; null for null, and for an array that shows no entry type."""
    shown = F.schema_of_variant(value)
    head = F.regexp_extract(shown, r"^(ARRAY<)*", 0)
    base = F.regexp_replace(F.substring(shown, F.length(head) + 1, F.lit(1 << 30)), r"^(\w+).*$", "$1")
    plain = (
        F.when(base.startswith("STRING"), "string").when(base.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "whole")
        .when(base.isin("DECIMAL", "DOUBLE", "FLOAT"), "fraction").when(base == "BOOLEAN", "boolean").when(base == "OBJECT", "object")
        .when(base == "VOID", F.lit(None)).otherwise("other")
    )
    depth = (F.length(head) / 6).cast("int")
    return F.concat(F.lower(head), plain, F.repeat(F.lit(">"), depth))


def listed(text: Column, column: str) -> Column:
    """The entries of a list written as a text, split at ';' and '|', and at the commas of its column (COMMAS).

    Terms that another sign parts keep their commas; identifiers hold none, so links are split at all signs.
    """
    comma = COMMAS.get(column)
    parts = F.split(text, "[;|]")
    if comma == LINK_COMMA:
        parts = F.split(text, f"[;|]|{comma}")
    elif comma:
        parts = F.when(text.rlike("[;|]"), parts).otherwise(F.split(text, comma))
    return F.filter(F.transform(parts, lambda x: coerce.strip(x)), lambda x: x != "")


def footers(raw: DataFrame, *, stream: str = "stream", file: str = "file_name", at: str = "exported_at", payload: str = "payload") -> DataFrame:
    """Distinct (stream, file, at, key, json_type) of the readable payloads. json_type is null where only nulls show."""
    keyed = raw.select(F.col(f"`{stream}`").alias("stream"), F.col(f"`{file}`").alias("file"), F.col(f"`{at}`").alias("at"), F.explode(readable(F.col(f"`{payload}`"))).alias("key", "value"))
    return keyed.select("stream", "file", "at", "key", json_type(F.col("value")).alias("json_type")).distinct()


def numbered_files(raw: DataFrame, *, stream: str = "stream", file: str = "file_name", at: str = "exported_at") -> DataFrame:
    """(stream, file, at, seq): files of each stream numbered from 1 in order of at (then file name).

    The order is cut into ranges, rows are numbered inside each range, and a table of one row a range and stream
    gives what to add. A file is known by stream and name; one sent with several times goes by the earliest.
    """
    files = raw.groupBy(F.col(f"`{stream}`").alias("stream"), F.col(f"`{file}`").alias("file")).agg(F.min(F.col(f"`{at}`")).alias("at"))
    ranged = durable(files.repartitionByRange("stream", "at", "file").withColumn("_part", F.spark_partition_id()))
    ahead = Window.partitionBy("stream").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("stream", "_part").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.coalesce(F.sum("n").over(ahead), F.lit(0))).drop("n")
    inside = F.row_number().over(Window.partitionBy("stream", "_part").orderBy("at", "file"))
    sizes = sizes.withColumnsRenamed({"stream": "_s", "_part": "_p"})
    return ranged.withColumn("_i", inside).join(sizes, F.col("stream").eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_p"))).select("stream", "file", "at", (F.col("_i") + F.col("before")).alias("seq"))


def changes(raw: DataFrame, columns: list[str], *, aliases: dict[str, list[str]] | None = None, stream: str = "stream", file: str = "file_name", at: str = "exported_at", payload: str = "payload") -> DataFrame:
    """(stream, file, field, change, was, now) of each file against the one before it in its stream.

    change is added, removed, renamed or retyped. A file without readable payloads shows no field. A type is
    compared only when both files show one. Rows with null stream form a stream; null payloads are unreadable.
    """
    names = dict(stream=stream, file=file, at=at)
    numbers = numbered_files(raw, **names)
    shown = footers(raw, payload=payload, **names).withColumn("field", column_of(F.col("key"), columns, aliases))
    fields = shown.groupBy("stream", "file", "field").agg(F.array_join(F.array_sort(F.collect_set("key")), ", ").alias("keys"), F.array_join(F.array_sort(F.collect_set("json_type")), ", ").alias("types"))
    placed = fields.join(numbers.select(F.col("stream").alias("_s"), F.col("file").alias("_f"), "seq"), F.col("stream").eqNullSafe(F.col("_s")) & F.col("file").eqNullSafe(F.col("_f"))).select("stream", "seq", "field", "keys", "types")
    # every footer meets the next file's under the number of the next file
    both = placed.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("late")).withColumn("seq", F.col("seq") + F.col("late"))
    value = lambda late, name: F.max(F.when(F.col("late") == late, F.col(name)))
    met = both.groupBy("stream", "seq", "field").agg(value(1, "keys").alias("k0"), value(1, "types").alias("t0"), value(0, "keys").alias("k1"), value(0, "types").alias("t1")).filter("seq > 1")
    gone = F.when(F.col("k0").isNull(), F.array(F.struct(F.lit("added").alias("change"), F.lit(None).cast("string").alias("was"), F.col("k1").alias("now")))).when(
        F.col("k1").isNull(), F.array(F.struct(F.lit("removed").alias("change"), F.col("k0").alias("was"), F.lit(None).cast("string").alias("now")))
    )
    renamed = F.when(F.col("k0") != F.col("k1"), F.struct(F.lit("renamed").alias("change"), F.col("k0").alias("was"), F.col("k1").alias("now")))
    retyped = F.when((F.col("t0") != F.col("t1")) & (F.col("t0") != "") & (F.col("t1") != ""), F.struct(F.lit("retyped").alias("change"), F.col("t0").alias("was"), F.col("t1").alias("now")))
    listed = met.withColumn("c", F.explode(F.coalesce(gone, F.filter(F.array(renamed, retyped), lambda x: x.isNotNull()))))
    return listed.join(numbers.select(F.col("stream").alias("_s"), F.col("seq").alias("_q"), "file"), F.col("stream").eqNullSafe(F.col("_s")) & (F.col("seq") == F.col("_q"))).select("stream", "file", "field", "c.change", "c.was", "c.now")


def lifespans(raw: DataFrame, columns: list[str], *, aliases: dict[str, list[str]] | None = None, stream: str = "stream", file: str = "file_name", at: str = "exported_at", payload: str = "payload") -> DataFrame:
    """(stream, field, key, json_type, first_seq, last_seq, first_at, last_at): unbroken runs of files that show a key with a type.

    Runs are islands in the numbering of files: a footer row starts one when the file before has no such row, and
    lag over the starts and ends alone, which are few, pairs them.
    """
    names = dict(stream=stream, file=file, at=at)
    numbers = numbered_files(raw, **names)
    shown = footers(raw, payload=payload, **names).drop("at").withColumn("field", column_of(F.col("key"), columns, aliases)).withColumn("json_type", F.coalesce("json_type", F.lit("unknown")))
    placed = shown.join(numbers.withColumnsRenamed({"stream": "_s", "file": "_f"}), F.col("stream").eqNullSafe(F.col("_s")) & F.col("file").eqNullSafe(F.col("_f")))
    group = ["stream", "field", "key", "json_type"]
    # a run's first row has no neighbour before it, its last none after it
    near = placed.select(*group, F.explode(F.array(*[F.struct((F.col("seq") + d).alias("seq"), F.lit(-d).alias("d"), F.col("at").alias("at")) for d in (-1, 0, 1)])).alias("n")).select(*group, "n.*")
    seen = lambda d: F.max(F.when(F.col("d") == d, 1))
    edges = near.groupBy(*group, "seq").agg(seen(0).alias("here"), seen(-1).alias("before"), seen(1).alias("after"), F.max(F.when(F.col("d") == 0, F.col("at"))).alias("at")).filter("here = 1 and (before is null or after is null)")
    order = Window.partitionBy(*group).orderBy("seq")
    paired = edges.withColumn("first_seq", F.when(F.col("before").isNull(), F.col("seq")).otherwise(F.lag("seq").over(order))).withColumn("first_at", F.when(F.col("before").isNull(), F.col("at")).otherwise(F.lag("at").over(order)))
    return paired.filter("after is null").select(*group, "first_seq", F.col("seq").alias("last_seq"), "first_at", F.col("at").alias("last_at"))


def unified(raw: DataFrame, schema: list[tuple[str, str]], *, aliases: dict[str, list[str]] | None = None, keep: list[str], payload: str = "payload") -> DataFrame:
    """Every record as one table: the columns of schema (name, type string | boolean | array<string>), after those in keep.

    Casts follow from the JSON type met: an object gives its text fields joined by '-' (a lone one is itself), an
    array of objects the id of each, a text for an array its entries (see listed), 0/1 and yes/no a boolean. readable
    is false for a damaged payload, whose columns are null. Where several keys of a record hold one column, the first in
    known_keys' order counts (of equal ones the first by name). Other keys, and keys without a column, stay in extra as
    JSON text. A clashing name in keep takes the suffix _raw.
    """
    columns = [c for c, _ in schema]
    kept = [F.col(f"`{c}`").alias(f"{c}_raw" if c in {*columns, "readable", "extra"} else c) for c in keep]
    known = known_keys(columns, aliases)
    # (column, place among its keys) of every known key, looked up once a key
    table = F.create_map(*[x for rank, (key, column) in enumerate(known.items()) for x in (F.lit(key), F.struct(F.lit(columns.index(column)).alias("c"), F.lit(rank).alias("r")))])
    base = raw.select(*kept, readable(F.col(f"`{payload}`")).alias("_m"))
    names = [c for c in base.columns if c != "_m"]
    ranked = F.array_sort(F.filter(F.transform(F.map_keys("_m"), lambda k: F.struct(F.element_at(table, _spelled(k)).alias("h"), k.alias("k"))), lambda x: x["h"].isNotNull()))
    order = base.withColumn("_o", ranked)
    chosen = order.withColumn("_o", F.filter("_o", lambda x, i: (i == 0) | (F.get(F.col("_o"), i - 1)["h"]["c"] != x["h"]["c"])))
    value = lambda j: F.try_element_at("_m", F.get(F.filter("_o", lambda x: x["h"]["c"] == j), F.lit(0))["k"])
    valued = chosen.select(*[F.col(f"`{c}`") for c in names], "_m", "_o", *[value(j).alias(f"_v{j}") for j in range(len(columns))])
    shaped = valued.select("*", *[json_type(F.col(f"_v{j}")).alias(f"_s{j}") for j, (_, kind) in enumerate(schema) if kind != "boolean"])
    out = [F.col("_m").isNotNull().alias("readable")]
    for j, (column, kind) in enumerate(schema):
        held, shape = F.col(f"_v{j}"), F.col(f"_s{j}")
        text = F.try_variant_get(held, "$", "string")
        if kind == "boolean":
            cast = F.when(F.lower(text).isin("true", "yes", "y", "1"), True).when(F.lower(text).isin("false", "no", "n", "0"), False)
        elif kind == "array<string>":
            ids = F.transform(F.try_variant_get(held, "$", "array<variant>"), lambda x: F.try_variant_get(x, "$.id", "string"))
            cast = F.when(shape == "array<object>", ids).when(shape == "string", listed(text, column)).otherwise(F.try_variant_get(held, "$", "array<string>"))
        else:
            one = F.coalesce(F.try_variant_get(held, "$.category", "string"), F.concat_ws("-", F.try_variant_get(held, "$.name", "string"), F.try_variant_get(held, "$.build", "string")))
            many = F.array_join(F.try_variant_get(held, "$", "array<string>"), "; ")
            cast = F.when(shape == "object", one).when(shape.startswith("array"), many).otherwise(text)
        out.append(cast.alias(column))
    extra = F.map_filter("_m", lambda k, _: ~F.exists("_o", lambda x: x["k"] == k))
    out.append(F.when(F.size(extra) > 0, F.to_json(extra)).alias("extra"))
    return shaped.select(*[F.col(f"`{c}`") for c in names], *out)
