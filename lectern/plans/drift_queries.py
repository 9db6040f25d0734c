"""Queries over raw_checklists: every change between files, lifespans of columns, one table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lectern.operators import drift
from lectern.schema import CHECKLIST_COLUMNS, CHECKLIST_TYPES, LIST_COLUMNS
from lectern.session import read_table


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drift.changes(read_table(spark, sf_dir, "raw_checklists"), CHECKLIST_COLUMNS)
    return found.selectExpr("file as file_name", "field", "change")


def p4_lifespans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.lifespans(read_table(spark, sf_dir, "raw_checklists"), CHECKLIST_COLUMNS)


def p4_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read_table(spark, sf_dir, "raw_checklists")
    return drift.unified(raw, CHECKLIST_TYPES, keep=[c for c in raw.columns if c != "payload"])


def p4_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p4_table as texts, for comparison: lists joined, truth in words, and of what stays in extra the keys."""
    keys = F.array_join(F.array_sort(F.json_object_keys("extra")), ", ")
    return p4_table(spark, sf_dir).withColumns({c: F.array_join(c, " | ") for c in LIST_COLUMNS} | {"ehr_used": F.col("ehr_used").cast("string"), "extra_keys": keys}).drop("extra")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p4_found": p4_found, "p4_lifespans": p4_lifespans, "p4_table": p4_table, "p4_cells": p4_cells}


def _field_sql() -> str:
    whens = [f"when {key!r} then {column!r}" for key, column in drift.known_keys(CHECKLIST_COLUMNS).items()]
    return f"case regexp_replace(lower(key), '[^0-9a-z]', '', 'g') {' '.join(whens)} else key end"


P4_TYPE = """case json_type(value) when 'VARCHAR' then 'string' when 'UBIGINT' then 'whole' when 'BIGINT' then 'whole' when 'DOUBLE' then 'fraction'
  when 'BOOLEAN' then 'boolean' when 'OBJECT' then 'object'
  when 'ARRAY' then nullif(array_to_string(list_sort(list_distinct(list_filter(list_transform(json_extract(value, '$[*]'),
    lambda e: replace(replace(json_type(e), 'UBIGINT', 'BIGINT'), 'NULL', '')), lambda t: t <> ''))), '|'), '') end"""

P4_FOOTERS = f"""
with files as (
  select stream, file_name, min(exported_at) as at, row_number() over (partition by stream order by min(exported_at), file_name) as seq
  from raw_checklists group by stream, file_name
), pairs as (
  select stream, file_name, unnest(json_keys(payload)) as key, payload from raw_checklists where json_valid(payload) and json_type(payload) = 'OBJECT'
), valued as (
  select stream, file_name, key, json_extract(payload, '$."' || key || '"') as value from pairs
), footer as (
  select distinct stream, file_name, key, {P4_TYPE} as type, {{field}} as field from valued
), placed as (
  select f.stream, seq, field, string_agg(distinct key, ', ' order by key) as keys, string_agg(distinct type, ', ' order by type) as types
  from footer f join files using (stream, file_name) group by all
)
"""


def oracle_sql() -> dict[str, str]:
    found = """
select file_name, field, change from (
  select coalesce(a.stream, b.stream) as stream, coalesce(a.seq, b.seq + 1) as seq, coalesce(a.field, b.field) as field,
    unnest(case when b.seq is null then ['added'] when a.seq is null then ['removed'] else
      list_filter([case when a.keys <> b.keys then 'renamed' end, case when a.types <> b.types then 'retyped' end], lambda x: x is not null) end) as change
  from placed a full join placed b on a.stream = b.stream and a.seq = b.seq + 1 and a.field = b.field
) join files using (stream, seq) where seq > 1
"""
    spans = """
, typed as (select distinct stream, seq, field, key, coalesce({type}, 'unknown') as json_type, files."at" from footer f join files using (stream, file_name)),
runs as (select *, seq - row_number() over (partition by stream, field, key, json_type order by seq) as run from typed)
select stream, field, key, json_type, min(seq) as first_seq, max(seq) as last_seq, min("at") as first_at, max("at") as last_at from runs group by stream, field, key, json_type, run
"""
    # a list of several types has one of its own
    shown = """case when type in ('VARCHAR', 'BIGINT', 'DOUBLE', 'BOOLEAN', 'OBJECT') then
  'array<' || case type when 'VARCHAR' then 'string' when 'BIGINT' then 'whole' when 'DOUBLE' then 'fraction' when 'BOOLEAN' then 'boolean' else 'object' end || '>' when contains(type, '|') then 'array<other>' else type end"""
    head = P4_FOOTERS.replace("{field}", _field_sql())
    return {"p4_found": head + found, "p4_lifespans": head + spans.replace("{type}", shown), "p4_cells": _table_sql()}


def _table_sql() -> str:
    """p4_cells in SQL: keys ranked by known_keys, one value a column, cast by its kind."""
    ranks = " ".join(f"when {key!r} then {rank}" for rank, key in enumerate(drift.known_keys(CHECKLIST_COLUMNS)))
    bare = "regexp_replace(lower(key), '[^0-9a-z]', '', 'g')"
    text = "json_extract_string(value, '$')"
    entries = lambda pattern: f"list_filter(list_transform(regexp_split_to_array({text}, '{pattern}'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '')"
    # DuckDB's patterns know no look-around: commas that part entries are marked first
    term = f"list_filter(list_transform(string_split(regexp_replace(regexp_replace({text}, '([^0-9]),', '\\1;', 'g'), ',([^0-9])', ';\\1', 'g'), ';'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '')"
    link = f"list_filter(list_transform(string_split(regexp_replace(regexp_replace({text}, ',(\\s|(?i:https?://|doi:|10\\.[0-9]|phs[0-9]|GSE[0-9]|PRJ[A-Z]{{2}}[0-9]|E-[A-Z]{{4}}-[0-9]))', ';\\1', 'g'), '[|]', ';', 'g'), ';'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '')"
    out = []
    for column, kind in CHECKLIST_TYPES:
        if kind == "boolean":
            cell = f"case when lower({text}) in ('true', 'yes', 'y', '1') then 'true' when lower({text}) in ('false', 'no', 'n', '0') then 'false' end"
        elif kind == "array<string>":
            split = entries("[;|]")
            if column in ("pathologies_diseases", "captured_features"):
                split = f"case when regexp_matches({text}, '[;|]') then {split} else {term} end"
            elif column == "data_accession_links":
                split = link
            listed = f"case when json_type(value) = 'VARCHAR' then {split} when json_type(value) = 'ARRAY' then list_transform(json_extract(value, '$[*]'), lambda e: case when json_type(e) = 'OBJECT' then json_extract_string(e, '$.id') else json_extract_string(e, '$') end) end"
            cell = f"array_to_string({listed}, ' | ')"
        else:
            one = "coalesce(json_extract_string(value, '$.category'), concat_ws('-', json_extract_string(value, '$.name'), json_extract_string(value, '$.build')))"
            many = "array_to_string(list_transform(json_extract(value, '$[*]'), lambda e: json_extract_string(e, '$')), '; ')"
            cell = f"case json_type(value) when 'OBJECT' then {one} when 'ARRAY' then {many} else {text} end"
        out.append(f"max(case when field = {column!r} then {cell} end) as {column}")
    return f"""
with good as (select distinct raw_id from raw_checklists where json_valid(payload) and json_type(payload) = 'OBJECT'),
pairs as (select raw_id, unnest(json_keys(payload)) as key, payload from raw_checklists where json_valid(payload) and json_type(payload) = 'OBJECT'),
ranked as (select raw_id, key, json_extract(payload, '$."' || key || '"') as value, {_field_sql()} as field, case {bare} {ranks} end as rank from pairs),
firsts as (select * from ranked where rank is not null qualify row_number() over (partition by raw_id, field order by rank, key) = 1),
cells as (select raw_id, {", ".join(out)} from firsts group by raw_id),
rest as (select raw_id, string_agg(key, ', ' order by key) as extra_keys from ranked r where not exists (select 1 from firsts f where f.raw_id = r.raw_id and f.key = r.key) group by raw_id)
select r.raw_id, r.stream, r.file_name, r.pos, r.exported_at, r.received_at, r.raw_id in (select raw_id from good) as readable, {", ".join(c for c, _ in CHECKLIST_TYPES)}, extra_keys
from raw_checklists r left join cells using (raw_id) left join rest using (raw_id)
"""
