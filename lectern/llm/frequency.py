"""Occurrences and records of every distinct term, with last-seen counters.

Each task reads its records in order and keeps one counter a term: occurrences, records and the last record
seen. A term met again in the same record adds an occurrence but no record, so no set of terms is kept for any
record. The counters of the tasks are hash-partitioned by term and added up, so a term that fills a third of all
rows reaches the shuffle as one row a task. Where rows of a record may lie apart, counters of (term, record) are
added up first, so a record that fills a third of all rows is spread over its terms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F

#: Counters a task keeps before it passes them on.
MAX_COUNTERS = 1_000_000


def tidy_term(entry: Column) -> Column:
    """Lower case, each run of white space (no-break space included) one space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(entry), r"(?U)\s+", " "))


class LastSeen:
    """Counters of one field: term -> [occurrences, records, last record]."""

    def __init__(self) -> None:
        self.terms: dict[str, list[int]] = {}

    def add(self, terms: pa.Array, records: np.ndarray) -> None:
        """Count terms, in record order; records has the record number of each."""
        if not len(terms):
            return
        coded = terms.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(codes, kind="stable")
        codes, seen = codes[order], records[order]
        first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        fresh = np.r_[True, (codes[1:] != codes[:-1]) | (seen[1:] != seen[:-1])]
        occurrences = np.diff(np.r_[first, len(codes)])
        in_records = np.add.reduceat(fresh.astype(np.int64), first)
        last = seen[np.r_[first[1:], len(codes)] - 1]
        names = coded.dictionary.to_pylist()
        for code, n, r, start, end in zip(codes[first].tolist(), occurrences.tolist(), in_records.tolist(), seen[first].tolist(), last.tolist(), strict=True):
            counter = self.terms.get(names[code])
            if counter is None:
                self.terms[names[code]] = [n, r, end]
            else:
                counter[0] += n
                counter[1] += r - (counter[2] == start)
                counter[2] = end

    def drain(self, current: int) -> dict[str, list[int]]:
        """The counters so far; those of the current record go on from nothing but keep their last record."""
        out = {t: c for t, c in self.terms.items() if c[0]}
        self.terms = {t: [0, 0, c[2]] for t, c in self.terms.items() if c[2] == current}
        return out


def term_counts(df: DataFrame, fields: list[str], *, record_col: str | None = None, tidy=tidy_term, max_counters: int = MAX_COUNTERS) -> DataFrame:
    """(field, term, occurrences, n_records) of every distinct entry of the array or string columns in fields.

    A row is a record; with record_col, rows that share its value are one record wherever they lie (null is a
    value too). Null arrays, null entries and entries that tidy to nothing do not count; an empty table gives no
    rows. Other columns, whatever their names, are not read.
    """
    kinds = dict(df.dtypes)
    lists = [F.filter(F.transform(F.col(f"`{f}`") if kinds[f].startswith("array") else F.array(F.col(f"`{f}`")), tidy), lambda x: x != "") for f in fields]
    if record_col is not None:
        told = df.select(F.col(f"`{record_col}`").cast("string").alias("_k"), F.explode(F.array(*[F.struct(F.lit(f).alias("field"), column.alias("terms")) for f, column in zip(fields, lists, strict=True)])).alias("_p"))
        each = told.select("_k", "_p.field", F.explode("_p.terms").alias("term")).groupBy("field", "term", "_k").agg(F.count(F.lit(1)).alias("n"))
        return each.groupBy("field", "term").agg(F.sum("n").alias("occurrences"), F.count(F.lit(1)).alias("n_records"))
    rows = df.select(F.lit(0).alias("_r"), *[column.alias(f"_f{i}") for i, column in enumerate(lists)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = [LastSeen() for _ in fields]
        done = 0

        def passed_on() -> Iterator[pa.RecordBatch]:
            for name, own in zip(fields, counters, strict=True):
                out = own.drain(done)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(out), pa.string()), pa.array(list(out), pa.string()), pa.array([c[0] for c in out.values()], pa.int64()), pa.array([c[1] for c in out.values()], pa.int64())], names=["field", "term", "occurrences", "n_records"])

        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = done + 1 + np.arange(batch.num_rows)
            done = int(numbers[-1])
            for i, own in enumerate(counters):
                column = batch.column(i + 1)
                sizes = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False)
                own.add(pa.compute.list_flatten(column), np.repeat(numbers, sizes))
            if sum(len(own.terms) for own in counters) > max_counters:
                yield from passed_on()
        yield from passed_on()

    partial = rows.mapInArrow(count, "field string, term string, occurrences long, n_records long")
    return partial.groupBy("field", "term").agg(F.sum("occurrences").alias("occurrences"), F.sum("n_records").alias("n_records"))


def marked(counts: DataFrame, records: DataFrame, *, rare_below: int = 3, common_above: int = 20) -> DataFrame:
    """counts plus mark: rare (in fewer than rare_below records), common (in more than one of common_above), else null.

    records is the table counted; a term in fewer than rare_below records is rare even where it is common too.
    """
    total = records.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("mark", F.when(F.col("n_records") < rare_below, "rare").when(F.col("n_records") * common_above > total, "common"))
