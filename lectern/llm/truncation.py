"""Find texts that lost their end, and the storage limits that cut them.

Lengths are recomputed as characters, UTF-8 bytes, UTF-16 units, with entities, JSON escapes and two-byte line
ends; a pile of texts that end no sentence at a length of a source under one of these is a hidden limit. Then endings
are inspected: an ending is judged by how the same words go on in the whole collection. Contexts of an ending (the last
word, the last two, three and six, and the frame of function words of its sentence) are looked up among all contexts of
all texts, counted by how often a sentence ends there and how often it goes on.

Texts are read twice. The first pass keeps, of texts that may have lost their end, lengths and contexts only; the second
counts the contexts of all texts, but passes on only those that a filter of fixed size says are asked for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lectern.operators.skew import lookup
from lectern.session import durable

#: Ends of a sentence in any script, and the closers that may follow.
STOPS = ".!?。！？؟۔।॥።"
CLOSERS = "\"”’')]»」』）"
FINAL = re.compile(f"[{STOPS}][{re.escape(CLOSERS)}]*$")
#: What a cut itself leaves behind: ellipsis, replacement character, half an entity, a note.
MARKS = ("…", "...", "\ufffd", "[cut]", "[truncated]")
HALF_ENTITY = re.compile(r"&(?:[A-Za-z]*|#[0-9]*)")
#: Words that make the frame of a sentence.
FRAME = frozenset(
    "a an the of in on at to for from with without and or but by as than then that this these which who their its is are was "
    "were be been has have had not no only can could may all each whether if when where while because how what during before "
    "after under over near into between among within through against about".split()
)
#: Contexts of a place in a sentence: name and how many words, 0 for the frame of all words so far.
KINDS = {"last": 1, "two": 2, "three": 3, "six": 6, "frame": 0}
#: Lengths a limit may be set on, with the most units of one character: a cut leaves up to one less unused.
MEASURES = {"chars": 1, "utf8": 4, "utf16": 2, "entities": 6, "json": 2, "crlf": 2}
MAX_SOURCES = 100_000
#: Words of 64 bits in the filter of contexts, at most (8 MB). A fuller filter passes on more contexts and loses none.
FILTER_WORDS = 1 << 20
_M = 0x9E3779B97F4A7C15
_START = np.uint64(0xA0761D6478BD642F)


def lengths(text: str) -> list[int]:
    """Length of a text under each of MEASURES."""
    chars, octets = len(text), len(text.encode("utf-8", "replace"))
    astral = len(text.encode("utf-16-le", "replace")) // 2 - chars if octets > chars + 2 else 0
    quotes, lines = text.count('"'), text.count("\n")
    angles = text.count("<") + text.count(">")
    escaped = quotes + lines + text.count("\\") + text.count("\r") + text.count("\t")
    return [chars, octets, chars + astral, chars + 4 * text.count("&") + 3 * angles + 5 * quotes, chars + escaped, chars + lines]


def is_marked(text: str) -> bool:
    """Whether a text without blanks at its end ends in what a cut leaves behind."""
    return text.endswith(MARKS) or ((at := text.rfind("&")) >= 0 and HALF_ENTITY.fullmatch(text, at) is not None)


def is_final(text: str) -> bool:
    """Whether a text without blanks at its end ends a sentence."""
    return text.rstrip(CLOSERS)[-1:] in tuple(STOPS)


def _plainly_final(texts: pa.Array) -> np.ndarray:
    """Texts that end in a full stop after a letter: neither marked nor in a number. Nulls are not among them."""
    texts = texts.cast(pa.large_string())
    if not len(texts) or texts.buffers()[2] is None:
        return np.zeros(len(texts), bool)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)
    some = np.diff(offsets) >= 2
    ends = np.where(some, offsets[1:], 2)
    if len(data) < 2:
        return np.zeros(len(texts), bool)
    last, before = data[ends - 1], data[ends - 2] | 32
    found = some & ((last == 46) | (last == 33) | (last == 63)) & (before >= 97) & (before <= 122)
    return found & texts.is_valid().to_numpy(zero_copy_only=False)


def texts_of(df: DataFrame, fields: list[str], id_col: str, source: str, record: Column | None = None) -> DataFrame:
    """(id, source, record, and one column a field): the rows as they stand; a null source is the source ''.

    record is a hash of what the copies of one record share; where that is null, or not given, of the id.
    """
    own = F.col(f"`{id_col}`").cast("string")
    same = F.xxhash64(own if record is None else F.coalesce(record.cast("string"), own))
    return df.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("source"), same.alias("record"), *[F.col(f"`{f}`").cast("string").alias(f"_text{i}") for i, f in enumerate(fields)])


def open_texts(rows: DataFrame, fields: list[str]) -> DataFrame:
    """One row a text that may have lost its end: that is marked, ends no sentence, or ends in a number.

    (id, source, record, field, key: hash of the text, marked, final, numeric, a length a measure, ending: hash of the last
    twelve characters with digits alike, a context a kind of the last word). rows come from texts_of.
    """
    kept = dict(rows.dtypes[:3])
    flags = ["marked", "final", "numeric"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for number, name in enumerate(fields, 1):
                column = batch.column(2 + number)
                at, shown, told = [], [], []
                rest = np.flatnonzero(~_plainly_final(column))
                for i, text in zip(rest.tolist(), column.take(pa.array(rest)).to_pylist(), strict=True):
                    short = text.rstrip() if text else ""
                    if not short:
                        continue
                    marked = is_marked(short)
                    final = not marked and is_final(short)
                    numeric = short[-1].isdecimal() or (short[-1] in STOPS and short[-2:-1].isdecimal())
                    if marked or not final or numeric:
                        at.append(i)
                        shown.append(text)
                        told.append((xxhash.xxh64_intdigest(text) - (1 << 63), marked, final, numeric, xxhash.xxh64_intdigest(re.sub("[0-9]", "0", short[-12:])) - (1 << 63), *lengths(text)))
                if not at:
                    continue
                found, owner, _ = contexts(pa.array(shown, pa.large_string()), np.full(len(at), number), words)
                tail = np.flatnonzero(np.r_[owner[1:] != owner[:-1], True])
                place = np.full(len(at), -1)
                place[owner[tail]] = tail
                key, marked, final, numeric, ending, *sizes = zip(*told, strict=True)
                columns = [*(batch.column(i).take(pa.array(at)) for i in range(3)), pa.array([name] * len(at)), pa.array(key, pa.int64()), *(pa.array(x, pa.bool_()) for x in (marked, final, numeric)), pa.array(ending, pa.int64()), *(pa.array(x, pa.int64()) for x in sizes), *(pa.array(h[np.maximum(place, 0)], mask=place < 0) for h in found.values())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = [*kept, "field", "key", *flags, "ending", *MEASURES, *KINDS]
    schema = [f"`{c}` {t}" for c, t in kept.items()] + ["field string", "key long", *(f"{x} boolean" for x in flags), "ending long", *(f"`{m}` long" for m in MEASURES), *(f"`{k}` long" for k in KINDS)]
    return rows.mapInArrow(scan, ", ".join(schema))


def limits(found: DataFrame, *, times: float = 3.0, least: int = 5, near: int = 10) -> DataFrame:
    """(field, source, measure, limit, n_at_limit, n): hidden limits, where a length of a source is a pile of open texts.

    found comes from open_texts. Of unmarked texts that end no sentence, different endings count, so copies, templates
    and phrases of one length are one. A pile exceeds the near lengths below it, and the same above it, by as much as times
    their mean, and by more than chance gives to one of many lengths (six standard deviations and least). A text without
    special characters has one length under all measures, so each text counts for the largest of the piles it lies at (of
    equal ones for that of the first of MEASURES), and a pile that owes its size to another's texts is none. n_at_limit counts
    different endings, n those of the source. found should be durable: it is read three times.
    """
    # (length, texts) of every measure: sums over lengths, not over texts
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("m"), F.col(name).alias("length")) for i, name in enumerate(MEASURES)]))
    group = ["field", "source", "m"]
    each = found.filter("not marked and not final").select("field", "source", "ending", pairs.alias("p")).select("field", "source", "p.m", "p.length", "ending").distinct()
    counted = each.groupBy(*group, "length").agg(F.count(F.lit(1)).alias("k"))
    # what lies near a length: every length is sent to its neighbours, so no window holds a source
    sent = counted.select(*group, F.explode(F.sequence(F.col("length") - near, F.col("length") + near)).alias("at"), "length", "k")
    side = lambda test: F.sum(F.when(test, F.col("k")).otherwise(0)) / near
    around = sent.groupBy(*group, F.col("at").alias("length")).agg(F.max(F.when(F.col("length") == F.col("at"), F.col("k"))).alias("k"), F.greatest(side(F.col("length") < F.col("at")), side(F.col("length") > F.col("at"))).alias("beside"))
    piles = around.filter((F.col("k") >= times * F.col("beside")) & (F.col("k") >= F.col("beside") + 6 * F.sqrt("beside") + least))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("k")).alias("_k"), "m", "length", "beside")))
    lists = _few_sources(durable(piles.groupBy("field", "source").agg(ordered.alias("p"))))
    # every text goes to the largest pile it lies at; what is left of the others tells whether they are limits of their own
    texts = found.filter("not marked and not final").join(F.broadcast(lists), ["field", "source"])
    size = F.array(*[F.col(name) for name in MEASURES])
    first = F.get(F.filter("p", lambda x: _at(size, x["m"], x["length"])), F.lit(0))
    own = texts.select("field", "source", "ending", first.alias("x")).filter("x is not null").distinct().groupBy("field", "source", "x").agg(F.count(F.lit(1)).alias("k"))
    left = own.filter((F.col("k") >= times * F.col("x.beside")) & (F.col("k") >= F.col("x.beside") + 6 * F.sqrt("x.beside") + least))
    of_source = found.filter("not marked and not final").select("field", "source", "ending").distinct().groupBy("field", "source").agg(F.count(F.lit(1)).alias("n"))
    return left.join(of_source, ["field", "source"]).select("field", "source", F.element_at(F.array(*map(F.lit, MEASURES)), F.col("x.m") + 1).alias("measure"), F.col("x.length").alias("limit"), F.col("k").alias("n_at_limit"), "n")


def _at(sizes: Column, measure: Column, limit: Column) -> Column:
    """Whether a text of these sizes lies at a limit: at it, or short of it by less than the widest character takes."""
    return (limit - F.get(sizes, measure)).between(0, F.get(F.array(*map(F.lit, MEASURES.values())), measure) - 1)


def _few_sources(piles: DataFrame) -> DataFrame:
    """piles, one row a field and source; they are sent to every task, so ValueError for more than MAX_SOURCES."""
    if piles.count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources with a limit")
    return piles


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text)


class Words:
    """What is needed of each distinct word: as it stands, generalised, whether it ends a sentence, frame or not."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, int, bool, bool]] = {}

    def of(self, word: str) -> tuple[int, int, bool, bool]:
        found = self.known.get(word)
        if found is None:
            ends = bool(FINAL.search(word)) and not word.endswith("...")
            base = FINAL.sub("", word) if ends else word
            lower = re.sub(r"\d", "0", base.lower())
            if not any(c.isalpha() for c in base):
                # a number is a number, decimals or not
                wide = "0" if "0" in lower else lower
            elif "0" in lower or "://" in lower:
                wide = "Id"
            else:
                wide = "Xx" if base[:1].isupper() else lower
            if wide == "Id":
                # of an identifier only its last part is shared with others; a closing bracket says it is whole
                lower = ")" if lower.endswith(")") else re.search(r"[-/._:]?[^-/._:]*$", lower)[0]
            if len(self.known) > 1_000_000:
                self.known.clear()
            found = self.known[word] = (_hash(lower), _hash(wide), ends, lower in FRAME)
        return found


def contexts(texts: pa.Array, fields: np.ndarray, words: Words) -> tuple[dict[str, np.ndarray], np.ndarray, dict[str, np.ndarray]]:
    """Context hashes by kind of every word of the texts, the text of each word, and what happens at it.

    What happens: a sentence ends (by its mark) or goes on; turns tells where it goes on into another part of its frame. fields: a number a text.
    """
    split = pc.utf8_split_whitespace(texts)
    sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    coded = pc.list_flatten(split).dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    table = [words.of(w) for w in coded.dictionary.to_pylist()]
    exact, wide = (np.array([x[i] for x in table], np.uint64)[codes] if table else np.zeros(0, np.uint64) for i in (0, 1))
    ends, frame = (np.array([x[i] for x in table], bool)[codes] if table else np.zeros(0, bool) for i in (2, 3))
    # utf8_split_whitespace gives an empty word for blanks at either end
    empty = np.array([w == "" for w in coded.dictionary.to_pylist()], bool)[codes] if table else np.zeros(0, bool)
    owner = np.repeat(np.arange(len(sizes)), sizes)[~empty]
    exact, wide, ends, frame = exact[~empty], wide[~empty], ends[~empty], frame[~empty]
    n = len(owner)
    at = np.arange(n)
    first = np.ones(n, bool)
    first[1:] = ends[:-1] | (owner[1:] != owner[:-1])
    begin = np.maximum.accumulate(np.where(first, at, 0)) if n else at
    last = np.r_[first[1:], True] if n else first
    salt = fields[owner].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    out = {}
    for number, (kind, size) in enumerate(KINDS.items()):
        total = np.zeros(n, np.uint64)
        if size:
            base = exact if size <= 2 else wide
            for back in range(size):
                here = at - back
                total += np.where(here >= begin, base[np.maximum(here, 0)], _START) * np.uint64(pow(_M, back + 1, 1 << 64))
        else:
            # words outside the frame count once a run
            kept = frame | first | np.r_[True, frame[:-1]][:n]
            turns = ~last & np.r_[kept[1:], True][:n]
            rank = np.cumsum(kept)
            rank = rank - rank[begin]
            powers = np.array([pow(_M, i + 1, 1 << 64) for i in range(int(rank.max(initial=0)) + 1)], np.uint64)
            summed = np.cumsum(np.where(kept, np.where(frame, exact, np.uint64(7)) * powers[rank], np.uint64(0)), dtype=np.uint64)
            before = np.where(begin > 0, summed[np.maximum(begin - 1, 0)], np.uint64(0))
            total = summed - before
        total = (total + salt + np.uint64(number + 1)) * np.uint64(_M)
        out[kind] = (total ^ (total >> np.uint64(29))).view(np.int64)
    return out, owner, {"ends": last & ends, "goes_on": ~last, "turns": turns}


def context_filter(wanted: DataFrame, column: str = "context", most_words: int = FILTER_WORDS) -> np.ndarray:
    """A filter of hashes: words of 64 bits, a power of two of them, at most most_words. A hash sets four bits of one word.

    Grown to four hashes a word. Words are made by a bitwise sum in the cluster; at most most_words numbers reach the driver.
    """
    count = wanted.count()
    size = 1 << max(6, min(int(most_words).bit_length() - 1, max(1, -(-count // 4)).bit_length()))
    h = F.col(column)
    bit = lambda shift: F.expr(f"shiftleft(1L, cast(shiftrightunsigned(`{column}`, {shift}) & 63 as int))")
    mask = bit(30).bitwiseOR(bit(36)).bitwiseOR(bit(42)).bitwiseOR(bit(48))
    rows = wanted.select(h.bitwiseAND(F.lit(size - 1)).alias("w"), mask.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(size, np.uint64)
    out[rows.column("w").to_numpy()] = rows.column("b").to_numpy().view(np.uint64)
    return out


def passes(filter_words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the filter holds; others pass by chance."""
    h = hashes.view(np.uint64)
    held = filter_words[(h & np.uint64(len(filter_words) - 1)).view(np.int64)]
    mask = np.zeros(len(h), np.uint64)
    for shift in (30, 36, 42, 48):
        mask |= np.uint64(1) << ((h >> np.uint64(shift)) & np.uint64(63))
    return (held & mask) == mask


def context_counts(rows: DataFrame, fields: list[str], wanted: np.ndarray) -> DataFrame:
    """(context, ends, goes_on) of the contexts of all texts that the filter wanted lets through; counted a batch before they move.

    rows come from texts_of. What stands before the mark of a cut is no word, so marked texts are left out.
    """
    shared = rows.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, asked = Words(), shared.value
        for batch in batches:
            kept, ended = [], []
            for number in range(1, len(fields) + 1):
                column = batch.column(number - 1)
                use = _plainly_final(column)
                rest = np.flatnonzero(~use)
                use[rest] = [bool(x) and not is_marked(x.rstrip()) for x in column.take(pa.array(rest)).to_pylist()]
                found, _, how = contexts(column.filter(pa.array(use)), np.full(int(use.sum()), number), words)
                for kind, hashes in found.items():
                    # in a frame, a sentence goes on only where the next word belongs to another part
                    told = passes(asked, hashes) & (how["ends"] | how["turns" if kind == "frame" else "goes_on"])
                    kept.append(hashes[told])
                    ended.append(how["ends"][told])
            keys, inverse = np.unique(np.concatenate(kept), return_inverse=True)
            stops = np.bincount(inverse, np.concatenate(ended), len(keys)).astype(np.int64)
            total = np.bincount(inverse, minlength=len(keys))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(stops), pa.array(total - stops)], names=["context", "ends", "goes_on"])

    texts = rows.select(*[f"_text{i}" for i in range(len(fields))])
    return texts.mapInArrow(count, "context long, ends long, goes_on long").groupBy("context").agg(*[F.sum(c).alias(c) for c in ("ends", "goes_on")])


def _sure(count: Column, total: Column, share: float) -> Column:
    """Whether count is share of total or more, with two standard deviations to spare: one rule at every size."""
    return count - 2 * F.sqrt(count.cast("double")) >= share * total


def _whole(stat: dict[str, dict[str, Column]], total: Column, share: float, one_source: Column) -> Column:
    """Whether an ending without a mark is a whole text's, from what happens at its contexts elsewhere.

    total and share: of how many open texts of the field the stops must make up how much to tell of a habit; one_source:
    whether there is but one source to show it.
    """
    n = {k: s["ends"] + s["goes_on"] for k, s in stat.items()}
    rate = {k: s["ends"] / F.greatest(n[k], F.lit(1)) for k, s in stat.items()}
    habit = (stat["three"]["spread"] | one_source) & _sure(stat["three"]["stops"], total, share) & (stat["three"]["ends"] + stat["three"]["stops"] >= stat["three"]["goes_on"])
    return (
        F.when((n["last"] < 1) & ~_sure(stat["last"]["stops"], total, share), False)
        .when(habit, True)
        .when(F.col("numeric") & (n["two"] < 1), False)
        .when((n["two"] < 1) & (n["three"] < 1), False)
        .when((n["two"] >= 3) & (rate["two"] == 0), False)
        .when((n["three"] >= 3) & (rate["three"] == 0), False)
        .when(n["frame"] >= 4, rate["frame"] >= 0.5)
        .when(n["six"] >= 2, rate["six"] >= 0.5)
        .when(n["three"] >= 2, rate["three"] >= 0.5)
        .when(n["two"] >= 2, rate["two"] >= 0.5)
        .otherwise((n["last"] >= 1) & (rate["last"] >= 0.5))
    )


def _support(rows: DataFrame, keys: list[str], **counts: Column) -> DataFrame:
    """(keys, counts, spread) over the records of each key, whose copies count once: of counts, a maximum a record, summed."""
    once = rows.groupBy(*keys, "record").agg(*[F.max(c).alias(name) for name, c in counts.items()], F.count(F.lit(1)).alias("_uses"), F.min(F.xxhash64("source")).alias("_lo"), F.max(F.xxhash64("source")).alias("_hi"))
    return once.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in counts], F.sum("_uses").alias("uses"), (F.min("_lo") < F.max("_hi")).alias("spread"))


def truncated(df: DataFrame, fields: list[str], *, id_col: str = "rec_id", source: str = "feed", record: Column | None = None, share: float = 0.005) -> DataFrame:
    """(id, source, field, cause) of each text that lost its end; cause is mark, limit or ending.

    A text with a mark of a cut (MARKS) is truncated. A text that ends a sentence is whole, unless it ends in a
    number and such numbers go on elsewhere. Of the others, a text at a hidden limit of its source, or short of it by less
    than the widest character takes, is truncated; one that records of several sources hold as a share of the open texts of
    its field (beyond doubt: see _sure) is a phrase and whole; the rest is judged by contexts over the whole collection.
    Copies of a record (rows alike in record; each id is one without it) count once, as does a text that comes with it
    again; neither a phrase nor a habit rests on one source where there are more, so copies of a damaged record are judged
    by their ending. Null and blank texts are no case; long texts are read whole; rows that repeat are reported as often as
    they come; an empty table gives no rows.
    """
    rows = texts_of(df, fields, id_col, source, record)
    kept = durable(open_texts(rows, fields))
    number = F.array_position(F.array(*map(F.lit, MEASURES)), F.col("measure")).cast("int") - 1
    piles = _few_sources(durable(limits(kept).groupBy("field", "source").agg(F.collect_list(F.struct(number.alias("m"), "limit")).alias("limits"))))
    # texts that many records share are phrases; at most 1 / share a field, so they go to every task
    shared = durable(_support(kept.filter("not marked and not final"), ["field", "key"], k=F.lit(1)))
    total = durable(shared.groupBy("field").agg(F.sum("k").alias("n")).join(kept.groupBy("field").agg((F.min("source") == F.max("source")).alias("one_source")), "field", "right").fillna(0, ["n"]))
    phrases = shared.join(F.broadcast(total), "field").filter((F.col("spread") | F.col("one_source")) & _sure(F.col("k"), F.col("n"), share)).select("field", "key", F.lit(True).alias("phrase"))
    sizes = F.array(*[F.col(m) for m in MEASURES])
    at_limit = F.exists("limits", lambda e: _at(sizes, e["m"], e["limit"]))
    judged = kept.join(F.broadcast(piles), ["field", "source"], "left").join(F.broadcast(phrases), ["field", "key"], "left")
    judged = judged.withColumn("cause", F.when(F.col("marked"), "mark").when(~F.col("final") & F.coalesce(at_limit, F.lit(False)), "limit").when(~F.col("final") & F.col("phrase"), "none"))
    sure = judged.filter("cause in ('mark', 'limit')").select("id", "source", "field", "cause")
    by_kind = F.explode(F.map_from_arrays(F.array(*map(F.lit, KINDS)), F.array(*KINDS))).alias("kind", "context")
    unmarked = judged.filter("not marked").select("id", "source", "record", "field", "key", "final", "numeric", F.col("cause").isNull().alias("asked"), by_kind)
    used = _support(unmarked, ["context"], stops=F.when(F.col("final"), 0).otherwise(1), asked=F.col("asked").cast("int"))
    wanted = durable(used.filter("asked > 0").select("context", "stops", "spread", "uses"))
    counts = context_counts(rows, fields, context_filter(wanted))
    stats = durable(wanted.join(counts, "context", "left"))
    met = lookup(unmarked.filter("asked").drop("asked", "record"), stats, ["context"], ["ends", "stops", "goes_on", "spread"], "uses")
    # an ending has counted itself once, and its record once
    own = {"ends": F.col("final").cast("int"), "stops": (~F.col("final")).cast("int"), "goes_on": F.lit(0)}
    value = lambda kind, name: F.max(F.when(F.col("kind") == kind, F.coalesce(F.col(name), F.lit(0)) - own[name])).alias(name)
    wide = met.groupBy("id", "source", "field", "key", "final", "numeric").agg(F.count(F.when(F.col("kind") == "last", 1)).alias("times"), *[F.struct(*[value(k, name) for name in own], F.bool_or((F.col("kind") == k) & F.coalesce("spread", F.lit(False))).alias("spread")).alias(k) for k in KINDS])
    stat = {k: {name: F.col(f"{k}.{name}") for name in [*own, "spread"]} for k in KINDS}
    wide = wide.join(F.broadcast(total), "field")
    number_goes_on = (stat["three"]["goes_on"] > 9 * stat["three"]["ends"]) & (stat["three"]["goes_on"] >= 3)
    lost = wide.filter(F.when(F.col("final"), F.coalesce(number_goes_on, F.lit(False))).otherwise(~_whole(stat, F.col("n"), share, F.col("one_source"))))
    by_ending = lost.select("id", "source", "field", F.lit("ending").alias("cause"), F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("_n")).drop("_n")
    return sure.unionByName(by_ending)


def shares(df: DataFrame, found: DataFrame, fields: list[str], *, id_col: str = "rec_id", source: str = "feed") -> DataFrame:
    """(source, field, n, n_truncated, share): how often each source truncates each field; blank texts do not count."""
    name = F.coalesce(F.col(f"`{source}`").cast("string"), F.lit(""))
    held = df.groupBy(name.alias("source")).agg(*[F.count_if(F.col(f"`{f}`").rlike(r"(?U)\S")).alias(f"_n{i}") for i, f in enumerate(fields)])
    every = held.select("source", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_n{i}").alias("n")) for i, f in enumerate(fields)])).alias("e")).select("source", "e.*").filter("n > 0")
    cut = found.groupBy("source", "field").agg(F.count(F.lit(1)).alias("n_truncated"))
    return every.join(cut, ["source", "field"], "left").fillna(0, ["n_truncated"]).withColumn("share", F.col("n_truncated") / F.col("n"))
