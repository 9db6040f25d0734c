"""Language of every document and of every stretch in one language, by prediction by partial matching.

Statistics are fitted on a bounded sample of labelled documents (PER_LANGUAGE of each language, of at most
MAX_CHARS characters) and cleaned of wrong labels by two-fold scoring. Then every document is scored whole, sentence
by sentence, inside its own partition: no shuffle, and a document costs in proportion to its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.llm import ppm

#: The sample: documents a language, and the shortest and longest that are taken.
PER_LANGUAGE, MIN_CHARS, MAX_CHARS = 200, 150, 4000
#: Bits by which a sentence must be cheaper in another language than the document's, and its least bytes.
SWITCH_BITS, SWITCH_BYTES = 24.0, 20
#: Bytes scored at once.
CHUNK = 1 << 19

#: The code of a text in no language that the model knows, as ISO 639-2 has it.
UNKNOWN = "und"
#: A stretch is in no known language if it costs these bits more than its language's limit (see Fit) and another language
#: costs less than this part more.
UNKNOWN_BITS, UNKNOWN_GAP = 64.0, 0.25

#: Bibliographic ISO 639-2 codes that differ from the others, and names and codes of the same language. Fixed values.
BIBLIOGRAPHIC = "alb:sq arm:hy baq:eu bur:my chi:zh cze:cs dut:nl fre:fr geo:ka ger:de gre:el ice:is mac:mk mao:mi may:ms per:fa rum:ro slo:sk tib:bo wel:cy"
SAME = "iw:he in:id ji:yi jw:jv mo:ro nb:no nob:no nn:no nno:no castellano:es"


@lru_cache(maxsize=1)
def language_names() -> dict[str, str]:
    """Name -> ISO 639-1 code: every such code, its ISO 639-2 codes, and its English and own name, in lower case.

    The names are those of the Java runtime that Spark runs on; the first word of a name stands for it unless another
    language has it.
    """
    locale = SparkContext._active_spark_context._jvm.java.util.Locale
    same = dict(x.split(":") for x in f"{BIBLIOGRAPHIC} {SAME}".split())
    codes = sorted(set(locale.getISOLanguages()))
    names = {code: same.get(code, code) for code in codes if len(code) == 2}
    for code in list(names):
        own = locale.forLanguageTag(code)
        for name in (own.getISO3Language(), own.getDisplayLanguage(locale.ENGLISH), own.getDisplayLanguage(own)):
            names.setdefault(name.lower(), names[code])
    for name, code in list(names.items()):
        if " " in name:
            names.setdefault(name.split()[0], code)
    return names | {name: code for name, code in same.items() if name not in names or len(name) == 3}


def label_code(label: Column) -> Column:
    """ISO 639-1 code a label names, in whatever notation (en, EN, eng, English, en-GB, en_US); null if it names none."""
    table = F.create_map(*[F.lit(x) for pair in language_names().items() for x in pair])
    whole = F.lower(F.regexp_replace(label, r"(?U)^\s+|\s+$", ""))
    return F.coalesce(F.element_at(table, whole), F.element_at(table, F.element_at(F.split(whole, r"[-_\s(]"), 1)))


class Sentences:
    """Sentences of documents that lie end to end in one buffer."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        """data: bytes; offsets: where each document begins, and the end. Documents without a word get no sentence."""
        blank = data <= 32
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        after_blank = np.r_[True, blank[:-1]]
        begins = np.flatnonzero(~blank & (after_blank | edge[:-1]))
        ends = np.flatnonzero(~blank & (np.r_[blank[1:], True] | edge[1:]))
        doc = np.searchsorted(offsets, begins, "right") - 1
        last = lambda back: data[np.maximum(ends - back, 0)]
        stop = lambda x: (x == 46) | (x == 33) | (x == 63)
        a, b, c = last(0), last(1), last(2)
        closed = stop(a) | (((a == 41) | (a == 34) | (a == 39) | (a == 93)) & stop(b)) | ((a == 0xBB) & (b == 0xC2) & stop(c))
        closed |= (c == 0xE2) & (b == 0x80) & (((a == 0x9D) & stop(last(3))) | (a == 0xA6))
        lines = np.r_[0, np.cumsum(data == 10)]
        new = np.ones(len(begins), bool)
        new[1:] = closed[:-1] | (doc[1:] != doc[:-1]) | (lines[begins[1:]] - lines[ends[:-1]] > 1)
        self.doc = doc[new]
        firsts = np.flatnonzero(new)
        self.begin = begins[new]
        self.end = ends[np.r_[firsts[1:], len(ends)] - 1] + 1 if len(ends) else self.begin
        # runs of blanks count as one for scoring
        kept = ~(blank & after_blank)
        self.packed = np.where(blank, np.uint8(32), data)[kept]
        self.start = (np.cumsum(kept) - 1)[self.begin] if len(self.begin) else self.begin


def decide(bits: np.ndarray, doc: np.ndarray, sizes: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Language (column of bits) of each document, and of each sentence.

    A document's language is that of most bytes in sentences that tell clearly, else the cheapest in all; a
    sentence has another only when that is clearly cheaper.
    """
    each = np.arange(len(doc))
    best = bits.argmin(1)
    ordered = np.partition(bits, 1, axis=1) if bits.shape[1] > 1 else np.c_[bits, np.full(len(bits), np.inf)]
    clear = ordered[:, 1] - ordered[:, 0] > SWITCH_BITS
    weight, total = np.zeros((docs, bits.shape[1])), np.zeros((docs, bits.shape[1]))
    np.add.at(weight, (doc[clear], best[clear]), sizes[clear])
    np.add.at(total, doc, bits)
    main = np.where(weight.any(1), weight.argmax(1), total.argmin(1))
    own = main[doc]
    other = (bits[each, own] - bits[each, best] > SWITCH_BITS) & (sizes >= SWITCH_BYTES)
    return main, np.where(other, best, own)


def confidence(bits: np.ndarray, chosen: np.ndarray, temper: float) -> np.ndarray:
    """Chance of the chosen column given code lengths; temper allows for bytes that hang together."""
    if not len(bits):
        return np.zeros(0)
    gap = np.clip((bits - bits[np.arange(len(bits)), chosen][:, None]) / temper, -500, 500)
    return 1 / np.exp2(-gap).sum(1)


@dataclass
class Fit:
    """A model with what its own held-out text costs: limits, bits a byte a language, half way from there to a byte without any
    knowledge; temper, under which confidences are right as often as they say."""

    model: ppm.Model
    limits: np.ndarray
    temper: float

    def plain(self) -> tuple:
        """Arrays and names only, for a broadcast."""
        return self.model.plain(), self.limits, self.temper

    @classmethod
    def of(cls, plain: tuple) -> Fit:
        return cls(ppm.Model.of(plain[0]), *plain[1:])

    def strange(self, bits: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """Which stretches are in no language of the model: dear for the chosen one, and about as dear for another."""
        if not len(bits):
            return np.zeros(0, bool)
        own = bits[np.arange(len(bits)), chosen]
        dear = own - self.limits[chosen] * sizes > UNKNOWN_BITS
        if bits.shape[1] == 1:
            return dear
        others = bits.copy()
        others[np.arange(len(bits)), chosen] = np.inf
        return dear & (others.min(1) < (1 + UNKNOWN_GAP) * own)


def fitted_temper(bits: np.ndarray, right: np.ndarray) -> float:
    """The temper that makes held-out sentences, each in the language right, most likely; 8 without any."""
    if not len(bits):
        return 8.0
    tempers = [2.0 ** (k / 2) for k in range(-2, 15)]
    cost = [-np.log2(np.maximum(confidence(bits, right, t), 1e-300)).mean() for t in tempers]
    return tempers[int(np.argmin(cost))]


SEGMENT = pa.struct([("lang", pa.string()), ("confidence", pa.float64()), ("start_char", pa.int64()), ("n_chars", pa.int64()), ("n_sentences", pa.int32())])
SEGMENT_DDL = "array<struct<lang:string,confidence:double,start_char:bigint,n_chars:bigint,n_sentences:int>>"


def label_chunk(fit: Fit, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    """lang, confidence and segments of the documents in data."""
    docs = len(offsets) - 1
    model = fit.model
    names = np.array([*model.languages, UNKNOWN], dtype=object)
    found = Sentences(data, offsets)
    if len(found.doc) and model.languages:
        starts = found.start.copy()
        starts[0] = 0
        bits = ppm.stretch_bits(model, found.packed, starts)
        size = np.diff(np.r_[starts, len(found.packed)])
    else:
        bits, size = np.zeros((len(found.doc), max(1, len(model.languages)))), np.zeros(len(found.doc), int)
    if not model.languages:
        found.doc, bits, size = found.doc[:0], bits[:0], size[:0]
    main, own = decide(bits, found.doc, found.end[: len(found.doc)] - found.begin[: len(found.doc)], docs)
    total, bulk = np.zeros((docs, bits.shape[1])), np.zeros(docs)
    agree = own == main[found.doc]
    np.add.at(total, found.doc[agree], bits[agree])
    np.add.at(bulk, found.doc[agree], size[agree])
    has = np.zeros(docs, bool)
    has[found.doc] = True
    heads = np.flatnonzero(np.r_[True, (found.doc[1:] != found.doc[:-1]) | (own[1:] != own[:-1])]) if len(own) else np.zeros(0, int)
    tails = np.r_[heads[1:], len(own)].astype(int)
    summed = np.add.reduceat(bits, heads, axis=0) if len(heads) else bits[:0]
    weight = np.add.reduceat(size, heads) if len(heads) else size[:0]
    chars = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    begin, end = found.begin[heads], found.end[tails - 1] if len(tails) else found.begin[heads]
    spoken = np.where(fit.strange(summed, weight, own[heads]), len(model.languages), own[heads])
    segments = pa.StructArray.from_arrays(
        [pa.array(names[spoken] if len(heads) else [], pa.string()), pa.array(np.where(spoken == own[heads], confidence(summed, own[heads], fit.temper), 0.0)), pa.array(chars[begin] - chars[offsets[found.doc[heads]]], pa.int64()), pa.array(chars[end] - chars[begin], pa.int64()), pa.array(tails - heads, pa.int32())],
        fields=list(SEGMENT),
    )
    bounds = np.r_[0, np.cumsum(np.bincount(found.doc[heads], minlength=docs))]
    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), segments)
    strange = fit.strange(total, bulk, main) if model.languages else np.zeros(docs, bool)
    sure = np.where(strange, 0.0, confidence(total, main, fit.temper))
    langs = [x if h else None for x, h in zip(names[np.where(strange, len(model.languages), main)], has, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(sure, mask=~has), lists], names=["lang", "confidence", "segments"])


def chunks(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about size bytes; a longer document is alone."""
    at = 0
    while at < len(offsets) - 1:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, end
        at = end


def sample(df: DataFrame, text: str, label: str, per_language: int = PER_LANGUAGE) -> dict[str, list[bytes]]:
    """Up to per_language labelled texts of each language, of MIN_CHARS to MAX_CHARS characters, those with the smallest hash."""
    rows = df.select(label_code(F.col(f"`{label}`")).alias("lang"), F.col(f"`{text}`").alias("text")).filter(f"lang is not null and length(text) between {MIN_CHARS} and {MAX_CHARS}")
    first = Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text")
    picked = rows.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= per_language).select("lang", F.lower("text").alias("text")).collect()
    texts: dict[str, list[bytes]] = {}
    for row in picked:
        texts.setdefault(row["lang"], []).append(row["text"].encode())
    return texts


def cleaned(texts: dict[str, list[bytes]], least_texts: int = 5, least_share: float = 0.5, rounds: int = 3) -> tuple[dict[str, list[bytes]], dict[str, float], float]:
    """Sentences of the texts that a model of the other half gives the language of their label, as does the text around.

    Repeated rounds learn from what the one before kept. A language with fewer than least_texts texts, or that keeps
    less than least_share of its bytes, is left out. With them come the bits a byte that the kept sentences of each language cost
    the model of the other half, and the temper under which that model's confidence is right.
    """
    texts = {x: sorted(own) for x, own in texts.items() if len(own) >= least_texts}
    halves = [{x: own[i::2] for x, own in texts.items()} for i in (0, 1)]
    learnt = halves
    cost: dict[str, list[float]] = {}
    seen: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds if texts else 0):
        kept: list[dict[str, list[bytes]]] = [{}, {}]
        cost, seen = {x: [0.0, 0.0] for x in texts}, []
        for side in (0, 1):
            model = ppm.fit(learnt[1 - side])
            for x, own in halves[side].items():
                data = np.frombuffer(b"".join(own), np.uint8)
                found = Sentences(data, np.r_[0, np.cumsum([len(o) for o in own])])
                kept[side][x] = []
                if not len(found.doc):
                    continue
                starts = found.start.copy()
                starts[0] = 0
                bits = ppm.stretch_bits(model, found.packed, starts)
                main, lang = decide(bits, found.doc, found.end - found.begin, len(own))
                at = model.languages.index(x)
                good = (lang == at) & (bits.argmin(1) == lang)
                kept[side][x] = [data[b:e].tobytes() for b, e in zip(found.begin[good], found.end[good], strict=True)]
                size = np.diff(np.r_[starts, len(found.packed)])
                cost[x][0] += bits[good, at].sum()
                cost[x][1] += size[good].sum()
                # sentences of texts in the language of their label that no other language claims clearly
                told = (main[found.doc] == at) & (lang == at)
                seen.append((bits[told], np.full(int(told.sum()), at)))
        learnt = kept
    joined = {x: learnt[0][x] + learnt[1][x] for x in texts}
    joined = {x: own for x, own in joined.items() if sum(map(len, own)) >= least_share * sum(map(len, texts[x]))}
    temper = fitted_temper(np.concatenate([b for b, _ in seen]), np.concatenate([r for _, r in seen])) if seen else 8.0
    return joined, {x: cost[x][0] / max(1.0, cost[x][1]) for x in joined}, temper


def fitted(df: DataFrame, text: str = "text", label: str = "lang", per_language: int = PER_LANGUAGE) -> Fit:
    """A model of every language that the labels of df name often enough."""
    texts, cost, temper = cleaned(sample(df, text, label, per_language))
    model = ppm.fit(texts)
    return Fit(model, np.array([(cost[x] + 8) / 2 for x in model.languages]), temper)


def identify(df: DataFrame, fit: Fit, *, id_col: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(id, columns of keep, lang, confidence, segments) of every document.

    segments are stretches in one language: lang, confidence, start_char and n_chars in the text, n_sentences. A text
    or stretch in no language of the model has lang UNKNOWN and confidence 0 (see Fit.strange). A null text, a text without a word, and a model without languages give null lang and no segments. Repeated ids
    stay repeated. Columns lang, confidence and segments of df are not kept unless renamed before.
    """
    kept = [c for c in (keep or []) if c not in ("lang", "confidence", "segments", id_col)]
    # a capital dotted i would become two characters in lower case and shift offsets
    rows = df.select(F.col(f"`{id_col}`"), *[F.col(f"`{c}`") for c in kept], F.lower(F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), "İ", "I")).alias("_text"))
    shared = df.sparkSession.sparkContext.broadcast(fit.plain())
    names = [*rows.columns[:-1], "lang", "confidence", "segments"]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Fit.of(shared.value)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            if not batch.num_rows:
                continue
            column = column.cast(pa.large_string())
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
            data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] and column.buffers()[2].size else np.zeros(0, np.uint8)
            for a, b in chunks(offsets, CHUNK):
                out = label_chunk(own, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                yield pa.RecordBatch.from_arrays([c.slice(a, b - a) for c in batch.columns[:-1]] + out.columns, names=names)

    types = dict(rows.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in names[:-3]] + ["lang string", "confidence double", f"segments {SEGMENT_DDL}"])
    return rows.mapInArrow(label, schema)


def mislabelled(labelled: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """(id, lang) of each case and each language it holds a sentence of.

    A case has a label that is null, blank or names no language, names another language than the text's, or holds
    sentences in several. A text in no known language is no case by itself: its label can't be held against it.
    labelled comes from identify with the label kept.
    """
    langs = F.array_distinct(F.filter(F.transform("segments", lambda s: s["lang"]), lambda x: x != UNKNOWN))
    code = label_code(F.col(f"`{label}`"))
    wrong = code.isNull() | ((F.col("lang") != UNKNOWN) & (code != F.col("lang"))) | (F.size("_langs") > 1)
    cases = labelled.withColumn("_langs", langs).filter(F.col("lang").isNotNull() & wrong)
    return cases.select(F.col(f"`{id_col}`"), F.explode("_langs").alias("lang"))
