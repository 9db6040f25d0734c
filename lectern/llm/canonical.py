"""Map freely typed values to the entries of a reference list.

A multi-pattern automaton over canonical names and aliases finds embedded mentions, the longest
non-overlapping mention wins, and what is left goes to token-set similarity with typo-tolerant tokens.
The reference list is small by nature (its size is checked); the values never leave their partition, so
the mapping needs no shuffle and a value that fills a third of all rows costs one lookup a batch.
"""

from __future__ import annotations

import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from math import log

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lectern.session import durable

#: Most names (terms and aliases) a reference list may hold; it travels to every task.
MAX_NAMES = 200_000
#: A word is learnt as filler only if it makes up one in so many words beside mentions, so there are no more fillers than that.
FILLER_WORDS = 20_000
#: Terms a word must stand beside to be filler, none of them with more than half of its uses.
FILLER_TERMS = 3

#: Part of a name's weight that a value must hold which says nothing else and fits one term only.
LEAST_PART = 0.4

#: Function words of English: they say nothing about what a value means.
FUNCTION_WORDS = frozenset("a an the of in on at by to and or with for from among as is are while after before during per vs via than".split())
#: Those that open a phrase of place, people or time behind a mention.
OPENERS = frozenset("in from among for of with".split())
#: Endings that English inflects and derives words with, longest first.
ENDINGS = "ations ation ments ment ings ing ions ion ages age ries ry ers er ies ied ed es s e y".split()


def normalise(value: str) -> str:
    """Compatibility form, case folded, every run of other than letters and digits made one space."""
    folded = unicodedata.normalize("NFKC", value).casefold()
    return " ".join("".join(c if c.isalnum() else " " for c in folded).split())


def edits(a: str, b: str, most: int) -> int:
    """Edits between a and b (swap of neighbours counts one), or most + 1 when there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            cost = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, last[j - 2] + 1)
            row.append(cost)
        if min(row) > most:
            return most + 1
    return min(row[-1], most + 1)


def shortened(word: str, times: int) -> set[str]:
    """The first seven characters of a word and what is left of them after dropping up to so many.

    Words within so many edits of each other share one of these, for an edit costs each side one character at most.
    """
    found = level = {word[:7]}
    for _ in range(times):
        level = {w[:i] + w[i + 1 :] for w in level for i in range(len(w))}
        found = found | level
    return found


def allowed(word: str) -> int:
    return 0 if len(word) < 3 else 1 if len(word) < 6 else 2


def stem(word: str) -> str:
    """A word without its ending, where at least four characters are left."""
    for ending in ENDINGS:
        if word.endswith(ending) and len(word) - len(ending) >= 4:
            return word[: -len(ending)]
    return word


class FieldIndex:
    """Names of one field: automaton for mentions, indexes of typos, stems and prefixes for tokens, token sets for similarity."""

    def __init__(self, names: dict[str, int], least_name: float, least_value: float, filler: frozenset[str] = frozenset()):
        import ahocorasick

        self.names, self.least_name, self.least_value = names, least_name, least_value
        self.sets = {name: tuple(name.split()) for name in names}
        self.automaton = ahocorasick.Automaton()
        for name in names:
            self.automaton.add_word(f" {name} ", name)
        if names:
            self.automaton.make_automaton()
        self.having: dict[str, list[str]] = {}
        for name, words in self.sets.items():
            for word in set(words):
                self.having.setdefault(word, []).append(name)
        # a word of a name keeps its meaning there, however often it stands beside other terms
        self.filler = FUNCTION_WORDS | {w for w in filler if w not in self.having}
        # a word weighs by its length and by how rare it is among the names
        scale = log(len(names) + 1)
        self.weight = {w: len(w) * max(0.2, log((len(names) + 1) / len(found)) / scale) * (0.3 if w in FUNCTION_WORDS else 1.0) for w, found in self.having.items()}
        self.sorted = sorted(self.having)
        self.typos: dict[str, list[str]] = {}
        self.stems: dict[str, list[str]] = {}
        for word in self.sorted:
            for short in shortened(word, allowed(word)):
                self.typos.setdefault(short, []).append(word)
            self.stems.setdefault(stem(word), []).append(word)
        self.like = lru_cache(maxsize=200_000)(self._like)

    def _like(self, token: str) -> dict[str, float]:
        """Words of the names that the token may be a spelling or a form of, with a similarity."""
        found = {token: 1.0} if token in self.having else {}
        if token.isdigit():
            return found
        for short in shortened(token, allowed(token)):
            for word in self.typos.get(short, ()):
                if word not in found and (d := edits(token, word, allowed(word))) <= allowed(word):
                    found[word] = 1 - d / max(len(token), len(word))
        for word in self.stems.get(stem(token), ()):
            found[word] = max(found.get(word, 0.0), 0.9)
        # an abbreviation; of one or two letters it tells less
        if token not in FUNCTION_WORDS:
            for at in range(bisect_left(self.sorted, token), len(self.sorted)):
                word = self.sorted[at]
                if not word.startswith(token):
                    break
                if word not in found and len(word) > len(token) + 1:
                    found[word] = 0.85 if len(token) >= 3 else 0.7
        return found

    def mentions(self, text: str) -> list[tuple[int, int, str]]:
        """Longest non-overlapping names in the text, as (start, end, name) without the blanks around."""
        if not self.names:
            return []
        hits = []
        for end, name in self.automaton.iter(f" {text} "):
            start = end - len(name) - 1
            hits.append((start, start + len(name), name))
        chosen: list[tuple[int, int, str]] = []
        for start, end, name in sorted(hits, key=lambda x: (x[0] - x[1], x[0])):
            at = bisect_left(chosen, (start, end, name))
            if (at == 0 or chosen[at - 1][1] <= start) and (at == len(chosen) or chosen[at][0] >= end):
                chosen.insert(at, (start, end, name))
        return chosen

    def content(self, tokens: list[str], used: set[int]) -> list[str]:
        """Unused tokens that carry meaning: no filler, no number, nothing in a phrase of place or people behind a used one."""
        rest, open_phrase, seen = [], False, False
        for i, token in enumerate(tokens):
            if i in used:
                seen, open_phrase = True, False
            elif token in OPENERS and seen:
                open_phrase = True
            elif not open_phrase and token not in self.filler and not token.isdigit():
                rest.append(token)
        return rest

    def mentioned(self, text: str) -> tuple[str, int, list[str]]:
        """The longest name in the text (the first of equal ones), the characters of all names in it, and the other tokens that carry meaning."""
        found = self.mentions(text)
        if not found:
            return "", 0, []
        tokens, at, used, spans = text.split(), 0, set(), iter(found)
        span = next(spans)
        for i, token in enumerate(tokens):
            while span and at >= span[1]:
                span = next(spans, None)
            if span and span[0] <= at:
                used.add(i)
            at += len(token) + 1
        longest = max(found, key=lambda x: (x[1] - x[0], -x[0]))[2]
        return longest, sum(len(name.replace(" ", "")) for *_, name in found), self.content(tokens, used)

    def by_mention(self, text: str) -> tuple[int, float]:
        name, named, rest = self.mentioned(text)
        share = named / (named + sum(map(len, rest))) if name else 0.0
        return (self.names[name], share) if name and share >= self.least_value else (0, 0.0)

    def by_tokens(self, text: str) -> tuple[int, float]:
        tokens = text.split()
        likes = [self.like(t) for t in tokens]
        candidates = {name for like in likes for word in like if word not in FUNCTION_WORDS for name in self.having[word]}
        best: tuple[float, float, str] = (0.0, 0.0, "")
        parts: dict[int, float] = {}
        for name in candidates:
            have = total = 0.0
            used: set[int] = set()
            for word in self.sets[name]:
                weight = self.weight[word]
                total += weight
                fit = max(((like[word], -i) for i, like in enumerate(likes) if word in like and i not in used), default=None)
                if fit:
                    used.add(-fit[1])
                    have += weight * fit[0]
            rest = self.content(tokens, used)
            if total and not rest and have / total >= LEAST_PART and any(len(tokens[i]) > 3 and tokens[i] not in FUNCTION_WORDS for i in used):
                parts[self.names[name]] = max(parts.get(self.names[name], 0.0), have / total)
            if total == 0 or have / total < self.least_name:
                continue
            named = sum(len(tokens[i]) for i in used if tokens[i] not in FUNCTION_WORDS)
            share = named / max(1, named + sum(map(len, rest)))
            if share >= self.least_value:
                best = max(best, (have / total * share, have, name))
        if best[0] > 0.8:
            return self.names[best[2]], best[0]
        found = max((self.names[best[2]], best[0]) if best[2] else (0, 0.0), self.by_spelling(tokens, likes), key=lambda x: x[1])
        # part of a name and nothing else, where no other term has a name with that part
        return next(iter(parts.items())) if not found[0] and len(parts) == 1 else found

    def by_spelling(self, tokens: list[str], likes: list[dict[str, float]]) -> tuple[int, float]:
        """The whole value against names that share a token with it: at most one edit in five characters."""
        text = " ".join(tokens)
        plain = " ".join(t for t in tokens if t not in self.filler and not t.isdigit())
        best: tuple[float, str] = (0.0, "")
        for name in {name for like in likes for word in like for name in self.having[word]}:
            most = len(name) // 5
            if len(name) >= 8:
                d = min(edits(text, name, most), edits(plain, name, most))
                if d <= most:
                    best = max(best, (1 - d / len(name), name))
        return (self.names[best[1]], best[0]) if best[1] else (0, 0.0)

    def resolve(self, value: str) -> tuple[int, str, float]:
        text = normalise(value)
        if text in self.names:
            return self.names[text], "name", 1.0
        term, score = self.by_mention(text)
        if term:
            return term, "mention", score
        term, score = self.by_tokens(text)
        return (term, "tokens", score) if term else (0, "none", 0.0)


def reference_names(terms: DataFrame, synonyms: dict[str, dict[str, list[str]]] | None = None, max_names: int = MAX_NAMES) -> dict[str, dict[str, int]]:
    """Normalised name -> term_id by field; a canonical name beats an alias, the smaller term_id another.

    terms needs columns field, term_id, term, alt_terms. Null terms and names without letter or digit are left
    out. More than max_names names raise ValueError: the list is sent to every task.
    """
    aliases = F.filter(F.flatten(F.array(F.array("term"), F.coalesce("alt_terms", F.array().cast("array<string>")))), lambda x: x.isNotNull())
    rows = terms.filter("field is not null and term_id is not null and term is not null").select("field", "term_id", "term", F.explode(aliases).alias("name")).limit(max_names + 1).collect()
    if len(rows) > max_names:
        raise ValueError(f"the reference list has more than {max_names} names")
    named: dict[str, dict[str, tuple[int, int]]] = {}
    for row in rows:
        extra = [(0 if row["name"] == row["term"] else 1, row["name"])]
        if row["name"] == row["term"]:
            extra += [(2, x) for x in (synonyms or {}).get(row["field"], {}).get(row["term"], [])]
        for rank, name in extra:
            if key := normalise(name):
                own = named.setdefault(row["field"], {})
                own[key] = min(own.get(key, (9, 0)), (rank, row["term_id"]))
    return {field: {k: v[1] for k, v in own.items()} for field, own in named.items()}


def _built(shared: dict, kind: str, least_name: float, least_value: float) -> dict[str, FieldIndex]:
    """The indexes of a broadcast list, built once a worker process: a broadcast value stays with the worker."""
    key = (kind, least_name, least_value)
    if key not in shared["built"]:
        shared["built"][key] = {f: FieldIndex(own, least_name, least_value, shared["filler"]) for f, own in shared["names"].items()}
    return shared["built"][key]


def filler_words(values: DataFrame, names: dict[str, dict[str, int]], *, field: str = "field", value: str = "value") -> DataFrame:
    """(word, n, n_terms): words that stand beside names of many terms and so say nothing about which is meant.

    Counted over all values that hold a mention. A word is filler if it stands beside FILLER_TERMS terms or more, none
    of them has more than half of its uses, and it is one in FILLER_WORDS of all such words or more, which bounds how
    many there are. Counts are combined in each task before they move.
    """
    shared = values.sparkSession.sparkContext.broadcast({"names": names, "filler": frozenset(), "built": {}})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _built(shared.value, "mentions", 0.0, 0.0)
        known: dict[tuple[str, str], tuple[int, list[str]]] = {}
        found: dict[tuple[str, int], int] = {}

        def sent() -> pa.RecordBatch:
            words, terms = zip(*found, strict=True) if found else ((), ())
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(terms, pa.int64()), pa.array(found.values(), pa.int64())], names=["word", "term", "n"])
            found.clear()
            return out

        for batch in batches:
            for key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hit = known.get(key)
                if hit is None:
                    own = index.get(key[0])
                    name, _, rest = own.mentioned(normalise(key[1])) if own and key[1] is not None else ("", 0, [])
                    hit = known[key] = (own.names[name], sorted(set(rest))) if name and own else (0, [])
                    if len(known) > 500_000:
                        known.clear()
                for word in hit[1]:
                    found[word, hit[0]] = found.get((word, hit[0]), 0) + 1
            if len(found) > 200_000:
                yield sent()
        yield sent()

    each = values.select(F.col(f"`{field}`"), F.col(f"`{value}`")).mapInArrow(count, "word string, term long, n long").groupBy("word", "term").agg(F.sum("n").alias("n"))
    words = each.groupBy("word").agg(F.sum("n").alias("n"), F.max("n").alias("_most"), F.count(F.lit(1)).alias("n_terms"))
    total = durable(words)
    every = total.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    return total.filter((F.col("n_terms") >= FILLER_TERMS) & (2 * F.col("_most") <= F.col("n")) & (F.col("n") * FILLER_WORDS >= every)).drop("_most")


def map_values(values: DataFrame, terms: DataFrame, *, field: str = "field", value: str = "value", synonyms: dict[str, dict[str, list[str]]] | None = None, least_name: float = 0.68, least_value: float = 0.5, max_names: int = MAX_NAMES) -> DataFrame:
    """values plus term_id (0: nothing on the list), match_by (name, mention, tokens, none) and match_score.

    Null field or value, a blank value, and a field without reference terms give term_id 0. Values of any length
    are read whole. Repeated rows stay repeated. Ties go to the higher score, then more matched characters, then
    the name that sorts last. Columns term_id, match_by and match_score of values are replaced. synonyms, field ->
    term -> names, adds names that the list lacks; without it a value must share words with a name of its term.
    """
    names = reference_names(terms, synonyms, max_names)
    filler = frozenset(r["word"] for r in filler_words(values, names, field=field, value=value).select("word").collect())
    shared = values.sparkSession.sparkContext.broadcast({"names": names, "filler": filler, "built": {}})

    @F.pandas_udf("term_id long, match_by string, match_score double")
    def resolve(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        index = _built(shared.value, "all", least_name, least_value)
        known: dict[tuple[str, str], tuple[int, str, float]] = {}
        for fields, texts in batches:
            out = []
            for key in zip(fields, texts, strict=True):
                hit = known.get(key)
                if hit is None:
                    own = index.get(key[0])
                    hit = own.resolve(key[1]) if own and isinstance(key[1], str) else (0, "none", 0.0)
                    if len(known) > 500_000:
                        known.clear()
                    known[key] = hit
                out.append(hit)
            yield pd.DataFrame(out, columns=["term_id", "match_by", "match_score"])

    kept = [c for c in values.columns if c not in ("term_id", "match_by", "match_score")]
    return values.select(*[F.col(f"`{c}`") for c in kept], resolve(F.col(f"`{field}`"), F.col(f"`{value}`")).alias("_hit")).select(*[F.col(f"`{c}`") for c in kept], "_hit.*")


def typed_values(df: DataFrame, fields: list[str], id_col: str = "rec_id") -> DataFrame:
    """(id, field, value) of every value that is not null or blank (no-break space counts as blank)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").alias("value")) for f in fields]))
    return df.select(F.col(f"`{id_col}`"), pairs.alias("_p")).select(id_col, "_p.field", "_p.value").filter(F.col("value").rlike(r"(?U)\S"))


def without_exact(values: DataFrame, terms: DataFrame, max_names: int = MAX_NAMES) -> DataFrame:
    """values whose text is not, character for character, a term of its field; ValueError for more than max_names terms."""
    exact = durable(terms.select("field", F.col("term").alias("value")).distinct())
    if exact.count() > max_names:
        raise ValueError(f"the reference list has more than {max_names} names")
    return values.join(F.broadcast(exact), ["field", "value"], "left_anti")


def unmatched_report(mapped: DataFrame) -> DataFrame:
    """Unmatched values with how many rows hold them: (field, value, n_rows)."""
    return mapped.filter("term_id = 0").groupBy("field", "value").agg(F.count(F.lit(1)).alias("n_rows"))

