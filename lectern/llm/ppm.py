"""Prediction by partial matching over bytes, with frozen statistics of several languages.

A model is a variable-order context tree a language: after the longest context that the language has seen, a byte
costs -log2(count / (total + kinds)); a byte not seen there costs the escape, -log2(kinds / (total + kinds)), and
goes on in the context one byte shorter, down to a uniform byte. Contexts never seen cost nothing. As nothing is
learnt while scoring, the cost of a byte in a language depends on the last ORDER bytes only, so exact code lengths
come from a table over all n-grams of the training text: a row has one lane a language.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np

ORDER = 4
#: Costs are kept in sixteenths of a bit, three languages to a 64-bit word.
UNIT, LANE = 16, 21
LANES = 3
#: Most bytes summed at once; fewer where the costs of a model could overflow a lane (Model.block).
BLOCK = 8000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64((1 << 64) - 1)


@dataclass
class Level:
    """Hash table from n-gram code to packed costs; keys and costs lie in the slots themselves."""

    keys: np.ndarray
    words: np.ndarray
    bits: int

    @classmethod
    def of(cls, keys: np.ndarray, costs: np.ndarray) -> Level:
        bits = max(8, int(np.ceil(np.log2(max(1, len(keys)) * 3))))
        rounded = np.rint(costs * UNIT).astype(np.uint64)
        rows = np.zeros((-(-costs.shape[1] // LANES), len(keys)), np.uint64)
        for i in range(costs.shape[1]):
            rows[i // LANES] |= rounded[:, i] << np.uint64(LANE * (i % LANES))
        table = cls(np.full(1 << bits, _EMPTY, np.uint64), np.zeros((len(rows), 1 << bits), np.uint64), bits)
        left, turn = np.arange(len(keys)), 0
        while len(left):
            at = table.slot(keys[left], turn)
            free = table.keys[at] == _EMPTY
            table.keys[at[free]] = keys[left[free]]
            placed = table.keys[at] == keys[left]
            table.words[:, at[placed]] = rows[:, left[placed]]
            left, turn = left[~placed], turn + 1
        return table

    def slot(self, keys: np.ndarray, turn: int) -> np.ndarray:
        mixed = keys * _MIX if turn == 0 else (keys ^ np.uint64(turn * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)) * _MIX
        mixed >>= np.uint64(64 - self.bits)
        return mixed.view(np.int64)

    def most(self) -> int:
        """The largest cost in any lane."""
        return max(int(((self.words >> np.uint64(LANE * i)) & np.uint64((1 << LANE) - 1)).max(initial=0)) for i in range(LANES))

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot of each code, and which codes are not there (their slots mean nothing)."""
        slots = self.slot(codes, 0)
        held = np.take(self.keys, slots)
        other = np.flatnonzero(held != codes)
        absent = other[held[other] == _EMPTY]
        other, turn, gone = other[held[other] != _EMPTY], 1, [absent]
        while len(other):
            again = self.slot(codes[other], turn)
            held = self.keys[again]
            slots[other] = again
            gone.append(other[held == _EMPTY])
            other = other[(held != _EMPTY) & (held != codes[other])]
            turn += 1
        return slots, np.sort(np.concatenate(gone)) if len(gone) > 1 else absent


@dataclass
class Model:
    """Frozen statistics: grams[k] costs bytes after k bytes of context, escapes[k] the way down from an unseen byte."""

    languages: list[str]
    grams: list[Level]
    escapes: list[Level]

    @cached_property
    def block(self) -> int:
        """Bytes whose costs fit a lane: none costs more than every escape and the dearest n-gram."""
        dearest = max((x.most() for x in self.grams), default=0) + sum(x.most() for x in self.escapes)
        return max(1, min(BLOCK, ((1 << LANE) - 1) // max(1, dearest)))

    def plain(self) -> tuple:
        """Arrays and names only, for a broadcast."""
        level = lambda x: (x.keys, x.words, x.bits)
        return self.languages, [level(x) for x in self.grams], [level(x) for x in self.escapes]

    @classmethod
    def of(cls, plain: tuple) -> Model:
        languages, grams, escapes = plain
        return cls(languages, [Level(*x) for x in grams], [Level(*x) for x in escapes])


def _codes(data: np.ndarray, size: int) -> np.ndarray:
    """Code of the size bytes that begin at each place, the first byte lowest."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    whole = np.ndarray((max(0, len(data) - size + 1),), "<u8", padded.data, 0, (1,))
    return whole & np.uint64((1 << (8 * size)) - 1)


def fit(texts: dict[str, list[bytes]], order: int = ORDER) -> Model:
    """Statistics of the texts of each language; every text is read on its own, after blanks."""
    languages = sorted(texts)
    if not languages:
        return Model([], [], [])
    streams = [np.frombuffer((b" " * order).join([b"", *texts[x], b""]), np.uint8) for x in languages]
    grams: list[Level] = []
    escapes: list[Level] = []
    lower_keys, lower_costs = np.arange(256, dtype=np.uint64), np.full((256, len(languages)), 8.0)
    for k in range(order + 1):
        seen = [np.unique(_codes(s, k + 1), return_counts=True) for s in streams]
        keys = np.unique(np.concatenate([g for g, _ in seen])) if k else np.arange(256, dtype=np.uint64)
        low = np.uint64((1 << (8 * k)) - 1)
        contexts = np.unique(keys & low)
        base = lower_costs[np.searchsorted(lower_keys, keys >> np.uint64(8) if k else keys)]
        costs, ways = np.empty((len(keys), len(languages))), np.zeros((len(contexts), len(languages)))
        of_key = np.searchsorted(contexts, keys & low)
        for i, (own, counts) in enumerate(seen):
            at = np.searchsorted(contexts, own & low)
            total, kinds = np.bincount(at, counts, len(contexts)), np.bincount(at, minlength=len(contexts))
            known = kinds > 0
            ways[known, i] = -np.log2(kinds[known] / (total[known] + kinds[known]))
            costs[:, i] = base[:, i] + ways[of_key, i]
            costs[np.searchsorted(keys, own), i] = -np.log2(counts / (total[at] + kinds[at]))
        grams.append(Level.of(keys, costs))
        escapes.append(Level.of(contexts, ways))
        lower_keys, lower_costs = keys, costs
    return Model(languages, grams, escapes)


def packed_costs(model: Model, data: np.ndarray) -> np.ndarray:
    """Packed cost of every byte of data but its first bytes, which are context only."""
    top = len(model.grams) - 1
    codes = _codes(data, top + 1)
    slots, missing = model.grams[top].find(codes)
    words = np.take(model.grams[top].words, slots, axis=1)
    if len(missing):
        words[:, missing] = 0
        codes = codes[missing]
        for k in range(top, -1, -1):
            if k < top:
                codes = codes >> np.uint64(8)
                slots, absent = model.grams[k].find(codes)
                there = np.ones(len(codes), bool)
                there[absent] = False
                words[:, missing[there]] += model.grams[k].words[:, slots[there]]
                missing, codes = missing[absent], codes[absent]
                if not len(missing):
                    break
            ways, unknown = model.escapes[k].find(codes & np.uint64((1 << (8 * k)) - 1))
            known = np.ones(len(codes), bool)
            known[unknown] = False
            words[:, missing[known]] += model.escapes[k].words[:, ways[known]]
    return words


def unpack(words: np.ndarray, languages: int) -> np.ndarray:
    """Bits a language of packed sums: one row a sum."""
    mask = np.uint64((1 << LANE) - 1)
    return np.stack([((words[i // LANES] >> np.uint64(LANE * (i % LANES))) & mask).astype(np.float64) / UNIT for i in range(languages)], axis=1)


def stretch_bits(model: Model, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Code length in bits, a row a stretch and a column a language, of the stretches of data that begin at starts.

    starts ascends from 0. Stretches longer than the model's block are summed block by block.
    """
    order = len(model.grams) - 1
    lead = np.full(order, 32, np.uint8)
    words = packed_costs(model, np.concatenate([lead, data]))
    ends = np.r_[starts[1:], len(data)]
    if (ends - starts).max(initial=0) <= model.block:
        return unpack(np.add.reduceat(words, starts, axis=1), len(model.languages))
    pieces = [(np.arange(s, max(e, s + 1), model.block), i) for i, (s, e) in enumerate(zip(starts, ends, strict=True))]
    cuts = np.concatenate([p for p, _ in pieces])
    owner = np.repeat([i for _, i in pieces], [len(p) for p, _ in pieces])
    bits = unpack(np.add.reduceat(words, cuts, axis=1), len(model.languages))
    out = np.zeros((len(starts), len(model.languages)))
    np.add.at(out, owner, bits)
    return out


def plain_bits(texts: dict[str, list[bytes]], text: bytes, order: int = ORDER) -> dict[str, float]:
    """The definition, byte by byte with dictionaries; for tests."""
    from math import log2

    out = {}
    for language, own in texts.items():
        stream = (b" " * order).join([b"", *own, b""])
        seen: dict[bytes, dict[int, int]] = {}
        for k in range(order + 1):
            for i in range(k, len(stream)):
                after = seen.setdefault(stream[i - k : i], {})
                after[stream[i]] = after.get(stream[i], 0) + 1
        full, bits = b" " * order + text, 0.0
        for i in range(order, len(full)):
            for k in range(order, -1, -1):
                after = seen.get(full[i - k : i], {})
                if not after:
                    continue
                total, kinds = sum(after.values()), len(after)
                if full[i] in after:
                    bits -= log2(after[full[i]] / (total + kinds))
                    break
                bits -= log2(kinds / (total + kinds))
            else:
                bits += 8
        out[language] = bits
    return out
