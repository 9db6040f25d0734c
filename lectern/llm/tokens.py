"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Rank file of a byte-level BPE; a parameter of every operator, never copied.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the tokenizer cuts a text before merging. A fixed value of the public vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def encoding(path: str = RANKS):
    """The tokenizer of a rank file; special tokens have no meaning in texts."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(texts: list[str | None], encode: Callable[[str], list[int]]) -> list[int]:
    """Tokens of each text; null counts 0."""
    return [len(encode(x)) if x else 0 for x in texts]


def with_tokens(df: DataFrame, *, text: str = "text", keep: list[str], name: str = "tokens", path: str = RANKS) -> DataFrame:
    """The columns of keep and name, the tokens of text (0 for null or empty). A column called name is replaced."""
    kept = [c for c in keep if c != name]
    rows = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("_text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path).encode_ordinary
        for batch in batches:
            sizes = pa.array(count_tokens(batch.column(batch.num_columns - 1).to_pylist(), encode), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], sizes], names=[*kept, name])

    types = dict(df.dtypes)
    return rows.mapInArrow(count, ", ".join([*(f"`{c}` {types[c]}" for c in kept), f"`{name}` long"]))
