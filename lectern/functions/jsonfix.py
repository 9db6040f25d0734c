"""Recover a JSON object from free text that a model wrote."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from lectern.functions import coerce, text as tx

#: A fenced block that holds an object, and where a reply names its category. Fixed patterns.
FENCE = re.compile(r"```(?:json)?\s*(\{.*\})\s*```", re.DOTALL)
CATEGORY = r"`?data_availability`?\s*:\s*[\"'`* ]*([A-Za-z_-]+(?:\s+[A-Za-z_-]+)*)"


def read(text: str) -> dict | None:
    """The object that the text is, but for blanks around; braces that its end lacks are supplied.

    They are supplied after what a reply that broke off leaves behind: blanks, then commas and quotes, then blanks.
    """
    missing = text.count("{") - text.count("}")
    for attempt in (text, text.rstrip().rstrip(',"').rstrip() + "}" * missing if missing > 0 else ""):
        try:
            found = json.loads(attempt)
        except ValueError:
            continue
        if isinstance(found, dict):
            return found
    return None


def spans(text: str) -> list[str]:
    """Outermost stretches from a brace to the one that closes it, whatever quotes say, longest first, then by place.

    A closing brace that closes nothing is passed over: depth counts from the lowest level reached so far.
    """
    braces = [(m.start(), 1 if m[0] == "{" else -1) for m in re.finditer("[{}]", text)]
    levels = list(accumulate(step for _, step in braces))
    floors = list(accumulate(levels, min, initial=0))[1:]
    found, opened = [], None
    for (place, step), level, floor in zip(braces, levels, floors, strict=True):
        if step > 0 and level - floor == 1:
            opened = place
        elif step < 0 and level == floor and opened is not None:
            found.append(text[opened : place + 1])
            opened = None
    return sorted(found, key=len, reverse=True)


def candidates(text: str) -> Iterator[str]:
    """Stretches that may be the object, best first: fenced blocks from the last, the longest balanced span, all from the first brace on."""
    yield from FENCE.findall(text)[::-1]
    yield from spans(text)[:1]
    head, brace, rest = text.partition("{")
    if brace:
        closed = rest.rfind("}")
        yield brace + (rest[: closed + 1] if closed >= 0 else rest)


def salvage(text: str | None) -> dict | None:
    """The object of a fenced block, else of the largest balanced span, else from the first brace to the last."""
    return next((found for part in candidates(text) if (found := read(part)) is not None), None) if isinstance(text, str) else None


@F.pandas_udf(T.StringType())
def salvaged_json(texts: pd.Series) -> pd.Series:
    """JSON text of the object that each text holds, null if none."""
    return texts.map(lambda x: None if (found := salvage(x)) is None else json.dumps(found, ensure_ascii=False, sort_keys=True))


def availability_reply(reply: Column) -> Column:
    """struct<data_availability, data_accession_links, data_availability_statement> from a prose reply, null if it tells nothing.

    The last valid category counts; links lift an unknown or not-stated one to public-repository, others drop links.
    """
    named = F.transform(F.regexp_extract_all(reply, F.lit(CATEGORY), F.lit(1)), lambda x: coerce.availability(F.regexp_replace(x, r"^[ \"'`*.]+|[ \"'`*.]+$", ""), None))
    said = F.try_element_at(F.filter(named, lambda x: x.isNotNull()), F.lit(-1))
    links = tx.accession_links(reply)
    category = F.when((F.size(links) > 0) & (said.isNull() | (said == "not-stated")), "public-repository").otherwise(said)
    kept = F.when(category == "public-repository", links).otherwise(F.array().cast("array<string>"))
    return F.when(category.isNotNull(), F.struct(category.alias("data_availability"), kept.alias("data_accession_links"), tx.quoted_statements(reply).alias("data_availability_statement")))
