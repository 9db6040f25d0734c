"""Extraction by an injected model client: retries with the error told back, chunked recovery, resume."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lectern.functions import text as tx
from lectern.functions.jsonfix import salvage
from lectern.operators import merge

MAX_ATTEMPTS, SOURCE_CHARS = 3, 6_000

Client = Callable[[list[dict[str, str]]], str]
DEFAULTS = {"url": "http://localhost:8000/v1", "model": "default", "max_tokens": "32768"}


def settings(environ: Mapping[str, str], defaults: dict[str, str] | None = None, prefix: str = "LECTERN_MODEL_") -> dict[str, str]:
    """Settings of a model service: url, model, max_tokens and key, each from the variable named after it, trimmed.

    A missing or blank variable gives the default; a missing key is a RuntimeError.
    """
    read = lambda name: environ.get(prefix + name.upper(), "").strip()
    if not read("key"):
        raise RuntimeError(f"{prefix}KEY is not set")
    return {name: read(name) or value for name, value in (defaults or DEFAULTS).items()} | {"key": read("key")}


def prompt(pmcid: str, title: str, year: str, text: str, keys: list[str]) -> str:
    return f"Title: {title}\nYear: {year}\nPMCID: {pmcid}\n\nReturn one JSON object with the keys {json.dumps(keys)}.\n\n{text}"


def ask(client: Client, system: str, user: str, check: Callable[[dict], str | None], attempts: int = MAX_ATTEMPTS, pause: float = 2.0) -> dict:
    """The object of the first reply that passes check; errors are told back, failures of the client waited out.

    RuntimeError after the last attempt.
    """
    messages = [{"role": "system", "content": system}, {"role": "user", "content": user}]
    why = "no reply"
    for attempt in range(1, attempts + 1):
        try:
            reply = client(messages)
        except Exception as error:  # noqa: BLE001
            why = str(error)
            time.sleep(pause * attempt)
            continue
        found = salvage(reply)
        why = "no JSON object" if found is None else check(found)
        if found is not None and why is None:
            return found
        messages += [{"role": "assistant", "content": reply}, {"role": "user", "content": f"Not valid: {why}. Return only the corrected JSON object."}]
    raise RuntimeError(why)


def extract(papers: DataFrame, client: Client, system: str, keys: list[str], *, attempts: int = MAX_ATTEMPTS, pause: float = 2.0) -> DataFrame:
    """(pmcid, piece, status, result, error) of each paper's or chunk's text; result is JSON text. Failures are rows, not errors."""

    def missing(found: dict) -> str | None:
        lacking = [k for k in keys if k not in found]
        return f"missing {', '.join(lacking)}" if lacking else None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                try:
                    found = ask(client, system, prompt(row.pmcid, row.title, row.year, row.text, keys), missing, attempts, pause)
                    out.append((row.pmcid, row.piece, "ok", json.dumps(found, ensure_ascii=False), None))
                except RuntimeError as error:
                    out.append((row.pmcid, row.piece, "failed", None, str(error)))
            yield pd.DataFrame(out, columns=["pmcid", "piece", "status", "result", "error"])

    return papers.select("pmcid", "title", "year", "piece", "text").mapInPandas(run, "pmcid string, piece int, status string, result string, error string")


def whole(papers: DataFrame) -> DataFrame:
    """Papers as one piece each, cut to what one call takes."""
    return papers.withColumn("piece", F.lit(0)).withColumn("text", F.left("text", F.lit(SOURCE_CHARS)))


def chunked(papers: DataFrame, size: int = 4000, overlap: int = 600) -> DataFrame:
    """Papers in overlapping pieces, none left out."""
    return papers.select("pmcid", "title", "year", F.posexplode(tx.chunks(F.col("text"), size, overlap)).alias("piece", "text"))


def to_do(papers: DataFrame, done: DataFrame) -> DataFrame:
    """Papers without a valid result."""
    return papers.join(done.select("pmcid"), "pmcid", "left_anti")


def merged(pieces: DataFrame) -> DataFrame:
    """One record a paper from the pieces that succeeded."""
    schema = "ehr_used string, ehr_evidence string, summary string, study_design string, data_source_type string, population string, exposure_domain string, confidence string, key_findings array<string>, captured_features array<string>, pathologies_diseases array<string>, limitations array<string>"
    from lectern.functions import coerce

    parts = pieces.filter("status = 'ok'").select("pmcid", "piece", F.from_json("result", schema).alias("r")).select("pmcid", "piece", "r.*").withColumn("ehr_used", coerce.boolean(F.col("ehr_used")))
    return merge.merge_chunks(parts, "pmcid", "piece", flag="ehr_used", evidence="ehr_evidence", texts=["summary", "study_design", "data_source_type", "population", "exposure_domain"], lists=["key_findings", "captured_features", "pathologies_diseases", "limitations"], confidence="confidence")


def tallies(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
