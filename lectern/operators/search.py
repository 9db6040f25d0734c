"""Catalogue searches: optional filters that all must hold, in the canonical order (year, pmcid)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lectern.functions import coerce
from lectern.functions.rules import RECORD_WORDS, VACCINE_WORDS

SEARCHED = ["title", "summary", "pmcid", "pathologies_diseases", "data_source_type", "exposure_domain", "data_accession_links"]
SITE_SEARCHED = ["pmcid", "title", "exposure_domain", "pathologies_diseases"]


def _text(df: DataFrame, columns: list[str]) -> Column:
    kinds = dict(df.dtypes)
    parts = [F.array_join(c, " ") if kinds[c].startswith("array") else F.col(c) for c in columns]
    return F.lower(F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts]))


def ordered(df: DataFrame) -> DataFrame:
    """The canonical order; both keys as text."""
    return df.orderBy("year", "pmcid")


def find(df: DataFrame, *, ehr_used: bool | None = None, disease: str | None = None, exposure: str | None = None, query: str | None = None, design: str | None = None, data_source: str | None = None, confidence: str | None = None) -> DataFrame:
    """Rows that pass every filter given, case ignored; a null flag counts as false."""

    def has(column: str, needle: str) -> Column:
        return F.contains(F.lower(F.coalesce(F.col(column), F.lit(""))), F.lit(needle.lower()))

    tests: list[Column] = []
    if ehr_used is not None:
        tests.append(F.coalesce(F.col("ehr_used"), F.lit(False)) == ehr_used)
    if disease:
        tests.append(F.coalesce(F.exists("pathologies_diseases", lambda x: F.contains(F.lower(F.coalesce(x, F.lit(""))), F.lit(disease.lower()))), F.lit(False)))
    for column, needle in (("exposure_domain", exposure), ("study_design", design), ("data_source_type", data_source)):
        if needle:
            tests.append(has(column, needle))
    if confidence:
        tests.append(F.lower("confidence") == confidence.lower())
    if query:
        tests.append(F.contains(_text(df, ["title", "summary"]), F.lit(query.lower())))
    return ordered(df.filter(reduce(lambda a, b: a & b, tests)) if tests else df)


def vaccine_like(df: DataFrame) -> Column:
    return _text(df, ["title", "summary", "exposure_domain"]).rlike("vacc|immuniz|immunis")


def web_search(df: DataFrame, q: str) -> DataFrame:
    """A search box: words for vaccines and for records select by meaning, other text by what seven columns contain."""
    word = q.lower().strip()
    if not q:
        return ordered(df)
    if word in VACCINE_WORDS:
        return ordered(df.filter(vaccine_like(df)))
    if word in RECORD_WORDS:
        return ordered(df.filter(F.col("ehr_used") == F.lit(True)))
    return ordered(df.filter(F.contains(_text(df, SEARCHED), F.lit(word))))


def site_search(df: DataFrame, mode: str = "all", q: str = "") -> DataFrame:
    """The static page's filter: mode all, ehr or public, and text in four columns; newest first."""
    test = F.contains(_text(df, SITE_SEARCHED), F.lit(q.lower().strip()))
    if mode == "ehr":
        test = test & (F.col("ehr_used") == F.lit(True))
    if mode == "public":
        test = test & (F.col("data_availability") == "public-repository")
    return df.filter(test).orderBy(F.desc("year"), "pmcid")


def get(df: DataFrame, pmcid: str) -> DataFrame:
    """The row of an id in any notation."""
    return df.filter(F.col("pmcid") == coerce.pmcid(F.lit(pmcid)))


def select_keys(df: DataFrame, keys: list[str], limit: int | None = None) -> DataFrame:
    """Rows of the ids given (all for none), in order of id, at most limit of them (0 or None: all)."""
    out = df
    if keys:
        out = df.filter(reduce(lambda a, b: a | b, [F.col("pmcid") == coerce.pmcid(F.lit(k)) for k in keys]))
    out = out.orderBy("pmcid")
    return out.limit(limit) if limit else out

