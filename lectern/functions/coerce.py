"""Coercion of delivered values to the checklist schema, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lectern.schema import AVAILABILITY, CONFIDENCE

TRUE_WORDS = ["true", "yes", "y", "1", "t", "used"]
FALSE_WORDS = ["false", "no", "n", "0", "f", "not used"]


def strip(text: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def pmcid(text: Column) -> Column:
    """Trimmed, upper case, with the prefix PMC."""
    tidy = F.upper(strip(text))
    return F.when(tidy.startswith("PMC"), tidy).otherwise(F.concat(F.lit("PMC"), tidy))


def boolean(text: Column) -> Column:
    """The truth a word tells; null for other words (see reject_reason)."""
    word = F.lower(strip(text))
    return F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False)


def availability(text: Column, unknown: str | None = "not-stated") -> Column:
    """A category of data availability; other values, null too, give unknown."""
    word = F.translate(F.lower(strip(text)), "_ ", "--")
    return F.when(word.isin(AVAILABILITY), word).otherwise(F.lit(unknown))


def confidence(text: Column) -> Column:
    """high, medium, low or unclear; other values, null too, give unclear."""
    word = F.lower(strip(text))
    return F.when(word.isin(CONFIDENCE), word).otherwise(F.lit("unclear"))


def list_of(entries: Column) -> Column:
    """Entries trimmed, blank and null ones dropped; null gives an empty list."""
    return F.coalesce(F.filter(F.transform(entries, strip), lambda x: x != ""), F.array().cast("array<string>"))


def list_of_text(text: Column) -> Column:
    """A list of the text as it stands; empty for a blank or null one."""
    return F.when(strip(text) != "", F.array(text)).otherwise(F.array().cast("array<string>"))


def list_of_variant(value: Column) -> Column:
    """A list from a variant that holds a list or one text."""
    one = F.try_variant_get(value, "$", "string")
    many = F.try_variant_get(value, "$", "array<string>")
    return F.when(F.schema_of_variant(value).startswith("ARRAY"), list_of(many)).otherwise(list_of_text(one))


def or_unspecified(text: Column, label: str = "unspecified") -> Column:
    """Trimmed text, or the label when null or blank."""
    return F.coalesce(F.nullif(strip(text), F.lit("")), F.lit(label))
