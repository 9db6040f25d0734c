"""Schemas of the domain records."""

from __future__ import annotations

from pyspark.sql import types as T

#: The checklist record, in output order: (column, type).
CHECKLIST_TYPES: list[tuple[str, str]] = [
    ("pmcid", "string"),
    ("title", "string"),
    ("year", "string"),
    ("ehr_used", "boolean"),
    ("ehr_evidence", "string"),
    ("summary", "string"),
    ("key_findings", "array<string>"),
    ("captured_features", "array<string>"),
    ("pathologies_diseases", "array<string>"),
    ("limitations", "array<string>"),
    ("study_design", "string"),
    ("data_source_type", "string"),
    ("population", "string"),
    ("exposure_domain", "string"),
    ("data_availability", "string"),
    ("data_accession_links", "array<string>"),
    ("data_availability_statement", "string"),
    ("confidence", "string"),
    ("source_format", "string"),
    ("model", "string"),
]
CHECKLIST_COLUMNS = [name for name, _ in CHECKLIST_TYPES]
REQUIRED = ["pmcid", "title", "year", "ehr_used", "ehr_evidence", "summary"]
LIST_COLUMNS = [name for name, kind in CHECKLIST_TYPES if kind == "array<string>"]
AVAILABILITY = ["public-repository", "available-upon-request", "in-house", "supplementary-only", "not-stated"]
CONFIDENCE = ["high", "medium", "low", "unclear"]
SOURCE_FORMATS = ["pdf", "xml", "text"]


def checklist_schema() -> T.StructType:
    """The checklist record as a Spark schema."""
    return T._parse_datatype_string(", ".join(f"{name} {kind}" for name, kind in CHECKLIST_TYPES))


def batch_schema() -> T.StructType:
    """The envelope of a batch: {n, model, summaries[]}."""
    return T.StructType([T.StructField("n", T.IntegerType()), T.StructField("model", T.StringType()), T.StructField("summaries", T.ArrayType(checklist_schema()))])
