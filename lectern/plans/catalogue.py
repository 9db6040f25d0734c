"""Registered queries of the core engine and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.plans import corpus_queries, drift_queries, file_queries, text_queries


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**corpus_queries.queries(), **text_queries.queries(), **file_queries.queries(), **drift_queries.queries()}


def oracle_sql() -> dict[str, str]:
    return {**corpus_queries.oracle_sql(), **text_queries.oracle_sql(), **file_queries.oracle_sql(), **drift_queries.oracle_sql()}
