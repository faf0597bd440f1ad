"""Collects the queries of all plan modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkloom.plans import base, files, layout, metrics, outputs, relational, sampling, text


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentence dedup, chunking, label join and a report by language."""
    return text.chunk_report(base.Tables(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(base.SQL)


__all__ = ["files", "flagship", "layout", "metrics", "oracle_sql", "outputs", "queries", "relational", "sampling"]
