"""Aliased scans of lake tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from fieldloom.operators.schema import apply_aliases


def scan_aliased(
    spark: SparkSession, path: str, aliases: Mapping[str, str], fmt: str = "parquet"
) -> DataFrame:
    """Read only the mapped columns of a table, each under its alias."""
    return apply_aliases(spark.read.format(fmt).load(path), aliases)
