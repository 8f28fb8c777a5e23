"""Parquet tables of one directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``name`` as it lies in ``sf_dir``; columns and rows are pruned by Catalyst."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
