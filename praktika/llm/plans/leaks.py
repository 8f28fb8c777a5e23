"""Queries on held-out items in documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from praktika.llm.leaks import find_leaks
from praktika.registry import Registry
from praktika.sources.tables import table

registry = Registry()


@registry.query("p9_found")
def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "item_id").distinct()
