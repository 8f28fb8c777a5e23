"""Queries on wrongly decoded documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from praktika.llm.encoding import restore_texts
from praktika.registry import Registry
from praktika.sources.tables import table

registry = Registry()


@registry.query("p10_found")
def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restore_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), "text").where("garbled").select("doc_id")


@registry.query("p10_restored")
def p10_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restore_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), "text").where("garbled").select("doc_id", "restored", "whole")
