"""Queries on names and titles in one form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from praktika.llm.unify import unify_texts
from praktika.registry import Registry
from praktika.sources.tables import table

registry = Registry()


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    subjects = table(spark, sf_dir, "match_subjects").select(F.lit("subject").alias("record_kind"), F.col("subject_id").alias("record_id"), F.col("name").alias("text"))
    decisions = table(spark, sf_dir, "decisions").select(F.lit("decision").alias("record_kind"), F.col("ada").alias("record_id"), F.col("subject").alias("text"))
    return unify_texts(subjects.unionByName(decisions), "text")


@registry.query("p4_found")
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).where("changed").select("record_kind", "record_id").distinct()


@registry.query("p4_texts")
def p4_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("record_kind", "record_id", "unified", "changed").distinct()
