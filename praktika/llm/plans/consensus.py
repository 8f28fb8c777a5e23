"""Queries on labels of several annotators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from praktika.llm.consensus import Consensus, consensus
from praktika.registry import Registry
from praktika.sources.tables import table

registry = Registry()


def reports(spark: SparkSession, sf_dir: str) -> Consensus:
    """Labels of one kind and, for orders, of one length can stand for one another."""
    label = F.upper(F.trim(F.col("label")))
    space = F.concat_ws(":", "item_kind", F.size(F.split(label, ">")).cast("string"))
    return consensus(table(spark, sf_dir, "pdf_reports"), "item_id", "annotator_id", space, label)


@registry.query("p1_found")
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).items.where("disputed").select(F.col("item").alias("item_id"), "label")


@registry.query("p1_annotators")
def p1_annotators(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reports(spark, sf_dir).annotators
    return found.groupBy(F.col("annotator").alias("annotator_id")).agg(F.sum("n_labels").alias("n_labels"), (F.sum(F.col("reliability") * F.col("n_labels")) / F.sum("n_labels")).alias("reliability"))


@registry.query("p1_items")
def p1_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item's label with how sure it is and how far its labels agree."""
    return reports(spark, sf_dir).items.select(F.col("item").alias("item_id"), "label", F.round("confidence", 6).alias("confidence"), F.round("agreement", 6).alias("agreement"), "n_labels", "disputed")
