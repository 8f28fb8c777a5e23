"""Queries on documents packed into containers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from praktika.llm.packing import pack_documents
from praktika.registry import Registry
from praktika.sources.tables import table

registry = Registry()


@registry.query("p8_containers")
def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return packed.select(F.col("item").alias("doc_id"), "part", "container", "start", F.col("size").alias("n_tokens"))
