"""Queries on subjects and the decisions that decide them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from praktika.llm.entities import link_records
from praktika.registry import Registry
from praktika.sources.tables import table

registry = Registry()


def decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    subjects = table(spark, sf_dir, "match_subjects").select("subject_id", "meeting_id", F.col("city_name").alias("city"), F.to_date("meeting_date").alias("day"), F.col("agenda_item_index").alias("position"), F.col("name").alias("text"))
    days = subjects.groupBy("meeting_id").agg(F.min("day").alias("day"))
    subjects = subjects.drop("day").join(days.hint("merge"), "meeting_id")
    # a decision published again keeps its identifier: its first publication counts
    row = F.struct(F.col("publish_timestamp_ms").isNull(), "publish_timestamp_ms", "ord", "subject", "protocol_number", "organization_label")
    first = table(spark, sf_dir, "decisions").groupBy("ada").agg(F.min(row).alias("r"), F.min("issue_date_ms").alias("issued"), F.min("publish_timestamp_ms").alias("published"), F.max("protocol_number").alias("protocol"))
    number = F.regexp_extract(F.coalesce("r.protocol_number", "protocol"), r"(\d+)(?=\s*[/-]\s*\d{2,4}\s*$|\s*$)", 1)
    decisions = first.select(
        "ada", F.col("r.organization_label").alias("city"), F.to_date(F.timestamp_millis("issued")).alias("issued"), F.to_date(F.timestamp_millis("published")).alias("published"), F.nullif(number, F.lit("")).cast("int").alias("number"), F.col("r.subject").alias("text")
    )
    return link_records(subjects, decisions)


@registry.query("p6_found")
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decided(spark, sf_dir).select("subject_id", "ada")


@registry.query("p6_confidence")
def p6_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decided(spark, sf_dir)
