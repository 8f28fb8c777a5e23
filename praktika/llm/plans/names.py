"""Queries on spellings of members' names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from praktika.llm.names import link_spellings
from praktika.registry import Registry
from praktika.sources.tables import table

registry = Registry()


def typed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each spelling of a meeting in the three name fields."""
    raw = table(spark, sf_dir, "raw_extractions")
    empty = F.array().cast("array<string>")
    names = F.concat(*[F.coalesce(c, empty) for c in (F.col("present_members"), F.col("absent_members"), F.col("attendance_changes.name"))])
    return raw.select("meeting_id", "city_id", F.explode(names).alias("raw_name")).where("raw_name is not null").distinct()


@registry.query("p2_found")
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "people").select("city_id", F.col("id").alias("person_id"), "name").distinct()
    typed = typed_names(spark, sf_dir)
    linked = link_spellings(typed, people, "city_id")
    same = people.select("city_id", "person_id", F.col("name").alias("raw_name")).hint("merge")
    return typed.hint("merge").join(linked.join(same, ["city_id", "person_id", "raw_name"], "left_anti"), ["city_id", "raw_name"]).select("meeting_id", "raw_name", "person_id").distinct()
