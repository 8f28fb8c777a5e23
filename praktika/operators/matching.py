"""Names to people, subjects to decisions, identifiers to identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from praktika.functions.text import coverage, jaccard, sort_keys, tokens
from praktika.operators.lineage import cut, drop


def match_names(raw: DataFrame, people: DataFrame, within: str, name: str, person: str, person_name: str, order: str, last: bool = False) -> DataFrame:
    """Raw names with the person that shares one of their sort keys; the first person wins, or with ``last`` the last.

    With ``last``, keys decide: per key the last person, then the raw name's first key that anybody has.
    """
    keyed_people = people.select(within, F.col(person).alias("person_id"), F.col(order).alias("_o"), F.explode(sort_keys(F.col(person_name))).alias("_key")).where("_key != ''")
    keyed_raw = raw.select(within, name).distinct().select(within, name, F.posexplode(sort_keys(F.col(name))).alias("_k", "_key"))
    if last:
        keyed_people = keyed_people.groupBy(within, "_key").agg(F.max_by("person_id", "_o").alias("person_id"), F.max("_o").alias("_o"))
    hits = keyed_raw.join(keyed_people, [within, "_key"])
    best = F.min_by("person_id", F.struct("_k", "_o") if last else F.struct("_o", "person_id"))
    return hits.groupBy(within, name).agg(best.alias("person_id"))


def leftovers(raw: DataFrame, people: DataFrame, matched: DataFrame, within: str, name: str, person: str) -> tuple[DataFrame, DataFrame]:
    """Names and people that a first pass did not match, for a second."""
    return raw.select(within, name).distinct().join(matched, [within, name], "left_anti"), people.join(matched.select(within, F.col("person_id").alias(person)), [within, person], "left_anti")


def similar_top(subjects: DataFrame, decisions: DataFrame, on: list[str], condition, n: int) -> DataFrame:
    """The ``n`` decisions most like each subject among those of the same ``on``; ties by the decision's order.

    Words are split once per side. ``on`` and ``condition`` are the source's filters (organisation, dates), which
    bound the pairs; similarity is the greater of Jaccard index and coverage.
    """
    a = subjects.withColumn("t_s", tokens(F.col("name")))
    b = decisions.withColumn("t_d", tokens(F.col("subject")))
    score = F.greatest(jaccard(F.col("t_s"), F.col("t_d")), coverage(F.col("t_s"), F.col("t_d")))
    pairs = a.join(b, on).where(condition).select("subject_id", "ada", "d_ord", F.round(score, 6).alias("similarity"))
    return pairs.withColumn("rank", F.row_number().over(Window.partitionBy("subject_id").orderBy(F.desc("similarity"), "d_ord", "ada"))).where(F.col("rank") <= n)


def short_ids(df: DataFrame, long_id: str, digits: int = 12) -> DataFrame:
    """A dictionary of identifiers and their short forms, the same on every run; long enough to be one to one."""
    return df.select(F.col(long_id).alias("long_id")).where("long_id is not null").distinct().withColumn("short_id", F.substring(F.sha2("long_id", 256), 1, digits))


def encode(df: DataFrame, column: str, dictionary: DataFrame) -> DataFrame:
    """``column`` in short form; unknown and null identifiers become null."""
    return df.join(dictionary.select(F.col("long_id").alias(column), "short_id"), column, "left").drop(column).withColumnRenamed("short_id", column)


def decode(df: DataFrame, column: str, dictionary: DataFrame) -> DataFrame:
    return df.join(dictionary.select(F.col("short_id").alias(column), "long_id"), column, "left").drop(column).withColumnRenamed("long_id", column)


def resolve_chains(edges: DataFrame, source: str, target: str, most: int = 30) -> DataFrame:
    """Where merges of merges end: each round doubles the length of the chains followed. A cycle keeps its members."""
    jumps = cut(edges.select(F.col(source).alias("a"), F.col(target).alias("b")).where("a is not null and b is not null and a != b").groupBy("a").agg(F.min("b").alias("b")))
    for _ in range(most):
        on = jumps.select(F.col("a").alias("b"), F.col("b").alias("c"))
        step = jumps.join(on, "b", "left").select("a", F.when(F.col("c") == F.col("a"), F.col("b")).otherwise(F.coalesce("c", "b")).alias("n"), "b")
        moved = step.where("n != b").limit(1).count()
        if not moved:
            break
        old, jumps = jumps, cut(step.select("a", F.col("n").alias("b")))
        drop(old)
    return jumps.select(F.col("a").alias(source), F.col("b").alias(target))
