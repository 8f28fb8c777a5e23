"""Counts, roll-ups and first- or last-wins choices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usage_rollup(df: DataFrame, phase: str, read: str, written: str, created: str, cached: str) -> DataFrame:
    """Token usage per phase and, with a null phase, in all: nulls count as nothing; what the cache saved in per cent.

    Aggregated before the shuffle: a rollup of sums needs one row per phase and task.
    """
    total = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0)))
    sums = df.rollup(phase).agg(total(read).alias("input_tokens"), total(written).alias("output_tokens"), total(created).alias("cache_creation_tokens"), total(cached).alias("cache_read_tokens"), F.count("*").alias("calls"))
    all_ = F.col("input_tokens") + F.col("cache_read_tokens") + F.col("output_tokens")
    shown = F.when(F.col("input_tokens") + F.col("cache_read_tokens") > 0, F.round(100 * F.col("cache_read_tokens") / (F.col("input_tokens") + F.col("cache_read_tokens")), 4)).otherwise(0.0)
    return sums.withColumns({"total_tokens": all_, "cache_percent": shown})


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in ``order``: a reduction to one row per key and task before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key in ``order``."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def two_level_counts(df: DataFrame, outer: str, inner: str) -> DataFrame:
    """Rows per (outer, inner) with the total of the outer level beside them."""
    counted = df.groupBy(outer, inner).agg(F.count("*").alias("n"))
    return counted.withColumn("outer_n", F.sum("n").over(Window.partitionBy(outer)))


def running_counts(df: DataFrame, key: str, batch: str) -> DataFrame:
    """Rows per key and batch, and up to and with the batch."""
    counted = df.groupBy(key, batch).agg(F.count("*").alias("n"))
    return counted.withColumn("n_so_far", F.sum("n").over(Window.partitionBy(key).orderBy(batch)))


def top_per_group(df: DataFrame, group: str, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group; ranks are cut before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= k)


def distinct_fingerprint(df: DataFrame, key: str, hash_: str, out: str = "fingerprint") -> DataFrame:
    """A fingerprint per key over its distinct hashes in order."""
    from praktika.functions.numbers import fingerprint

    return df.groupBy(key).agg(F.collect_set(hash_).alias("_h")).select(key, fingerprint(F.col("_h")).alias(out))
