"""Sinks: results as JSON, idempotent objects, appended logs and bounded traces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from praktika.operators.lineage import file_system

TRACE_BYTES, INPUT_CHARS = 800_000, 500


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def embed_json(df: DataFrame, column: str = "html_json") -> DataFrame:
    """Rows as JSON that can stand inside a page: no < is left."""
    return df.select(F.replace(F.to_json(F.struct(*df.columns)), F.lit("<"), F.lit("\\u003c")).alias(column))


def put_once(df: DataFrame, key: str, path: str) -> None:
    """Append the rows whose key is not there yet. Two runs at once may both write a key: readers take the first."""
    spark = df.sparkSession
    fs, at = file_system(spark, path)
    if fs.exists(at):
        df = df.join(spark.read.parquet(path).select(key).distinct(), key, "left_anti")
    df.dropDuplicates([key]).write.mode("append").parquet(path)


def delete_prefix(spark: SparkSession, path: str, prefix: str) -> int:
    """Delete what lies in a folder under names that begin with ``prefix``; how much it was."""
    fs, at = file_system(spark, path)
    found = [f.getPath() for f in fs.listStatus(at) if f.getPath().getName().startswith(prefix)] if prefix and fs.exists(at) else []
    for p in found:
        fs.delete(p, True)
    return len(found)


def replace_partitions(df: DataFrame, by: str, path: str) -> None:
    """Rewrite only the partitions that ``df`` has."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def append_log(df: DataFrame, text: str, path: str) -> None:
    """Append lines without terminal colours."""
    df.select(F.regexp_replace(text, r"\x1b\[[0-9;]*m", "").alias("value")).write.mode("append").text(path)


def bounded_trace(df: DataFrame, out: str = "output") -> DataFrame:
    """Output as JSON; one beyond TRACE_BYTES is replaced by its size and first characters."""
    text = F.to_json(F.col(out))
    summary = F.to_json(F.struct(F.octet_length(text).alias("bytes"), F.substring(text, 1, INPUT_CHARS).alias("head")))
    return df.withColumn(out, F.when(F.octet_length(text) > TRACE_BYTES, summary).otherwise(text))
