"""Streams of events and words: windows, sessions, latest states and answers within a time."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from praktika.operators.lineage import file_system, shared_dir


def read_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream of its files."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return spark.readStream.schema(schema).parquet(path)
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def run_once(stream: DataFrame, mode: str, sink: Callable[[DataFrame, int], None], checkpoint: str | None = None) -> None:
    """Everything that is there, through ``sink`` batch by batch.

    With ``checkpoint`` the next run goes on where this one ended; without, each run begins anew.
    """
    at = checkpoint or f"{shared_dir(stream.sparkSession)}/stream-{uuid.uuid4().hex}"
    stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", at).trigger(availableNow=True).start().awaitTermination()


def materialise(stream: DataFrame, mode: str = "append") -> DataFrame:
    """The result of a stream over what is there, as a table."""
    spark = stream.sparkSession
    out = f"{shared_dir(spark)}/result-{uuid.uuid4().hex}"
    schema = stream.schema
    write = "overwrite" if mode == "complete" else "append"
    run_once(stream, mode, lambda df, _: df.write.mode(write).parquet(out))
    return spark.read.schema(schema).parquet(out)


def windowed_counts(stream: DataFrame, at: str, key: str, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Events per window and key; what is later than ``late`` is left out of closed windows."""
    return stream.withWatermark(at, late).groupBy(F.window(at, window).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), key, "n")


def pause_sessions(stream: DataFrame, keys: list[str], at: str, gap: str) -> DataFrame:
    """Sessions of a key that end after a pause of ``gap``."""
    return stream.withWatermark(at, gap).groupBy(*keys, F.session_window(at, gap).alias("w")).agg(F.count("*").alias("n")).select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions of a table kept by ``upsert_latest`` that were written to their end, oldest first."""
    fs, at = file_system(spark, path)
    if not fs.exists(at):
        return []
    done = [f.getPath() for f in fs.listStatus(at) if f.getPath().getName().startswith("v=")]
    whole = [p for p in done if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName()[2:]) for p in whole)


def upsert_latest(key: str, order: list[str], path: str, keep: int = 2) -> Callable[[DataFrame, int], None]:
    """A sink that keeps the latest row per key: each batch is merged with the table and written beside it.

    A batch that comes again after a failure replaces its version; only the last ``keep`` versions stay.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = [v for v in versions(spark, path) if v < number]
        if before:
            batch = batch.unionByName(spark.read.parquet(f"{path}/v={before[-1]}"))
        columns = batch.columns
        newest = batch.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("r")).select("r.*")
        newest.write.mode("overwrite").parquet(f"{path}/v={number}")
        for old in before[: max(0, len(before) + 1 - keep)]:
            fs, at = file_system(spark, f"{path}/v={old}")
            fs.delete(at, True)

    return merge


def answered(asked: DataFrame, answers: DataFrame, key: str, asked_at: str, answered_at: str, within: str) -> DataFrame:
    """Requests with the answers that came within a time; each side's state is kept only that long."""
    a = asked.withWatermark(asked_at, within)
    b = answers.withWatermark(answered_at, within)
    fits = (F.col(answered_at) >= F.col(asked_at)) & (F.col(answered_at) <= F.col(asked_at) + F.expr(f"INTERVAL {within}"))
    return a.join(b, (a[key] == b[f"{key}_answered"]) & fits, "inner")


def numbered_changes(stream: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """Changes of a key's value with a running number, from state carried over batches."""

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, n = state.get if state.exists else (None, 0)
        rows = []
        for pdf in batches:
            for t, v in sorted(zip(pdf[at], pdf[value])):
                if v != last:
                    n += 1
                    rows.append((k[0], t, v, n))
                    last = v
        state.update((last, n))
        yield pd.DataFrame(rows, columns=[key, at, value, "number"])

    schema = stream.schema
    kind = lambda c: schema[c].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(step, f"{key} {kind(key)}, {at} {kind(at)}, {value} {kind(value)}, number int", f"last {kind(value)}, n int", "append", GroupStateTimeout.NoTimeout)
