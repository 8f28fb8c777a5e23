"""Continuous periods and gaps of overlapping, nested or touching intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from praktika.operators.chunks import prefix_sum
from praktika.operators.lineage import cut

#: A chunk of an entity's time line; after merging equal times it holds at most this many boundaries of one kind.
CHUNK_MS = 600_000


def to_millis(seconds: Column) -> Column:
    """Seconds as whole milliseconds, halves up."""
    return F.floor(seconds * 1000 + F.lit(0.5)).cast("bigint")


def periods_and_gaps(df: DataFrame, entity: list[str], start: str, end: str, chunk_ms: int = CHUNK_MS) -> DataFrame:
    """Periods and gaps per ``entity`` of the intervals [``start``, ``end``], both in whole milliseconds.

    Starts and ends are ranked independently. A gap lies before the start of rank i+1 where it exceeds the end of
    rank i; the k-th period then runs from the k-th start after a gap to the k-th end before one. Equal times are
    counted before anything is sorted, ranks are prefix sums over time chunks, and starts meet ends by an equi-join
    on (entity, rank), so no task holds a whole entity.

    Rows whose start or end is null, or whose end is not after the start, are no intervals. Touching intervals are
    one period, repeated rows change nothing, a null in an entity column is a value of its own, an empty table gives
    an empty result, and further columns of ``df`` are ignored whatever their names.
    Out: the entity columns, ``row_kind`` (period, gap), ``start_ms``, ``end_ms``.
    """
    rows = df.select(F.struct(*[F.col(c).alias(f"e{i}") for i, c in enumerate(entity)]).alias("_e"), F.col(start).alias("_s"), F.col(end).alias("_t")).where("_t > _s")

    def ranked(at: str, name: str) -> DataFrame:
        counted = rows.groupBy("_e", F.col(at).alias("_at")).agg(F.count("*").alias("_n"))
        counted = counted.withColumn("_chunk", F.floor(F.col("_at") / chunk_ms))
        return prefix_sum(counted, "_e", "_chunk", [F.col("_at")], "_n", "_rank").select("_e", F.col("_at").alias(name), "_n", "_rank")

    starts = ranked("_s", "_start").select("_e", "_start", (F.col("_rank") - F.col("_n")).alias("_rank"))
    ends = ranked("_t", "_end").select("_e", "_end", "_rank")
    gaps = starts.where("_rank > 0").join(ends, ["_e", "_rank"]).where("_start > _end").select("_e", "_end", "_start")

    # gaps are asked for five times below: they are found once
    numbered = cut(prefix_sum(gaps.withColumns({"_chunk": F.floor(F.col("_start") / chunk_ms), "_one": F.lit(1)}), "_e", "_chunk", [F.col("_start")], "_one", "_k").select("_e", "_start", "_end", "_k"))
    whole = rows.groupBy("_e").agg(F.min("_s").alias("_first"), F.max("_t").alias("_last"), F.lit(0).cast("bigint").alias("_k"))
    count = numbered.groupBy("_e").agg(F.max("_k").alias("_gaps"))
    opened = numbered.select("_e", "_k", F.col("_start").alias("_from")).unionByName(whole.select("_e", "_k", F.col("_first").alias("_from")))
    closed = numbered.select("_e", (F.col("_k") - 1).alias("_k"), F.col("_end").alias("_to")).unionByName(
        whole.join(count, "_e", "left").select("_e", F.coalesce("_gaps", F.lit(0)).cast("bigint").alias("_k"), F.col("_last").alias("_to"))
    )
    periods = opened.join(closed, ["_e", "_k"]).select("_e", F.lit("period").alias("row_kind"), F.col("_from").alias("start_ms"), F.col("_to").alias("end_ms"))
    out = periods.unionByName(numbered.select("_e", F.lit("gap").alias("row_kind"), F.col("_end").alias("start_ms"), F.col("_start").alias("end_ms")))
    return out.select(*[F.col(f"_e.e{i}").alias(c) for i, c in enumerate(entity)], "row_kind", "start_ms", "end_ms")
