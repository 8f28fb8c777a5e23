"""Order-dependent operations on keys of any size, through bounded chunks.

A window over a whole key puts that key into one task. Here rows are windowed within (key, chunk), where the chunk
is a fixed slice of the order (a span of time, a range of positions), and only one summary row per chunk is windowed
over the whole key. Chunks depend on the row alone, so every recomputation of a lost partition gives the same ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _whole(df: DataFrame, key: str) -> tuple[DataFrame, str]:
    """``df`` with its key as a struct, inside which nulls are equal, in windows and joins alike.

    A key that is a struct already stays, so that one operation after another finds its rows where they must be.
    """
    if isinstance(df.schema[key].dataType, T.StructType):
        return df, key
    return df.withColumn("_whole", F.struct(key)), "_whole"


def prefix_sum(df: DataFrame, key: str, chunk: str, order: list[Column], value: str, out: str) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over the rows of ``key`` up to and including this one.

    Rows of equal order must have been merged before. ``key`` may be a struct; nulls inside it compare equal.
    """
    rows, whole = _whole(df, key)
    local = Window.partitionBy(whole, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    within = rows.withColumn(out, F.sum(value).over(local))
    totals = rows.groupBy(whole, chunk).agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(whole).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(whole, chunk, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    return within.join(offsets, [whole, chunk]).withColumn(out, F.col(out) + F.col("_offset")).drop("_whole", "_offset")


#: Positions of a chunk where a key is ordered by position.
CHUNK_POSITIONS = 4096


def position_chunk(position: str) -> Column:
    """The chunk of a numeric position; rows without one come first."""
    return F.coalesce(F.floor(F.col(position) / CHUNK_POSITIONS), F.lit(-1)).cast("bigint")


def neighbours(df: DataFrame, key: str, chunk: str, order: list[str], payload: list[str], before: str = "_before", after: str = "_after") -> DataFrame:
    """``df`` with the payload of the rows before and after each row of ``key`` in ``order`` (null at the ends).

    ``order`` must tell rows apart. Only the first and last row of each chunk is windowed over the whole key.
    """
    p, at, (rows, whole) = F.struct(*payload), F.struct(*order), _whole(df, key)
    local = Window.partitionBy(whole, chunk).orderBy(*order)
    ends = rows.groupBy(whole, chunk).agg(F.min_by(p, at).alias("_first"), F.max_by(p, at).alias("_last"))
    chunks = Window.partitionBy(whole).orderBy(chunk)
    ends = ends.select(whole, chunk, F.lag("_last").over(chunks).alias("_l"), F.lead("_first").over(chunks).alias("_n"))
    joined = rows.withColumns({before: F.lag(p).over(local), after: F.lead(p).over(local)}).join(ends, [whole, chunk])
    return joined.withColumns({before: F.coalesce(before, "_l"), after: F.coalesce(after, "_n")}).drop("_whole", "_l", "_n")


def carried(df: DataFrame, key: str, chunk: str, order: list[str], value: Column, out: str) -> DataFrame:
    """``df`` with ``out``: the last ``value`` that is not null in the rows of ``key`` up to and including this one.

    Only the last value of each chunk is windowed over the whole key.
    """
    rows, whole = _whole(df.withColumn("_value", value), key)
    at = F.struct(*order)
    local = Window.partitionBy(whole, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ends = rows.groupBy(whole, chunk).agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), at)).alias("_last"))
    before = Window.partitionBy(whole).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(whole, chunk, F.last("_last", ignorenulls=True).over(before).alias("_before_chunk"))
    within = rows.withColumn(out, F.last("_value", ignorenulls=True).over(local)).join(ends, [whole, chunk])
    return within.withColumn(out, F.coalesce(out, "_before_chunk")).drop("_whole", "_value", "_before_chunk")
