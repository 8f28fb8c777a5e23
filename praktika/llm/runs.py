"""Runs of equal consecutive events by associative summaries of chunks.

A sequence is cut into chunks by its own order (spans of time or of positions), so a chunk is bounded whatever the
length of the sequence and is the same whenever it is computed again. Each chunk is encoded into runs by one local
window. Only the runs at its two ends can go on in a neighbour; these few rows per chunk are merged over the whole
sequence, the others are final.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Runs at either end of a chunk that take part in the merge: a leading run without a value takes the value carried
#: in from the left and may then equal the run after it; an edge row may stand before both.
HEAD_RUNS, TAIL_RUNS = 3, 2
#: The part of the runs that may go on: no chunk's number.
OUTER = -(1 << 50)


def speaker_label(label: Column) -> Column:
    """One spelling per speaker label: speaker_0, SPEAKER_00, Speaker 0, spk0, S00 and the Greek word with 0 are one.

    Null and blank give null. A label of another kind is lower-cased, its separators made one space.
    """
    low = F.lower(F.trim(label))
    number = F.regexp_extract(low, r"^[^\p{L}\d]*(?:speaker|spk|s|ομιλητ[ηή]ς|ομιλήτρια)?[\s_.:#-]*0*(\d+)[^\p{L}\d]*$", 1)
    other = F.trim(F.regexp_replace(low, r"[\s_.:#-]+", " "))
    return F.when(F.length(number) > 0, F.concat(F.lit("speaker_"), number)).otherwise(F.nullif(other, F.lit("")))


#: Where the chunks of rows without a position begin, before all others; so many of their ordinals make one.
NOWHERE, NOWHERE_ORDINALS = -(1 << 40), 4096


def chunk_of(position: Column, width: float, ordinal: Column | None = None) -> Column:
    """The chunk of a position. Rows without one come first, in chunks of their ordinals if these are numbers."""
    nowhere = F.lit(NOWHERE) if ordinal is None else F.lit(NOWHERE) + F.coalesce(F.floor(ordinal.try_cast("double") / NOWHERE_ORDINALS), F.lit(-1))
    return F.coalesce(F.floor(position / F.lit(width)), nowhere).cast("bigint")


def local_runs(rows: DataFrame, keys: list[str], extra: list[Column] = ()) -> DataFrame:
    """Summaries of the runs within each (keys, chunk) of rows numbered by ``_run``."""
    return rows.groupBy(*keys, "_chunk", "_run").agg(
        F.max("_value").alias("_value"),
        F.count("*").alias("_n"),
        F.min(F.struct("_pos", "_ord", "_start")).alias("_first"),
        F.max(F.struct("_pos", "_ord", "_end")).alias("_last"),
        *extra,
    )


def mark_ends(runs: DataFrame, keys: list[str]) -> DataFrame:
    """``runs`` with ``_part``: OUTER if the run may go on beyond its chunk, else the chunk.

    Partitioned by (keys, _part), the outer runs of a sequence stand together and the inner ones stay apart, so one
    window serves both and nothing is computed twice.
    """
    chunk = Window.partitionBy(*keys, "_chunk")
    outer = (F.col("_run") <= HEAD_RUNS) | (F.col("_run") > F.max("_run").over(chunk) - TAIL_RUNS)
    return runs.withColumn("_part", F.when(outer, F.lit(OUTER).cast("bigint")).otherwise(F.col("_chunk")))


def merge(runs: DataFrame, keys: list[str], apart: Column | None = None) -> DataFrame:
    """Adjacent runs of equal value as one, over chunk boundaries. ``_value`` must be filled in outer runs.

    ``apart`` may forbid a merge: it sees the summary and, as ``_before``, the summary ahead of it.
    """
    order = Window.partitionBy(*keys, "_part").orderBy("_chunk", "_run")
    runs = runs.withColumn("_before", F.lag(F.struct("_value", "_chunk", "_run", "_last")).over(order))
    new = F.col("_before").isNull() | ~F.col("_value").eqNullSafe(F.col("_before._value"))
    new = new | ((F.col("_before._chunk") == F.col("_chunk")) & (F.col("_run") - F.col("_before._run") > 1))
    if apart is not None:
        new = new | F.coalesce(apart, F.lit(False))
    return (
        runs.withColumn("_group", F.sum(new.cast("bigint")).over(order))
        .groupBy(*keys, "_part", "_group")
        .agg(F.max("_value").alias("_value"), F.sum("_n").alias("_n"), F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    )


def collapse_runs(
    df: DataFrame, keys: list[str], position: str, value: Column, start: str, end: str, chunk: float, carry: bool = False, ordinal: str | None = None, min_events: int = 1
) -> DataFrame:
    """One row per run of equal ``value`` in the order of ``position`` (then ``ordinal``) within ``keys``.

    Exact repetitions of a row in the columns used count once. With ``carry`` a null value continues the value before
    it, or is a run of its own at the head of a sequence; without, nulls equal each other. Nulls in a key are a key of
    their own; rows without position come first. Equal positions are ordered by ``ordinal``. Other columns of ``df``
    are ignored, an empty table gives none. ``chunk`` is the width of a chunk in units of ``position``.
    Out: keys, ``first_ord``, ``last_ord``, ``n_events``, ``start``, ``end`` (of the first and last event), ``value``.
    """
    rows = df.select(
        *keys,
        chunk_of(F.col(position), chunk, F.col(ordinal or position)).alias("_chunk"),
        F.col(position).alias("_pos"),
        F.col(ordinal or position).alias("_ord"),
        F.col(start).alias("_start"),
        F.col(end).alias("_end"),
        (value if carry else F.coalesce(value, F.lit("\0"))).alias("_value"),
    )
    rows = rows.repartition(*keys, "_chunk").dropDuplicates()
    local = Window.partitionBy(*keys, "_chunk").orderBy("_pos", "_ord", "_start", "_end")
    if carry:
        rows = rows.withColumn("_value", F.last("_value", ignorenulls=True).over(local))
    new = (~F.col("_value").eqNullSafe(F.lag("_value").over(local))) | (F.row_number().over(local) == 1)
    rows = rows.withColumn("_new", new.cast("int")).withColumn("_run", F.sum("_new").over(local))
    runs = mark_ends(local_runs(rows, keys), keys)
    if carry:
        whole = Window.partitionBy(*keys, "_part").orderBy("_chunk", "_run")
        runs = runs.withColumn("_value", F.last("_value", ignorenulls=True).over(whole))
    out = merge(runs, keys).where(F.col("_n") >= min_events)
    return out.select(
        *keys,
        F.col("_first._ord").alias("first_ord"),
        F.col("_last._ord").alias("last_ord"),
        F.col("_n").alias("n_events"),
        F.col("_first._start").alias("start"),
        F.col("_last._end").alias("end"),
        F.nullif("_value", F.lit("\0")).alias("value"),
    )
