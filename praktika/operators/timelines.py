"""Joins and windows over intervals and over positions in time."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from praktika.operators.chunks import neighbours, position_chunk, prefix_sum

#: Seconds of a chunk of a time line.
CHUNK_SECONDS = 3600.0
#: Seconds of a bucket of the interval joins, buckets that an interval may span, and by how much wider those of longer ones are.
BUCKET_SECONDS, MOST_BUCKETS, WIDER = 60.0, 64, 4096


def _sequence(start: Column, end: Column, width: float) -> Column:
    return F.sequence(F.floor(start / width), F.floor(F.greatest(start, end) / width))


def _long(start: Column, end: Column, width: float) -> Column:
    """Whether an interval is too long for buckets of ``width``."""
    return F.coalesce(end - start > F.lit(width * MOST_BUCKETS), F.lit(False))


def _places(kind: str, buckets: Column) -> Column:
    return F.transform(buckets, lambda b: F.struct(F.lit(kind).alias("kind"), b.alias("at")))


def _overlap_places(start: str, end: str, width: float, side: str) -> Column:
    """Where an interval looks for partners: short meets short in narrow buckets; wherever one is long, in wide ones."""
    s, e = F.col(start), F.col(end)
    wide, mine, other = _sequence(s, e, width * WIDER), "L" if side == "left" else "R", "R" if side == "left" else "L"
    short = F.concat(_places("S", _sequence(s, e, width)), _places(other, wide))  # a long partner on the other side
    long = F.concat(_places(mine, wide), _places("B", wide))
    return F.explode(F.when(_long(s, e, width), long).otherwise(short))


def overlap_join(a: DataFrame, b: DataFrame, key: str, a_span: tuple[str, str], b_span: tuple[str, str], width: float = BUCKET_SECONDS) -> DataFrame:
    """Pairs of one key whose closed intervals share a moment.

    Both sides are cut into time buckets, so that a join on (key, bucket) finds them and no key sits in one task. A
    pair that shares several buckets is kept in the one where the later of the two starts. An interval of more than
    MOST_BUCKETS buckets goes into buckets WIDER times as wide, where the short ones of the other side look for it as
    well, so that one wrong end makes no millions of rows.
    """
    (s0, e0), (s1, e1) = a_span, b_span
    left = a.withColumn("_b", _overlap_places(s0, e0, width, "left"))
    right = b.withColumn("_b", _overlap_places(s1, e1, width, "right"))
    meets = (F.col(s1) <= F.col(e0)) & (F.col(e1) >= F.col(s0))
    home = F.floor(F.greatest(F.col(s0), F.col(s1)) / F.when(F.col("_b.kind") == "S", F.lit(width)).otherwise(F.lit(width * WIDER)))
    return left.join(right, [key, "_b"]).where(meets & (F.col("_b.at") == home)).drop("_b")


def contained_join(a: DataFrame, b: DataFrame, key: str, a_span: tuple[str, str], b_span: tuple[str, str], width: float = BUCKET_SECONDS) -> DataFrame:
    """Pairs of one key in which the interval of ``b`` holds that of ``a``: only the container is cut into buckets, a long one into wide ones."""
    at = lambda w: F.array(F.floor(F.col(a_span[0]) / w))
    left = a.withColumn("_b", F.explode(F.concat(_places("S", at(width)), _places("L", at(width * WIDER)))))
    s, e = F.col(b_span[0]), F.col(b_span[1])
    right = b.withColumn("_b", F.explode(F.when(_long(s, e, width), _places("L", _sequence(s, e, width * WIDER))).otherwise(_places("S", _sequence(s, e, width)))))
    return left.join(right, [key, "_b"]).where((s <= F.col(a_span[0])) & (e >= F.col(a_span[1]))).drop("_b")


def nearest_segment(items: DataFrame, segments: DataFrame, key: str, item: str, span: tuple[str, str], seg_span: tuple[str, str], order: str, width: float = BUCKET_SECONDS) -> DataFrame:
    """For each item and each speaker who overlaps it the nearest of the speaker's segments, by the distances of both ends.

    A later segment that holds the item beats whatever came before it, the first one of a speaker excepted; after it
    a nearer one beats it again: the nearest, first on ties, among those from the last such segment on.

    Who overlaps comes from the bucketed join; the nearest overlapping segment then bounds how far a start can lie
    that is nearer still, and a second bucketed join on (key, speaker, bucket of the start) looks only there.
    ``segments`` hold ``key``, a speaker, ``seg_span`` and ``order``; ``items`` hold ``key``, ``item`` and ``span``.
    """
    (s, e), (a, b) = span, seg_span
    ranked = segments.withColumn("_i", F.row_number().over(Window.partitionBy(key, "speaker").orderBy(order)) - 1).select(key, "speaker", a, b, "_i")
    far = F.abs(F.col(a) - F.col(s)) + F.abs(F.col(b) - F.col(e))
    holds = (F.col(a) <= F.col(s)) & (F.col(b) >= F.col(e)) & (F.col("_i") >= 1)
    met = overlap_join(items.select(key, item, s, e), ranked, key, span, seg_span, width).withColumns({"_far": far, "_k": F.when(holds, F.col("_i"))})
    since = met.withColumn("_since", F.coalesce(F.max("_k").over(Window.partitionBy(key, item, "speaker")), F.lit(0)))
    # where only earlier ones overlap, the segment on from which the choice is made is itself among them
    reach = since.where("_i >= _since").groupBy(key, item, s, e, "speaker").agg(F.min("_since").alias("_since"), F.min("_far").alias("_most"))
    low, high = F.col(s) - F.col("_most"), F.col(s) + F.col("_most")
    asked = reach.withColumn("_b", F.explode(F.when(_long(low, high, width), _places("L", _sequence(low, high, width * WIDER))).otherwise(_places("S", _sequence(low, high, width)))))
    starts = F.explode(F.concat(*[_places(kind, F.array(F.floor(F.col(a) / w))) for kind, w in (("S", width), ("L", width * WIDER))]))
    pairs = asked.join(ranked.withColumn("_b", starts), [key, "speaker", "_b"]).withColumn("_far", far).where("_i >= _since and _far <= _most")
    best = pairs.groupBy(key, item, "speaker").agg(F.min_by(F.struct(s, e, a, b), F.struct("_far", "_i")).alias("_m"))
    return best.select(key, item, "speaker", "_m.*")


def bridge_gaps(df: DataFrame, key: str, order: list[str], start: str, end: str, most: float = 2.0) -> DataFrame:
    """Ends drawn to the next start over gaps of up to ``most`` seconds. ``order`` begins with a position."""
    rows = neighbours(df.withColumn("_chunk", position_chunk(order[0])), key, "_chunk", order, [start])
    gap = F.col("_after")[start] - F.col(end)
    return rows.withColumn("bridged_end", F.when((gap > 0) & (gap <= most), F.col(end) + gap).otherwise(F.col(end))).drop("_chunk", "_before", "_after")


def merge_touching(df: DataFrame, key: str, order: list[str], start: str, end: str, epsilon: float = 0.001) -> DataFrame:
    """Consecutive intervals whose ends meet within ``epsilon`` as one. ``order`` begins with a position."""
    rows = neighbours(df.withColumn("_chunk", position_chunk(order[0])), key, "_chunk", order, [end])
    new = F.coalesce((F.abs(F.col("_before")[end] - F.col(start)) >= epsilon).cast("int"), F.lit(1))
    numbered = prefix_sum(rows.withColumn("_new", new), key, "_chunk", [F.col(c) for c in order], "_new", "run")
    at = F.struct(*order)
    return numbered.groupBy(key, "run").agg(F.min_by(start, at).alias("start"), F.max_by(end, at).alias("end"), F.count("*").alias("n"))


def on_one_line(df: DataFrame, key: str, order: list[str], start: str, end: str) -> DataFrame:
    """Where each interval begins when all are laid end to end. ``order`` begins with a position."""
    rows = df.withColumns({"_chunk": position_chunk(order[0]), "_length": F.col(end) - F.col(start)})
    summed = prefix_sum(rows, key, "_chunk", [F.col(c) for c in order], "_length", "_through")
    return summed.withColumn("normalized_start", F.col("_through") - F.col("_length")).drop("_chunk", "_length", "_through")


def changes_of(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Rows whose value is not that of the row before; the first row is one. ``order`` begins with a position."""
    rows = neighbours(df.withColumn("_chunk", position_chunk(order[0])), key, "_chunk", order, [value])
    return rows.where(F.col("_before").isNull() | ~F.col("_before")[value].eqNullSafe(F.col(value))).drop("_chunk", "_before", "_after")


def silences(df: DataFrame, key: str, order: list[str], start: str, end: str, bounds: DataFrame, low: str, high: str, least: float = 0.5) -> DataFrame:
    """Pauses of ``least`` seconds or more between the segments that lie wholly within a key's bounds.

    A pause begins where the segment before it ends, even if an earlier one ended later. ``order`` begins with ``start``.
    """
    inside = df.join(bounds, key).where((F.col(start) >= F.col(low)) & (F.col(end) <= F.col(high)))
    rows = neighbours(inside.withColumn("_chunk", F.floor(F.col(start) / CHUNK_SECONDS)), key, "_chunk", order, [end])
    between = rows.select(key, F.coalesce(F.col("_before")[end], F.col(low)).alias("from"), F.col(start).alias("to"))
    last = bounds.join(inside.groupBy(key).agg(F.max_by(end, F.struct(*order)).alias("_last")), key, "left").select(key, F.coalesce("_last", low).alias("from"), F.col(high).alias("to"))
    return between.unionByName(last).where((F.col("to") > F.col("from")) & (F.col("to") - F.col("from") >= least))


def split_at_silences(df: DataFrame, key: str, start: str, end: str, longest: float, long_pause: float = 5.0, short_pause: float = 0.5) -> DataFrame:
    """Parts of at most ``longest`` seconds per key, cut at the end of a long pause or else of a short one.

    The stretch that may still be heard in one part is looked through in slices of twenty pauses' length, the latest
    slice first; the first pause of the first slice that has one is taken. A slice knows only the segments that lie
    wholly in it. Each cut depends on the one before, so a key (one recording) is one group. What is left where no
    pause can be found is one part with ``uncut`` true, so that no recording is lost.
    """

    def first_pause(starts: np.ndarray, ends: np.ndarray, low: float, high: float, least: float) -> float | None:
        inside = (starts >= low) & (ends <= high)
        begins, stops = np.append(low, ends[inside]), np.append(starts[inside], high)
        long = np.flatnonzero(stops - begins >= least)
        return float(stops[long[0]]) if len(long) else None

    def slices(low: float, high: float, least: float) -> list[tuple[float, float]]:
        edges = np.append(np.arange(high, low, -min(20 * least, high - low)), low)
        return [(b, a) for a, b in zip(edges, edges[1:])]

    def parts(pdf: pd.DataFrame) -> pd.DataFrame:
        spans = pdf.sort_values([start, end])
        starts, ends = spans[start].to_numpy(float), spans[end].to_numpy(float)
        total, bounds, uncut = float(ends.max()), [0.0], False
        while total - bounds[-1] > longest and not uncut:
            low, high = bounds[-1], bounds[-1] + longest
            pauses = (first_pause(starts, ends, a, b, least) for least in (long_pause, short_pause) for a, b in slices(low, high, least))
            found = next((p for p in pauses if p is not None), None)
            uncut = found is None or found <= low
            bounds += [] if uncut else [found]
        bounds += [total] if total > bounds[-1] else []
        n = len(bounds) - 1
        return pd.DataFrame({key: [pdf[key].iloc[0]] * n, "part": range(n), "start": bounds[:-1], "end": bounds[1:], "uncut": [uncut and i == n - 1 for i in range(n)]})

    rows = df.where(F.col(end) > F.col(start)).select(key, start, end).distinct()
    return rows.groupBy(key).applyInPandas(parts, f"{key} {df.schema[key].dataType.simpleString()}, part int, start double, end double, uncut boolean")


def attendance_at(people: DataFrame, events: DataFrame, positions: DataFrame) -> DataFrame:
    """Whether each person is present at each position of a meeting.

    ``people``: meeting_id, name, present (at the roll call). ``events``: meeting_id, name, change_type, position
    (null for the whole session), timing, ord. ``positions``: meeting_id, position. An arrival before the session
    counts from the start, an event during a position at it, one after a position from the next on; a departure
    without position and an event at a position without timing change nothing. The last event in effect decides.
    """
    placed = events.withColumn("at", F.when(F.col("position").isNull(), F.when(F.col("change_type") == "arrival", F.lit(-1))).when(F.col("timing") == "during", F.col("position")).when(F.col("timing") == "after", F.col("position") + 1))
    placed = placed.where("at is not null").select("meeting_id", "name", "at", F.when(F.col("timing") == "during", 1).otherwise(0).alias("phase"), "ord", (F.col("change_type") == "arrival").alias("arrives"))
    # people's starting state is the event before all others; one union and one window, no join of all to all
    start = people.select("meeting_id", "name", F.lit(-2).alias("at"), F.lit(0).alias("phase"), F.lit(-1).cast("bigint").alias("ord"), F.col("present").alias("arrives"))
    states = start.unionByName(placed.withColumn("ord", F.col("ord").cast("bigint")))
    roster = states.select("meeting_id", "name").distinct()
    asked = roster.join(positions, "meeting_id").select("meeting_id", "name", F.col("position").alias("at"), F.lit(2).alias("phase"), F.lit(0).cast("bigint").alias("ord"), F.lit(None).cast("boolean").alias("arrives"), F.col("position"))
    w = Window.partitionBy("meeting_id", "name").orderBy("at", "phase", "ord").rowsBetween(Window.unboundedPreceding, 0)
    known = states.withColumn("position", F.lit(None).cast("int")).unionByName(asked).withColumn("present", F.coalesce(F.last("arrives", ignorenulls=True).over(w), F.lit(False)))
    return known.where("position is not null").select("meeting_id", "name", "position", "present")
