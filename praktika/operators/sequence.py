"""Numbered sequences: clusters, gaps, filled indices, sessions, batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from praktika.functions.numbers import confidence, round_half_up
from praktika.functions.text import ends_sentence, protocol_parts
from praktika.operators.chunks import carried, neighbours, position_chunk, prefix_sum
from praktika.operators.lineage import cut

#: Numbers that may be missing inside a run is one less than this; members that make it a sequence.
MAX_GAP, LEAST_RUN = 3, 3
#: Seconds of silence and of speech after which an utterance ends.
PAUSE_SECONDS, MAX_SECONDS = 1.0, 30.0
#: Waits of a throttle in one chunk of time.
CHUNK_WAITS = 1024


def protocol_pattern(df: DataFrame, key: str, number: str) -> DataFrame:
    """Per key the numbers of its longest run, if it has three or more and all are written alike.

    Out: key, prefix, suffix, num, in_run. A run breaks where MAX_GAP or more numbers are missing; of runs of equal
    length the first is taken.
    """
    parsed = df.where(F.col(number).isNotNull()).select(key, protocol_parts(F.col(number)).alias("p"))
    alike = parsed.groupBy(key).agg(F.count("*").alias("n"), F.count("p").alias("ok"), F.min("p.prefix").alias("p0"), F.max("p.prefix").alias("p1"), F.min("p.suffix").alias("s0"), F.max("p.suffix").alias("s1"))
    alike = alike.where("n >= 3 and n = ok and p0 = p1 and s0 = s1").select(key, F.col("p0").alias("prefix"), F.col("s0").alias("suffix"))
    nums = parsed.select(key, "p.num").join(alike, key)
    order = Window.partitionBy(key).orderBy("num")
    new = F.coalesce((F.col("num") - F.lag("num").over(order) - 1 >= MAX_GAP).cast("int"), F.lit(1))
    runs = nums.withColumn("new", new).withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    size = runs.withColumn("size", F.count("*").over(Window.partitionBy(key, "run")))
    best = size.withColumn("best", F.min_by("run", F.struct(-F.col("size"), F.col("run"))).over(Window.partitionBy(key)))
    return best.withColumn("in_run", F.col("run") == F.col("best")).select(key, "prefix", "suffix", "num", "in_run", F.when(F.col("in_run"), F.col("size")).alias("run_size"))


def missing_numbers(df: DataFrame, key: str, num: str, max_gap: int = MAX_GAP) -> DataFrame:
    """Numbers missing between those of a key; none where any gap has ``max_gap`` numbers or more."""
    order = Window.partitionBy(key).orderBy(num)
    gaps = df.select(key, num).distinct().withColumn("next", F.lead(num).over(order)).withColumn("gap", F.coalesce(F.col("next") - F.col(num) - 1, F.lit(0)))
    small = gaps.withColumn("worst", F.max("gap").over(Window.partitionBy(key))).where((F.col("worst") < max_gap) & (F.col("gap") > 0))
    return small.select(key, F.explode(F.sequence(F.col(num) + 1, F.col("next") - 1)).alias("missing"))


def fill_missing_index(df: DataFrame, key: str, index: str, order: str) -> DataFrame:
    """Rows without an index get the ones after the highest of their key, in ``order``."""
    whole = Window.partitionBy(key)
    nulls = F.sum(F.col(index).isNull().cast("int")).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("filled", F.coalesce(F.col(index), F.coalesce(F.max(index).over(whole), F.lit(0)) + nulls).cast("int"))


def even_sample(df: DataFrame, key: str, order: str, k: int) -> DataFrame:
    """At most ``k`` rows of a key, evenly spaced in ``order``: the sampling report of a comparison."""
    ranked = df.withColumns({"rn": F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1, "n": F.count("*").over(Window.partitionBy(key))})
    # row r is picked if r = round(i (n-1)/(k-1)) for some i: the nearest i decides
    step = (F.col("n") - 1) / F.lit(max(1, k - 1))
    i = F.greatest(F.lit(0), F.ceil((F.col("rn") - 0.5) / step))
    picked = (F.col("n") <= k) | ((F.lit(k) == 1) & (F.col("rn") == 0)) | ((F.lit(k) > 1) & (i < k) & (round_half_up(i * step) == F.col("rn")))
    return ranked.where(picked).drop("rn", "n")


def pause_sessions(df: DataFrame, keys: list[str], order: str, start: str, end: str, text: str, pause: float = PAUSE_SECONDS) -> DataFrame:
    """Sessions of words by pauses and sentence ends alone: first and last position, words, start and end."""
    rows = df.withColumns({"_key": F.struct(*keys), "_chunk": position_chunk(order), "_ended": ends_sentence(F.col(text))}).repartition("_key", "_chunk")
    known = neighbours(rows, "_key", "_chunk", [order], [end, "_ended"])
    before = F.col("_before")
    new = (before[end].isNull() | (F.col(start) - before[end] > pause) | F.coalesce(before["_ended"], F.lit(False))).cast("int")
    numbered = prefix_sum(known.withColumn("_new", new), "_key", "_chunk", [F.col(order)], "_new", "session")
    return numbered.groupBy(*keys, "session").agg(F.min(order).alias("first_ord"), F.max(order).alias("last_ord"), F.count("*").alias("n_words"), F.min(start).alias("start"), F.max(end).alias("end"))


def paced(df: DataFrame, keys: list[str], at: str, order: str, wait: float) -> DataFrame:
    """Rows that pass a throttle: the first of a key, then always the first that comes ``wait`` seconds or more after the last to pass.

    What comes ``wait`` or more after the row before it passes whatever went before, so the rows between two such
    pauses stand alone. Of a stretch shorter than ``wait`` only the first passes; only longer ones are followed row by
    row. Rows without a time pass never; of equal times the lower ``order`` is first.
    """
    # whole microseconds, so that sums are exact
    moment, pause = F.round(F.col(at) * 1_000_000) if dict(df.dtypes)[at] in ("double", "float") else F.unix_micros(F.col(at).cast("timestamp")), round(wait * 1_000_000)
    rows = df.where(F.col(at).isNotNull()).withColumns({"_key": F.struct(*keys), "_t": moment.cast("bigint")})
    rows = rows.withColumn("_chunk", F.floor(F.col("_t") / (CHUNK_WAITS * pause)))
    known = neighbours(rows, "_key", "_chunk", ["_t", order], ["_t"])
    new = F.coalesce((F.col("_t") - F.col("_before._t") >= pause).cast("int"), F.lit(1))
    numbered = cut(prefix_sum(known.withColumn("_new", new), "_key", "_chunk", [F.col("_t"), F.col(order)], "_new", "_stretch").drop("_before", "_after"))
    spans = numbered.groupBy("_key", "_stretch").agg(F.min("_t").alias("_t0"), F.max("_t").alias("_t1"))
    long = numbered.join(spans.where(F.col("_t1") - F.col("_t0") >= pause).select("_key", "_stretch"), ["_key", "_stretch"], "left_semi")

    def follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = 0
        for batch in batches:
            passes = []
            for new, t in zip(batch["_new"], batch["_t"]):
                passes.append(bool(new) or t - last >= pause)
                last = t if passes[-1] else last
            yield batch[passes]

    # in order, batch by batch: no stretch is ever held as a whole
    ids = ["_key", "_stretch"]
    passed = long.repartition(*ids).sortWithinPartitions(*ids, "_t", order).mapInPandas(follow, long.schema)
    return numbered.where("_new = 1").unionByName(passed.where("_new = 0")).select(*df.columns)


def words_to_utterances(df: DataFrame, keys: list[str], order: str = "ord", text: str = "text", kind: str = "word_type", start: str = "start_sec", end: str = "end_sec", logprob: str = "logprob") -> DataFrame:
    """Utterances of a word stream: parted by pauses before, and sentence ends or MAX_SECONDS after a word.

    A missing end is the start, a missing start the end of the word before. Pauses and sentence ends are marked first,
    over chunks of positions; only the sessions between them that last MAX_SECONDS or more are parted further, where
    each part depends on the one before. Spacing belongs to the utterance of the last word unless that word closed it.
    """
    columns = [F.struct(*keys).alias("stream"), F.col(order).cast("bigint").alias("o"), F.col(text).alias("t"), (F.col(kind) == "word").alias("w"), F.col(start).cast("double").alias("s"), F.col(end).cast("double").alias("e"), confidence(F.col(logprob)).alias("c")]
    # one exchange: repeated rows are dropped, and all that follows is done, where a chunk's rows lie
    rows = df.where(F.col(kind).isin("word", "spacing")).select(*columns).withColumn("_chunk", position_chunk("o")).repartition("stream", "_chunk").distinct()
    words = carried(rows.where("w").withColumn("stop", F.coalesce(ends_sentence(F.col("t")), F.lit(False))), "stream", "_chunk", ["o"], F.coalesce("e", "s"), "e1")
    words = neighbours(words.withColumn("e1", F.coalesce("e1", F.lit(0.0))), "stream", "_chunk", ["o"], ["e1", "stop"])
    words = words.withColumn("s1", F.coalesce("s", "_before.e1", F.lit(0.0)))
    new = F.col("_before").isNull() | (F.col("s1") - F.col("_before.e1") > PAUSE_SECONDS) | F.col("_before.stop")
    words = prefix_sum(words.withColumn("_new", new.cast("int")), "stream", "_chunk", [F.col("o")], "_new", "session")
    words = cut(words.select("stream", "session", "_chunk", "o", "t", "c", "s1", "e1", "stop"))
    session = Window.partitionBy("stream", "session")
    whole = words.withColumns({"from": F.min_by("s1", "o").over(session), "to": F.max("e1").over(session)})
    lasting = F.col("to") - F.col("from") >= MAX_SECONDS

    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("o", kind="stable").reset_index(drop=True)
        starts, ends, first, parts = pdf["s1"].to_numpy(), pdf["e1"].to_numpy(), 0, np.zeros(len(pdf), "int32")
        while len(over := np.flatnonzero(ends[first:] - starts[first] >= MAX_SECONDS)) and first + over[0] + 1 < len(pdf):
            first += over[0] + 1
            parts[first:] += 1
        return pdf.assign(part=parts)

    long = whole.where(lasting).drop("from", "to")
    parted = long.groupBy("stream", "session").applyInPandas(part, T.StructType([*long.schema, T.StructField("part", T.IntegerType())]))
    placed = cut(whole.where(~lasting).drop("from", "to").withColumn("part", F.lit(0)).unionByName(parted))
    ids = ["stream", "session", "part"]
    heads = placed.groupBy(*ids).agg(F.min_by("s1", "o").alias("start"), F.max_by("e1", "o").alias("end"), F.avg("c").alias("confidence"), F.count("*").cast("int").alias("n_words"), F.min("o").alias("first_ord"), F.max("o").alias("last_ord"))
    # a sentence's last word, or one with which the time is up, lets no spacing in
    closed = F.col("stop") | (F.col("e1") - F.col("start") >= MAX_SECONDS)
    said = placed.join(heads.select(*ids, "start"), ids).select("stream", "_chunk", "o", "t", F.struct("session", "part", closed.alias("closed")).alias("at"))
    spacing = rows.where("not w").select("stream", "_chunk", "o", "t", F.lit(None).cast(said.schema["at"].dataType).alias("at"))
    both = carried(said.withColumn("word", F.lit(0)).unionByName(spacing.withColumn("word", F.lit(1))), "stream", "_chunk", ["o", "word"], F.col("at"), "of")
    kept = both.where("of is not null and (word = 0 or not of.closed)").select("stream", "of.session", "of.part", "o", "word", F.coalesce("t", F.lit("")).alias("t"))
    texts = kept.groupBy(*ids).agg(F.array_sort(F.collect_list(F.struct("o", "word", "t"))).alias("x"))
    texts = texts.select(*ids, F.regexp_replace(F.array_join("x.t", ""), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "").alias("text"))
    return heads.join(texts, ids).select("stream.*", "text", "start", "end", "confidence", "n_words", "first_ord", "last_ord")


def greedy_batches(df: DataFrame, key: str, order: str, size: Column, limit: int) -> DataFrame:
    """Batches in order whose sizes sum to at most ``limit``; a row beyond it is a batch of its own."""
    rows = df.withColumns({"_size": size.cast("bigint")})

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        batch, used, out = 0, 0, []
        for s in pdf["_size"]:
            if used and used + s > limit:
                batch, used = batch + 1, 0
            used += s
            out.append(batch)
        return pdf.assign(batch=out)

    return rows.groupBy(key).applyInPandas(number, f"{_ddl(rows)}, batch int").drop("_size")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def batches_of(rows: Iterator, size: int) -> Iterator[list]:
    """Lists of ``size`` rows, for writers that take them so."""
    block = []
    for row in rows:
        block.append(row)
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block
