"""Clean speaker turns out of a recognised word stream."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from praktika.llm.runs import chunk_of, local_runs, mark_ends, merge, speaker_label
from praktika.operators.chunks import neighbours
from praktika.operators.lineage import cut

#: Seconds of a chunk of a stream: some thousand words at the pace of speech.
CHUNK_SECONDS = 600.0
#: Seconds of speech that a rolling caption shows at most: so far before and after it begins are its words repeated.
CAPTION_SECONDS = 60.0
#: Pauses are calibrated between these bounds, in seconds.
PAUSE_BOUNDS = (0.4, 3.0)

# Hesitation sounds, words of sound descriptions, time marks and labels as regular expressions.
HESITATION = r"^[^\p{L}\d]*(?:[αά]{2,}|[εέ]{2,}|[εέ]+μ+|[εέ]*χμ+|χ{2,}μ+|μ{2,}|ο+υφ+|[αά]+χ{2,}|u+h+|u+h*m+|h+m+|e+r+m*|e+h+|m{2,})[^\p{L}\d]*$"
SOUND_WORDS = r"θ[οό]ρυβ|γ[εέ]λ[ιω]|χειροκρ|παλαμ|μουσικ|μελωδ|ομιλ[ιί]|[ηή]χος|μικροφ|πα[υύ]ση|σιωπ|β[ηή]χ|ακατ[αά]ληπτ|δυσδι[αά]κριτ|μιλο[υύ]ν|ταυτ[οό]χρον|κουδο[υύ]ν|χτ[υύ]π|φων[εέ]ς|ψ[ιί]θυρ|διακοπ|εκτ[οό]ς|παρεμβ|laugh|applau|music|nois|cough|inaudible|silence|pause|crosstalk"
TIME_MARK = r"^[\[<(]\s*\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d+)?\s*[\]>)]$|^\d{1,2}:\d{2}:\d{2}(?:[.,]\d+)?$"
LABEL_WORD = r"^[\[<(]?\s*(?:speaker|spk|ομιλητ[ηή]ς|ομιλήτρια)[\s_-]*\d+\s*[:>\])]+$"
SPOKEN, NOISE, OPENS, CLOSES = 0, 1, 2, 3
BRACKETS = {"[": "]", "<": ">", "*": "*", "(": ")"}


def entry_class(text: Column) -> Column:
    """SPOKEN or NOISE from the entry alone; OPENS and CLOSES where it may be half of a description in brackets."""
    t = F.lower(F.trim(text))
    first, last = F.substring(t, 1, 1), F.substring(t, -1, 1)
    marked = first.isin("[", "<", "*", "(", "♪") | last.isin("]", ">", "*", ")", ":", "♪")
    whole = (first == "[") & (last == "]") | (first == "<") & (last == ">") | (first == "*") & (last == "*") & (F.length(t) > 1)
    sound = whole | ((first == "(") & (last == ")") & t.rlike(SOUND_WORDS) & ~t.rlike(r"\d"))
    halves = F.when(first.isin(*BRACKETS) & ~last.isin(*BRACKETS.values()), OPENS).when(last.isin(*BRACKETS.values()) & ~first.isin(*BRACKETS), CLOSES).otherwise(SPOKEN)
    in_brackets = F.when(sound | t.rlike(TIME_MARK) | t.rlike(LABEL_WORD) | t.rlike(r"^\W*♪\W*$"), NOISE).otherwise(halves)
    plain = F.when((F.length(t) <= 12) & t.rlike(HESITATION), NOISE).when(first.between("0", "9") & t.rlike(TIME_MARK), NOISE).otherwise(SPOKEN)
    return F.when(t.isNull() | (t == ""), NOISE).when(marked, in_brackets).otherwise(plain).cast("tinyint")


def describes_sound(opening: Column, closing: Column) -> Column:
    """Whether two neighbouring halves are one sound description. Round brackets also hold what somebody says."""
    pair = F.create_map(*[F.lit(x) for kv in BRACKETS.items() for x in kv])
    o, c = F.lower(F.trim(opening)), F.lower(F.trim(closing))
    fits = F.element_at(pair, F.substring(o, 1, 1)) == F.substring(c, -1, 1)
    both = F.concat_ws(" ", o, c)
    return F.coalesce(fits & ((F.substring(o, 1, 1) != "(") | (both.rlike(SOUND_WORDS) & ~both.rlike(r"\d"))), F.lit(False))


def calibrated_pauses(df: DataFrame, keys: list[str], start: str, end: str, ordinal: str, quantile: float = 0.98, chunk: float = CHUNK_SECONDS) -> DataFrame:
    """Per stream the pause in seconds that ends a turn: a high quantile of its pauses between words, within PAUSE_BOUNDS.

    Neighbours are found over chunks of time. A stream without a pause has the upper bound. Out: keys, ``pause``.
    """
    low, high = PAUSE_BOUNDS
    rows = df.select(F.struct(*keys).alias("_key"), chunk_of(F.col(start), chunk, F.col(ordinal)).alias("_chunk"), F.col(start).alias("_pos"), F.col(ordinal).alias("_ord"), F.col(end).alias("_end")).distinct()
    gap = F.col("_pos") - F.col("_before._end")
    gaps = neighbours(rows, "_key", "_chunk", ["_pos", "_ord", "_end"], ["_end"]).select("_key", F.when(gap > 0, gap).alias("gap"))
    found = gaps.groupBy("_key").agg(F.percentile_approx("gap", quantile).alias("pause"))
    return found.select("_key.*", F.when(F.col("pause").isNull(), high).otherwise(F.least(F.lit(high), F.greatest(F.lit(low), "pause"))).alias("pause"))


def caption_starts(df: DataFrame, keys: list[str], ordinal: str, text: str, speaker: str, start: str, end: str, chunk: float) -> DataFrame:
    """(_key, _pos) of entries that start before the one ahead of them has ended; of the columns this needs alone."""
    order = ["_pos", "_ord", "_end", "_id"]
    rows = df.select(F.struct(*keys).alias("_key"), chunk_of(F.col(start), chunk, F.col(ordinal)).alias("_chunk"), F.col(start).alias("_pos"), F.col(ordinal).alias("_ord"), F.col(end).alias("_end"), F.xxhash64(text, speaker).alias("_id"))
    rows = rows.repartition("_key", "_chunk").dropDuplicates()
    local = Window.partitionBy("_key", "_chunk").orderBy(*order)
    seen = rows.select("_key", "_chunk", "_pos", "_end", F.lag("_end").over(local).alias("_until"), F.lead("_pos").over(local).isNull().alias("_last"))
    within = seen.where("_pos < _until").select("_key", "_pos")
    ends = seen.groupBy("_key", "_chunk").agg(F.min("_pos").alias("_pos"), F.max(F.when(F.col("_last"), F.col("_end"))).alias("_end"))
    across = ends.withColumn("_until", F.lag("_end").over(Window.partitionBy("_key").orderBy("_chunk"))).where("_pos < _until").select("_key", "_pos")
    return within.unionByName(across)


def repetitions(rows: DataFrame, starts: DataFrame, keys: list[str]) -> DataFrame:
    """The entries that repeat the caption before them, as arrays ``_gone`` per (_key, _chunk).

    A caption begins at an entry that starts before the one ahead of it has ended (``starts``). The longest suffix of
    the entries before it that is the prefix of those from it on, word for word and by the same speaker (as far as they
    have labels), is repeated; both lie within CAPTION_SECONDS of its start. Only entries near such starts are
    gathered, in groups of three spans of that length.
    """
    order = ["_pos", "_ord", "_end", "_word"]
    span = F.floor(F.col("_pos") / F.lit(CAPTION_SECONDS)).cast("bigint")
    asked = starts.select("_key", span.alias("_span")).distinct().select("_key", "_span", F.explode(F.sequence(F.col("_span") - 1, F.col("_span") + 1)).alias("_at"))
    near = rows.withColumn("_at", span).join(asked, ["_key", "_at"]).select("_key.*", "_span", "_chunk", *order, "_value")

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable", na_position="first").reset_index(drop=True)
        at, until = pdf["_pos"].tolist(), pdf["_end"].tolist()
        said = list(zip(pdf["_word"].tolist(), pdf["_value"].where(pdf["_value"].notna(), None).tolist()))
        same = lambda a, b: a[0] == b[0] and (a[1] is None or b[1] is None or a[1] == b[1])
        gone = set()
        for i in range(1, len(pdf)):
            if at[i] < until[i - 1] and at[i] // CAPTION_SECONDS == pdf["_span"].iloc[0]:
                before = sum(at[i] - t <= CAPTION_SECONDS for t in at[:i])
                after = sum(t - at[i] <= CAPTION_SECONDS for t in at[i:])
                k = next((k for k in range(min(before, after), 0, -1) if all(map(same, said[i - k : i], said[i : i + k]))), 0)
                gone.update(range(i, i + k))
        return pdf.iloc[sorted(gone)][[*keys, "_chunk", *order]]

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in near.drop("_span", "_value").schema)
    found = near.groupBy(*keys, "_span").applyInPandas(find, kinds)
    return found.groupBy(F.struct(*keys).alias("_key"), "_chunk").agg(F.collect_list(F.struct(*order)).alias("_gone"))


def speaker_turns(
    df: DataFrame, keys: list[str], ordinal: str = "ord", text: str = "text", kind: str = "word_type", speaker: str = "speaker_id", start: str = "start_sec", end: str = "end_sec", pause: float | Column | None = None, chunk: float = CHUNK_SECONDS
) -> DataFrame:
    """Turns per stream (``keys``): longest runs of spoken words of one speaker in order of start, then ``ordinal``.

    Entries of another kind than word are left out. So are hesitation sounds, sound descriptions in one or two entries,
    time marks and speaker labels, and empty texts. What a rolling caption repeats of the one before it is left out
    (``repetitions``). A word without label continues the speaker before it; at the head of a stream it has none and is
    a turn of its own. With ``pause``, seconds or a column of ``df`` that is the same all over a stream, a longer
    silence ends a turn as well.

    Exact repetitions of a row count once. Nulls in a key are a key of their own; words without start come first.
    Columns with other names are ignored; an empty table gives none.
    Out: keys, ``speaker``, ``first_ord``, ``last_ord``, ``n_words``, ``start``, ``end``.
    """
    cls = entry_class(F.col(text))
    limit = pause if isinstance(pause, Column) else F.lit(pause)
    rows = df.where(F.col(kind) == "word").select(
        F.struct(*keys).alias("_key"),
        chunk_of(F.col(start), chunk, F.col(ordinal)).alias("_chunk"),
        F.col(start).alias("_pos"),
        F.col(ordinal).alias("_ord"),
        F.col(end).alias("_end"),
        cls.alias("_cls"),
        F.when(cls >= OPENS, F.col(text)).alias("_half"),
        F.xxhash64(F.lower(F.trim(F.col(text)))).alias("_word"),
        speaker_label(F.col(speaker)).alias("_value"),
        limit.cast("double").alias("_limit"),
    )
    names, keys = keys, ["_key"]
    rows = rows.repartition("_key", "_chunk").dropDuplicates()
    starts = cut(caption_starts(df.where(F.col(kind) == "word"), names, ordinal, text, speaker, start, end, chunk))
    if not starts.isEmpty():  # without any nothing is repeated, and nothing need be looked up
        gone = repetitions(rows, starts, names)
        rows = rows.join(gone, ["_key", "_chunk"], "left").where(F.col("_gone").isNull() | ~F.array_contains("_gone", F.struct("_pos", "_ord", "_end", "_word"))).drop("_gone")
    local = Window.partitionBy(*keys, "_chunk").orderBy("_pos", "_ord", "_end", "_word")
    seen = F.struct("_cls", "_half")
    rows = rows.select(*keys, "_chunk", "_pos", "_ord", "_end", "_cls", "_half", "_word", "_limit", F.last("_value", ignorenulls=True).over(local).alias("_value"), F.lag(seen).over(local).alias("_l"), F.lead(seen).over(local).alias("_r"))
    rows = rows.withColumns({"_cls": _resolved("_l", "_r"), "_edge": F.col("_l").isNull() | F.col("_r").isNull()}).where(f"_edge or _cls != {NOISE}").drop("_l", "_r")

    # The first and the last entry of a chunk stay rows of their own: their neighbours stand in other chunks.
    before = F.lag(F.struct("_value", "_edge", "_end")).over(local)
    new = before.isNull() | F.col("_edge") | before["_edge"] | ~F.col("_value").eqNullSafe(before["_value"])
    if pause is not None:
        new = new | F.coalesce(F.col("_pos") - before["_end"] > F.col("_limit"), F.lit(False))
    rows = rows.withColumn("_new", new.cast("int")).withColumn("_run", F.sum("_new").over(local)).withColumn("_start", F.col("_pos"))
    runs = mark_ends(local_runs(rows, keys, [F.max("_edge").alias("_edge"), F.max("_cls").alias("_cls"), F.max("_half").alias("_half"), F.max("_limit").alias("_limit")]), keys)

    whole = Window.partitionBy(*keys, "_part").orderBy("_chunk", "_run")
    seen = F.struct("_chunk", F.col("_first._pos").alias("_pos"), F.col("_last._end").alias("_end"), "_cls", "_half", "_edge")
    runs = runs.withColumns({"_value": F.last("_value", ignorenulls=True).over(whole), "_l": F.lag(seen).over(whole), "_r": F.lead(seen).over(whole), "_pos": F.col("_first._pos")})
    across = {side: F.when((F.col(f"{side}._chunk") != F.col("_chunk")) & F.col(f"{side}._edge") & F.col("_edge"), F.col(side)) for side in ("_l", "_r")}
    runs = runs.withColumns(across).withColumn("_cls", F.when(F.col("_edge"), _resolved("_l", "_r")).otherwise(F.col("_cls"))).where(f"_cls != {NOISE}")
    apart = None if pause is None else F.col("_first._pos") - F.col("_before._last._end") > F.col("_limit")
    return merge(runs, keys, apart).select(
        "_key.*",
        F.col("_value").alias("speaker"),
        F.col("_first._ord").alias("first_ord"),
        F.col("_last._ord").alias("last_ord"),
        F.col("_n").alias("n_words"),
        F.col("_first._start").alias("start"),
        F.col("_last._end").alias("end"),
    )


def _resolved(left: str, right: str) -> Column:
    """The class of an entry once the entries beside it are known; a half that found no other half was spoken."""
    l, r = F.col(left), F.col(right)
    opened = (F.col("_cls") == OPENS) & (r["_cls"] == CLOSES) & describes_sound(F.col("_half"), r["_half"])
    closed = (F.col("_cls") == CLOSES) & (l["_cls"] == OPENS) & describes_sound(l["_half"], F.col("_half"))
    return F.when(F.coalesce(opened, F.lit(False)) | F.coalesce(closed, F.lit(False)), F.lit(NOISE)).otherwise(F.col("_cls")).cast("tinyint")
