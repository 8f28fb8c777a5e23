"""Queries on intervals, attendance, word streams and runs of one meeting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from praktika.functions.numbers import round_half_up
from praktika.functions.text import clean_refs
from praktika.operators import aggregates as A
from praktika.operators import diff as D
from praktika.operators import sequence as S
from praktika.operators import timelines as T
from praktika.operators.chunks import position_chunk, prefix_sum
from praktika.plans.counts import STATUSES_SQL, statuses
from praktika.plans.names import _CITY, city
from praktika.registry import Registry
from praktika.sources.tables import table

registry = Registry()

_SEG = "(SELECT DISTINCT ord, meeting_id, speaker_id, start_time AS a, end_time AS b FROM display_segments WHERE end_time > start_time)"
_SIL = "(SELECT DISTINCT ord, meeting_id, start_sec AS s, end_sec AS e FROM silent_segments WHERE end_sec > start_sec)"
_UTT = f"(SELECT meeting_id, utterance_id, min(ord) AS ord, min(start_timestamp) AS s, max(end_timestamp) AS e FROM {STATUSES_SQL} GROUP BY 1, 2)"


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "display_segments").where("end_time > start_time")
    return rows.select("ord", "meeting_id", F.col("speaker_id").alias("speaker"), F.col("start_time").alias("a"), F.col("end_time").alias("b")).distinct()


def silent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "silent_segments").where("end_sec > start_sec").select("ord", "meeting_id", F.col("start_sec").alias("s"), F.col("end_sec").alias("e")).distinct()


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statuses(spark, sf_dir).groupBy("meeting_id", "utterance_id").agg(F.min("ord").alias("ord"), F.min("start_timestamp").alias("s"), F.max("end_timestamp").alias("e"))


@registry.query("q_interval_overlap", f"SELECT u.utterance_id, g.ord AS segment_ord, g.speaker_id FROM {_UTT} u JOIN {_SEG} g ON u.meeting_id = g.meeting_id AND g.a <= u.e AND g.b >= u.s")
def interval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = T.overlap_join(utterances(spark, sf_dir).drop("ord"), segments(spark, sf_dir), "meeting_id", ("s", "e"), ("a", "b"))
    return pairs.select("utterance_id", F.col("ord").alias("segment_ord"), F.col("speaker").alias("speaker_id"))


@registry.query("q_contained", f"SELECT x.ord AS silent_ord, g.ord AS segment_ord FROM {_SIL} x JOIN {_SEG} g ON x.meeting_id = g.meeting_id AND g.a <= x.s AND g.b >= x.e")
def contained(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = silent(spark, sf_dir).withColumnRenamed("ord", "silent_ord")
    return T.contained_join(left, segments(spark, sf_dir), "meeting_id", ("s", "e"), ("a", "b")).select("silent_ord", F.col("ord").alias("segment_ord"))


_NEAR = f"""
    WITH g AS (SELECT *, row_number() OVER (PARTITION BY meeting_id, speaker_id ORDER BY ord) - 1 AS i FROM {_SEG}),
    p AS (SELECT u.meeting_id, u.utterance_id, u.s, u.e, g.speaker_id, g.a, g.b, g.i, g.ord, abs(g.a - u.s) + abs(g.b - u.e) AS far, CASE WHEN g.a <= u.s AND g.b >= u.e AND g.i >= 1 THEN g.i END AS k FROM {_UTT} u JOIN g USING (meeting_id) WHERE (u.utterance_id, g.speaker_id) IN (SELECT (v.utterance_id, h.speaker_id) FROM {_UTT} v JOIN {_SEG} h ON v.meeting_id = h.meeting_id AND h.a <= v.e AND h.b >= v.s)),
    c AS (SELECT *, coalesce(max(k) OVER (PARTITION BY utterance_id, meeting_id, speaker_id), 0) AS since FROM p),
    n AS (SELECT meeting_id, utterance_id, speaker_id, arg_min((s, e, a, b), (far, i)) AS m FROM c WHERE i >= since GROUP BY ALL)"""


@registry.query("q_nearest_segment", _NEAR + " SELECT utterance_id, speaker_id, m[3] AS a, m[4] AS b FROM n".replace("m[3]", "struct_extract_at(m, 3)").replace("m[4]", "struct_extract_at(m, 4)"))
def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = T.nearest_segment(utterances(spark, sf_dir).drop("ord"), segments(spark, sf_dir), "meeting_id", "utterance_id", ("s", "e"), ("a", "b"), "ord")
    return found.select("utterance_id", F.col("speaker").alias("speaker_id"), "a", "b")


@registry.query(
    "q_diarize",
    _NEAR
    + """, f AS (SELECT utterance_id, speaker_id, struct_extract_at(m, 1) AS s, struct_extract_at(m, 2) AS e, struct_extract_at(m, 3) AS a, struct_extract_at(m, 4) AS b FROM n),
    d AS (SELECT utterance_id, speaker_id, CASE WHEN a <= s AND b >= e THEN 0 ELSE round(sqrt((a - s) * (a - s) + (b - e) * (b - e)), 6) END AS drift FROM f)
    SELECT utterance_id, arg_min(speaker_id, (drift, speaker_id)) AS speaker_id, min(drift) AS drift, count(*) AS n_candidates FROM d GROUP BY 1""",
)
def diarize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The speaker whose nearest segment drifts least from each utterance; a segment that holds it drifts nothing."""
    found = T.nearest_segment(utterances(spark, sf_dir).drop("ord"), segments(spark, sf_dir), "meeting_id", "utterance_id", ("s", "e"), ("a", "b"), "ord")
    apart = F.sqrt((F.col("a") - F.col("s")) * (F.col("a") - F.col("s")) + (F.col("b") - F.col("e")) * (F.col("b") - F.col("e")))
    drift = F.when((F.col("a") <= F.col("s")) & (F.col("b") >= F.col("e")), 0.0).otherwise(F.round(apart, 6))
    scored = found.select("utterance_id", "speaker", drift.alias("drift"))
    return scored.groupBy("utterance_id").agg(F.min_by("speaker", F.struct("drift", "speaker")).alias("speaker_id"), F.min("drift").alias("drift"), F.count("*").alias("n_candidates"))


@registry.query("q_bridge_gaps", f"SELECT utterance_id, round(CASE WHEN n - e > 0 AND n - e <= 2 THEN e + (n - e) ELSE e END, 6) AS bridged_end FROM (SELECT *, lead(s) OVER (PARTITION BY meeting_id ORDER BY ord, utterance_id) AS n FROM {_UTT})")
def bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.bridge_gaps(utterances(spark, sf_dir), "meeting_id", ["ord", "utterance_id"], "s", "e").select("utterance_id", F.round("bridged_end", 6).alias("bridged_end"))


@registry.query(
    "q_merge_intervals",
    f"""
    WITH f AS (SELECT *, CASE WHEN abs(lag(b) OVER w - a) >= 0.5 OR lag(b) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM {_SEG} WINDOW w AS (PARTITION BY meeting_id ORDER BY ord)),
    r AS (SELECT *, sum(new) OVER (PARTITION BY meeting_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS run FROM f)
    SELECT meeting_id, run::BIGINT AS run, arg_min(a, ord) AS "start", arg_max(b, ord) AS "end", count(*) AS n FROM r GROUP BY 1, 2
    """,
)
def merge_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.merge_touching(segments(spark, sf_dir), "meeting_id", ["ord"], "a", "b", 0.5)


@registry.query("q_cum_timeline", f"SELECT ord, round(coalesce(sum(b - a) OVER (PARTITION BY meeting_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 3) AS normalized_start FROM {_SEG}")
def cum_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.on_one_line(segments(spark, sf_dir), "meeting_id", ["ord"], "a", "b").select("ord", F.round("normalized_start", 3).alias("normalized_start"))


@registry.query("q_speaker_changes", f"SELECT ord, speaker_id FROM (SELECT *, lag(speaker_id) OVER w AS p, row_number() OVER w AS n FROM {_SEG} WINDOW w AS (PARTITION BY meeting_id ORDER BY ord)) WHERE n = 1 OR p IS DISTINCT FROM speaker_id")
def speaker_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.changes_of(segments(spark, sf_dir), "meeting_id", ["ord"], "speaker").select("ord", F.col("speaker").alias("speaker_id"))


@registry.query(
    "q_silences",
    f"""
    WITH bounds AS (SELECT meeting_id, min(a) AS low, max(b) AS high FROM {_SEG} GROUP BY 1), i AS (SELECT g.* FROM {_SEG} g JOIN bounds USING (meeting_id) WHERE a >= low AND b <= high),
    t AS (SELECT i.meeting_id, coalesce(lag(b) OVER (PARTITION BY i.meeting_id ORDER BY a, ord), low) AS f, a AS t FROM i JOIN bounds USING (meeting_id)
      UNION ALL SELECT meeting_id, coalesce(x, low), high FROM bounds LEFT JOIN (SELECT meeting_id, arg_max(b, (a, ord)) AS x FROM i GROUP BY 1) USING (meeting_id))
    SELECT meeting_id, round(f, 3) AS "from", round(t, 3) AS "to" FROM t WHERE t - f >= 0.5
    """,
)
def silences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = segments(spark, sf_dir)
    bounds = rows.groupBy("meeting_id").agg(F.min("a").alias("low"), F.max("b").alias("high"))
    return T.silences(rows, "meeting_id", ["a", "ord"], "a", "b", bounds, "low", "high").select("meeting_id", F.round("from", 3).alias("from"), F.round("to", 3).alias("to"))


@registry.query("q_split_points")
def split_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.split_at_silences(segments(spark, sf_dir), "meeting_id", "a", "b", 300.0)


_EVENTS = "(SELECT DISTINCT meeting_id, c.name AS name, c.change_type AS change_type, c.agenda_item_index AS position, c.timing AS timing, ord FROM (SELECT meeting_id, ord, unnest(attendance_changes) AS c FROM raw_extractions))"


@registry.query(
    "q_asof_attendance",
    f"""
    WITH o AS (SELECT meeting_id, min(ord) AS ord FROM raw_extractions GROUP BY 1),
    r AS (SELECT DISTINCT r.meeting_id, present_members, absent_members FROM raw_extractions r JOIN o ON o.meeting_id = r.meeting_id AND o.ord = r.ord),
    p AS (SELECT meeting_id, name, bool_and(present) AS present FROM (SELECT meeting_id, unnest(present_members) AS name, true AS present FROM r UNION ALL SELECT meeting_id, unnest(absent_members), false FROM r) WHERE name IS NOT NULL GROUP BY 1, 2),
    e AS (SELECT meeting_id, name, change_type, ord, CASE WHEN position IS NULL THEN CASE WHEN change_type = 'arrival' THEN -1 END WHEN timing = 'during' THEN position WHEN timing = 'after' THEN position + 1 END AS eff, CASE WHEN timing = 'during' THEN 1 ELSE 0 END AS phase FROM {_EVENTS} WHERE name IS NOT NULL),
    x AS (SELECT DISTINCT meeting_id, agenda_item_index AS position FROM match_subjects WHERE agenda_item_index IS NOT NULL),
    n AS (SELECT meeting_id, name FROM p UNION SELECT meeting_id, name FROM e WHERE eff IS NOT NULL),
    q AS (SELECT n.meeting_id, n.name, x.position, arg_max(e.change_type, (e.eff, e.phase, e.ord)) AS last_type FROM n JOIN x USING (meeting_id) LEFT JOIN e ON e.meeting_id = n.meeting_id AND e.name = n.name AND e.eff <= x.position GROUP BY 1, 2, 3)
    SELECT q.meeting_id, q.name, q.position, CASE WHEN q.last_type IS NOT NULL THEN q.last_type = 'arrival' ELSE coalesce(p.present, false) END AS present FROM q LEFT JOIN p USING (meeting_id, name)
    """,
)
def asof_attendance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attendance at every agenda item, from the roll call of a meeting's first document and all reported changes."""
    raw = table(spark, sf_dir, "raw_extractions")
    first = raw.groupBy("meeting_id").agg(F.min_by(F.struct("present_members", "absent_members"), "ord").alias("r"))
    named = first.select("meeting_id", F.explode(F.coalesce("r.present_members", F.array().cast("array<string>"))).alias("name"), F.lit(True).alias("present")).unionByName(
        first.select("meeting_id", F.explode(F.coalesce("r.absent_members", F.array().cast("array<string>"))).alias("name"), F.lit(False).alias("present"))
    )
    people = named.where("name is not null").groupBy("meeting_id", "name").agg(F.bool_and("present").alias("present"))
    events = raw.select("meeting_id", "ord", F.explode("attendance_changes").alias("c")).select("meeting_id", "c.name", "c.change_type", F.col("c.agenda_item_index").alias("position"), "c.timing", "ord").where("name is not null").distinct()
    positions = table(spark, sf_dir, "match_subjects").where("agenda_item_index is not null").select("meeting_id", F.col("agenda_item_index").alias("position")).distinct()
    return T.attendance_at(people, events, positions)


_WORDS = "(SELECT DISTINCT meeting_id, segment_index, ord, text, start_sec, end_sec FROM asr_words WHERE word_type = 'word')"
_ENDS = r"(regexp_matches(text, '[!?;\x{037E}]$') OR (text LIKE '%.' AND NOT (length(text) <= 3 OR lower(text[:-2]) IN ('δηλ', 'βλ', 'σελ', 'αριθ', 'κεφ', 'λεωφ', 'τηλ') OR regexp_full_match(text[:-2], '(\p{L}\.)+\p{L}{0,3}'))))"


@registry.query(
    "q_pause_sessions",
    f"""
    WITH f AS (SELECT *, CASE WHEN lag(end_sec) OVER w IS NULL OR start_sec - lag(end_sec) OVER w > 1 OR coalesce(lag({_ENDS}) OVER w, false) THEN 1 ELSE 0 END AS new FROM {_WORDS} WINDOW w AS (PARTITION BY meeting_id, segment_index ORDER BY ord)),
    r AS (SELECT *, sum(new) OVER (PARTITION BY meeting_id, segment_index ORDER BY ord ROWS UNBOUNDED PRECEDING)::BIGINT AS session FROM f)
    SELECT meeting_id, segment_index, session, min(ord) AS first_ord, max(ord) AS last_ord, count(*) AS n_words, min(start_sec) AS "start", max(end_sec) AS "end" FROM r GROUP BY 1, 2, 3
    """,
)
def pause_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "asr_words").where("word_type = 'word'").select("meeting_id", "segment_index", "ord", "text", "start_sec", "end_sec").distinct()
    return S.pause_sessions(words, ["meeting_id", "segment_index"], "ord", "start_sec", "end_sec", "text")


@registry.query(
    "q_words_to_utterances",
    rf"""
    WITH RECURSIVE x AS (SELECT DISTINCT meeting_id, segment_index, ord::BIGINT AS o, text AS t, word_type = 'word' AS w, start_sec AS s, end_sec AS e, coalesce(least(1, exp(logprob)), 1) AS c, coalesce({_ENDS}, false) AS stop FROM asr_words WHERE word_type IN ('word', 'spacing')),
    a AS (SELECT *, coalesce(last_value(coalesce(e, s) IGNORE NULLS) OVER (PARTITION BY meeting_id, segment_index ORDER BY o ROWS UNBOUNDED PRECEDING), 0) AS e1 FROM x WHERE w),
    b AS (SELECT *, coalesce(s, lag(e1) OVER k, 0) AS s1, (row_number() OVER k = 1 OR coalesce(s, lag(e1) OVER k, 0) - lag(e1) OVER k > 1 OR lag(stop) OVER k)::INT AS new FROM a WINDOW k AS (PARTITION BY meeting_id, segment_index ORDER BY o)),
    n AS (SELECT *, sum(new) OVER (PARTITION BY meeting_id, segment_index ORDER BY o ROWS UNBOUNDED PRECEDING) AS session FROM b),
    r AS (SELECT *, row_number() OVER (PARTITION BY meeting_id, segment_index, session ORDER BY o) AS rn FROM n),
    j AS (SELECT p.meeting_id, p.segment_index, p.session, p.rn, min(q.rn) + 1 AS nx FROM r p JOIN r q ON p.meeting_id = q.meeting_id AND p.segment_index = q.segment_index AND p.session = q.session AND q.rn >= p.rn AND q.e1 - p.s1 >= 30 GROUP BY ALL),
    h AS (SELECT meeting_id, segment_index, session, rn, 0 AS part, s1 AS first_s FROM r WHERE rn = 1
      UNION ALL SELECT r.meeting_id, r.segment_index, r.session, r.rn, h.part + 1, r.s1 FROM h JOIN j USING (meeting_id, segment_index, session, rn) JOIN r ON r.meeting_id = h.meeting_id AND r.segment_index = h.segment_index AND r.session = h.session AND r.rn = j.nx),
    y AS (SELECT r.*, last_value(h.part IGNORE NULLS) OVER k AS part, last_value(h.first_s IGNORE NULLS) OVER k AS first_s FROM r LEFT JOIN h USING (meeting_id, segment_index, session, rn) WINDOW k AS (PARTITION BY r.meeting_id, r.segment_index, r.session ORDER BY r.rn ROWS UNBOUNDED PRECEDING)),
    u AS (SELECT meeting_id, segment_index, o, 0 AS k, t, {{'session': session, 'part': part, 'closed': stop OR e1 - first_s >= 30}} AS pl FROM y UNION ALL SELECT meeting_id, segment_index, o, 1, t, NULL FROM x WHERE NOT w),
    v AS (SELECT *, last_value(pl IGNORE NULLS) OVER (PARTITION BY meeting_id, segment_index ORDER BY o, k ROWS UNBOUNDED PRECEDING) AS f FROM u),
    z AS (SELECT meeting_id, segment_index, f.session AS session, f.part AS part, string_agg(coalesce(t, ''), '' ORDER BY o, k, t) AS text FROM v WHERE f IS NOT NULL AND (k = 0 OR NOT f.closed) GROUP BY ALL),
    g AS (SELECT meeting_id, segment_index, session, part, arg_min(s1, o) AS "start", arg_max(e1, o) AS "end", round(avg(c), 6) AS confidence, count(*)::INT AS n_words, min(o) AS first_ord, max(o) AS last_ord FROM y GROUP BY 1, 2, 3, 4)
    SELECT meeting_id, segment_index, regexp_replace(text, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g') AS text, "start", "end", confidence, n_words, first_ord, last_ord FROM g JOIN z USING (meeting_id, segment_index, session, part)
    """,
)
def words_to_utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = S.words_to_utterances(table(spark, sf_dir, "asr_words"), ["meeting_id", "segment_index"])
    return words.withColumn("confidence", F.round("confidence", 6))


@registry.query("q_chronological_index", f"SELECT utterance_id, row_number() OVER (PARTITION BY meeting_id ORDER BY ord, utterance_id)::INT - 1 AS idx FROM {_UTT}")
def chronological_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = utterances(spark, sf_dir).withColumns({"_chunk": position_chunk("ord"), "_one": F.lit(1)})
    return prefix_sum(rows, "meeting_id", "_chunk", [F.col("ord"), F.col("utterance_id")], "_one", "_n").select("utterance_id", (F.col("_n") - 1).cast("int").alias("idx"))


@registry.query("q_first_appearance", f"SELECT meeting_id, speaker_id, row_number() OVER (PARTITION BY meeting_id ORDER BY first, speaker_id)::INT - 1 AS position FROM (SELECT meeting_id, speaker_id, min(ord) AS first FROM {_SEG} GROUP BY 1, 2)")
def first_appearance(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = segments(spark, sf_dir).groupBy("meeting_id", F.col("speaker").alias("speaker_id")).agg(F.min("ord").alias("first"))
    return first.select("meeting_id", "speaker_id", (F.row_number().over(Window.partitionBy("meeting_id").orderBy("first", "speaker_id")) - 1).alias("position"))


@registry.query(
    "q_even_sample",
    f"""
    WITH r AS (SELECT meeting_id, utterance_id, row_number() OVER w - 1 AS rn, count(*) OVER (PARTITION BY meeting_id) AS n FROM {_UTT} WINDOW w AS (PARTITION BY meeting_id ORDER BY ord, utterance_id))
    SELECT meeting_id, utterance_id FROM r WHERE n <= 10 OR rn IN (SELECT CAST(floor(i * (r.n - 1) / 9.0 + 0.5) AS BIGINT) FROM range(10) t(i))
    """,
)
def even_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = utterances(spark, sf_dir).withColumn("o", F.struct("ord", "utterance_id"))
    return S.even_sample(rows, "meeting_id", "o", 10).select("meeting_id", "utterance_id")


_LATEST = f"""
    WITH c AS (SELECT meeting_id, min({_CITY.format('city_name')}) AS grp, min(meeting_date) AS day FROM match_subjects GROUP BY 1),
    m AS (SELECT meeting_id, grp, row_number() OVER (PARTITION BY grp ORDER BY day DESC, meeting_id DESC) AS r FROM c),
    s AS (SELECT DISTINCT subject_id, meeting_id, ord, name, agenda_item_index, non_agenda_reason FROM match_subjects),
    a AS (SELECT s.*, grp FROM s JOIN m USING (meeting_id) WHERE r = 2), b AS (SELECT s.*, grp FROM s JOIN m USING (meeting_id) WHERE r = 1)"""


def ranked_meetings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last two meetings of each city, the latest first."""
    rows = table(spark, sf_dir, "match_subjects").groupBy("meeting_id").agg(F.min(city("city_name")).alias("grp"), F.min("meeting_date").alias("day"))
    return A.top_per_group(rows, "grp", [F.desc("day"), F.desc("meeting_id")], 2).select("grp", "meeting_id", F.col("rank").alias("r"))


def latest_two(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The subjects of the last meeting but one and of the last of each city: two runs to compare."""
    rows = table(spark, sf_dir, "match_subjects").select("subject_id", "meeting_id", "ord", "name", "agenda_item_index", "non_agenda_reason").distinct()
    chosen = rows.join(ranked_meetings(spark, sf_dir), "meeting_id")
    return chosen.where("r = 2").drop("r"), chosen.where("r = 1").drop("r")


@registry.query("q_trace_latest_two", _LATEST + " SELECT grp, meeting_id, r::INT AS r FROM m WHERE r <= 2")
def trace_latest_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_meetings(spark, sf_dir)


_ALIGNED = _LATEST + """, la AS (SELECT grp, agenda_item_index, arg_max(name, ord) AS a_name, arg_max(coalesce(non_agenda_reason, ''), ord) AS a_reason FROM a WHERE agenda_item_index IS NOT NULL GROUP BY 1, 2),
    lb AS (SELECT grp, agenda_item_index, arg_max(name, ord) AS b_name, arg_max(coalesce(non_agenda_reason, ''), ord) AS b_reason FROM b WHERE agenda_item_index IS NOT NULL GROUP BY 1, 2)"""


@registry.query("q_run_diff_full_outer", _ALIGNED + " SELECT grp, agenda_item_index, a_name, b_name, CASE WHEN a_name IS NOT NULL AND b_name IS NOT NULL THEN 'both' WHEN a_name IS NOT NULL THEN 'a' ELSE 'b' END AS side FROM la FULL OUTER JOIN lb USING (grp, agenda_item_index)")
def run_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = latest_two(spark, sf_dir)
    return D.align_by_index(a, b, "grp", "agenda_item_index", "ord").select("grp", "agenda_item_index", "a_name", "b_name", "side")


@registry.query(
    "q_run_verdict",
    _ALIGNED
    + """, v AS (SELECT grp, CASE WHEN a_name = b_name AND a_reason = b_reason THEN 'identical' WHEN a_reason <> b_reason OR abs(length(b_name) - length(a_name)) / greatest(length(a_name), 1) > 0.3 THEN 'structural' ELSE 'cosmetic' END AS verdict FROM la JOIN lb USING (grp, agenda_item_index))
    SELECT grp, verdict, count(*) AS n FROM v GROUP BY 1, 2""",
)
def run_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = latest_two(spark, sf_dir)
    both = D.align_by_index(a, b, "grp", "agenda_item_index", "ord").where("side = 'both'")
    x, y = clean_refs(F.col("a_name")), clean_refs(F.col("b_name"))
    reason = F.coalesce("a_non_agenda_reason", F.lit("")) != F.coalesce("b_non_agenda_reason", F.lit(""))
    verdict, _ = D.verdict([("name", x != y, D.share_changed(F.length(x), F.length(y), D.DESCRIPTION_SHARE)), ("reason", reason, reason)])
    return both.select("grp", verdict.alias("verdict")).groupBy("grp", "verdict").agg(F.count("*").alias("n"))


@registry.query("q_fuzzy_leftover")
def fuzzy_leftover(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = latest_two(spark, sf_dir)
    pairs = D.align_by_index(a, b, "grp", "agenda_item_index", "ord").where("side = 'both'")
    left_a = a.join(pairs.select(F.col("a_subject_id").alias("subject_id")), "subject_id", "left_anti")
    left_b = b.join(pairs.select(F.col("b_subject_id").alias("subject_id")), "subject_id", "left_anti")
    return D.match_leftovers(left_a, left_b, "grp", "name", "ord", "subject_id")


@registry.query("q_live_transitions", "SELECT event_id, event_type FROM (SELECT *, lag(event_type) OVER w AS p, row_number() OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE n = 1 OR p IS DISTINCT FROM event_type")
def live_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("day", F.unix_date(F.to_date("ts")) * 4096)  # a chunk a day
    return T.changes_of(rows, "user_id", ["day", "ts", "event_id"], "event_type").select("event_id", "event_type")


def _throttled(keys: str, rows: str, out: str) -> str:
    """SQL of a throttle of ten seconds; ``rows`` have ``keys``, id and t in microseconds."""
    same = " AND ".join(f"a.{k} = b.{k}" for k in keys.split(", "))
    return f"""
    WITH RECURSIVE e AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY t, id) AS rn FROM {rows}),
    n AS (SELECT {', '.join(f'a.{k}' for k in keys.split(', '))}, a.rn, min(b.rn) AS nx FROM e a JOIN e b ON {same} AND b.t >= a.t + 10000000 GROUP BY ALL),
    r AS (SELECT {keys}, rn FROM e WHERE rn = 1 UNION ALL SELECT {keys}, nx FROM r JOIN n USING ({keys}, rn))
    SELECT {out} FROM r JOIN e USING ({keys}, rn)"""


@registry.query("q_throttle", _throttled("user_id, event_type", "(SELECT user_id, event_type, event_id AS id, epoch_us(ts) AS t FROM events WHERE ts IS NOT NULL)", "user_id, event_type, id AS event_id"))
def throttle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At most one event of a user and kind in ten seconds, counted from the last one let through."""
    return S.paced(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", "event_id", 10.0).select("user_id", "event_type", "event_id")


@registry.query("q_throttle_status", _throttled("meeting_id, status", f"(SELECT meeting_id, status, ord AS id, CAST(round(start_timestamp * 1000000) AS BIGINT) AS t FROM {STATUSES_SQL} WHERE start_timestamp IS NOT NULL)", "meeting_id, status, id AS ord"))
def throttle_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over utterance states, which follow each other within seconds."""
    return S.paced(statuses(spark, sf_dir), ["meeting_id", "status"], "start_timestamp", "ord", 10.0).select("meeting_id", "status", "ord")


@registry.query("q_latest_state", "SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, count(*) AS n FROM events GROUP BY 1")
def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("event_type"), F.count("*").alias("n"))


@registry.query("q_rounded_names", f"SELECT ord, 'speech_' || CAST(floor(a + 0.5) AS BIGINT) || '-' || CAST(floor(b + 0.5) AS BIGINT) || '.mp3' AS object_key FROM {_SEG}")
def object_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda c: round_half_up(F.col(c)).cast("string")
    return segments(spark, sf_dir).select("ord", F.concat(F.lit("speech_"), at("a"), F.lit("-"), at("b"), F.lit(".mp3")).alias("object_key"))
