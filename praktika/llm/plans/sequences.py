"""Queries on word streams and utterance states: clean turns and collapsed runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from praktika.llm.runs import collapse_runs, speaker_label
from praktika.llm.turns import CHUNK_SECONDS, HESITATION, LABEL_WORD, SOUND_WORDS, TIME_MARK, calibrated_pauses, speaker_turns
from praktika.registry import Registry
from praktika.sources.tables import table

registry = Registry()

#: Positions of a chunk of a meeting's utterances.
CHUNK_POSITIONS = 4096


def _millis(seconds: Column) -> Column:
    return F.floor(seconds * 1000 + F.lit(0.5)).cast("bigint")


def state(status: Column, subject: Column) -> Column:
    """Status and subject in one spelling; a blank subject is none."""
    s = F.upper(F.regexp_replace(F.trim(status), r"[\s_-]+", "_"))
    of = F.regexp_replace(F.lower(F.trim(subject)), r"^subject:\s*", "")
    return F.concat(F.coalesce(s, F.lit("")), F.lit("\t"), F.coalesce(of, F.lit("")))


_LABEL = r"""
  CASE WHEN regexp_extract(lower(trim(speaker_id)), '^[^\p{L}\d]*(?:speaker|spk|s|ομιλητ[ηή]ς|ομιλήτρια)?[\s_.:#-]*0*(\d+)[^\p{L}\d]*$', 1) <> ''
       THEN 'speaker_' || regexp_extract(lower(trim(speaker_id)), '^[^\p{L}\d]*(?:speaker|spk|s|ομιλητ[ηή]ς|ομιλήτρια)?[\s_.:#-]*0*(\d+)[^\p{L}\d]*$', 1)
       ELSE nullif(trim(regexp_replace(lower(trim(speaker_id)), '[\s_.:#-]+', ' ', 'g')), '') END"""

P7_SQL = rf"""
WITH w AS (
  SELECT DISTINCT meeting_id, segment_index, ord, start_sec, end_sec, {_LABEL} AS label FROM asr_words WHERE word_type = 'word'
), filled AS (
  SELECT *, last_value(label IGNORE NULLS) OVER (PARTITION BY meeting_id, segment_index ORDER BY start_sec NULLS FIRST, ord ROWS UNBOUNDED PRECEDING) AS v FROM w
), u AS (
  SELECT DISTINCT meeting_id, ord, start_timestamp, end_timestamp,
    upper(regexp_replace(trim(status), '[\s_-]+', '_', 'g')) || chr(9) || coalesce(regexp_replace(lower(trim(subject_id)), '^subject:\s*', ''), '') AS v FROM utt_status
), e AS (
  SELECT 'speaker' AS seq_kind, meeting_id, CAST(segment_index AS BIGINT) AS segment_index, CAST(ord AS BIGINT) AS ord, start_sec AS pos, start_sec AS s, end_sec AS t, v FROM filled
  UNION ALL
  SELECT 'status', meeting_id, -1, ord, ord, start_timestamp, end_timestamp, v FROM u
), flagged AS (
  SELECT *, CASE WHEN v IS DISTINCT FROM lag(v) OVER k OR row_number() OVER k = 1 THEN 1 ELSE 0 END AS new FROM e
  WINDOW k AS (PARTITION BY seq_kind, meeting_id, segment_index ORDER BY pos NULLS FIRST, ord)
), numbered AS (
  SELECT *, sum(new) OVER (PARTITION BY seq_kind, meeting_id, segment_index ORDER BY pos NULLS FIRST, ord ROWS UNBOUNDED PRECEDING) AS run,
    row_number() OVER (PARTITION BY seq_kind, meeting_id, segment_index ORDER BY pos NULLS FIRST, ord) AS rn FROM flagged
)
SELECT seq_kind, meeting_id, segment_index, arg_min(ord, rn) AS first_ord, arg_max(ord, rn) AS last_ord, count(*) AS n_events,
  CAST(floor(arg_max(t, rn) * 1000 + 0.5) AS BIGINT) - CAST(floor(arg_min(s, rn) * 1000 + 0.5) AS BIGINT) AS duration_ms
FROM numbered GROUP BY seq_kind, meeting_id, segment_index, run HAVING count(*) >= 2
"""


P5_SQL = rf"""
WITH w AS (
  SELECT DISTINCT meeting_id, segment_index, ord, start_sec, end_sec, lower(trim(text)) AS t, {_LABEL} AS label FROM asr_words WHERE word_type = 'word'
), filled AS (
  SELECT *, last_value(label IGNORE NULLS) OVER k AS v, lag(t) OVER k AS p, lead(t) OVER k AS n, lag(end_sec) OVER k AS p_end,
    left(t, 1) AS a, right(t, 1) AS z
  FROM w WINDOW k AS (PARTITION BY meeting_id, segment_index ORDER BY start_sec NULLS FIRST, ord)
), classed AS (
  SELECT *, coalesce(t, '') = '' OR coalesce(false
    OR (length(t) <= 12 AND regexp_matches(t, '{HESITATION}'))
    OR regexp_matches(t, '{TIME_MARK}') OR regexp_matches(t, '{LABEL_WORD}') OR regexp_full_match(t, '[^\p{{L}}\d]*♪[^\p{{L}}\d]*')
    OR (a = '[' AND z = ']') OR (a = '<' AND z = '>') OR (a = '*' AND z = '*' AND length(t) > 1)
    OR (a = '(' AND z = ')' AND regexp_matches(t, '{SOUND_WORDS}') AND NOT regexp_matches(t, '\d'))
    OR (a IN ('[', '<', '*', '(') AND z NOT IN (']', '>', '*', ')') AND right(n, 1) = CASE a WHEN '[' THEN ']' WHEN '<' THEN '>' WHEN '(' THEN ')' ELSE '*' END AND left(n, 1) NOT IN ('[', '<', '*', '(')
        AND (a <> '(' OR (regexp_matches(t || ' ' || n, '{SOUND_WORDS}') AND NOT regexp_matches(t || ' ' || n, '\d'))))
    OR (z IN (']', '>', '*', ')') AND a NOT IN ('[', '<', '*', '(') AND right(p, 1) NOT IN (']', '>', '*', ')') AND z = CASE left(p, 1) WHEN '[' THEN ']' WHEN '<' THEN '>' WHEN '(' THEN ')' WHEN '*' THEN '*' END
        AND (left(p, 1) <> '(' OR (regexp_matches(p || ' ' || t, '{SOUND_WORDS}') AND NOT regexp_matches(p || ' ' || t, '\d'))))
    OR coalesce(start_sec < p_end AND t = p, false), false) AS noise
  FROM filled
), flagged AS (
  SELECT *, CASE WHEN v IS DISTINCT FROM lag(v) OVER k OR row_number() OVER k = 1 THEN 1 ELSE 0 END AS new FROM classed WHERE NOT noise
  WINDOW k AS (PARTITION BY meeting_id, segment_index ORDER BY start_sec NULLS FIRST, ord)
), numbered AS (
  SELECT *, sum(new) OVER k AS run, row_number() OVER k AS rn FROM flagged WINDOW k AS (PARTITION BY meeting_id, segment_index ORDER BY start_sec NULLS FIRST, ord)
)
SELECT meeting_id, segment_index, arg_min(ord, rn) AS first_ord, arg_max(ord, rn) AS last_ord, CAST(count(*) AS INT) AS n_words FROM numbered GROUP BY meeting_id, segment_index, run
"""


@registry.query("p5_found", P5_SQL)
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = speaker_turns(table(spark, sf_dir, "asr_words"), ["meeting_id", "segment_index"])
    return turns.select("meeting_id", "segment_index", "first_ord", "last_ord", F.col("n_words").cast("int").alias("n_words"))


@registry.query("p5_pauses")
def p5_pauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns that also end at pauses, calibrated for each recording."""
    words = table(spark, sf_dir, "asr_words").where("word_type = 'word'")
    keys = ["meeting_id", "segment_index"]
    pauses = calibrated_pauses(words, keys, "start_sec", "end_sec", "ord")
    turns = speaker_turns(words.join(pauses, keys), keys, pause=F.col("pause"))
    return turns.select("meeting_id", "segment_index", "first_ord", "last_ord", F.col("n_words").cast("int").alias("n_words"))


@registry.query("p7_found", P7_SQL)
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "asr_words").where("word_type = 'word'")
    speaker = collapse_runs(words, ["meeting_id", "segment_index"], "start_sec", speaker_label(F.col("speaker_id")), "start_sec", "end_sec", CHUNK_SECONDS, carry=True, ordinal="ord", min_events=2)
    states = table(spark, sf_dir, "utt_status")
    status = collapse_runs(states, ["meeting_id"], "ord", state(F.col("status"), F.col("subject_id")), "start_timestamp", "end_timestamp", CHUNK_POSITIONS, min_events=2)

    def shaped(df: DataFrame, kind: str, segment: Column) -> DataFrame:
        return df.select(
            F.lit(kind).alias("seq_kind"),
            "meeting_id",
            segment.cast("bigint").alias("segment_index"),
            F.col("first_ord").cast("bigint").alias("first_ord"),
            F.col("last_ord").cast("bigint").alias("last_ord"),
            F.col("n_events").cast("bigint").alias("n_events"),
            (_millis(F.col("end")) - _millis(F.col("start"))).alias("duration_ms"),
        )

    return shaped(speaker, "speaker", F.col("segment_index")).unionByName(shaped(status, "status", F.lit(-1)))
