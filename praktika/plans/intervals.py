"""Queries on overlapping and gapped time intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from praktika.operators.periods import periods_and_gaps, to_millis
from praktika.registry import Registry
from praktika.sources.tables import table

registry = Registry()

P3_SQL = """
WITH iv AS (
  SELECT 'speaker' AS seg_kind, meeting_id, speaker_id, CAST(floor(start_time * 1000 + 0.5) AS BIGINT) AS s, CAST(floor(end_time * 1000 + 0.5) AS BIGINT) AS e FROM display_segments
  UNION ALL
  SELECT 'silent', meeting_id, '-', CAST(floor(start_sec * 1000 + 0.5) AS BIGINT), CAST(floor(end_sec * 1000 + 0.5) AS BIGINT) FROM silent_segments
), reach AS (
  SELECT *, max(e) OVER (PARTITION BY seg_kind, meeting_id, speaker_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM iv WHERE e > s
), island AS (
  SELECT *, sum(CASE WHEN before IS NULL OR s > before THEN 1 ELSE 0 END) OVER (PARTITION BY seg_kind, meeting_id, speaker_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM reach
), period AS (
  SELECT seg_kind, meeting_id, speaker_id, k, min(s) AS start_ms, max(e) AS end_ms FROM island GROUP BY ALL
)
SELECT seg_kind, 'period' AS row_kind, meeting_id, speaker_id, start_ms, end_ms FROM period
UNION ALL
SELECT seg_kind, 'gap', meeting_id, speaker_id, end_ms, next_ms FROM (
  SELECT *, lead(start_ms) OVER (PARTITION BY seg_kind, meeting_id, speaker_id ORDER BY k) AS next_ms FROM period
) WHERE next_ms IS NOT NULL
"""


@registry.query("p3_found", P3_SQL)
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    speaker = table(spark, sf_dir, "display_segments").select(
        F.lit("speaker").alias("seg_kind"), "meeting_id", "speaker_id", to_millis(F.col("start_time")).alias("s"), to_millis(F.col("end_time")).alias("e")
    )
    silent = table(spark, sf_dir, "silent_segments").select(
        F.lit("silent").alias("seg_kind"), "meeting_id", F.lit("-").alias("speaker_id"), to_millis(F.col("start_sec")).alias("s"), to_millis(F.col("end_sec")).alias("e")
    )
    found = periods_and_gaps(speaker.unionByName(silent), ["seg_kind", "meeting_id", "speaker_id"], "s", "e")
    return found.select("seg_kind", "row_kind", "meeting_id", "speaker_id", "start_ms", "end_ms")
