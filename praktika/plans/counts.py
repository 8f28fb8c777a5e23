"""Counts, roll-ups, first- and last-wins choices and predicates over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from praktika.functions import numbers as N
from praktika.functions.text import falsy
from praktika.operators import aggregates as A
from praktika.registry import Registry
from praktika.sources.tables import table

registry = Registry()
#: What tells one word of the stream from another; a repeated row repeats all of it.
WORD_TIMES = ("meeting_id", "segment_index", "ord", "start_sec", "end_sec")
NO_PARTY = "ΧΩΡΙΣ ΠΑΡΑΤΑΞΗ"
_STATUS = r"upper(regexp_replace(trim(status), '[\s_-]+', '_', 'g'))"
_SUBJECT = r"coalesce(regexp_replace(lower(trim(subject_id)), '^subject:\s*', ''), '')"


def status_of(c: Column) -> Column:
    return F.upper(F.regexp_replace(F.trim(c), r"[\s_-]+", "_"))


def subject_of(c: Column) -> Column:
    return F.coalesce(F.regexp_replace(F.lower(F.trim(c)), r"^subject:\s*", ""), F.lit(""))


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct utterance states in one spelling; no subject is the empty string."""
    rows = table(spark, sf_dir, "utt_status").select("meeting_id", "ord", "utterance_id", status_of(F.col("status")).alias("status"), subject_of(F.col("subject_id")).alias("subject_id"), "start_timestamp", "end_timestamp", "ingested_at")
    return rows.distinct()


STATUSES_SQL = f"(SELECT DISTINCT meeting_id, ord, utterance_id, {_STATUS} AS status, {_SUBJECT} AS subject_id, start_timestamp, end_timestamp, ingested_at FROM utt_status)"


@registry.query(
    "q_usage_rollup",
    """
    SELECT phase, input_tokens, output_tokens, cache_creation_tokens, cache_read_tokens, calls, input_tokens + cache_read_tokens + output_tokens AS total_tokens,
      CASE WHEN input_tokens + cache_read_tokens > 0 THEN round(100.0 * cache_read_tokens / (input_tokens + cache_read_tokens), 4) ELSE 0 END AS cache_percent
    FROM (SELECT l_returnflag AS phase, sum(CAST(l_quantity AS BIGINT))::BIGINT AS input_tokens, sum(CAST(l_linenumber AS BIGINT))::BIGINT AS output_tokens,
      sum(coalesce(nullif(CAST(round(l_tax * 100) AS BIGINT), 0), 0))::BIGINT AS cache_creation_tokens, sum(coalesce(nullif(CAST(round(l_discount * 100) AS BIGINT), 0), 0))::BIGINT AS cache_read_tokens, count(*) AS calls
      FROM lineitem GROUP BY ROLLUP (l_returnflag))
    """,
)
def usage_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = lambda c: F.nullif(F.round(F.col(c) * 100).cast("bigint"), F.lit(0))
    calls = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("phase"), F.col("l_quantity").cast("bigint").alias("read"), F.col("l_linenumber").cast("bigint").alias("written"), cents("l_tax").alias("created"), cents("l_discount").alias("cached"))
    return A.usage_rollup(calls, "phase", "read", "written", "created", "cached")


@registry.query("q_status_counts", f"SELECT status, subject_id, n, sum(n) OVER (PARTITION BY status)::BIGINT AS outer_n FROM (SELECT status, subject_id, count(*) AS n FROM {STATUSES_SQL} GROUP BY ALL)")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.two_level_counts(statuses(spark, sf_dir), "status", "subject_id")


@registry.query("q_status_cumulative", f"SELECT status, batch, n, sum(n) OVER (PARTITION BY status ORDER BY batch)::BIGINT AS n_so_far FROM (SELECT status, CAST(ingested_at AS DATE) AS batch, count(*) AS n FROM {STATUSES_SQL} GROUP BY ALL)")
def status_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.running_counts(statuses(spark, sf_dir).withColumn("batch", F.to_date("ingested_at")), "status", "batch")


@registry.query("q_top_subjects_per_status", f"SELECT status, subject_id, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY status ORDER BY n DESC, subject_id)::INT AS rank FROM (SELECT status, subject_id, count(*) AS n FROM {STATUSES_SQL} WHERE subject_id <> '' GROUP BY ALL)) WHERE rank <= 5")
def top_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = statuses(spark, sf_dir).where("subject_id != ''").groupBy("status", "subject_id").agg(F.count("*").alias("n"))
    return A.top_per_group(counted, "status", [F.desc("n"), F.col("subject_id")], 5)


@registry.query("q_subject_utterances", f"SELECT s.subject_id, coalesce(n, 0) AS n_utterances FROM (SELECT DISTINCT subject_id FROM match_subjects) s LEFT JOIN (SELECT subject_id, count(*) AS n FROM {STATUSES_SQL} WHERE status = 'SUBJECT_DISCUSSION' GROUP BY 1) u USING (subject_id)")
def subject_utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = statuses(spark, sf_dir).where("status = 'SUBJECT_DISCUSSION'").groupBy("subject_id").agg(F.count("*").alias("n"))
    return table(spark, sf_dir, "match_subjects").select("subject_id").distinct().join(counted, "subject_id", "left").select("subject_id", F.coalesce("n", F.lit(0).cast("bigint")).alias("n_utterances"))


@registry.query("q_semi_known_ids", f"SELECT meeting_id, count(*) AS n FROM {STATUSES_SQL} WHERE subject_id IN (SELECT subject_id FROM match_subjects) GROUP BY 1")
def known_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statuses(spark, sf_dir).join(table(spark, sf_dir, "match_subjects").select("subject_id").distinct(), "subject_id", "left_semi").groupBy("meeting_id").agg(F.count("*").alias("n"))


@registry.query("q_null_unknown_ids", f"SELECT u.utterance_id, s.subject_id FROM {STATUSES_SQL} u LEFT JOIN (SELECT DISTINCT subject_id FROM match_subjects) s USING (subject_id)")
def null_unknown_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "match_subjects").select("subject_id", F.col("subject_id").alias("known")).distinct()
    return statuses(spark, sf_dir).join(known, "subject_id", "left").select("utterance_id", F.col("known").alias("subject_id"))


@registry.query("q_anti_undiscussed", f"SELECT DISTINCT meeting_id, subject_id FROM match_subjects WHERE subject_id NOT IN (SELECT subject_id FROM {STATUSES_SQL} WHERE status = 'SUBJECT_DISCUSSION')")
def undiscussed(spark: SparkSession, sf_dir: str) -> DataFrame:
    discussed = statuses(spark, sf_dir).where("status = 'SUBJECT_DISCUSSION'").select("subject_id").distinct()
    return table(spark, sf_dir, "match_subjects").select("meeting_id", "subject_id").distinct().join(discussed, "subject_id", "left_anti")


@registry.query(
    "q_party_counts",
    f"SELECT coalesce(nullif(p.party, ''), '{NO_PARTY}') AS party, count(*) AS n FROM (SELECT DISTINCT * FROM display_segments) d JOIN (SELECT DISTINCT id, party FROM people) p ON d.speaker_id = p.id GROUP BY 1",
)
def party_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "people").select(F.col("id").alias("speaker_id"), "party").distinct()
    # counted per speaker before the join: a row per speaker instead of one per segment is shuffled
    spoken = table(spark, sf_dir, "display_segments").distinct().groupBy("speaker_id").agg(F.count("*").alias("n"))
    return spoken.join(people, "speaker_id").groupBy(falsy(F.col("party"), F.lit(NO_PARTY)).alias("party")).agg(F.sum("n").alias("n"))


@registry.query("q_first_wins_dedup", "SELECT ada, arg_min(subject, (ord, status)) AS subject, arg_min(status, (ord, status)) AS status, min(ord) AS ord FROM decisions GROUP BY ada")
def first_wins_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.first_wins(table(spark, sf_dir, "decisions").select("ada", "subject", "status", "ord"), ["ada"], ["ord", "status"])


@registry.query("q_last_wins_dedup", "SELECT ada, status, publish_timestamp_ms FROM (SELECT *, row_number() OVER (PARTITION BY ada ORDER BY coalesce(publish_timestamp_ms, -1) DESC, ord DESC, status DESC) AS rn FROM decisions) WHERE rn = 1")
def last_wins_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "decisions").select("ada", "status", "publish_timestamp_ms", "ord", F.coalesce("publish_timestamp_ms", F.lit(-1)).alias("at"))
    return A.last_wins(rows, ["ada"], ["at", "ord", "status"]).select("ada", "status", "publish_timestamp_ms")


@registry.query(
    "q_absent_wins",
    """
    SELECT meeting_id, name, CASE WHEN bool_or(absent) THEN 'ABSENT' ELSE 'PRESENT' END AS status FROM (
      SELECT meeting_id, unnest(present_members) AS name, false AS absent FROM raw_extractions UNION ALL SELECT meeting_id, unnest(absent_members), true FROM raw_extractions)
    WHERE name IS NOT NULL GROUP BY 1, 2
    """,
)
def absent_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "raw_extractions")
    present = raw.select("meeting_id", F.explode("present_members").alias("name"), F.lit(False).alias("absent"))
    absent = raw.select("meeting_id", F.explode("absent_members").alias("name"), F.lit(True).alias("absent"))
    both = present.unionByName(absent).where("name is not null").groupBy("meeting_id", "name").agg(F.bool_or("absent").alias("absent"))
    return both.select("meeting_id", "name", F.when(F.col("absent"), "ABSENT").otherwise("PRESENT").alias("status"))


@registry.query("q_side_stats", "SELECT meeting_id, count(*) AS total_subjects, count(agenda_item_index) AS agenda_subjects, count(*) FILTER (WHERE non_agenda_reason = 'beforeAgenda') AS before_agenda, count(*) FILTER (WHERE non_agenda_reason = 'outOfAgenda') AS out_of_agenda, coalesce(max(agenda_item_index), -1) AS last_index FROM (SELECT DISTINCT subject_id, meeting_id, agenda_item_index, non_agenda_reason FROM match_subjects) GROUP BY 1")
def side_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "match_subjects").select("subject_id", "meeting_id", "agenda_item_index", "non_agenda_reason").distinct()
    return rows.groupBy("meeting_id").agg(
        F.count("*").alias("total_subjects"), F.count("agenda_item_index").alias("agenda_subjects"), F.count_if(F.col("non_agenda_reason") == "beforeAgenda").alias("before_agenda"), F.count_if(F.col("non_agenda_reason") == "outOfAgenda").alias("out_of_agenda"), F.coalesce(F.max("agenda_item_index"), F.lit(-1)).alias("last_index")
    )


@registry.query("q_fingerprint", "SELECT meeting_id, substr(sha256(array_to_string(list_sort(list(DISTINCT sha256(pdf_id))), ',')), 1, 12) AS fingerprint FROM raw_extractions GROUP BY 1")
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.distinct_fingerprint(table(spark, sf_dir, "raw_extractions").select("meeting_id", F.sha2("pdf_id", 256).alias("h")), "meeting_id", "h")


@registry.query("q_transcript_combine", "SELECT meeting_id, count(*) AS n_streams, sum(n_words)::BIGINT AS n_words, round(sum(span), 3) AS duration, max(span) AS longest FROM (SELECT meeting_id, segment_index, count(*) AS n_words, round(max(end_sec), 3) AS span FROM (SELECT DISTINCT * FROM asr_words WHERE word_type = 'word') GROUP BY 1, 2) GROUP BY 1")
def transcript_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "asr_words").where("word_type = 'word'").select(*WORD_TIMES).distinct()
    streams = words.groupBy("meeting_id", "segment_index").agg(F.count("*").alias("n_words"), F.round(F.max("end_sec"), 3).alias("span"))
    return streams.groupBy("meeting_id").agg(F.count("*").alias("n_streams"), F.sum("n_words").alias("n_words"), F.round(F.sum("span"), 3).alias("duration"), F.max("span").alias("longest"))


@registry.query("q_shifted_words", "SELECT meeting_id, segment_index, ord, round(start_sec + segment_index * 900, 3) AS start_sec, round(end_sec + segment_index * 900, 3) AS end_sec FROM (SELECT DISTINCT * FROM asr_words WHERE word_type = 'word')")
def shifted_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of later recordings on the time line of the whole meeting, fifteen minutes apart."""
    at = lambda c: F.round(F.col(c) + F.col("segment_index") * 900, 3).alias(c)
    return table(spark, sf_dir, "asr_words").where("word_type = 'word'").select(*WORD_TIMES).distinct().select("meeting_id", "segment_index", "ord", at("start_sec"), at("end_sec"))


@registry.query("q_mean_confidence", "SELECT meeting_id, round(avg(coalesce(least(1, exp(logprob)), 1)), 6) AS confidence FROM (SELECT DISTINCT * FROM asr_words WHERE word_type = 'word') GROUP BY 1")
def mean_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "asr_words").where("word_type = 'word'").select(*WORD_TIMES, "logprob").distinct()
    return words.groupBy("meeting_id").agg(F.round(F.avg(N.confidence(F.col("logprob"))), 6).alias("confidence"))


@registry.query(
    "q_top3_confidence",
    """
    SELECT item_id, label, n, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY n DESC, label)::INT AS rank FROM (
        SELECT item_id, upper(trim(label)) AS label, count(*) AS n FROM (SELECT DISTINCT * FROM pdf_reports) WHERE label IS NOT NULL GROUP BY 1, 2)) WHERE rank <= 3
    """,
)
def top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best supported labels of an item, through a map as a scorer returns it."""
    counted = table(spark, sf_dir, "pdf_reports").where("label is not null").distinct().groupBy("item_id", F.upper(F.trim("label")).alias("label")).agg(F.count("*").alias("n"))
    maps = counted.groupBy("item_id").agg(F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("m"))
    order = lambda a, b: F.when(a["value"] != b["value"], F.when(a["value"] > b["value"], -1).otherwise(1)).otherwise(F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
    best = maps.select("item_id", F.posexplode(F.slice(F.array_sort(F.map_entries("m"), order), 1, 3)).alias("p", "e"))
    return best.select("item_id", F.col("e.key").alias("label"), F.col("e.value").alias("n"), (F.col("p") + 1).alias("rank"))


@registry.query("q_unit_profile", "SELECT organization_id, unit_id, count(*) AS n_decisions FROM (SELECT DISTINCT organization_id, ada, unnest(unit_ids) AS unit_id FROM decisions WHERE status <> 'REVOKED') GROUP BY 1, 2")
def unit_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "decisions").where("status != 'REVOKED'").select("organization_id", "ada", F.explode("unit_ids").alias("unit_id")).distinct()
    return rows.groupBy("organization_id", "unit_id").agg(F.count("*").alias("n_decisions"))


@registry.query("q_queue_stats", "SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS n_failed, count(*) FILTER (WHERE event_type = 'click') AS n_running, round(max(epoch(ts)) - min(epoch(ts)), 3) AS span_seconds FROM events GROUP BY 1")
def queue_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("ts").cast("timestamp").cast("double")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("n_failed"), F.count_if(F.col("event_type") == "click").alias("n_running"), F.round(F.max(at) - F.min(at), 3).alias("span_seconds"))


@registry.query("q_trace_tree", "SELECT o.o_orderkey AS trace_id, l.l_linenumber AS position, l.l_linenumber IS NULL AS is_leaf FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey")
def trace_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans with their children; a span without any is a leaf."""
    spans = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("trace_id"))
    children = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("trace_id"), F.col("l_linenumber").alias("position"))
    return spans.join(children, "trace_id", "left").withColumn("is_leaf", F.col("position").isNull())


@registry.query(
    "q_formats",
    r"""
    SELECT l_orderkey, l_linenumber, printf('%02d:%02d:%02d', (q // 3600)::BIGINT, ((q % 3600) // 60)::BIGINT, (q % 60)::BIGINT) AS clock,
      CASE WHEN p < 1000 THEN p::VARCHAR WHEN p < 1000000 THEN printf('%.1fk', floor(p / 100.0 + 0.5) / 10) ELSE printf('%.1fM', floor(p / 100000.0 + 0.5) / 10) END AS tokens,
      CASE WHEN q >= 90 THEN printf('%dm%ds', (q // 60)::BIGINT, (q % 60)::BIGINT) ELSE printf('%ds', q::BIGINT) END AS duration
    FROM (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) * 97 AS q, CAST(floor(l_extendedprice) AS BIGINT) AS p FROM lineitem)
    """,
)
def formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity").cast("bigint") * 97).alias("q"), F.floor("l_extendedprice").cast("bigint").alias("p"))
    return rows.select("l_orderkey", "l_linenumber", N.clock(F.col("q")).alias("clock"), N.token_label(F.col("p")).alias("tokens"), N.duration_label(F.col("q")).alias("duration"))


@registry.query(
    "q_wal_severity",
    """
    SELECT o_orderkey, retained, CASE WHEN o_orderstatus = 'F' AND pct >= 95 OR pct >= 95 THEN 'critical' WHEN pct >= 80 THEN 'high' WHEN pct >= 50 THEN 'warning' ELSE 'ok' END AS severity
    FROM (SELECT o_orderkey, o_orderstatus, o_orderkey * 4294967296 + CAST(floor(o_totalprice) AS BIGINT) AS retained, floor(o_totalprice) / 5000.0 AS pct FROM orders)
    """,
)
def wal_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log positions in hex, as a monitor gives them, back to bytes and a level of alarm."""
    lsn = F.concat_ws("/", F.conv(F.col("o_orderkey").cast("string"), 10, 16), F.conv(F.floor("o_totalprice").cast("string"), 10, 16))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", N.lsn_bytes(lsn).alias("retained"), (F.floor("o_totalprice") / 5000).alias("pct"))
    return rows.select("o_orderkey", "retained", N.severity(F.lit("reserved"), F.col("pct")).alias("severity"))


@registry.query("q_completeness", "SELECT l_orderkey, l_linenumber, l_extendedprice >= l_quantity * 1000 * 0.98 OR l_quantity * 1000 - l_extendedprice <= 120 AS complete, least(1, greatest(0.6, l_discount * 10)) AS zoom FROM lineitem")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = F.col("l_quantity") * 1000
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", N.is_complete(F.col("l_extendedprice"), expected).alias("complete"), N.clamp(F.col("l_discount") * 10, 0.6, 1.0).alias("zoom"))
