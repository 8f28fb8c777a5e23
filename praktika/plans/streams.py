"""Queries that run a stream over what is there, and on addresses and merges."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from praktika.functions.text import falsy, meeting_of_callback
from praktika.operators import matching as M
from praktika.operators.lineage import shared_dir
from praktika.registry import Registry
from praktika.sources.readers import DecisionSource, media_kind, probe_line
from praktika.sources.tables import table
from praktika.streaming import events as E

registry = Registry()


@registry.query("q_stream_windows", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = E.read_stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return E.materialise(E.windowed_counts(stream, "ts", "event_type"), "complete").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@registry.query("q_stream_latest", "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1")
def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{shared_dir(spark)}/latest-{uuid.uuid4().hex}"
    E.run_once(E.read_stream(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type"), "append", E.upsert_latest("user_id", ["ts", "event_id"], out))
    return spark.read.parquet(f"{out}/v={E.versions(spark, out)[-1]}").select("user_id", "event_id", "event_type")


@registry.query(
    "q_answered",
    "SELECT s.event_id AS asked, p.event_id AS answered FROM events s JOIN events p ON s.user_id = p.user_id AND s.event_type = 'view' AND p.event_type = 'purchase' AND p.ts >= s.ts AND p.ts <= s.ts + INTERVAL 2 HOURS",
)
def answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests with answers within two hours: a join on (user, hour) with the hours a request can reach."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    hour = 3_600_000_000
    asked = rows.where("event_type = 'view'").select("user_id", F.col("event_id").alias("asked"), F.col("t").alias("t0"), F.explode(F.sequence(F.floor(F.col("t") / hour), F.floor((F.col("t") + 2 * hour) / hour))).alias("h"))
    came = rows.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("answered"), F.col("t").alias("t1"), F.floor(F.col("t") / hour).alias("h"))
    return asked.join(came, ["user_id", "h"]).where(F.col("t1").between(F.col("t0"), F.col("t0") + 2 * hour)).select("asked", "answered")


@registry.query("q_subject_merge", "WITH RECURSIVE e AS (SELECT o_orderkey AS a, o_custkey AS b FROM orders WHERE o_orderkey > o_custkey), w(a, b) AS (SELECT a, b FROM e UNION SELECT w.a, e.b FROM w JOIN e ON w.b = e.a) SELECT a AS removed, min(b) AS kept FROM w GROUP BY 1")
def subject_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where merges into merged items end; each item is merged into one with a lower number."""
    edges = table(spark, sf_dir, "orders").where("o_orderkey > o_custkey").select(F.col("o_orderkey").alias("removed"), F.col("o_custkey").alias("kept"))
    return M.resolve_chains(edges, "removed", "kept")


@registry.query("q_url_classify", "SELECT doc_id, CASE WHEN doc_kind = 'minutes' THEN 'video' WHEN doc_kind = 'letter' THEN 'cdn' WHEN doc_kind = 'agenda' THEN 'direct' ELSE 'unknown' END AS kind, CASE WHEN doc_kind = 'minutes' THEN 'vid' || lpad(doc_id::VARCHAR, 8, '0') END AS video_id, CASE WHEN doc_kind = 'summary' THEN 'unknown' ELSE doc_id::VARCHAR END AS meeting_id FROM documents")
def url_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses made of the documents' kinds, classified, and the meeting of their callback."""
    n = F.col("doc_id").cast("string")
    url = F.when(F.col("doc_kind") == "minutes", F.concat(F.lit("https://www.youtube.com/watch?v=vid"), F.lpad(n, 8, "0"))).when(F.col("doc_kind") == "letter", F.concat(F.lit("https://x.cdn.example.org/"), n)).when(F.col("doc_kind") == "agenda", F.concat(F.lit("https://example.org/"), n, F.lit(".mp3"))).otherwise(F.lit("ftp://x"))
    callback = F.when(F.col("doc_kind") == "summary", F.lit("https://example.org/cb")).otherwise(F.concat(F.lit("https://example.org/api/meetings/"), n, F.lit("/cb")))
    rows = table(spark, sf_dir, "documents").select("doc_id", media_kind(url).alias("m"), meeting_of_callback(callback).alias("meeting_id"))
    return rows.select("doc_id", "m.kind", "m.video_id", "meeting_id")


@registry.query("q_probe_lines", "SELECT event_id, nullif(event_type, 'error') AS status, CASE WHEN value > 0 THEN value END AS duration FROM events")
def probe_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(F.lit("noise\n"), F.when(F.col("event_type") == "error", "NA").otherwise(F.col("event_type")), F.lit("|"), falsy(F.col("value").cast("string"), F.lit("NA")))
    return table(spark, sf_dir, "events").select("event_id", probe_line(line).alias("p")).select("event_id", "p.status", "p.duration")


@registry.query("q_pushed_scan", "SELECT ada, issue_date_ms FROM decisions WHERE status = 'PUBLISHED' AND issue_date_ms >= 1643673600000 AND issue_date_ms <= 1648771200000")
def pushed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The register's own source with its filters pushed to the scan."""
    spark.dataSource.register(DecisionSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    rows = spark.read.format("decisions").option("path", f"{sf_dir.rstrip('/')}/decisions.parquet").load()
    return rows.where("status = 'PUBLISHED' and issue_date_ms >= 1643673600000 and issue_date_ms <= 1648771200000").select("ada", "issue_date_ms")
