"""Queries on records from outside: accepted, re-pointed, rewritten."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from praktika.operators import matching as M
from praktika.operators import records as R
from praktika.plans.counts import STATUSES_SQL, statuses
from praktika.plans.names import _CITY, GAPS_SQL, SIMILAR_SQL, WINDOW_DAYS, gap_candidates, sides, span_of, subjects, token_similarity, with_spans
from praktika.registry import Registry
from praktika.sources.tables import table

registry = Registry()

_PROPOSED = "(SELECT DISTINCT r.ord, r.pdf_id, coalesce(d.ada, 'none-' || r.pdf_id) AS ada, CASE WHEN r.incomplete THEN 'low' WHEN r.vote_result IS NULL THEN 'medium' ELSE 'high' END AS confidence, r.decision_number FROM raw_extractions r LEFT JOIN (SELECT CAST(ord AS BIGINT) // 3 AS o, min(ada) AS ada FROM decisions GROUP BY 1) d ON d.o = r.ord)"


@registry.query(
    "q_accept_chain",
    f"""
    WITH t AS (SELECT p.*, CASE WHEN p.decision_number IS NULL THEN 'CONTRADICTION' WHEN confidence NOT IN ('high', 'medium') THEN 'LOW_CONFIDENCE' WHEN p.ada NOT IN (SELECT ada FROM decisions) THEN 'UNKNOWN' END AS reason0 FROM {_PROPOSED} p),
    f AS (SELECT *, min(CASE WHEN reason0 IS NULL THEN ord END) OVER (PARTITION BY ada) AS first FROM t), g AS (SELECT *, coalesce(reason0, CASE WHEN ord > first THEN 'DUPLICATE' END) AS reason FROM f)
    SELECT pdf_id, ada, ord, CASE WHEN reason IS NULL THEN CASE confidence WHEN 'high' THEN 0.9 ELSE 0.7 END END::DOUBLE AS score, reason FROM g
    """,
)
def accept_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proposals made of extractions and every third decision, through the chain of refusals."""
    decisions = table(spark, sf_dir, "decisions")
    guess = decisions.groupBy(F.floor(F.col("ord") / 3).cast("int").alias("ord")).agg(F.min("ada").alias("ada"))
    raw = table(spark, sf_dir, "raw_extractions").select("ord", "pdf_id", "incomplete", "vote_result", "decision_number").distinct()
    label = F.when(F.col("incomplete"), "low").when(F.col("vote_result").isNull(), "medium").otherwise("high")
    proposed = raw.join(guess, "ord", "left").select("ord", "pdf_id", F.coalesce("ada", F.concat(F.lit("none-"), "pdf_id")).alias("ada"), label.alias("confidence"), "decision_number").distinct()
    return R.accept_matches(proposed, decisions, "pdf_id", "ada", "confidence", "ord", F.col("decision_number").isNull())


@registry.query(
    "q_candidate_pool",
    f"""
    WITH t AS ({SIMILAR_SQL}), q AS ({GAPS_SQL}),
    m AS (SELECT DISTINCT subject_id, {_CITY.format('city_name')} AS city, CAST(meeting_date AT TIME ZONE 'UTC' AS DATE) AS day FROM match_subjects),
    d AS (SELECT DISTINCT ada, {_CITY.format('organization_label')} AS city, CAST(epoch_ms(publish_timestamp_ms) AS DATE) AS published FROM decisions WHERE ada IN (SELECT ada FROM q WHERE ada IS NOT NULL)),
    o AS (SELECT DISTINCT subject_id, ada FROM m JOIN d USING (city) WHERE published BETWEEN day AND day + 45)
    SELECT subject_id, ada, false AS is_gap FROM t UNION ALL SELECT subject_id, ada, true FROM o WHERE (subject_id, ada) NOT IN (SELECT (subject_id, ada) FROM t)
    """,
)
def candidate_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five most similar decisions of each subject and those of number gaps that were published in its window."""
    similar = token_similarity(spark, sf_dir).select("subject_id", "ada")
    gaps = gap_candidates(spark, sf_dir).where("ada is not null").select("ada").distinct()
    meetings, decisions = sides(spark, sf_dir)
    fits = F.col("published").between(F.col("day"), F.date_add("day", WINDOW_DAYS))
    near = decisions.join(gaps, "ada", "left_semi").select("ada", "city", "published").distinct().withColumn("span", span_of("published"))
    offered = with_spans(meetings.select("subject_id", "city", "day").distinct(), "day").join(near, ["city", "span"]).where(fits).select("subject_id", "ada")
    return R.candidate_pool(similar, offered, "subject_id", "ada")


@registry.query("q_primary_subjects", f"WITH l AS (SELECT s.subject_id, p.subject_id AS primary_id FROM (SELECT DISTINCT meeting_id, subject_id, agenda_item_index FROM match_subjects) s JOIN (SELECT meeting_id, min(subject_id) AS subject_id FROM match_subjects WHERE agenda_item_index = 1 GROUP BY 1) p USING (meeting_id) WHERE s.agenda_item_index IS NULL) SELECT u.utterance_id, coalesce(l.primary_id, u.subject_id) AS subject_id FROM {STATUSES_SQL} u LEFT JOIN l USING (subject_id)")
def primary_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of subjects without a place on the agenda count for the first item of their meeting."""
    all_ = subjects(spark, sf_dir).select("meeting_id", "subject_id", "agenda_item_index").distinct()
    first = all_.where("agenda_item_index = 1").groupBy("meeting_id").agg(F.min("subject_id").alias("first"))
    linked = all_.join(first, "meeting_id", "left").withColumn("discussed_in", F.when(F.col("agenda_item_index").isNull(), F.col("first")))
    return R.point_to_primary(statuses(spark, sf_dir), linked, "subject_id", "discussed_in").select("utterance_id", "subject_id")


@registry.query("q_remapped_ids", f"SELECT u.utterance_id, coalesce('S' || s.ord, u.subject_id) AS subject_id FROM {STATUSES_SQL} u LEFT JOIN (SELECT subject_id, min(ord) AS ord FROM match_subjects GROUP BY 1) s USING (subject_id)")
def remapped_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = table(spark, sf_dir, "match_subjects").groupBy("subject_id").agg(F.concat(F.lit("S"), F.min("ord").cast("string")).alias("new_id"))
    return R.remap(statuses(spark, sf_dir), "subject_id", mapping, "subject_id", "new_id").select("utterance_id", "subject_id")


@registry.query("q_by_speaker", "WITH g AS (SELECT meeting_id, coalesce(nullif(speaker_id, ''), 'name:' || speaker_name) AS speaker_key, count(*) AS n, min(ord) AS first_ord FROM (SELECT DISTINCT * FROM display_segments) GROUP BY 1, 2) SELECT *, (row_number() OVER (PARTITION BY meeting_id ORDER BY first_ord, speaker_key) - 1)::INT AS position FROM g")
def by_speaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.by_speaker(table(spark, sf_dir, "display_segments").distinct(), ["meeting_id"], "speaker_id", "speaker_name", "ord")


@registry.query("q_rewritten_links", "SELECT subject_id, 'βλ. [' || any_value(meeting_id) || '](REF:SUBJECT:' || subject_id || ') και [x](REF:PERSON:none).' AS text FROM (SELECT DISTINCT subject_id, meeting_id FROM match_subjects) GROUP BY subject_id")
def rewritten_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "match_subjects").select("subject_id", "meeting_id").distinct()
    dictionary = M.short_ids(rows, "subject_id")
    short = rows.join(dictionary.withColumnRenamed("long_id", "subject_id"), "subject_id")
    text = F.concat(F.lit("βλ. ["), "meeting_id", F.lit("](REF:SUBJECT:"), "short_id", F.lit(") και [x](REF:PERSON:none)."))
    return R.rewrite_links(short.select("subject_id", text.alias("text")), "subject_id", "text", dictionary)


@registry.query("q_numbered_lines", "SELECT meeting_id, n FROM (SELECT meeting_id, count(*) AS n FROM (SELECT DISTINCT meeting_id, subject_id FROM match_subjects) GROUP BY 1)")
def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An agenda written as numbered lines, some wrapped, read back."""
    rows = table(spark, sf_dir, "match_subjects").select("meeting_id", "subject_id").distinct().groupBy("meeting_id").agg(F.array_sort(F.collect_set("subject_id")).alias("s"))
    lines = F.array_join(F.transform("s", lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x, F.lit("\n2.5 μέτρα"))), "\n")
    return rows.select("meeting_id", F.size(R.numbered_lines(lines)).cast("bigint").alias("n"))


@registry.query("q_title_diffs")
def title_diffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed between the first and the last title of a decision that was published again."""
    titles = table(spark, sf_dir, "decisions").groupBy("ada").agg(F.min_by("subject", "ord").alias("a"), F.max_by("subject", "ord").alias("b"), F.count_distinct("status").alias("n")).where("n > 1")
    return titles.select("ada", R.diff_column(F.col("a"), F.col("b")).alias("diff")).select("ada", F.size("diff").alias("n_steps"))


_UNSEEN = r"[\x{00AD}\x{200B}-\x{200F}\x{2060}\x{FEFF}]"


@registry.query("q_changed_texts", rf"SELECT ada, subject FROM (SELECT ada, arg_min(subject, (ord, subject)) AS before, regexp_replace(arg_min(subject, (ord, subject)), '{_UNSEEN}', '', 'g') AS subject FROM decisions GROUP BY 1) WHERE trim(before) IS DISTINCT FROM trim(subject)")
def changed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles corrected of what nobody sees, only those that it changes."""
    before = table(spark, sf_dir, "decisions").groupBy("ada").agg(F.min_by("subject", F.struct("ord", "subject")).alias("subject"))
    return R.changed_texts(before, before.withColumn("subject", F.regexp_replace("subject", _UNSEEN, "")), "ada", "subject")


@registry.query("q_presets", "SELECT p_partkey, CASE WHEN p_size <= 18 THEN 'low' WHEN p_size <= 35 THEN 'middle' ELSE 'high' END AS preset FROM (SELECT p_partkey, p_size FROM part)")
def presets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", R.nearest_preset(F.col("p_size"), {"low": 10, "middle": 27, "high": 44}).alias("preset"))
