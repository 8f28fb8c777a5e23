"""Queries on the order of a meeting, attendance along it, roll calls and what two runs say of a subject."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from praktika.functions import text as X
from praktika.operators import diff as D
from praktika.operators import matching as M
from praktika.operators import meetings as G
from praktika.operators import records as R
from praktika.operators import sequence as S
from praktika.operators import timelines as T
from praktika.operators import votes as V
from praktika.plans.counts import STATUSES_SQL, statuses
from praktika.plans.names import _CITY, _KEY, _KEYS, _NAME, _TYPED, GAPS_SQL, SIMILAR_SQL, WINDOW_DAYS, gap_candidates, people, sides, span_of, token_similarity, typed, with_spans
from praktika.plans.timelines import _ALIGNED, _NEAR, _SEG, latest_two, segments, utterances
from praktika.registry import Registry
from praktika.sources.tables import table

registry = Registry()

_NAMES = "array_to_string(list_sort(coalesce({0}, [])), '|')"


@registry.query(
    "q_rollcall_lists",
    f"""
    WITH d AS (SELECT DISTINCT ord, pdf_id, meeting_id, present_members AS p, absent_members AS a, mayor_present.present AS m FROM raw_extractions),
    k AS (SELECT meeting_id, ord, 'P:' || {_NAMES.format('p')} || ';;A:' || {_NAMES.format('a')} || ';;M:' || coalesce(m::VARCHAR, 'unknown') AS roll_call FROM d WHERE coalesce(len(p), 0) > 0 OR coalesce(len(a), 0) > 0),
    g AS (SELECT meeting_id, roll_call, count(*) AS n, min(ord) AS first_ord FROM k GROUP BY 1, 2)
    SELECT *, sum(n) OVER (PARTITION BY meeting_id)::BIGINT AS n_documents, 2 * n > sum(n) OVER (PARTITION BY meeting_id) AS selected FROM g
    """,
)
def rollcall_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roll calls of a meeting's documents as they stand, and the one that most agree on."""
    rows = table(spark, sf_dir, "raw_extractions").select("ord", "pdf_id", "meeting_id", "present_members", "absent_members", F.col("mayor_present.present").alias("mayor")).distinct()
    shown = rows.where((F.coalesce(F.size("present_members"), F.lit(0)) > 0) | (F.coalesce(F.size("absent_members"), F.lit(0)) > 0))
    return G.roll_calls(shown, "meeting_id", V.roll_call_key(F.col("present_members"), F.col("absent_members"), F.col("mayor")), "ord")


_ORDER = """
    l AS (SELECT meeting_id, upper(trim(label)) AS label, count(*) AS n FROM (SELECT DISTINCT report_id, meeting_id, label FROM pdf_reports WHERE item_kind = 'discussion_order' AND label IS NOT NULL) GROUP BY 1, 2),
    e AS (SELECT meeting_id, arg_min(label, (-n, label)) AS label FROM l GROUP BY 1),
    x AS (SELECT meeting_id, i - 1 AS pl, string_split(label, '>')[i]::INT AS item_index, '' AS reason FROM e, unnest(range(1, len(string_split(label, '>')) + 1)) AS u(i)),
    s AS (SELECT DISTINCT subject_id, meeting_id, agenda_item_index AS item_index, coalesce(non_agenda_reason, '') AS reason FROM match_subjects WHERE agenda_item_index IS NOT NULL AND coalesce(non_agenda_reason, '') IN ('', 'outOfAgenda')),
    r AS (SELECT meeting_id, item_index, reason, CASE WHEN reason = '' THEN 2 ELSE 1 END AS g, item_index AS pl FROM s WHERE (meeting_id, item_index, reason) NOT IN (SELECT (meeting_id, item_index, reason) FROM x)),
    o AS (SELECT meeting_id, item_index, reason, row_number() OVER (PARTITION BY meeting_id ORDER BY g, pl, item_index)::INT - 1 AS position FROM (SELECT meeting_id, item_index, reason, 0 AS g, pl FROM x UNION ALL SELECT * FROM r))"""


def discussed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order that most reports of a meeting give, completed by its other items."""
    reports = table(spark, sf_dir, "pdf_reports").where("item_kind = 'discussion_order' and label is not null").select("report_id", "meeting_id", "label").distinct()
    counted = reports.groupBy("meeting_id", F.upper(F.trim("label")).alias("label")).agg(F.count("*").alias("n"))
    chosen = counted.groupBy("meeting_id").agg(F.min_by("label", F.struct((-F.col("n")).alias("n"), "label")).alias("label"))
    explicit = chosen.select("meeting_id", F.posexplode(F.split("label", ">")).alias("position", "item")).select("meeting_id", "position", F.col("item").cast("int").alias("item_index"), F.lit(None).cast("string").alias("reason"))
    subjects = table(spark, sf_dir, "match_subjects").select("subject_id", "meeting_id", F.col("agenda_item_index").alias("item_index"), F.col("non_agenda_reason").alias("reason")).distinct()
    return G.complete_order(subjects, explicit, "meeting_id")


@registry.query("q_complete_order", "WITH " + _ORDER + " SELECT * FROM o")
def complete_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discussed(spark, sf_dir)


_PRESENT = (
    "WITH "
    + _ORDER
    + f""", f AS (SELECT meeting_id, min(ord) AS ord FROM raw_extractions GROUP BY 1),
    t AS (SELECT DISTINCT w.meeting_id, present_members, absent_members FROM raw_extractions w JOIN f ON f.meeting_id = w.meeting_id AND f.ord = w.ord),
    p AS (SELECT meeting_id, {_NAME.format('name')} AS name, bool_and(present) AS present FROM (SELECT meeting_id, unnest(present_members) AS name, true AS present FROM t UNION ALL SELECT meeting_id, unnest(absent_members), false FROM t) WHERE name IS NOT NULL GROUP BY 1, 2),
    c AS (SELECT meeting_id, {_NAME.format('v.name')} AS name, v.change_type AS change_type, v.agenda_item_index AS item_index, coalesce(v.non_agenda_reason, '') AS reason, v.timing AS timing, ord, k FROM (SELECT DISTINCT meeting_id, ord, attendance_changes[i] AS v, i AS k FROM raw_extractions, unnest(range(1, len(attendance_changes) + 1)) AS u(i)) WHERE v.name IS NOT NULL),
    b AS (SELECT c.meeting_id, name, change_type, ord, k, CASE WHEN c.item_index IS NULL THEN CASE WHEN change_type = 'arrival' THEN -1 END WHEN timing = 'during' THEN o.position WHEN timing = 'after' THEN o.position + 1 END AS eff, CASE WHEN timing = 'during' THEN 1 ELSE 0 END AS phase
      FROM c LEFT JOIN o ON o.meeting_id = c.meeting_id AND o.item_index = c.item_index AND o.reason = c.reason WHERE c.item_index IS NULL OR o.position IS NOT NULL),
    y AS (SELECT DISTINCT meeting_id, position FROM o),
    n AS (SELECT meeting_id, name FROM p UNION SELECT meeting_id, name FROM b WHERE eff IS NOT NULL),
    q AS (SELECT n.meeting_id, n.name, y.position, arg_max(b.change_type, (b.eff, b.phase, b.ord, b.k)) AS last_type FROM n JOIN y USING (meeting_id) LEFT JOIN b ON b.meeting_id = n.meeting_id AND b.name = n.name AND b.eff <= y.position GROUP BY 1, 2, 3),
    z AS (SELECT q.meeting_id, q.name, q.position, CASE WHEN q.last_type IS NOT NULL THEN q.last_type = 'arrival' ELSE coalesce(p.present, false) END AS present FROM q LEFT JOIN p USING (meeting_id, name))"""
)


@registry.query("q_attendance_along_order", _PRESENT + " SELECT * FROM z")
def attendance_along(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who is present at each item in the order in which items were discussed; names count in normal form."""
    raw = table(spark, sf_dir, "raw_extractions")
    order = discussed(spark, sf_dir)
    first = raw.groupBy("meeting_id").agg(F.min_by(F.struct("present_members", "absent_members"), "ord").alias("r"))
    empty = F.array().cast("array<string>")
    named = first.select("meeting_id", F.explode(F.coalesce("r.present_members", empty)).alias("name"), F.lit(True).alias("present")).unionByName(first.select("meeting_id", F.explode(F.coalesce("r.absent_members", empty)).alias("name"), F.lit(False).alias("present")))
    present = named.where("name is not null").groupBy("meeting_id", X.normalize_name(F.col("name")).alias("name")).agg(F.bool_and("present").alias("present"))
    changes = raw.select("meeting_id", "ord", F.posexplode("attendance_changes").alias("k", "c")).distinct().where("c.name is not null")
    # the place of a change: its document, then its place there
    changes = changes.select("meeting_id", X.normalize_name(F.col("c.name")).alias("name"), "c.change_type", F.col("c.agenda_item_index").alias("item_index"), F.col("c.non_agenda_reason").alias("reason"), "c.timing", (F.col("ord").cast("bigint") * 1_000_000 + F.col("k")).alias("ord"))
    events = G.placed_changes(changes, order, "meeting_id")
    return T.attendance_at(present, events, order.select("meeting_id", "position").distinct())


@registry.query(
    "q_meeting_votes",
    _PRESENT
    + rf""", g AS (SELECT DISTINCT pdf_id, meeting_id, subject_info.agenda_item_index AS item_index, coalesce(subject_info.non_agenda_reason, '') AS reason, vote_result, vote_details FROM raw_extractions),
    h AS (SELECT pdf_id, g.meeting_id, min(o.position) AS position, any_value(vote_result) AS vote_result, any_value(coalesce(vote_details, [])) AS votes FROM g JOIN o ON o.meeting_id = g.meeting_id AND o.item_index = g.item_index AND o.reason = g.reason GROUP BY 1, 2),
    i AS (SELECT h.pdf_id, z.name FROM h JOIN z ON z.meeting_id = h.meeting_id AND z.position = h.position AND z.present
      WHERE regexp_matches(replace(strip_accents(lower(vote_result)), 'ς', 'σ'), 'ομοφων|κατα\s+πλειοψηφι') AND len(list_filter(votes, lambda v: v.vote = 'FOR')) = 0 AND NOT list_contains(list_transform(votes, lambda v: {_NAME.format('v.name')}), z.name))
    SELECT DISTINCT pdf_id, {_NAME.format('v.name')} AS name, v.vote AS vote, 'written' AS origin FROM (SELECT pdf_id, unnest(votes) AS v FROM h) WHERE v.name IS NOT NULL UNION ALL SELECT pdf_id, name, 'FOR', 'inferred' FROM i
    """,
)
def meeting_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The votes on each decision: those written down, and FOR of whoever else was present when its item was discussed."""
    order = discussed(spark, sf_dir)
    rows = table(spark, sf_dir, "raw_extractions").select("pdf_id", "meeting_id", F.col("subject_info.agenda_item_index").alias("item_index"), F.coalesce("subject_info.non_agenda_reason", F.lit("")).alias("reason"), "vote_result", "vote_details").distinct()
    placed = rows.join(order, ["meeting_id", "item_index", "reason"]).groupBy("pdf_id", "meeting_id").agg(F.min("position").alias("position"), F.first("vote_result").alias("vote_result"), F.first("vote_details").alias("vote_details"))
    there = attendance_along(spark, sf_dir).where("present").groupBy("meeting_id", "position").agg(F.collect_list("name").alias("present"))
    inferred = V.inferred_for_votes(placed.join(there, ["meeting_id", "position"]), "pdf_id", "present", "vote_result", "vote_details")
    written = placed.select("pdf_id", F.explode("vote_details").alias("v")).where("v.name is not null").select("pdf_id", X.normalize_name(F.col("v.name")).alias("name"), "v.vote", F.lit("written").alias("origin")).distinct()
    return written.unionByName(inferred.withColumn("origin", F.lit("inferred")))


_WORDS = "list_filter(string_split(" + _KEY.format("{0}") + ", ' '), lambda t: length(t) >= 5)"


@registry.query(
    "q_name_second_stage",
    f"""
    WITH p AS (SELECT DISTINCT city_id, id, unnest({_KEYS.format('name')}) AS k FROM people), r AS (SELECT DISTINCT city_id, name, unnest({_KEYS.format('name')}) AS k FROM {_TYPED}),
    h AS (SELECT r.city_id, r.name, p.id, q.ord FROM r JOIN p ON r.city_id = p.city_id AND r.k = p.k AND p.k <> '' JOIN (SELECT DISTINCT id, ord FROM people) q ON q.id = p.id),
    m AS (SELECT city_id, name, arg_min(id, (ord, id)) AS id FROM h GROUP BY 1, 2),
    l AS (SELECT DISTINCT city_id, name FROM r WHERE (city_id, name) NOT IN (SELECT (city_id, name) FROM m)),
    f AS (SELECT DISTINCT city_id, id, ord, name FROM people WHERE (city_id, id) NOT IN (SELECT (city_id, id) FROM m)),
    a AS (SELECT DISTINCT city_id, name, unnest({_WORDS.format('name')}) AS w FROM l), b AS (SELECT DISTINCT city_id, id, ord, unnest({_WORDS.format('name')}) AS w FROM f)
    SELECT a.city_id, a.name, arg_min(b.id, (b.ord, b.id)) AS id FROM a JOIN b USING (city_id, w) GROUP BY 1, 2
    """,
)
def name_second_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that share no key with anybody, proposed to whom they share a long word with, if nobody has taken that person."""
    raw, roster = typed(spark, sf_dir), people(spark, sf_dir)
    matched = M.match_names(raw, roster, "city_id", "name", "id", "name", "ord")
    left, free = M.leftovers(raw, roster, matched, "city_id", "name", "id")
    words = lambda c: F.explode(F.array_distinct(F.filter(F.split(X.sort_key(F.col(c)), " "), lambda t: F.length(t) >= 5))).alias("w")
    proposals = left.select("city_id", "name", words("name")).join(free.select("city_id", "id", "ord", words("name")), ["city_id", "w"]).select("city_id", "name", "id", "ord")
    return G.second_stage(left, free, proposals, "city_id", "name", "id", "ord")


_DISCUSSED = f"(SELECT subject_id, map_from_entries(list((status, n::VARCHAR) ORDER BY status)) AS contributions, sum(n)::BIGINT AS utterances FROM (SELECT subject_id, status, count(*) AS n FROM {STATUSES_SQL} WHERE subject_id <> '' GROUP BY 1, 2) GROUP BY 1)"


@registry.query(
    "q_subject_verdicts",
    _ALIGNED.replace("arg_max(name, ord) AS a_name", "arg_max(name, ord) AS a_name, arg_max(subject_id, ord) AS a_id").replace("arg_max(name, ord) AS b_name", "arg_max(name, ord) AS b_name, arg_max(subject_id, ord) AS b_id")
    + f""", u AS {_DISCUSSED},
    v AS (SELECT grp, agenda_item_index, a_name, b_name, nullif(a_reason, '') AS ar, nullif(b_reason, '') AS br, coalesce(map_keys(x.contributions), []) AS ka, coalesce(map_keys(y.contributions), []) AS kb, x.contributions AS ca, y.contributions AS cb, coalesce(x.utterances, 0) AS na, coalesce(y.utterances, 0) AS nb
      FROM la JOIN lb USING (grp, agenda_item_index) LEFT JOIN u x ON x.subject_id = a_id LEFT JOIN u y ON y.subject_id = b_id),
    w AS (SELECT grp, agenda_item_index, list_filter([CASE WHEN a_name IS DISTINCT FROM b_name THEN 'name' END, CASE WHEN ar IS DISTINCT FROM br THEN 'topic' END, CASE WHEN coalesce(a_name, '') <> coalesce(b_name, '') THEN 'description' END,
      CASE WHEN len(list_filter(kb, lambda k: NOT list_contains(ka, k))) > 0 THEN 'speakers added' END, CASE WHEN len(list_filter(ka, lambda k: NOT list_contains(kb, k))) > 0 THEN 'speakers removed' END,
      CASE WHEN len(list_filter(ka, lambda k: list_contains(kb, k) AND ca[k] <> cb[k])) > 0 THEN 'contributions' END, CASE WHEN na <> nb THEN 'utterances' END], lambda z: z IS NOT NULL) AS changes,
      ar IS DISTINCT FROM br OR abs(length(coalesce(b_name, '')) - length(coalesce(a_name, ''))) / greatest(length(coalesce(a_name, '')), 1) > 0.3 OR len(list_filter(kb, lambda k: NOT list_contains(ka, k))) > 0 OR len(list_filter(ka, lambda k: NOT list_contains(kb, k))) > 0 OR abs(nb - na) / greatest(na, 1) > 0.2 AS structural FROM v)
    SELECT grp, agenda_item_index, array_to_string(changes, ',') AS changes, CASE WHEN len(changes) = 0 THEN 'identical' WHEN structural THEN 'structural' ELSE 'cosmetic' END AS verdict FROM w
    """,
)
def subject_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last two meetings of a city as two runs: subjects by agenda index, by every criterion of a comparison.

    Where they stand outside the agenda counts as topic, the name as description, states of their utterances as speakers.
    """
    a, b = latest_two(spark, sf_dir)
    counted = statuses(spark, sf_dir).where("subject_id != ''").groupBy("subject_id", "status").agg(F.count("*").cast("string").alias("n"))
    spoken = counted.groupBy("subject_id").agg(F.map_from_entries(F.collect_list(F.struct("status", "n"))).alias("contributions"), F.sum(F.col("n").cast("bigint")).alias("utterances"))
    full = lambda df: df.join(spoken, "subject_id", "left").withColumns({"topic": F.col("non_agenda_reason"), "description": F.col("name"), "withdrawn": F.lit(False), "topic_importance": F.lit("normal"), "proximity_importance": F.lit("none"), "context": F.lit(None).cast("string")})
    both = D.align_by_index(full(a), full(b), "grp", "agenda_item_index", "ord").where("side = 'both'")
    verdict, changes = G.subject_verdict()
    return both.select("grp", "agenda_item_index", F.array_join(changes, ",").alias("changes"), verdict.alias("verdict"))


@registry.query(
    "q_speaker_numbers",
    f"SELECT meeting_id, speaker_key, row_number() OVER (PARTITION BY meeting_id ORDER BY first, speaker_key)::INT AS speaker_no FROM (SELECT meeting_id, coalesce(p.id, g.speaker_id) AS speaker_key, min(ord) AS first FROM {_SEG} g LEFT JOIN (SELECT DISTINCT id FROM people WHERE party IS NOT NULL) p ON p.id = g.speaker_id WHERE g.speaker_id IS NOT NULL GROUP BY 1, 2)",
)
def speaker_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "people").where("party is not null").select(F.col("id").alias("speaker"), F.col("id").alias("match")).distinct()
    return G.numbered_speakers(segments(spark, sf_dir).join(known, "speaker", "left"), "meeting_id", "match", "speaker", "ord")


@registry.query(
    "q_diarize_summary",
    _NEAR
    + f""", f AS (SELECT meeting_id, utterance_id, speaker_id, struct_extract_at(m, 1) AS s, struct_extract_at(m, 2) AS e, struct_extract_at(m, 3) AS a, struct_extract_at(m, 4) AS b FROM n),
    d AS (SELECT meeting_id, utterance_id, CASE WHEN a <= s AND b >= e THEN 0 ELSE round(sqrt((a - s) * (a - s) + (b - e) * (b - e)), 6) END AS drift FROM f),
    k AS (SELECT meeting_id, utterance_id, min(drift) AS drift, count(*) AS c FROM d GROUP BY 1, 2),
    t AS (SELECT meeting_id, count(*) AS n_utterances FROM (SELECT DISTINCT meeting_id, utterance_id FROM {STATUSES_SQL}) GROUP BY 1)
    SELECT t.meeting_id, n_utterances, count(k.utterance_id) AS n_assigned, round(100.0 * (n_utterances - count(k.utterance_id)) / n_utterances, 2) AS skipped_percent, round(coalesce(sum(CASE WHEN c > 1 THEN k.drift END), 0), 3) AS total_drift FROM t LEFT JOIN k USING (meeting_id) GROUP BY 1, 2""",
)
def diarize_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per meeting how many utterances found a speaker, which share did not, and the drift where several could have it."""
    spoken = utterances(spark, sf_dir)
    found = T.nearest_segment(spoken.drop("ord"), segments(spark, sf_dir), "meeting_id", "utterance_id", ("s", "e"), ("a", "b"), "ord")
    apart = F.sqrt((F.col("a") - F.col("s")) * (F.col("a") - F.col("s")) + (F.col("b") - F.col("e")) * (F.col("b") - F.col("e")))
    drift = F.when((F.col("a") <= F.col("s")) & (F.col("b") >= F.col("e")), 0.0).otherwise(F.round(apart, 6))
    best = found.select("meeting_id", "utterance_id", drift.alias("drift")).groupBy("meeting_id", "utterance_id").agg(F.min("drift").alias("drift"), F.count("*").alias("c"))
    given = best.groupBy("meeting_id").agg(F.count("*").alias("n_assigned"), F.sum(F.when(F.col("c") > 1, F.col("drift"))).alias("total"))
    all_ = spoken.groupBy("meeting_id").agg(F.count("*").alias("n_utterances")).join(given, "meeting_id", "left").withColumn("n_assigned", F.coalesce("n_assigned", F.lit(0).cast("bigint")))
    skipped = F.round(100.0 * (F.col("n_utterances") - F.col("n_assigned")) / F.col("n_utterances"), 2)
    return all_.select("meeting_id", "n_utterances", "n_assigned", skipped.alias("skipped_percent"), F.round(F.coalesce("total", F.lit(0.0)), 3).alias("total_drift"))


@registry.query("q_transcript_build")
def transcript_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words to utterances, on the time line of the whole meeting, each with the speaker whose segment drifts least."""
    said = S.words_to_utterances(table(spark, sf_dir, "asr_words"), ["meeting_id", "segment_index"])
    offset = F.col("segment_index") * G.SEGMENT_SECONDS
    placed = said.select("meeting_id", F.concat_ws(":", "segment_index", "first_ord").alias("utterance_id"), (F.col("start") + offset).alias("s"), (F.col("end") + offset).alias("e"), "n_words", "text")
    found = T.nearest_segment(placed.select("meeting_id", "utterance_id", "s", "e"), segments(spark, sf_dir), "meeting_id", "utterance_id", ("s", "e"), ("a", "b"), "ord")
    apart = F.when((F.col("a") <= F.col("s")) & (F.col("b") >= F.col("e")), 0.0).otherwise(F.sqrt(F.pow(F.col("a") - F.col("s"), 2) + F.pow(F.col("b") - F.col("e"), 2)))
    best = found.withColumn("drift", apart).groupBy("meeting_id", "utterance_id").agg(F.min_by("speaker", F.struct("drift", "speaker")).alias("speaker_id"))
    return placed.join(best, ["meeting_id", "utterance_id"], "left").select("meeting_id", "utterance_id", F.round("s", 3).alias("start"), F.round("e", 3).alias("end"), "n_words", "text", "speaker_id")


@registry.query(
    "q_agenda_build",
    "WITH s AS (SELECT DISTINCT meeting_id, subject_id, ord, name, agenda_item_index FROM match_subjects), f AS (SELECT *, coalesce(agenda_item_index, coalesce(max(agenda_item_index) OVER (PARTITION BY meeting_id), 0) + sum(CASE WHEN agenda_item_index IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY meeting_id ORDER BY ord ROWS UNBOUNDED PRECEDING))::INT AS filled FROM s) SELECT subject_id, filled, substr(sha256(coalesce(name, '') || filled::VARCHAR), 1, 16) AS agenda_id FROM f",
)
def agenda_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An agenda's items with every index filled and an identifier made of what they say."""
    rows = table(spark, sf_dir, "match_subjects").select("meeting_id", "subject_id", "ord", "name", "agenda_item_index").distinct()
    filled = S.fill_missing_index(rows, "meeting_id", "agenda_item_index", "ord")
    return filled.select("subject_id", "filled", F.substring(F.sha2(F.concat(F.coalesce("name", F.lit("")), F.col("filled").cast("string")), 256), 1, 16).alias("agenda_id"))


@registry.query(
    "q_decision_matching",
    f"""
    WITH t AS ({SIMILAR_SQL}), q AS ({GAPS_SQL}), k AS (SELECT subject_id, min(ord) AS o FROM match_subjects GROUP BY 1),
    b AS (SELECT t.subject_id, ada, similarity, o, CASE WHEN similarity >= 0.8 THEN 0.9 WHEN similarity >= 0.5 THEN 0.7 END::DOUBLE AS score FROM t JOIN k USING (subject_id) WHERE rank = 1),
    f AS (SELECT *, min(CASE WHEN score IS NOT NULL THEN (o, subject_id) END) OVER (PARTITION BY ada) AS first FROM b),
    a AS (SELECT subject_id, ada, score FROM f WHERE score IS NOT NULL AND (o, subject_id) = first),
    m AS (SELECT DISTINCT subject_id, {_CITY.format('city_name')} AS city, CAST(meeting_date AT TIME ZONE 'UTC' AS DATE) AS day FROM match_subjects WHERE subject_id NOT IN (SELECT subject_id FROM a)),
    d AS (SELECT DISTINCT ada, {_CITY.format('organization_label')} AS city, CAST(epoch_ms(publish_timestamp_ms) AS DATE) AS published FROM decisions WHERE ada IN (SELECT ada FROM q WHERE ada IS NOT NULL) AND ada NOT IN (SELECT ada FROM a)),
    g AS (SELECT ada, arg_min(subject_id, (published - day, o, subject_id)) AS subject_id FROM m JOIN d USING (city) JOIN k USING (subject_id) WHERE published BETWEEN day AND day + 45 GROUP BY 1),
    h AS (SELECT subject_id, min(ada) AS ada FROM g GROUP BY 1)
    SELECT subject_id, ada, score, 1 AS stage FROM a UNION ALL SELECT subject_id, ada, 0.6, 2 FROM h
    """,
)
def decision_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects to decisions in two passes: the most similar one if it is like enough and free, then decisions of number gaps.

    A decision of a gap that nobody has goes to the open subject of its city with the nearest meeting before it.
    """
    placed = table(spark, sf_dir, "match_subjects").groupBy("subject_id").agg(F.min("ord").alias("o"))
    best = token_similarity(spark, sf_dir).where("rank = 1").join(placed, "subject_id").withColumn("at", F.struct("o", "subject_id"))
    label = F.when(F.col("similarity") >= 0.8, "high").when(F.col("similarity") >= 0.5, "medium").otherwise("low")
    tested = R.accept_matches(best.withColumn("confidence", label), table(spark, sf_dir, "decisions"), "subject_id", "ada", "confidence", "at", F.lit(False))
    first = tested.where("score is not null").select("subject_id", "ada", "score")
    meetings, decisions = sides(spark, sf_dir)
    gaps = gap_candidates(spark, sf_dir).where("ada is not null").select("ada").distinct().join(first.select("ada"), "ada", "left_anti")
    free = decisions.join(gaps, "ada", "left_semi").select("ada", "city", "published").distinct().withColumn("span", span_of("published"))
    left = meetings.select("subject_id", "city", "day").distinct().join(first.select("subject_id"), "subject_id", "left_anti").join(placed, "subject_id")
    near = with_spans(left, "day").join(free, ["city", "span"]).where(F.col("published").between(F.col("day"), F.date_add("day", WINDOW_DAYS)))
    chosen = near.groupBy("ada").agg(F.min_by("subject_id", F.struct(F.datediff("published", "day").alias("lag"), "o", "subject_id")).alias("subject_id"))
    second = chosen.groupBy("subject_id").agg(F.min("ada").alias("ada"))
    return first.withColumn("stage", F.lit(1)).unionByName(second.select("subject_id", "ada", F.lit(0.6).alias("score"), F.lit(2).alias("stage")))
