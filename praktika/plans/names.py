"""Queries on names, titles, protocol numbers and votes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from praktika.functions import numbers as N
from praktika.functions import text as X
from praktika.operators import matching as M
from praktika.operators import sequence as S
from praktika.operators import votes as V
from praktika.registry import Registry
from praktika.sources.tables import table

registry = Registry()

_FOLD = "replace(strip_accents(lower({0})), 'ς', 'σ')"
_NORM = r"trim(regexp_replace(regexp_replace(regexp_replace(" + _FOLD + r", '[\"''«»“”‘’`]', '', 'g'), '[^a-z0-9_\sα-ω]', ' ', 'g'), '\s+', ' ', 'g'))"
_TOKENS = "list_distinct(list_filter(string_split(" + _NORM + ", ' '), lambda t: length(t) >= 3))"
_NAME = r"trim(regexp_replace(" + _FOLD.format(r"translate(regexp_replace({0}, '\s*\([^)]*\)', '', 'g'), '‐‑‒–—―', '      ')") + r", '\s+', ' ', 'g'))"
_KEY = r"array_to_string(list_sort(list_filter(string_split_regex(translate(" + _NAME + r", '-', ' '), '\s+'), lambda t: t <> '')), ' ')"
_NICK = r"CASE WHEN regexp_matches({0}, '\S+\s*\([^)]+\)') THEN " + _KEY.format(r"regexp_replace({0}, '\S+\s*\(([^)]+)\)', '\1', 'g')") + " END"
_KEYS = "list_distinct(list_filter([" + _KEY + ", " + _NICK + "], lambda k: k IS NOT NULL))"
_TYPED = "(SELECT DISTINCT meeting_id, city_id, name FROM (SELECT meeting_id, city_id, unnest(present_members) AS name FROM raw_extractions UNION ALL SELECT meeting_id, city_id, unnest(absent_members) FROM raw_extractions UNION ALL SELECT meeting_id, city_id, unnest(list_transform(attendance_changes, lambda c: c.name)) FROM raw_extractions) WHERE name IS NOT NULL)"
_CITY = r"trim(regexp_replace(regexp_replace(" + _FOLD + r", '[^α-ω]+', ' ', 'g'), '^\s*(δημοσ|δ)\s', '', 'g'))"


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every name as it stands in a document: of those present, absent, come or gone."""
    raw = table(spark, sf_dir, "raw_extractions")
    empty = F.array().cast("array<string>")
    names = F.concat(*[F.coalesce(c, empty) for c in (F.col("present_members"), F.col("absent_members"), F.col("attendance_changes.name"))])
    return raw.select("meeting_id", "city_id", F.explode(names).alias("name")).where("name is not null").distinct()


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "people").select("ord", "id", "name", "city_id").distinct()


@registry.query("q_normalize_text", f"SELECT DISTINCT subject_id, {_NORM.format('name')} AS normalized, {_KEY.format('name')} AS sort_key, array_to_string(list_sort({_TOKENS.format('name')}), ' ') AS tokens FROM match_subjects")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "match_subjects").select("subject_id", "name").distinct()
    return rows.select("subject_id", X.normalize_text(F.col("name")).alias("normalized"), X.sort_key(F.col("name")).alias("sort_key"), F.array_join(F.array_sort(X.tokens(F.col("name"))), " ").alias("tokens"))


@registry.query(
    "q_name_match_first",
    f"""
    WITH p AS (SELECT DISTINCT city_id, id, ord, unnest({_KEYS.format('name')}) AS k FROM people), r AS (SELECT DISTINCT city_id, name, unnest({_KEYS.format('name')}) AS k FROM {_TYPED})
    SELECT r.city_id, r.name, arg_min(p.id, (p.ord, p.id)) AS person_id FROM r JOIN p ON r.city_id = p.city_id AND r.k = p.k AND p.k <> '' GROUP BY 1, 2
    """,
)
def name_match_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.match_names(typed(spark, sf_dir), people(spark, sf_dir), "city_id", "name", "id", "name", "ord")


@registry.query(
    "q_name_match_last",
    f"""
    WITH p AS (SELECT city_id, k, arg_max(id, ord) AS id, max(ord) AS ord FROM (SELECT DISTINCT city_id, id, ord, unnest({_KEYS.format('name')}) AS k FROM people) WHERE k <> '' GROUP BY 1, 2),
    r AS (SELECT city_id, name, keys[i] AS k, i FROM (SELECT DISTINCT city_id, name, {_KEYS.format('name')} AS keys, {_KEY.format('name')} AS base FROM {_TYPED}), unnest(range(1, len(keys) + 1)) AS u(i)),
    o AS (SELECT r.city_id, r.name, p.id, p.ord, CASE WHEN r.k = {_KEY.format('r.name')} THEN 0 ELSE 1 END AS i FROM r JOIN p ON r.city_id = p.city_id AND r.k = p.k)
    SELECT city_id, name, arg_min(id, (i, ord)) AS person_id FROM o GROUP BY 1, 2
    """,
)
def name_match_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.match_names(typed(spark, sf_dir), people(spark, sf_dir), "city_id", "name", "id", "name", "ord", last=True)


@registry.query(
    "q_name_leftovers",
    f"""
    WITH p AS (SELECT DISTINCT city_id, id, unnest({_KEYS.format('name')}) AS k FROM people), r AS (SELECT DISTINCT city_id, name, unnest({_KEYS.format('name')}) AS k FROM {_TYPED})
    SELECT DISTINCT city_id, name FROM r WHERE (city_id, name) NOT IN (SELECT (r.city_id, r.name) FROM r JOIN p ON r.city_id = p.city_id AND r.k = p.k AND p.k <> '')
    """,
)
def name_leftovers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, roster = typed(spark, sf_dir), people(spark, sf_dir)
    matched = M.match_names(raw, roster, "city_id", "name", "id", "name", "ord")
    return M.leftovers(raw, roster, matched, "city_id", "name", "id")[0]


def city(column: str):
    """A city's name without what kind of body it is, folded."""
    return F.trim(F.regexp_replace(F.regexp_replace(X.fold(F.col(column)), "[^α-ω]+", " "), r"^\s*(δημοσ|δ)\s", ""))


#: Days after a meeting in which its decisions are looked for.
WINDOW_DAYS = 45


def with_spans(meetings: DataFrame, day: str) -> DataFrame:
    """``meetings`` once for each span of WINDOW_DAYS + 1 days that its window touches: two."""
    at = lambda d: F.floor(F.unix_date(d) / (WINDOW_DAYS + 1))
    return meetings.withColumn("span", F.explode(F.sequence(at(F.col(day)), at(F.date_add(day, WINDOW_DAYS)))))


def span_of(day: str):
    return F.floor(F.unix_date(day) / (WINDOW_DAYS + 1))


def sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    subjects = table(spark, sf_dir, "match_subjects").select("subject_id", "name", city("city_name").alias("city"), F.to_date("meeting_date").alias("day")).distinct()
    decisions = table(spark, sf_dir, "decisions").select("ada", "subject", F.col("ord").alias("d_ord"), city("organization_label").alias("city"), F.to_date(F.timestamp_millis("publish_timestamp_ms")).alias("published")).distinct()
    return subjects, decisions


SIMILAR_SQL = f"""
WITH s AS (SELECT DISTINCT subject_id, {_TOKENS.format('name')} AS a, {_CITY.format('city_name')} AS city, CAST(meeting_date AT TIME ZONE 'UTC' AS DATE) AS day FROM match_subjects),
d AS (SELECT DISTINCT ada, ord AS d_ord, {_TOKENS.format('subject')} AS b, {_CITY.format('organization_label')} AS city, CAST(epoch_ms(publish_timestamp_ms) AS DATE) AS published FROM decisions),
p AS (SELECT subject_id, ada, d_ord, CASE WHEN least(len(a), len(b)) = 0 THEN 0 ELSE round(len(list_intersect(a, b)) / least(len(a), len(b)), 6) END AS similarity FROM s JOIN d USING (city) WHERE published BETWEEN day AND day + 45)
SELECT subject_id, ada, d_ord, similarity, rank FROM (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY similarity DESC, d_ord, ada)::INT AS rank FROM p) WHERE rank <= 5
"""


@registry.query("q_token_similarity_topn", SIMILAR_SQL)
def token_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    subjects, decisions = sides(spark, sf_dir)
    # a city's decisions of years do not meet all its subjects: both sides are cut into spans of time first
    subjects, decisions = with_spans(subjects, "day"), decisions.withColumn("span", span_of("published"))
    return M.similar_top(subjects, decisions, ["city", "span"], F.col("published").between(F.col("day"), F.date_add("day", WINDOW_DAYS)), 5).drop("span")


@registry.query("q_decision_window", f"SELECT meeting_id, count(DISTINCT ada) AS n FROM (SELECT DISTINCT meeting_id, {_CITY.format('city_name')} AS city, CAST(meeting_date AT TIME ZONE 'UTC' AS DATE) AS day FROM match_subjects) s JOIN (SELECT DISTINCT ada, {_CITY.format('organization_label')} AS city, CAST(epoch_ms(issue_date_ms) AS DATE) AS issued FROM decisions WHERE status <> 'REVOKED') d USING (city) WHERE issued BETWEEN day AND day + 45 GROUP BY 1")
def decision_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions of a meeting's organisation that were issued in the 45 days after it."""
    meetings = table(spark, sf_dir, "match_subjects").select("meeting_id", city("city_name").alias("city"), F.to_date("meeting_date").alias("day")).distinct()
    issued = table(spark, sf_dir, "decisions").where("status != 'REVOKED'").select("ada", city("organization_label").alias("city"), F.to_date(F.timestamp_millis("issue_date_ms")).alias("issued")).distinct()
    meetings, issued = with_spans(meetings, "day"), issued.withColumn("span", span_of("issued"))
    return meetings.join(issued, ["city", "span"]).where(F.col("issued").between(F.col("day"), F.date_add("day", WINDOW_DAYS))).groupBy("meeting_id").agg(F.count_distinct("ada").alias("n"))


_PARSED = r"""
    WITH w AS (SELECT organization_id, ada, ord, issue_date_ms, publish_timestamp_ms, regexp_extract(protocol_number, '^\s*(\D*?)\s*(\d+)\s*(?:[/-]\s*(\d{4}|\d{2}))?\s*$', ['p', 'n', 'y']) AS m FROM decisions WHERE regexp_matches(protocol_number, '^\s*\D*?\s*\d+\s*(?:[/-]\s*(\d{4}|\d{2}))?\s*$')),
    y AS (SELECT organization_id, ada, ord, publish_timestamp_ms, CAST(m.n AS BIGINT) AS num, CASE length(m.y) WHEN 4 THEN '/' || m.y WHEN 2 THEN '/20' || m.y ELSE coalesce('/' || year(epoch_ms(issue_date_ms)), '') END AS suffix FROM w WHERE organization_id IS NOT NULL),
    n AS (SELECT DISTINCT organization_id, ada, num, '' AS prefix, suffix FROM y),
    c AS (SELECT organization_id, suffix FROM n GROUP BY 1, 2 HAVING count(*) >= 3),
    f AS (SELECT n.*, CASE WHEN num - lag(num) OVER w - 1 < 3 THEN 0 ELSE 1 END AS new FROM n JOIN c USING (organization_id, suffix) WINDOW w AS (PARTITION BY organization_id, suffix ORDER BY num)),
    r AS (SELECT *, sum(new) OVER (PARTITION BY organization_id, suffix ORDER BY num ROWS UNBOUNDED PRECEDING) AS run FROM f),
    z AS (SELECT *, count(*) OVER (PARTITION BY organization_id, suffix, run) AS size FROM r),
    b AS (SELECT *, first_value(run) OVER (PARTITION BY organization_id, suffix ORDER BY size DESC, run) AS best FROM z),
    g AS (SELECT DISTINCT organization_id, suffix, num FROM b WHERE run = best AND size >= 3), l AS (SELECT *, lead(num) OVER (PARTITION BY organization_id, suffix ORDER BY num) AS nx FROM g),
    m AS (SELECT organization_id, suffix, unnest(range(num + 1, nx)) AS missing FROM l WHERE nx - num > 1)"""


def numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every protocol number of the table that holds one: blanks, words before it and the year in two or four digits aside.

    ``suffix`` is the year, as written or else that of the issue; empty where neither is there.
    """
    pattern = r"^\s*(\D*?)\s*(\d+)\s*(?:[/-]\s*(\d{4}|\d{2}))?\s*$"
    part = lambda k: F.regexp_extract("protocol_number", pattern, k)
    issued = F.concat(F.lit("/"), F.year(F.timestamp_millis("issue_date_ms")).cast("string"))
    suffix = F.when(F.length(part(3)) == 4, F.concat(F.lit("/"), part(3))).when(F.length(part(3)) == 2, F.concat(F.lit("/20"), part(3))).otherwise(F.coalesce(issued, F.lit("")))
    rows = table(spark, sf_dir, "decisions").where(F.col("protocol_number").rlike(pattern) & F.col("organization_id").isNotNull())
    return rows.select("organization_id", "ada", "ord", "publish_timestamp_ms", part(2).try_cast("bigint").alias("num"), suffix.alias("suffix")).where("num is not null")


def _series(numbers: DataFrame) -> DataFrame:
    """The runs of an organisation's numbers of one year, whatever form each is written in."""
    written = numbers.select("organization_id", "suffix", "ada", "num").distinct()
    return S.protocol_pattern(written.select(F.struct("organization_id", "suffix").alias("series"), F.concat(F.col("num").cast("string"), "suffix").alias("number")), "series", "number")


def _series_gaps(numbers: DataFrame) -> DataFrame:
    return S.missing_numbers(_series(numbers).where("in_run and run_size >= 3"), "series", "num").select("series.organization_id", "series.suffix", "missing")


@registry.query("q_islands_protocol", _PARSED + " SELECT organization_id, prefix, suffix, num, run = best AS in_run, CASE WHEN run = best THEN size END AS run_size FROM b")
def islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _series(numbers(spark, sf_dir)).select("series.organization_id", "prefix", "suffix", "num", "in_run", "run_size")


@registry.query("q_sequence_gaps", _PARSED + " SELECT organization_id, suffix, missing FROM m")
def sequence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _series_gaps(numbers(spark, sf_dir))


GAPS_SQL = (
    _PARSED
    + """ SELECT m.organization_id, m.suffix, m.missing, arg_min(y.ada, (y.ord, y.ada)) AS ada FROM m LEFT JOIN y ON y.organization_id = m.organization_id AND y.num = m.missing AND (m.suffix = '' OR y.suffix = '')
      AND (m.suffix = '' OR y.publish_timestamp_ms IS NULL OR year(epoch_ms(y.publish_timestamp_ms)) - CAST(substr(m.suffix, 2) AS INT) BETWEEN 0 AND 1) GROUP BY 1, 2, 3"""
)


@registry.query("q_gap_candidates", GAPS_SQL)
def gap_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions that may be the missing one: of its number, in any form, where one of the two has no year; gaps without one stay.

    A decision without year is published in the year of the series or the next, if that date is known.
    """
    written = numbers(spark, sf_dir)
    found = written.select("organization_id", F.col("num").alias("missing"), "ada", "ord", F.col("suffix").alias("written"), F.year(F.timestamp_millis("publish_timestamp_ms")).alias("published"))
    gaps = _series_gaps(written)
    late = F.col("published") - F.substring("suffix", 2, 4).try_cast("int")
    may = (F.col("suffix") == "") | ((F.col("written") == "") & (F.col("published").isNull() | late.between(0, 1)))
    first = gaps.join(found, ["organization_id", "missing"]).where(may).groupBy("organization_id", "suffix", "missing").agg(F.min_by("ada", F.struct("ord", "ada")).alias("ada"))
    return gaps.join(first, ["organization_id", "suffix", "missing"], "left").select("organization_id", "suffix", "missing", "ada")


@registry.query(
    "q_ada_lookup",
    f"""
    WITH c AS (SELECT meeting_id, min({_CITY.format('city_name')}) AS city FROM match_subjects GROUP BY 1),
    d AS (SELECT {_CITY.format('organization_label')} AS city, protocol_number AS decision_number, arg_min(ada, (ord, ada)) AS ada, arg_min(status, (ord, ada)) AS status FROM decisions WHERE protocol_number IS NOT NULL GROUP BY 1, 2)
    SELECT pdf_id, ada, status FROM (SELECT DISTINCT pdf_id, meeting_id, decision_number FROM raw_extractions) LEFT JOIN c USING (meeting_id) LEFT JOIN d USING (city, decision_number)
    """,
)
def ada_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first decision of a document's number in the organisation of its own city; organisations share numbers."""
    cities = table(spark, sf_dir, "match_subjects").groupBy("meeting_id").agg(F.min(city("city_name")).alias("city"))
    first = table(spark, sf_dir, "decisions").where("protocol_number is not null").groupBy(city("organization_label").alias("city"), F.col("protocol_number").alias("decision_number")).agg(F.min_by(F.struct("ada", "status"), F.struct("ord", "ada")).alias("d"))
    documents = table(spark, sf_dir, "raw_extractions").select("pdf_id", "meeting_id", "decision_number").distinct().join(cities, "meeting_id", "left")
    return documents.join(first, ["city", "decision_number"], "left").select("pdf_id", "d.ada", "d.status")


@registry.query("q_document_urls", "SELECT DISTINCT ada, coalesce(nullif(document_url, ''), 'https://example.org/doc/' || ada) AS url, substr(sha256(ada), 1, 16) AS cache_key FROM decisions")
def document_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = X.falsy(F.col("document_url"), F.concat(F.lit("https://example.org/doc/"), F.col("ada")))
    return table(spark, sf_dir, "decisions").select("ada", url.alias("url"), F.substring(F.sha2("ada", 256), 1, 16).alias("cache_key")).distinct()


@registry.query(
    "q_majority_rollcall",
    """
    WITH r AS (SELECT item_id, pdf_no, 'P:' || CASE WHEN label = 'PRESENT' THEN item_id::VARCHAR ELSE '' END || ';;A:' || CASE WHEN label = 'ABSENT' THEN item_id::VARCHAR ELSE '' END || ';;M:unknown' AS roll_call
      FROM (SELECT DISTINCT report_id, item_id, pdf_no, upper(trim(label)) AS label FROM pdf_reports WHERE item_kind = 'roll_call') WHERE label IN ('PRESENT', 'ABSENT')),
    g AS (SELECT item_id, roll_call, count(*) AS n, min(pdf_no) AS first_ord FROM r GROUP BY 1, 2)
    SELECT * FROM (SELECT *, sum(n) OVER (PARTITION BY item_id)::BIGINT AS n_documents FROM g) WHERE 2 * n > n_documents
    """,
)
def majority_rollcall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per member of a roll call what most of the documents that name them say."""
    label = F.upper(F.trim("label"))
    named = lambda what: F.when(label == what, F.array(F.col("item_id").cast("string")))
    rows = table(spark, sf_dir, "pdf_reports").where("item_kind = 'roll_call'").select("report_id", "item_id", "pdf_no", named("PRESENT").alias("p"), named("ABSENT").alias("a"), F.lit(None).cast("boolean").alias("mayor")).distinct()
    return V.majority_roll_call(rows, "item_id", "p", "a", "mayor", "pdf_no")


_CHANGES = f"(SELECT meeting_id, {_KEY.format('c.name')} AS name, c.change_type AS change_type, coalesce(c.agenda_item_index::VARCHAR, '') || ':' || coalesce(c.non_agenda_reason, '') AS item, c.timing AS timing FROM (SELECT pdf_id, meeting_id, unnest(attendance_changes) AS c FROM (SELECT DISTINCT pdf_id, meeting_id, attendance_changes FROM raw_extractions)))"


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "raw_extractions").select("pdf_id", "meeting_id", "attendance_changes").distinct()
    item = F.concat_ws(":", F.coalesce(F.col("c.agenda_item_index").cast("string"), F.lit("")), F.coalesce("c.non_agenda_reason", F.lit("")))
    return rows.select("pdf_id", "meeting_id", F.explode("attendance_changes").alias("c")).select("meeting_id", X.sort_key(F.col("c.name")).alias("name"), "c.change_type", item.alias("item"), "c.timing")


@registry.query(
    "q_consensus_changes",
    f"""
    WITH v AS (SELECT meeting_id, name, change_type, item, timing, count(*) AS v FROM {_CHANGES} GROUP BY ALL),
    b AS (SELECT meeting_id, name, change_type, item, arg_min(coalesce(timing, '-'), (-v, CASE WHEN timing = 'during' THEN 0 WHEN timing IS NOT NULL THEN 1 ELSE 2 END)) AS best_timing, sum(v)::BIGINT AS n_reports FROM v GROUP BY ALL),
    d AS (SELECT meeting_id, count(DISTINCT pdf_id) AS n_pdfs FROM raw_extractions GROUP BY 1)
    SELECT meeting_id, name, change_type, item, nullif(best_timing, '-') AS best_timing, n_reports, n_pdfs FROM b JOIN d USING (meeting_id) WHERE 2 * n_reports > n_pdfs
    """,
)
def consensus_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "raw_extractions").groupBy("meeting_id").agg(F.count_distinct("pdf_id").alias("n_pdfs"))
    return V.consensus_changes(changes(spark, sf_dir), "meeting_id", ["name", "change_type", "item"], "timing", documents, "n_pdfs")


@registry.query(
    "q_order_vote",
    """
    WITH r AS (SELECT DISTINCT report_id, item_id, string_split(trim(label), '>') AS items FROM pdf_reports WHERE item_kind = 'discussion_order'),
    g AS (SELECT item_id, items, count(*) AS n FROM r GROUP BY 1, 2), t AS (SELECT item_id, sum(n)::BIGINT AS n_documents FROM g GROUP BY 1),
    l AS (SELECT a.item_id, a.items FROM g a WHERE a.items IS NOT NULL AND NOT EXISTS (SELECT 1 FROM g b WHERE b.item_id = a.item_id AND len(b.items) > len(a.items) AND b.items[1:len(a.items)] = a.items)),
    m AS (SELECT g.item_id, g.n, arg_min(l.items, (-len(l.items), l.items)) AS items FROM g JOIN l ON l.item_id = g.item_id AND l.items[1:len(g.items)] = g.items GROUP BY g.item_id, g.items, g.n),
    c AS (SELECT item_id, items, sum(n)::BIGINT AS n FROM m GROUP BY 1, 2)
    SELECT item_id, items, n, n_documents FROM c JOIN t USING (item_id) WHERE 2 * n > n_documents
    """,
)
def order_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pdf_reports").where("item_kind = 'discussion_order'").select("report_id", "item_id", F.split(F.trim("label"), ">").alias("items")).distinct()
    return V.order_vote(rows, "item_id", "items")


@registry.query(
    "q_infer_for_votes",
    rf"""
    SELECT pdf_id, name, 'FOR' AS vote FROM (SELECT pdf_id, unnest(present_members) AS name, voters FROM (
      SELECT DISTINCT pdf_id, present_members, list_transform(coalesce(vote_details, []), lambda v: {_NAME.format('v.name')}) AS voters FROM raw_extractions
      WHERE (regexp_matches(replace(strip_accents(lower(vote_result)), 'ς', 'σ'), 'ομοφων|κατα\s+πλειοψηφι')) AND len(list_filter(coalesce(vote_details, []), lambda v: v.vote = 'FOR')) = 0 AND len(present_members) > 0))
    WHERE NOT list_contains(voters, {_NAME.format('name')})
    """,
)
def infer_for_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "raw_extractions").select("pdf_id", "present_members", "vote_result", "vote_details").distinct()
    return V.inferred_for_votes(rows, "pdf_id", "present_members", "vote_result", "vote_details")


@registry.query(
    "q_validate_rules",
    r"""
    WITH r AS (SELECT DISTINCT pdf_id, incomplete, decision_excerpt, decision_number, present_members, absent_members, vote_result, vote_details FROM raw_extractions)
    SELECT pdf_id, 'EXTRACTION_INCOMPLETE' AS code, 'error' AS severity FROM r WHERE coalesce(incomplete, false)
    UNION ALL SELECT pdf_id, 'EMPTY_EXCERPT', 'warning' FROM r WHERE coalesce(trim(decision_excerpt), '') = ''
    UNION ALL SELECT pdf_id, 'MISSING_DECISION_NUMBER', 'info' FROM r WHERE coalesce(decision_number, '') = ''
    UNION ALL SELECT pdf_id, 'NO_ATTENDANCE', 'warning' FROM r WHERE coalesce(len(present_members), 0) = 0 AND coalesce(len(absent_members), 0) = 0
    UNION ALL SELECT pdf_id, 'MISSING_VOTE_RESULT', 'warning' FROM r WHERE vote_result IS NULL AND regexp_matches(coalesce(decision_excerpt, ''), '(?i)ΑΠΟΦΑΣΙΖΕΙ')
    UNION ALL SELECT pdf_id, 'NO_VOTE_DETAILS', 'warning' FROM r WHERE regexp_matches(strip_accents(lower(vote_result)), 'κατα\s+πλειοψηφι') AND len(list_filter(coalesce(vote_details, []), lambda v: v.vote IN ('AGAINST', 'ABSTAIN', 'PRESENT', 'DID_NOT_VOTE'))) = 0
    """,
)
def validate_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "raw_extractions").select("pdf_id", "incomplete", "decision_excerpt", "decision_number", "present_members", "absent_members", "vote_result", "vote_details").distinct()
    return V.extraction_warnings(rows, "pdf_id")


@registry.query("q_present_from_absent", f"SELECT pdf_id, len(list_filter(present_members, lambda p: NOT list_contains(list_transform(absent_members, lambda a: {_NAME.format('a')}), {_NAME.format('p')}))) AS n_present FROM (SELECT DISTINCT pdf_id, coalesce(present_members, []) AS present_members, coalesce(absent_members, []) AS absent_members FROM raw_extractions)")
def present_from_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The composition less those who are absent, names compared in normal form."""
    empty = F.array().cast("array<string>")
    rows = table(spark, sf_dir, "raw_extractions").select("pdf_id", F.coalesce("present_members", empty).alias("p"), F.coalesce("absent_members", empty).alias("a")).distinct()
    gone = F.transform("a", X.normalize_name)
    return rows.withColumn("gone", gone).select("pdf_id", F.size(F.filter("p", lambda n: ~F.array_contains(F.col("gone"), X.normalize_name(n)))).cast("bigint").alias("n_present"))


@registry.query("q_subject_mismatch", "SELECT r.pdf_id, CASE WHEN r.i IS NULL THEN 'UNKNOWN' WHEN s.agenda_item_index IS NULL THEN 'NOT_ON_AGENDA' WHEN r.i = s.agenda_item_index THEN 'MATCH' ELSE 'MISMATCH' END AS verdict FROM (SELECT DISTINCT pdf_id, subject_id, subject_info.agenda_item_index AS i FROM raw_extractions) r LEFT JOIN (SELECT DISTINCT subject_id, agenda_item_index FROM match_subjects) s USING (subject_id)")
def subject_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "raw_extractions").select("pdf_id", "subject_id", F.col("subject_info.agenda_item_index").alias("i")).distinct()
    known = table(spark, sf_dir, "match_subjects").select("subject_id", "agenda_item_index").distinct()
    case = F.when(F.col("i").isNull(), "UNKNOWN").when(F.col("agenda_item_index").isNull(), "NOT_ON_AGENDA").when(F.col("i") == F.col("agenda_item_index"), "MATCH").otherwise("MISMATCH")
    return rows.join(known, "subject_id", "left").select("pdf_id", case.alias("verdict"))


_SUBJ = "(SELECT DISTINCT meeting_id, subject_id, ord, name, agenda_item_index, non_agenda_reason FROM match_subjects)"


def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "match_subjects").select("meeting_id", "subject_id", "ord", "name", "agenda_item_index", "non_agenda_reason").distinct()


@registry.query("q_missing_index_fill", f"SELECT subject_id, coalesce(agenda_item_index, coalesce(max(agenda_item_index) OVER (PARTITION BY meeting_id), 0) + sum(CASE WHEN agenda_item_index IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY meeting_id ORDER BY ord ROWS UNBOUNDED PRECEDING))::INT AS filled FROM {_SUBJ}")
def missing_index_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.fill_missing_index(subjects(spark, sf_dir), "meeting_id", "agenda_item_index", "ord").select("subject_id", "filled")


@registry.query("q_out_of_agenda_ordinal", f"SELECT subject_id, CASE WHEN non_agenda_reason = 'outOfAgenda' THEN sum(CASE WHEN non_agenda_reason = 'outOfAgenda' THEN 1 ELSE 0 END) OVER (PARTITION BY meeting_id ORDER BY ord ROWS UNBOUNDED PRECEDING) END::INT AS ordinal FROM {_SUBJ}")
def out_of_agenda_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = F.coalesce(F.col("non_agenda_reason") == "outOfAgenda", F.lit(False))
    w = Window.partitionBy("meeting_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    return subjects(spark, sf_dir).select("subject_id", F.when(out, F.sum(out.cast("int")).over(w)).cast("int").alias("ordinal"))


@registry.query("q_discussion_order", f"SELECT subject_id, row_number() OVER (PARTITION BY meeting_id ORDER BY CASE WHEN non_agenda_reason = 'outOfAgenda' THEN 0 ELSE 1 END, coalesce(agenda_item_index, 1000000), ord)::INT AS position FROM {_SUBJ}")
def discussion_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without an order of its own a meeting takes the items outside the agenda first, then the agenda."""
    bucket = F.when(F.coalesce(F.col("non_agenda_reason"), F.lit("")) == "outOfAgenda", 0).otherwise(1)
    w = Window.partitionBy("meeting_id").orderBy(bucket, F.coalesce("agenda_item_index", F.lit(1_000_000)), "ord")
    return subjects(spark, sf_dir).select("subject_id", F.row_number().over(w).alias("position"))


@registry.query("q_dict_roundtrip", "SELECT DISTINCT meeting_id, subject_id, substr(sha256(subject_id), 1, 12) AS short_id FROM match_subjects")
def dict_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "match_subjects").select("meeting_id", "subject_id").distinct()
    dictionary = M.short_ids(rows, "subject_id")
    short = M.encode(rows, "subject_id", dictionary).withColumn("short_id", F.col("subject_id"))
    return M.decode(short, "subject_id", dictionary)


@registry.query("q_subject_hash", f"SELECT subject_id, sha256(coalesce(name, '') || '' || coalesce(agenda_item_index::VARCHAR, 'NO_AGENDA')) AS hash FROM {_SUBJ}")
def subject_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects(spark, sf_dir).select("subject_id", N.subject_hash(F.col("name"), F.lit(""), F.col("agenda_item_index")).alias("hash"))


@registry.query("q_ref_links", f"SELECT subject_id, regexp_replace('βλ. [' || name || '](REF:SUBJECT:' || subject_id || ') του ' || meeting_id, '\\[([^\\]]*)\\]\\(REF:[A-Z]+:[^)]+\\)', '\\1', 'g') AS text FROM {_SUBJ}")
def ref_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = F.concat(F.lit("βλ. ["), "name", F.lit("](REF:SUBJECT:"), "subject_id", F.lit(") του "), "meeting_id")
    return subjects(spark, sf_dir).select("subject_id", X.clean_refs(linked).alias("text"))


@registry.query("q_sentence_ends", r"SELECT text, coalesce(regexp_matches(text, '[!?;\x{037E}]$') OR (text LIKE '%.' AND NOT (length(text) <= 3 OR lower(text[:-2]) IN ('δηλ', 'βλ', 'σελ', 'αριθ', 'κεφ', 'λεωφ', 'τηλ') OR regexp_full_match(text[:-2], '(\p{L}\.)+\p{L}{0,3}'))), false) AS ends FROM (SELECT DISTINCT text FROM asr_words WHERE word_type = 'word')")
def sentence_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "asr_words").where("word_type = 'word'").select("text").distinct()
    return words.select("text", F.coalesce(X.ends_sentence(F.col("text")), F.lit(False)).alias("ends"))


@registry.query(
    "q_greedy_batches",
    f"""
    WITH RECURSIVE s AS (SELECT meeting_id, subject_id, length(CASE WHEN name IS NULL THEN to_json({{'subject_id': subject_id}}) ELSE to_json({{'subject_id': subject_id, 'name': name}}) END::VARCHAR) AS size, row_number() OVER (PARTITION BY meeting_id ORDER BY ord) AS rn FROM {_SUBJ}),
    b AS (SELECT meeting_id, rn, size AS used, 0 AS batch FROM s WHERE rn = 1
      UNION ALL SELECT s.meeting_id, s.rn, CASE WHEN b.used + s.size > 500 THEN s.size ELSE b.used + s.size END, CASE WHEN b.used + s.size > 500 THEN b.batch + 1 ELSE b.batch END FROM b JOIN s ON s.meeting_id = b.meeting_id AND s.rn = b.rn + 1)
    SELECT meeting_id, subject_id, batch FROM b JOIN s USING (meeting_id, rn)
    """,
)
def greedy_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects of a meeting in batches of 500 characters of JSON, in order."""
    rows = subjects(spark, sf_dir)
    return S.greedy_batches(rows, "meeting_id", "ord", F.length(F.to_json(F.struct("subject_id", "name"))), 500).select("meeting_id", "subject_id", "batch")
