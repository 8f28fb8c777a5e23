import pytest
from pyspark.sql import functions as F

from praktika.operators import meetings as G
from praktika.operators import timelines as T

REFS = "m string, item_index int, reason string"


def order(spark, explicit, subjects):
    said = spark.createDataFrame([("m", p, *e) for p, e in enumerate(explicit)], "m string, position int, item_index int, reason string")
    got = G.complete_order(spark.createDataFrame([("m", *s) for s in subjects], REFS), said, "m").orderBy("position").collect()
    assert [r.position for r in got] == list(range(len(got)))
    return [("OA" if r.reason == "outOfAgenda" else "") + str(r.item_index) for r in got]


ITEMS = [(i, None) for i in (3, 1, 2, 4)] + [(2, "outOfAgenda"), (1, "outOfAgenda"), (None, "beforeAgenda")]


def test_order_of_discussion(spark):
    assert order(spark, [], ITEMS) == ["OA1", "OA2", "1", "2", "3", "4"]
    assert order(spark, [(1, None), (1, "outOfAgenda"), (4, None)], ITEMS) == ["1", "OA1", "4", "OA2", "2", "3"]
    assert order(spark, [(9, None)], ITEMS[:2]) == ["9", "1", "3"] and order(spark, [], []) == []


def test_attendance_follows_the_order_and_not_the_numbers(spark):
    said = spark.createDataFrame([("m", p, i, "") for p, i in enumerate((5, 2, 7, 1))], "meeting_id string, position int, item_index int, reason string")
    changes = spark.createDataFrame([("m", "a", "departure", 2, None, "after", 1), ("m", "b", "arrival", 7, None, "during", 2), ("m", "c", "arrival", 3, None, "during", 3), ("m", "d", "arrival", None, None, None, 4)], "meeting_id string, name string, change_type string, item_index int, reason string, timing string, ord int")
    people = spark.createDataFrame([("m", n, n == "a") for n in "abcd"], "meeting_id string, name string, present boolean")
    events = G.placed_changes(changes, said, "meeting_id")
    got = {(r.name, r.position) for r in T.attendance_at(people, events, said.select("meeting_id", "position")).where("present").collect()}
    assert got == {("a", 0), ("a", 1), ("b", 2), ("b", 3), *(("d", p) for p in range(4))}


def test_second_stage_takes_free_people_only(spark):
    left = spark.createDataFrame([("c", "x"), ("c", "y")], "city string, name string")
    free = spark.createDataFrame([("c", "p1"), ("c", "p2")], "city string, id string")
    asked = spark.createDataFrame([("c", "x", "p9", 0), ("c", "x", "p2", 2), ("c", "x", "p1", 1), ("c", "z", "p1", 0), ("d", "y", "p1", 0)], "city string, name string, id string, o int")
    assert [tuple(r) for r in G.second_stage(left, free, asked, "city", "name", "id", "o").collect()] == [("c", "x", "p1")]


def version(**changed):
    base = {"name": "n", "topic": "t", "withdrawn": False, "topic_importance": "normal", "proximity_importance": "none", "context": None, "description": "δέκα γράμμ", "contributions": {"s1": "x"}, "utterances": 10}
    return base | changed


@pytest.mark.parametrize(
    "changed,verdict,changes",
    [
        ({}, "identical", []),
        ({"name": "other", "topic_importance": "high", "proximity_importance": "near", "context": "c"}, "cosmetic", ["name", "topicImportance", "proximityImportance", "context"]),
        ({"description": "[δέκα](REF:PERSON:1) γράμμ"}, "identical", []),
        ({"description": "δέκα γράμμα!"}, "cosmetic", ["description"]),
        ({"description": "δέκα γράμματα"}, "cosmetic", ["description"]),
        ({"description": "δέκα γράμματα !"}, "structural", ["description"]),
        ({"topic": "u"}, "structural", ["topic"]),
        ({"withdrawn": True}, "structural", ["withdrawn"]),
        ({"contributions": {"s1": "x", "s2": "y"}}, "structural", ["speakers added"]),
        ({"contributions": None}, "structural", ["speakers removed"]),
        ({"contributions": {"s1": "z"}}, "cosmetic", ["contributions"]),
        ({"utterances": 12}, "cosmetic", ["utterances"]),
        ({"utterances": 13}, "structural", ["utterances"]),
    ],
)
def test_verdict_by_every_criterion(spark, changed, verdict, changes):
    kinds = "name string, topic string, withdrawn boolean, topic_importance string, proximity_importance string, context string, description string, contributions map<string,string>, utterances int"
    schema = ", ".join(f"{p}_{c}" for p in "ab" for c in kinds.split(", "))
    df = spark.createDataFrame([tuple(version().values()) + tuple(version(**changed).values())], schema)
    found = df.select(*[c.alias(n) for c, n in zip(G.subject_verdict(), ("v", "c"))]).first()
    assert (found.v, found.c) == (verdict, changes)


@pytest.mark.parametrize("n,m,want", [(3, 20, 10), (20, 5, 10), (4, 2, 6), (0, 25, 10), (9, 40, 10)])
def test_samples_are_substantial_first(spark, n, m, want):
    rows = [("k", i, True) for i in range(n)] + [("k", 100 + i, False) for i in range(m)]
    got = G.segment_samples(spark.createDataFrame(rows, "k string, o int, substantial boolean"), "k", "o").collect()
    assert len(got) == want and sum(r.substantial for r in got) == min(n, 10)
    others = sorted(r.o for r in got if not r.substantial)
    k = 10 - min(n, 10)
    assert others == ([100 + i for i in range(m)] if m <= k else [100] if k == 1 else sorted({100 + int(i * (m - 1) / (k - 1) + 0.5) for i in range(k)}) if k > 1 else [])


def test_runs_that_cannot_be_compared(spark):
    rows = [(None,), ("",), ("[1]",), ('{"error":"x"}',), ('{"error":"x","subjects":[]}',), ('{"resultTruncated":true,"subjects":[]}',), ('{"a":1}',), ('{"subjects":[]}',)]
    got = [r[0] for r in spark.createDataFrame(rows, "o string").select(G.rejected(F.col("o"))).collect()]
    assert got == ["NO_OUTPUT", "NO_OUTPUT", "NO_OUTPUT", "FAILED", None, "TRUNCATED", "NOT_COMPARABLE", None]


def test_lines_of_a_run(spark):
    rows = [("r", "s2", None, "SPAN", 5), ("r", "s1", None, "SPAN", 1), ("r", "g2", "s1", "GENERATION", 3), ("r", "g1", "s1", "GENERATION", 2), ("r", "g0", None, "GENERATION", 0), ("r", "e", None, "EVENT", 0), ("r", "gx", "g1", "GENERATION", 9), ("r", "g3", "s2", "GENERATION", None)]
    got = G.span_lines(spark.createDataFrame(rows, "run string, id string, parent string, kind string, start int"), "run").orderBy("line").collect()
    assert [(r.id, r.depth) for r in got] == [("s1", 0), ("g1", 1), ("g2", 1), ("s2", 0), ("g3", 1), ("g0", 0), ("e", 0)]


def test_small_rules(spark):
    rows = [("m", None, "B", 1), ("m", "p1", "A", 2), ("m", None, "B", 3), ("m", "p1", "C", 4), ("m", None, None, 0)]
    got = G.numbered_speakers(spark.createDataFrame(rows, "m string, match string, speaker string, o int"), "m", "match", "speaker", "o").collect()
    assert {(r.speaker_key, r.speaker_no) for r in got} == {("B", 1), ("p1", 2)}
    results = spark.createDataFrame([("d1", None, "", "7"), ("d2", "x", "ok", "")], "id string, excerpt string, vote_result string, protocol_number string")
    known = spark.createDataFrame([("d1", "t", "2024-01-01", "9/2024"), ("d2", "u", None, "")], "id string, title string, publish_date string, protocol_number string")
    assert [tuple(r) for r in G.decision_result(results).orderBy("id").collect()] == [("d1", "", None, "7"), ("d2", "x", "ok", None)]
    assert [(r.protocol_number, r.register_title) for r in G.overlay(results, known, "id").orderBy("id").collect()] == [("9/2024", "t"), ("", "u")]
    df = spark.createDataFrame([("ell", 961.0, 2), ("fra", 960.0, 2), ("deu", 9000.0, 1)], "c string, d double, n int")
    assert [tuple(r) for r in df.select(G.language_code(F.col("c")), G.wrong_recording(F.col("d"), F.col("n"))).collect()] == [("el", True), ("fr", False), ("deu", False)]
    batches = [spark.createDataFrame(rows, "id string, v string, o int") for rows in ([("a", "1", 0), ("b", "1", 1)], [("a", "2", 0), ("c", "1", 1)])]
    assert {(r.id, r.v, r.batch) for r in G.carried_state(batches, "id", "o").collect()} == {("a", "2", 1), ("b", "1", 0), ("c", "1", 1)}
