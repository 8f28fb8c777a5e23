import random

import pytest
from pyspark.sql import functions as F

from praktika.operators import diff as D
from praktika.operators import matching as M
from praktika.operators import timelines as T
from praktika.operators import votes as V


def spans(rnd, n, m="m"):
    return [(m, i, rnd.choice("xy"), float(s := rnd.randrange(200)), float(s + rnd.randrange(1, 30))) for i in range(n)]


def frames(spark, seed):
    rnd = random.Random(seed)
    seg = spans(rnd, 30)
    items = [(m, f"u{i}", s, e) for m, i, _, s, e in spans(rnd, 25)]
    return seg, items, spark.createDataFrame(seg, "m string, ord int, speaker string, a double, b double"), spark.createDataFrame(items, "m string, u string, s double, e double")


@pytest.mark.parametrize("width", [3.0, 60.0])
def test_interval_joins(spark, width):
    seg, items, sdf, idf = frames(spark, 3)
    want = {(u, i) for _, u, s, e in items for _, i, _, a, b in seg if a <= e and b >= s}
    got = [(r.u, r.ord) for r in T.overlap_join(idf, sdf, "m", ("s", "e"), ("a", "b"), width).collect()]
    assert len(got) == len(want) and set(got) == want
    want = {(u, i) for _, u, s, e in items for _, i, _, a, b in seg if a <= s and b >= e}
    got = [(r.u, r.ord) for r in T.contained_join(idf, sdf, "m", ("s", "e"), ("a", "b"), width).collect()]
    assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("seed", range(4))
def test_nearest_segment_follows_the_scan(spark, seed):
    seg, items, sdf, idf = frames(spark, seed)
    want = set()
    for _, u, s, e in items:
        for who in "xy":
            own = [(a, b) for _, _, w, a, b in seg if w == who]
            if not any(a <= e and b >= s for a, b in own):
                continue
            best = own[0]
            for a, b in own[1:]:
                if a <= s and b >= e:
                    best = (a, b)
                elif abs(a - s) + abs(b - e) < abs(best[0] - s) + abs(best[1] - e):
                    best = (a, b)
            want.add((u, who, *best))
    got = {(r.u, r.speaker, r.a, r.b) for r in T.nearest_segment(idf, sdf, "m", "u", ("s", "e"), ("a", "b"), "ord", 7.0).collect()}
    assert got == want


def test_bridge_merge_line_silence(spark):
    df = spark.createDataFrame([("p", 0, 0.0, 3.0), ("p", 1, 4.0, 7.0), ("p", 2, 17.0, 20.0)], "k string, o int, s double, e double")
    assert [r.bridged_end for r in T.bridge_gaps(df, "k", ["o"], "s", "e").orderBy("o").collect()] == [4.0, 7.0, 20.0]
    assert [r.normalized_start for r in T.on_one_line(df, "k", ["o"], "s", "e").orderBy("o").collect()] == [0.0, 3.0, 6.0]
    close = spark.createDataFrame([("p", 0, 0.0, 4.0), ("p", 1, 4.0, 8.0), ("p", 2, 8.0005, 11.0), ("p", 3, 12.0, 13.0)], "k string, o int, s double, e double")
    assert [(r.start, r.end) for r in T.merge_touching(close, "k", ["o"], "s", "e").orderBy("start").collect()] == [(0.0, 11.0), (12.0, 13.0)]
    bounds = spark.createDataFrame([("p", 0.0, 30.0)], "k string, lo double, hi double")
    got = {(r["from"], r.to) for r in T.silences(df, "k", ["s", "o"], "s", "e", bounds, "lo", "hi").collect()}
    assert got == {(3.0, 4.0), (7.0, 17.0), (20.0, 30.0)}


def test_split_at_silences(spark):
    rows = [("m", float(s), float(s + 50)) for s in range(0, 600, 60)]
    got = sorted((r.start, r.end) for r in T.split_at_silences(spark.createDataFrame(rows, "m string, a double, b double"), "m", "a", "b", 200.0).collect())
    assert got[0][0] == 0.0 and got[-1][1] == 590.0 and all(e - s <= 200 for s, e in got) and all(x[1] == y[0] for x, y in zip(got, got[1:]))
    # one who never pauses: nothing is lost, and what could not be cut says so
    rows = [("m", 0.0, 190.0), ("m", 190.9, 700.0), ("m", 700.0, 900.0)]
    got = [(r.start, r.end, r.uncut) for r in T.split_at_silences(spark.createDataFrame(rows, "m string, a double, b double"), "m", "a", "b", 200.0).orderBy("part").collect()]
    assert got[0][0] == 0.0 and got[-1][1] == 900.0 and [u for *_, u in got] == [False] * (len(got) - 1) + [got[-1][1] - got[-1][0] > 200]


@pytest.mark.parametrize("seed", range(3))
def test_interval_joins_with_very_long_intervals(spark, seed):
    rnd = random.Random(seed)
    span = lambda: (s := rnd.uniform(0, 40_000), s + rnd.choice([0, 1, 30, 500, 5_000, 3e8]) * rnd.random())
    a, b = ([(i, "k", *span()) for i in range(120)] for _ in range(2))
    left, right = spark.createDataFrame(a, "i int, k string, s double, e double"), spark.createDataFrame(b, "j int, k string, x double, y double")
    want = sorted((i, j) for i, _, s, e in a for j, _, x, y in b if x <= e and y >= s)
    assert sorted((r.i, r.j) for r in T.overlap_join(left, right, "k", ("s", "e"), ("x", "y")).collect()) == want
    want = sorted((i, j) for i, _, s, e in a for j, _, x, y in b if x <= s and y >= e)
    assert sorted((r.i, r.j) for r in T.contained_join(left, right, "k", ("s", "e"), ("x", "y")).collect()) == want


def present(spark, events, position, positions=(1, 2, 3, 4, 5)):
    people = spark.createDataFrame([("m", n, n in ("Alice", "Bob", "Charlie")) for n in ("Alice", "Bob", "Charlie", "Diana", "Eve")], "meeting_id string, name string, present boolean")
    ev = spark.createDataFrame([("m", *e, i) for i, e in enumerate(events)], "meeting_id string, name string, change_type string, position int, timing string, ord int")
    pos = spark.createDataFrame([("m", p) for p in positions], "meeting_id string, position int")
    return {r.name for r in T.attendance_at(people, ev, pos).where(F.col("position") == position).collect() if r.present}


def test_attendance(spark):
    base = {"Alice", "Bob", "Charlie"}
    assert present(spark, [], 3) == base
    assert present(spark, [("Diana", "arrival", None, None)], 1) == base | {"Diana"}
    during = [("Diana", "arrival", 3, "during"), ("Bob", "departure", 4, "after"), ("Eve", "arrival", 2, None), ("Alice", "departure", None, None)]
    assert present(spark, during, 2) == base and present(spark, during, 3) == base | {"Diana"} and present(spark, during, 5) == {"Alice", "Charlie", "Diana"}


def test_votes(spark):
    calls = spark.createDataFrame([("m", i, p, a, y) for i, (p, a, y) in enumerate([(["x", "y"], ["z"], True), (["y", "x"], ["z"], True), (["x"], ["z"], True), (None, [], None)])], "m string, o int, p array<string>, a array<string>, y boolean")
    got = V.majority_roll_call(calls, "m", "p", "a", "y", "o").collect()
    assert [(r.n, r.n_documents, r.first_ord) for r in got] == [(2, 3, 0)]
    orders = [([1, 2], "a"), ([1, 2, 3], "a"), ([1, 2], "a"), (None, "a"), ([3], "a"), ([1], "b"), (None, "b"), (None, "b")]
    df = spark.createDataFrame([(k, o) for o, k in orders], "k string, o array<int>")
    assert [(r.k, r.o, r.n) for r in V.order_vote(df, "k", "o").collect()] == [("a", [1, 2, 3], 3)]
    votes = spark.createDataFrame(
        [("d1", ["Αλίκη", "Βάσω", "Γιώργος"], "Κατά πλειοψηφία", [("ΓΙΩΡΓΟΣ", "AGAINST")]), ("d2", ["Α", "Β"], "Κατά πλειοψηφία", [("Α", "FOR")]), ("d3", ["Α"], "ΟΜΟΦΩΝΑ", None), ("d4", ["Α"], None, None), ("d5", None, "ομόφωνα", [])],
        "d string, p array<string>, r string, v array<struct<name: string, vote: string>>",
    )
    assert {(r.d, r.name) for r in V.inferred_for_votes(votes, "d", "p", "r", "v").collect()} == {("d1", "Αλίκη"), ("d1", "Βάσω"), ("d3", "Α")}


def test_consensus_changes(spark):
    rows = [("m", "A", "during"), ("m", "A", None), ("m", "B", "after"), ("m", "B", "during"), ("m", "B", "after"), ("m", "C", None)]
    changes = spark.createDataFrame(rows, "m string, n string, t string")
    docs = spark.createDataFrame([("m", 3)], "m string, c bigint")
    assert {(r.n, r.best_timing, r.n_reports) for r in V.consensus_changes(changes, "m", ["n"], "t", docs, "c").collect()} == {("A", "during", 2), ("B", "after", 3)}


def test_names_dictionary_and_chains(spark):
    people = spark.createDataFrame([("c", "p1", 0, "Ευθύμιος Μπαρμπέρης"), ("c", "p2", 1, "Μπαρμπέρης Ευθύμιος"), ("c", "p3", 2, "Ευανθία Καμινάρη")], "c string, id string, o int, name string")
    raw = spark.createDataFrame([("c", "ΜΠΑΡΜΠΕΡΗΣ ΕΥΘΥΜΙΟΣ"), ("c", "ΚΑΜΙΝΑΡΗ ΕΥΑΝΘΙΑ"), ("c", "ΑΓΝΩΣΤΟΣ")], "c string, n string")
    first = {r.n: r.person_id for r in M.match_names(raw, people, "c", "n", "id", "name", "o").collect()}
    last = {r.n: r.person_id for r in M.match_names(raw, people, "c", "n", "id", "name", "o", last=True).collect()}
    assert first == {"ΜΠΑΡΜΠΕΡΗΣ ΕΥΘΥΜΙΟΣ": "p1", "ΚΑΜΙΝΑΡΗ ΕΥΑΝΘΙΑ": "p3"} and last["ΜΠΑΡΜΠΕΡΗΣ ΕΥΘΥΜΙΟΣ"] == "p2"
    ids = M.short_ids(people, "id")
    assert {r.id for r in M.decode(M.encode(people, "id", ids), "id", ids).collect()} == {"p1", "p2", "p3"}
    chains = spark.createDataFrame([(i, i - 1) for i in range(1, 40)] + [(50, 51), (51, 50)], "a int, b int")
    ends = {r.a: r.b for r in M.resolve_chains(chains, "a", "b").collect()}
    assert all(ends[i] == 0 for i in range(1, 40)) and set(ends) == set(range(1, 40)) | {50, 51}


def test_greedy_name_pairs(spark):
    s = "g string, i string, o int, n string"
    a = spark.createDataFrame([("g", "a1", 0, "Ανακοίνωση για το έργο Α"), ("g", "a2", 1, "Ανακοίνωση για το έργο Β"), ("g", "a3", 2, "")], s)
    b = spark.createDataFrame([("g", "b1", 0, "Ανακοίνωση για το έργο Β"), ("g", "b2", 1, "Άλλο")], s)
    assert [(r.a_id, r.b_id) for r in D.match_leftovers(a, b, "g", "n", "o", "i").collect()] == [("a1", "b1")]


def test_neighbours_over_chunks(spark, monkeypatch):
    from praktika.operators import chunks

    monkeypatch.setattr(chunks, "CHUNK_POSITIONS", 3)
    rnd = random.Random(1)
    rows = [(k, i, rnd.choice(["x", "y", None]), float(i), i + rnd.choice([0.5, 1.0, 0.2])) for k in ("a", None) for i in range(40) if rnd.random() < 0.8]
    df = spark.createDataFrame(rows, "k string, o int, v string, s double, e double")
    want, line, bridged = set(), {}, {}
    for k in ("a", None):
        own = [r for r in rows if r[0] == k]
        total = 0.0
        for n, r in enumerate(own):
            if n == 0 or own[n - 1][2] != r[2]:
                want.add((k, r[1]))
            line[k, r[1]] = round(total, 6)
            total += r[4] - r[3]
            after = own[n + 1][3] if n + 1 < len(own) else None
            bridged[k, r[1]] = after if after is not None and 0 < after - r[4] <= 2 else r[4]
    got = T.changes_of(df, "k", ["o"], "v").collect()
    assert {(r.k, r.o) for r in got} == want and len(got) == len(want)
    assert {(r.k, r.o): round(r.normalized_start, 6) for r in T.on_one_line(df, "k", ["o"], "s", "e").collect()} == line
    assert {(r.k, r.o): r.bridged_end for r in T.bridge_gaps(df, "k", ["o"], "s", "e").collect()} == bridged
