from pyspark.sql import functions as F

from praktika.operators import projections as P


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_places(spark):
    got = values(spark, P.split_index(F.col("i")), [("3",), ("OUT_OF_AGENDA",), ("BEFORE_AGENDA",), (None,)], "i string")
    assert [tuple(r) for r in got] == [(3, None), (None, "outOfAgenda"), (None, "beforeAgenda"), (None, "beforeAgenda")]
    df = spark.createDataFrame([("2", None, "d", None, "", None)], "idx string, name string, description string, withdrawn boolean, topic_importance string, proximity_importance string")
    r = P.subject_view(df, "idx", "name", "description").first()
    assert (r.agenda_item_index, r.type, r.name, r.withdrawn, r.topic_importance, r.proximity_importance) == (2, "IN_AGENDA", "", False, "normal", "none")


def test_predicates(spark):
    assert values(spark, P.tag(F.col("t"), "meeting"), [(["a:b", "meeting:m1", "meeting:m2"],), ([],), (None,)], "t array<string>") == ["m1", None, None]
    assert values(spark, P.too_quiet_or_loud(F.col("x")), [("-14.5",), ("-23",), ("-inf",), ("x",), (None,)], "x string") == [False, True, True, True, True]
    assert values(spark, P.voice_known(F.col("m"), F.col("c")), [("a", {"a": 50.0}), ("b", {"a": 50.0}), (None, {"a": 90.0}), ("a", {"a": 49.0})], "m string, c map<string, double>") == [True, False, False, False]
    assert values(spark, P.is_municipality(F.col("l")), [("ΔΗΜΟΣ ΧΙΟΥ",), ("δημος-χιου",), ("Δήμος Χίου",), ("Περιφέρεια Αττικής",), ("Δ. Χίου",), ("ΔΗΜΟΣΙΑ ΥΠΗΡΕΣΙΑ",)], "l string") == [True, True, False, False, False, False]
    units = ["Δημοτικο Συμβουλιο Χιου", "Δ.Σ. ΔΗΜΟΥ ΧΙΟΥ", "ΔΣ ΔΗΜΟΥ", "ΤΟ Δ.Σ. ΔΗΜΟΥ", "οικονομικη επιτροπη", "ΕΠΙΤΡΟΠΗ ΠΟΙΟΤΗΤΑΣ ΖΩΗΣ", "ΔΗΜΑΡΧΟΥ", "ΑΝΤΙΔΗΜΑΡΧΟΣ ΚΑΘΑΡΙΟΤΗΤΑΣ", "ΤΜΗΜΑ ΕΣΟΔΩΝ"]
    assert values(spark, P.is_council_unit(F.col("l")), [(u,) for u in units], "l string") == [True, True, True, False, True, True, True, False, False]
    assert values(spark, P.label_contains(F.col("l"), F.col("x"), "Χίου"), [("ΔΗΜΟΣ ΧΙΟΥ", None), (None, "chios")], "l string, x string") == [True, False]
    assert values(spark, P.is_public(F.col("p"), ["/docs", "/health"]), [("/docs",), ("/docs/a",), ("/docsx",)], "p string") == [True, True, False]
    assert values(spark, P.is_prefix(F.col("a"), F.col("b")), [([1], [1, 2]), ([2], [1, 2]), ([], [1]), ([1, 2], [1])], "a array<int>, b array<int>") == [True, False, True, False]
    assert values(spark, P.escape_filter_text(F.col("t")), [("a:b'c",), ('[x], "50%"; \\',)], "t string") == ["a\\:b’c", '\\[x\\]\\, "50\\%"\\; \\\\']
    assert values(spark, P.fitting_size(F.col("n"), 100.0, 40, 10), [(4,), (10,), (1000,)], "n int") == [40, 16, 10]
    assert values(spark, P.bullet_list(F.col("a")), [(["x", "y"],)], "a array<string>") == ["- x\n- y"]
    assert values(spark, P.display_name(F.col("n")), [("",), ("Α",), (None,)], "n string") == ["Unknown Speaker", "Α", "Unknown Speaker"]


def test_tables(spark):
    front = spark.createDataFrame([(1, ["a"], "x"), (2, ["b"], None)], "k int, l array<string>, s string")
    tail = spark.createDataFrame([(1, [], "y"), (2, ["c"], "z")], "k int, l array<string>, s string")
    assert {r.k: (r.l, r.s) for r in P.merge_parts(front, tail, "k", ["l"], ["s"]).collect()} == {1: (["a"], "y"), 2: (["c"], "z")}
    df = spark.createDataFrame([("x" * 600, [1, 2], 5)], "t string, a array<int>, n int")
    r = P.input_summary(df).first()
    assert (len(r.t), r.tLength, r.aCount, r.n) == (500, 600, 2, 5)
    s = "m string, seg string, o int, summary string, type string"
    a = spark.createDataFrame([("m", "1", 0, "α", "PROCEDURAL"), ("m", "2", 1, "β", "SUBSTANTIAL")], s)
    b = spark.createDataFrame([("m", "1", 0, "x", "PROCEDURAL"), ("m", "1", 1, "α", "PROCEDURAL"), ("m", "2", 1, "γ", "SUBSTANTIAL")], s)
    assert [(r.seg, r.substantial) for r in P.changed_segments(a, b, "m", "seg", "o").collect()] == [("2", True)]
    load = spark.createDataFrame([(0, 5), (0, 5), (1, 10), (2, 3)], "b int, n int")
    assert {(r.b, r.used, r.is_fullest) for r in P.batch_load(load, "b", "n", 20).collect()} == {(0, 10, True), (1, 10, False), (2, 3, False)}
    assert [r.l for r in P.by_greek_order(spark.createDataFrame([("Ωμέγα",), ("Άλφα",), ("Βήτα",)], "l string"), "l").collect()] == ["Άλφα", "Βήτα", "Ωμέγα"]


def test_small_rules(spark):
    df = spark.createDataFrame([(1, None, None, " ", "a"), (2, "d", True, "x", None), (3, "d", None, None, "b")], "k int, d string, e boolean, t string, kind string")
    assert [r[0] for r in df.orderBy("k").select(P.linking_state(F.col("d"), F.col("e"))).collect()] == ["unlinked", "linked", "needs_extraction"]
    assert [r.k for r in P.with_text(df, "t").collect()] == [2] and {r.k for r in P.without_kinds(df, "kind", ["a"]).collect()} == {2, 3}
    assert values(spark, P.paired(F.col("a"), F.col("b")), [([1, 2, 3], [4, 5])], "a array<int>, b array<int>") == [[(1, 4), (2, 5), (3, None)]]
    assert str(spark.range(1).select(P.months_before(F.lit("2024-05-31").cast("date"))).first()[0]) == "2024-02-29"
    settings = spark.createDataFrame([("el", "Greek"), ("fr", "French")], "code string, name string")
    rows = spark.createDataFrame([(1, "fr"), (2, None), (3, "xx")], "k int, lang string")
    assert {r.k: r.name for r in P.with_settings(rows, "lang", settings, "el").collect()} == {1: "French", 2: "Greek", 3: "Greek"}
    usage = spark.createDataFrame([("p", 0, ""), ("p", 1, "batch"), ("p", 2, "x"), ("q", 0, None)], "p string, o int, tier string")
    assert {r.p: r.t for r in usage.groupBy("p").agg(P.first_filled("tier", "o").alias("t")).collect()} == {"p": "batch", "q": None}
    asked = spark.createDataFrame([("m", "c", 0), ("m", "a", 1), ("m", "b", 2)], "m string, s string, o int")
    seen = spark.createDataFrame([("m", "b", 5), ("m", "a", 9), ("m", "b", 11)], "m string, s string, o int")
    assert [r.s for r in P.unknown_last(asked, "m", "s", seen, "o").orderBy("position").collect()] == ["b", "a", "c"]
