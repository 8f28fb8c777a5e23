import pytest
from pyspark.sql import functions as F

from praktika.operators import records as R


def test_accept_chain(spark):
    m = spark.createDataFrame([(0, "s1", "a", "high", ""), (1, "s2", "a", "medium", ""), (2, "s3", "b", "low", ""), (3, "s4", "zz", "high", ""), (4, "s5", "b", "medium", "no"), (5, "s6", "b", "medium", "")], "o int, s string, k string, c string, why string")
    known = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    got = {r.s: (r.score, r.reason) for r in R.accept_matches(m, known, "s", "k", "c", "o", F.col("why") == "no").collect()}
    assert got == {"s1": (0.9, None), "s2": (None, "DUPLICATE"), "s3": (None, "LOW_CONFIDENCE"), "s4": (None, "UNKNOWN"), "s5": (None, "CONTRADICTION"), "s6": (0.7, None)}


@pytest.mark.parametrize("text,want", [("1. α\n2. β", ["α", "β"]), ("1. α\nσυνέχεια\n2. β", ["α συνέχεια", "β"]), ("1. α\n2.5 μ", ["α 2.5 μ"]), ("α\n1. β", None), ("1. α\n3. β", None), ("", None), (None, None)])
def test_numbered_lines(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(R.numbered_lines(F.col("t"))).first()[0] == want


def test_word_diff(spark):
    assert R.word_diff("το έργο α λήγει", "το έργο β λήγει σήμερα") == [("=", "το έργο"), ("-", "α"), ("+", "β"), ("=", "λήγει"), ("+", "σήμερα")]
    assert R.word_diff("α β", "α β") == [("=", "α β")] and R.word_diff(None, "") == [] and R.word_diff("α α", "α") == [("=", "α"), ("-", "α")]
    got = spark.createDataFrame([("α β", "α γ")], "a string, b string").select(R.diff_column(F.col("a"), F.col("b"))).first()[0]
    assert [tuple(x) for x in got] == [("=", "α"), ("-", "β"), ("+", "γ")]


def test_links_and_texts(spark):
    df = spark.createDataFrame([(1, "[α](REF:P:s1), [β](REF:P:zz)[γ](REF:Q:s2)"), (2, "κανένα"), (3, "")], "k int, t string")
    d = spark.createDataFrame([("s1", "long1"), ("s2", "long2")], "short_id string, long_id string")
    assert {r.k: r.t for r in R.rewrite_links(df, "k", "t", d).collect()} == {1: "[α](REF:P:long1), [β](REF:P:zz)[γ](REF:Q:long2)", 2: "κανένα", 3: ""}
    one = spark.createDataFrame([("Κείμενο.\n\n**Πηγές**\n- a", 30)], "t string, h int")
    row = one.select(R.without_sources(F.col("t")), R.nearest_preset(F.col("h"), {"low": 20, "high": 40})).first()
    assert tuple(row) == ("Κείμενο.", "high")


def test_errors_by_the_first_cause_that_tells(spark):
    chains = [
        [("APIConnectionError", None, "x")],
        [("Error", None, "HTTP 503 network"), ("InternalServerError", None, "x")],
        [("APIError", "overloaded_error", "x")],
        [("ServiceError", None, "x"), ("TypeError", None, "terminated")],
        [("Error", None, "network"), ("Error", None, "500")],
        [],
        None,
    ]
    df = spark.createDataFrame([(k, c) for k, c in enumerate(chains)], "k int, c array<struct<kind: string, inner: string, message: string>>")
    assert [r[0] for r in df.orderBy("k").select(R.error_class(F.col("c"))).collect()] == ["connection", "server", "server", "connection", "none", "none", "none"]


def test_pointing(spark):
    subjects = spark.createDataFrame([("a", None), ("b", "a"), ("c", "zz")], "s string, p string")
    states = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "u int, s string")
    assert {r.u: r.s for r in R.point_to_primary(states, subjects, "s", "p").collect()} == {1: "a", 2: "a", 3: "c", 4: None}
    before = spark.createDataFrame([("a", "x"), ("b", None)], "s string, v string")
    now = spark.createDataFrame([("a", "y"), ("b", "z"), ("c", "w")], "s string, v string")
    assert {r.s: r.v for r in R.keep_previous(now, before, "s", "v").collect()} == {"a": "x", "b": "z", "c": "w"}
    pool = R.candidate_pool(states.select("u", F.col("s").alias("k")).where("k is not null"), spark.createDataFrame([(1, "a"), (1, "q")], "u int, k string"), "u", "k")
    assert {(r.u, r.k, r.is_gap) for r in pool.collect()} == {(1, "a", False), (2, "b", False), (3, "c", False), (1, "q", True)}
