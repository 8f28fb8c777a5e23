import random

import pytest
from pyspark.sql import functions as F

from praktika.operators import sequence as S


def runs(spark, numbers):
    df = spark.createDataFrame([("k", n) for n in numbers], "k string, n string")
    got = S.protocol_pattern(df, "k", "n").collect()
    return sorted(r.num for r in got if r.in_run), sorted(r.num for r in got if not r.in_run), {(r.prefix, r.suffix) for r in got}


def test_protocol_runs(spark):
    assert runs(spark, ["595/2025", "596/2025", "597/2025"]) == ([595, 596, 597], [], {("", "/2025")})
    assert runs(spark, ["ΑΔΣ 5/2026", "ΑΔΣ 6/2026", "ΑΔΣ 7/2026"])[2] == {("ΑΔΣ ", "/2026")}
    assert runs(spark, ["10/2025", "11/2025", "12/2025", "50/2025"])[:2] == ([10, 11, 12], [50])
    assert runs(spark, ["1/2025", "2/2026", "3/2025"]) == ([], [], set())
    assert runs(spark, ["1/2025", "2/2025"]) == ([], [], set())


def gaps(spark, numbers):
    df = spark.createDataFrame([("k", n) for n in numbers], "k string, n bigint")
    return sorted(r.missing for r in S.missing_numbers(df, "k", "n").collect())


def test_missing_numbers(spark):
    assert gaps(spark, [1, 3, 5, 7]) == [2, 4, 6]
    assert gaps(spark, [1, 2, 3, 5, 10]) == []
    assert gaps(spark, [3, 1, 1]) == [2] and gaps(spark, [4]) == []


def test_fill_missing_index(spark):
    df = spark.createDataFrame([("m", 1, 2), ("m", 2, None), ("m", 3, 1), ("m", 4, None), ("n", 1, None)], "m string, ord int, i int")
    assert [r.filled for r in S.fill_missing_index(df, "m", "i", "ord").orderBy("m", "ord").collect()] == [2, 3, 1, 4, 1]


@pytest.mark.parametrize("n,k", [(3, 10), (12, 10), (25, 7), (40, 1), (11, 2)])
def test_even_sample(spark, n, k):
    want = list(range(n)) if n <= k else [0] if k == 1 else sorted({int(i * (n - 1) / (k - 1) + 0.5) for i in range(k)})
    df = spark.createDataFrame([("m", i) for i in range(n)], "m string, i int")
    assert sorted(r.i for r in S.even_sample(df, "m", "i", k).collect()) == want


WORDS = "m string, ord int, text string, word_type string, start_sec double, end_sec double, logprob double"


def utterances(spark, rows):
    df = spark.createDataFrame([("m", i, *r) for i, r in enumerate(rows)], WORDS)
    return sorted(S.words_to_utterances(df, ["m"]).collect(), key=lambda r: r.first_ord)


def test_words_to_utterances(spark):
    got = utterances(spark, [("Καλημέρα", "word", 0.0, 0.5, 0.0), (" ", "spacing", None, None, None), ("σας.", "word", 0.5, 1.0, -0.5), ("Υπάρχει", "word", 1.1, 1.5, None), (" ", "spacing", None, None, None), ("απαρτία;", "word", 1.5, 2.0, None), ("Ναι", "word", 2.1, 2.3, None)])
    assert [r.text for r in got] == ["Καλημέρα σας.", "Υπάρχει απαρτία;", "Ναι"] and (got[0].start, got[0].end) == (0.0, 1.0)
    assert len(utterances(spark, [("Ο", "word", 0.0, 0.1, None), ("κ.", "word", 0.1, 0.2, None), ("Δημάκης", "word", 0.2, 0.3, None), ("Κ.Κ.Ε.", "word", 0.3, 0.4, None), ("ψήφισε.", "word", 0.4, 0.5, None)])) == 1
    assert len(utterances(spark, [("α", "word", 0.0, 0.1, None), ("β", "word", 2.5, 2.6, None)])) == 2
    long = utterances(spark, [(f"w{i}", "word", float(i), i + 0.9, None) for i in range(50)])
    assert len(long) >= 2 and all(r.end - r.start <= 31 for r in long) and sum(r.n_words for r in long) == 50
    assert [r.n_words for r in utterances(spark, [("[γέλια]", "audio_event", 0.0, 1.0, None), ("ναι", "word", None, None, None)])] == [1]


def test_greedy_batches(spark):
    df = spark.createDataFrame([("m", i, "x" * n) for i, n in enumerate([110, 120, 110, 500, 10])], "m string, o int, t string")
    got = S.greedy_batches(df, "m", "o", F.length("t"), 250).orderBy("o").collect()
    assert [r.batch for r in got] == [0, 0, 1, 2, 3]
    assert S.greedy_batches(df.limit(0), "m", "o", F.length("t"), 250).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_paced(spark, seed):
    rnd = random.Random(seed)
    rows, at = [], 0.0
    for i in range(400):
        at += rnd.choice([0, 0.5, 1.0, 3.0, 9.999999, 10.0, 25.0])
        rows.append((rnd.choice("ab"), i, at))
    df = spark.createDataFrame([*rows, ("a", 999, None)], "k string, id int, at double")
    want, last = [], {}
    for k, i, t in rows:
        if k not in last or round(t * 1e6) - last[k] >= 10_000_000:
            want.append((k, i))
            last[k] = round(t * 1e6)
    assert sorted((r.k, r.id) for r in S.paced(df, ["k"], "at", "id", 10.0).collect()) == sorted(want)
    assert S.paced(df.limit(0), ["k"], "at", "id", 10.0).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_words_to_utterances_word_by_word(spark, seed):
    rnd = random.Random(seed)
    rows, at = [], 0.0
    for i in range(600):
        kind = rnd.choice(["word", "word", "spacing", "audio_event"])
        at += rnd.choice([0.1, 0.4, 0.9, 3.0 if rnd.random() < 0.1 else 0.2])
        long = rnd.choice([0.2, 0.5, 12.0 if rnd.random() < 0.1 else 0.3])
        rows.append(("m", i, rnd.choice(["ένα", "δύο.", "κ.", "τρία;"]) if kind == "word" else " ", kind, None if rnd.random() < 0.1 else at, None if rnd.random() < 0.1 else at + long, rnd.choice([None, -0.1])))
    want, open_, text, last = [], [], "", 0.0
    for _, i, t, kind, s, e, _ in rows:
        if kind == "spacing" and open_:
            text += t
        if kind != "word":
            continue
        s = last if s is None else s
        e = s if e is None else e
        if open_ and s - last > 1:
            want.append((open_[0], open_[-1], text.strip()))
            open_, text = [], ""
        if not open_:
            begun = s
        open_.append(i)
        text, last = text + t, e
        if t in ("δύο.", "τρία;") or e - begun >= 30:
            want.append((open_[0], open_[-1], text.strip()))
            open_, text = [], ""
    if open_:
        want.append((open_[0], open_[-1], text.strip()))
    df = spark.createDataFrame(rows, "m string, ord int, text string, word_type string, start_sec double, end_sec double, logprob double")
    got = S.words_to_utterances(df, ["m"]).orderBy("first_ord").collect()
    assert [(r.first_ord, r.last_ord, r.text) for r in got] == want
