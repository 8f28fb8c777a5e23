import random
import re

import pytest
from pyspark.sql import functions as F

from praktika.llm.runs import collapse_runs, speaker_label
from praktika.llm.turns import calibrated_pauses, speaker_turns

SCHEMA = "m string, seg int, ord int, text string, word_type string, start_sec double, end_sec double, logprob double, speaker_id string, _value string"
NOISES = ["[γέλια]", "εεε...", "Χμμ,", "<00:00:01.000>", "(00:12)", "SPEAKER_01:", "♪", "(θόρυβος)"]
PAIRS = [("(μιλούν", "ταυτόχρονα)", True), ("[έντονος", "θόρυβος]", True), ("*χτύπημα", "κουδουνιού*", True), ("(άρθρο", "75)", False)]


def stream(rnd, n):
    """(text, label, spoken) in order of time."""
    out, who = [], "speaker_0"
    while len(out) < n:
        if rnd.random() < 0.15:
            who = f"speaker_{rnd.randrange(3)}"
        label = rnd.choice([who, who, None, " ", who.upper().replace("_", "_0"), who.replace("speaker_", "Ομιλητής ")])
        if rnd.random() < 0.2:
            out.append((rnd.choice(NOISES), label, False))
        elif rnd.random() < 0.25:
            a, b, noise = rnd.choice(PAIRS)
            out += [(a, label, not noise), (b, label, not noise)]
        else:
            out.append((rnd.choice(["και", "στις", "20:15", "Ε", "(άλλο", "75)", "ότι"]), label, True))
    return out


def norm(label):
    d = re.search(r"(\d+)", label or "")
    return f"speaker_{int(d[1])}" if d else None


def rows_of(rnd, m, n):
    rows = []
    for i, (text, label, _) in enumerate(s := stream(rnd, n)):
        rows.append((m, 0, i, text, "word", i * 0.5, i * 0.5 + 0.4, -0.1, label, "x"))
        if rnd.random() < 0.1:
            rows.append((m, 0, 10_000 + i, " ", "spacing", None, None, None, None, None))
    return s, rows


@pytest.mark.parametrize("chunk", [0.5, 1.0, 2.5, 600.0])
def test_turns_match_a_scan(spark, chunk):
    rnd, rows, want = random.Random(int(chunk * 10)), [], set()
    for m in ("a", "b", None):
        s, r = rows_of(rnd, m, 120)
        rows += r + r[:7]
        who, turn, turns = None, None, []
        for i, (_, label, spoken) in enumerate(s):
            who = norm(label) or who
            if spoken and (turn is None or turns[-1][0] != who):
                turns.append(turn := [who, i, i, 0])
            if spoken:
                turns[-1][2], turns[-1][3] = i, turns[-1][3] + 1
        want |= {(m, *t) for t in turns}
    # stray halves that happen to stand side by side are no pairs in the model above: none of them fits another
    rnd.shuffle(rows)
    got = speaker_turns(spark.createDataFrame(rows, SCHEMA), ["m", "seg"], chunk=chunk)
    got = [tuple(r) for r in got.select("m", "speaker", "first_ord", "last_ord", "n_words").collect()]
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("chunk", [0.5, 600.0])
def test_rolling_captions_and_pauses(spark, chunk):
    words = [("θα", 0.0, 1.0), ("πάμε", 1.0, 2.0), ("πάμε", 1.2, 2.2), ("στο", 2.2, 3.0), ("στο", 3.0, 3.2), ("έργο", 9.0, 9.5)]
    rows = [("a", 0, i, t, "word", s, e, None, "spk1", None) for i, (t, s, e) in enumerate(words)]
    df = spark.createDataFrame(rows, SCHEMA)
    turns = {tuple(r) for r in speaker_turns(df, ["m", "seg"], chunk=chunk).select("first_ord", "last_ord", "n_words").collect()}
    assert turns == {(0, 5, 5)}
    turns = {tuple(r) for r in speaker_turns(df, ["m", "seg"], pause=2.0, chunk=chunk).select("first_ord", "last_ord", "n_words").collect()}
    assert turns == {(0, 4, 4), (5, 5, 1)}


CAPTIONS = [
    ([(0.0, "we will vote"), (1.05, "will vote now")], None, 4),  # the new one begins while the old one is shown
    ([(0.0, "we will vote"), (0.6, "will vote now")], None, 4),  # both run side by side
    ([(0.0, "a b c d"), (1.7, "b c d e"), (3.4, "c d e f")], None, 6),
    ([(0.0, "a b c d"), (1.7, "x b c")], None, 7),
    ([(0.0, "yes yes yes"), (1.2, "yes no")], None, 4),
    ([(0.0, "a b c"), (1.05, "b c d")], ["spk1", "spk2"], 6),  # another speaker repeats nothing
    ([(0.0, "a b c"), (1.05, "b c d")], ["spk1", None], 4),
    ([(0.0, "a b c"), (1.8, "b c d")], None, 6),  # no overlap in time: said twice
]


def caption_rows(stream, captions, speakers):
    rows = []
    for n, (begin, text) in enumerate(captions):
        for k, w in enumerate(text.split()):
            rows.append((f"m{stream}", stream, len(rows), w, "word", begin + k * 0.5, begin + k * 0.5 + 0.5, None, (speakers or ["spk1"] * 9)[n], None))
    return rows


@pytest.mark.parametrize("chunk", [0.3, 0.7, 1.0, 2.0, 600.0])
def test_rolling_captions_overlap_by_words(spark, chunk):
    rows = [r for k, (captions, speakers, _) in enumerate(CAPTIONS) for r in caption_rows(k, captions, speakers)]
    got = speaker_turns(spark.createDataFrame(rows, SCHEMA), ["m", "seg"], chunk=chunk).groupBy("seg").agg(F.sum("n_words").alias("n")).collect()
    assert {r.seg: r.n for r in got} == {k: n for k, (*_, n) in enumerate(CAPTIONS)}


def test_pause_is_calibrated_within_bounds(spark):
    rows = [("a", 0, i, "και", "word", i * 1.0, i + 0.9, None, None, None) for i in range(50)] + [("b", 0, i, "και", "word", i * 2.0, i * 2.0 + 1, None, None, None) for i in range(50)] + [(None, 0, 0, "και", "word", 0.0, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    for chunk in (0.5, 7.0, 600.0):
        got = {r.m: r.pause for r in calibrated_pauses(df, ["m", "seg"], "start_sec", "end_sec", "ord", chunk=chunk).collect()}
        assert got == {"a": 0.4, "b": 1.0, None: 3.0}
    assert calibrated_pauses(df.limit(0), ["m", "seg"], "start_sec", "end_sec", "ord").count() == 0
    turns = speaker_turns(df.where("m = 'b'").withColumn("p", F.lit(0.5)), ["m", "seg"], pause=F.col("p"))
    assert turns.count() == 50


@pytest.mark.parametrize("chunk", [1.0, 3.0, 4096.0])
def test_runs_match_a_scan(spark, chunk):
    rnd, rows, want = random.Random(7), [], set()
    for m in ("a", None):
        values = [rnd.choice(["x", "x", "x", "y", None]) for _ in range(200)]
        rows += [(m, i, v, i * 1.0, i + 0.5, 3) for i, v in enumerate(values)]
        run = None
        for i, v in enumerate(values):
            if run is None or run[0] != v:
                run and want.add((m, *run))
                run = [v, i, i, 0]
                run = [v, i, i, 0]
            run[2], run[3] = i, run[3] + 1
        want.add((m, *run))
    df = spark.createDataFrame(rows + rows[:20], "m string, ord bigint, v string, s double, e double, _n int")
    got = collapse_runs(df, ["m"], "ord", F.col("v"), "s", "e", chunk)
    assert {tuple(r) for r in got.select("m", "value", "first_ord", "last_ord", "n_events").collect()} == {(m, v, a, b, n) for m, v, a, b, n in want}
    assert {(r.last_ord + 0.5, r.first_ord * 1.0) for r in got.collect()} == {(r.end, r.start) for r in got.collect()}
    assert collapse_runs(df.limit(0), ["m"], "ord", F.col("v"), "s", "e", chunk).count() == 0


def test_rows_without_a_position_are_chunked_by_their_ordinals(spark):
    from praktika.llm.runs import NOWHERE, chunk_of

    rows = [(None, 0), (None, 4095), (None, 4096), (None, None), (5.0, 1), (-700.0, 1)]
    got = [r[0] for r in spark.createDataFrame(rows, "p double, o int").select(chunk_of(F.col("p"), 600.0, F.col("o"))).collect()]
    assert got == [NOWHERE, NOWHERE, NOWHERE + 1, NOWHERE - 1, 0, -2]
    words = [("a", 0, i, "και", "word", None if i < 9000 else i * 1.0, None, None, "spk1" if i % 6000 < 3000 else "spk2", None) for i in range(12_000)]
    turns = {tuple(r) for r in speaker_turns(spark.createDataFrame(words, SCHEMA), ["m", "seg"]).select("first_ord", "last_ord", "n_words").collect()}
    assert turns == {(0, 2999, 3000), (3000, 5999, 3000), (6000, 8999, 3000), (9000, 11_999, 3000)}


def test_ties_nulls_and_long_texts(spark):
    rows = [("a", 0, 0, "x" * 200_000, "word", 1.0, None, None, None, None), ("a", 0, 1, None, "word", 1.0, 1.0, None, "spk2", None), ("a", 0, 2, "", "word", None, None, None, "spk2", None), ("a", 0, 3, "ναι", None, 2.0, 2.0, None, None, None), ("a", 0, 4, "ναι", "word", 1.0, 1.2, None, "S02", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {tuple(r) for r in speaker_turns(df, ["m", "seg"]).select("speaker", "first_ord", "last_ord", "n_words").collect()}
    assert got == {("speaker_2", 0, 4, 2)}
    assert speaker_turns(df.limit(0), ["m", "seg"]).count() == 0


def test_labels(spark):
    labels = ["speaker_0", "SPEAKER_00", "speaker-0", "speaker_0:", "Speaker 0", "Ομιλητής 0", "spk0", " speaker_0", "S00", "speaker_10", " ", None, "Πρόεδρος"]
    df = spark.createDataFrame([(x,) for x in labels], "l string")
    assert [r[0] for r in df.select(speaker_label(F.col("l"))).collect()] == ["speaker_0"] * 9 + ["speaker_10", None, None, "πρόεδρος"]
