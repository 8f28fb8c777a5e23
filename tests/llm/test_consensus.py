import random

import pytest
from pyspark.sql import functions as F

from praktika.llm.consensus import consensus

SCHEMA = "item bigint, who string, sp string, lab string, _p string, label int"


def run(spark, rows):
    return consensus(spark.createDataFrame(rows, SCHEMA), "item", "who", F.col("sp"), F.col("lab"))


def test_planted_reliabilities_beat_the_majority(spark):
    rnd = random.Random(3)
    truth, rows = {}, []
    skill = {"good1": 0.97, "good2": 0.95, "mid": 0.8, "coin": 0.5, "foe1": 0.08, "foe2": 0.1}
    for i in range(700):
        truth[i] = "A" if rnd.random() < 0.3 else "B"
        other = {"A": "B", "B": "A"}[truth[i]]
        for who in rnd.sample(sorted(skill), 4):
            rows.append((i, who, "s", truth[i] if rnd.random() < skill[who] else other, None, None))
        rows.append((i, "const", "s", "B", None, None))
    got = run(spark, rows + rows[:50] + [(None, "mid", "s", "A", None, None), (1, "mid", "s", None, None, None)])
    labels = {r.item: r for r in got.items.collect()}
    assert len(labels) == 700
    votes = {i: [r[3] for r in rows if r[0] == i] for i in truth}
    ours = sum(labels[i].label == truth[i] for i in truth)
    majority = sum((votes[i].count("A") > votes[i].count("B")) == (truth[i] == "A") for i in truth)
    assert ours > 0.93 * 700 and ours > majority + 60
    by = {r.annotator: r.reliability for r in got.annotators.collect()}
    assert by["good1"] > 0.85 > by["mid"] > 0.65 > by["coin"] > 0.35 > by["foe1"]
    assert 0 < got.rounds < 25


def test_agreement_ties_single_and_empty(spark):
    rows = [(1, "a", None, "X", None, None), (2, "a", None, "X", None, None), (2, "b", None, "Y", None, None), (3, "b", None, "Y" * 3000, None, None)]
    items = {r.item: r for r in run(spark, rows).items.collect()}
    assert (items[1].label, items[1].agreement, items[1].disputed) == ("X", 1.0, False)
    assert items[2].disputed and items[2].agreement == 0.0 and items[2].n_labels == 2
    assert items[3].label == "Y" * 3000
    none = run(spark, [])
    assert none.items.count() == 0 and none.annotators.count() == 0


def test_rounds_go_on_until_labels_settle_or_fail(spark, monkeypatch):
    import praktika.llm.consensus as m

    rnd = random.Random(5)
    skill = {"a": 0.9, "b": 0.75, "c": 0.6, "d": 0.2}
    rows = [(i, who, "s", "AB"[(i % 3 == 0) == (rnd.random() < p)], None, None) for i in range(150) for who, p in skill.items()]
    whole = run(spark, rows)
    assert whole.change <= m.TOLERANCE and whole.moved <= m.TOLERANCE
    want = {r.item: r.label for r in whole.items.collect()}
    monkeypatch.setattr(m, "MAX_ROUNDS", 1)
    damped = run(spark, rows)
    assert damped.rounds > 1 and damped.change <= m.TOLERANCE and damped.moved <= m.TOLERANCE
    assert {r.item: r.label for r in damped.items.collect()} == want
    monkeypatch.setattr(m, "DAMPED_ROUNDS", 0)
    with pytest.raises(RuntimeError, match="not settled"):
        run(spark, rows)
