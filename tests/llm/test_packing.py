import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from praktika.llm.packing import VOCABULARY, cost, pack, pack_documents, pack_items, token_count


def used_of(rows):
    used = defaultdict(list)
    for r in rows:
        used[r.container].append((r.start, r.size))
    return used


@pytest.mark.parametrize("per_task", [2_000, 20])
def test_every_token_once_and_little_unused(spark, per_task):
    rnd = random.Random(4)
    sizes = {i: int(min(30_000, rnd.lognormvariate(5.5, 1.1))) + 1 for i in range(4000)}
    rows = [(i, s, "x") for i, s in sizes.items()]
    df = spark.createDataFrame(rows + rows[:20] + [(None, 5, "x"), (-1, None, "x"), (-2, 0, "x")], "doc bigint, size bigint, container string")
    got = pack_items(df, "doc", "size", 4096, per_task).collect()
    parts = defaultdict(list)
    for r in got:
        parts[r.item].append(r)
    assert set(parts) == set(sizes) and all(sum(r.size for r in p) == sizes[i] for i, p in parts.items())
    assert all(len(p) == 1 for i, p in parts.items() if sizes[i] <= 4096)
    used = used_of(got)
    for spans in used.values():
        at = 0
        for start, size in sorted(spans):
            assert start == at
            at += size
        assert at <= 4096
    assert sum(sizes.values()) / (4096 * len(used)) > (0.985 if per_task == 2_000 else 0.97)


def test_costs_are_level():
    rnd = random.Random(2)
    sizes = [rnd.choice([50, 80, 120, 300, 2000]) for _ in range(3000)]
    where = pack(sizes, 4096)
    spent, room = defaultdict(float), defaultdict(int)
    for s, c in zip(sizes, where):
        spent[c] += cost(s)
        room[c] += s
    assert max(room.values()) <= 4096 and len(room) <= -(-sum(sizes) // 4096) + 4
    fixed = sorted(spent.values())[1:]
    assert fixed[-1] < 2 * fixed[0]


def brute(sizes, capacity):
    """The rule by looking at every container each time."""
    room, spent, where = [capacity] * max(1, -(-sum(sizes) // capacity)), [], [-1] * len(sizes)
    spent = [0.0] * len(room)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [(spent[c], c) for c in range(len(room)) if room[c] >= sizes[i]]
        if not fits:
            room.append(capacity)
            spent.append(0.0)
            fits = [(0.0, len(room) - 1)]
        c = min(fits)[1]
        room[c] -= sizes[i]
        spent[c] += cost(sizes[i])
        where[i] = c
    return where


@pytest.mark.parametrize("seed", range(6))
def test_always_the_cheapest_container_with_room(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([7, 64, 4096])
    sizes = [rnd.randint(1, max(1, int(capacity * rnd.random() ** 2))) for _ in range(900)]
    assert pack(sizes, capacity) == brute(sizes, capacity)


def test_edges(spark):
    df = spark.createDataFrame([(1, 4096), (2, 4097), (3, 1), (3, 1)], "doc bigint, size bigint")
    got = {(r.item, r.part): r for r in pack_items(df, "doc", "size").collect()}
    assert set(got) == {(1, 0), (2, 1), (2, 2), (3, 0)} and got[2, 1].size == 4096 and got[2, 2].size == 1
    assert pack_items(df.limit(0), "doc", "size").count() == 0
    assert pack([], 10) == [] and pack([10, 10], 10) == [0, 1]


@pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary here")
def test_documents(spark):
    df = spark.createDataFrame([(1, "Το Δημοτικό Συμβούλιο αποφασίζει."), (2, None), (3, ""), (4, "λέξη " * 20_000)], "doc_id bigint, text string")
    counts = {r.doc_id: r.n for r in df.select("doc_id", token_count(F.col("text")).alias("n")).collect()}
    assert counts[2] is None and counts[3] == 0 and counts[1] > 5
    got = pack_documents(df).collect()
    assert sum(r.size for r in got) == counts[1] + counts[4] and {r.item for r in got} == {1, 4}


def test_each_item_goes_to_the_cheapest_with_room():
    rnd = random.Random(8)
    sizes = [int(min(4096, rnd.lognormvariate(6, 1.2))) + 1 for _ in range(1500)]
    sizes = [min(s, 4096) for s in sizes]
    count = -(-sum(sizes) // 4096)
    room, spent, want = [4096] * count, [0.0] * count, {}
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [c for c in range(len(room)) if room[c] >= sizes[i]]
        if not fits:
            fits = [len(room)]
            room.append(4096)
            spent.append(0.0)
        want[i] = c = min(fits, key=lambda c: (spent[c], c))
        room[c] -= sizes[i]
        spent[c] += cost(sizes[i])
    assert pack(sizes, 4096) == [want[i] for i in range(len(sizes))]
