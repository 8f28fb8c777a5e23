import random

import pytest

from praktika.operators.periods import periods_and_gaps

SCHEMA = "m string, p string, s bigint, e bigint, _chunk string, row_kind int"


def brute(rows):
    out, by = set(), {}
    for m, p, s, e, *_ in rows:
        if s is not None and e is not None and e > s:
            by.setdefault((m, p), []).append((s, e))
    for key, iv in by.items():
        iv.sort()
        merged = [list(iv[0])]
        for s, e in iv[1:]:
            if s > merged[-1][1]:
                merged.append([s, e])
            else:
                merged[-1][1] = max(merged[-1][1], e)
        out |= {(*key, "period", s, e) for s, e in merged}
        out |= {(*key, "gap", a[1], b[0]) for a, b in zip(merged, merged[1:])}
    return out


def found(spark, rows, chunk_ms=600_000):
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in periods_and_gaps(df, ["m", "p"], "s", "e", chunk_ms).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("chunk_ms", [7, 50, 600_000])
def test_random_intervals(spark, chunk_ms):
    rnd = random.Random(chunk_ms)
    rows = []
    for _ in range(400):
        s = rnd.randrange(600)
        rows.append((rnd.choice(["a", "b", None]), rnd.choice(["x", None]), s, s + rnd.choice([-3, 0, 1, 2, 5, 40]), "t", 1))
    rows += rows[:30]
    assert found(spark, rows, chunk_ms) == brute(rows)


def test_touching_nested_null_and_empty(spark):
    rows = [("a", "x", 0, 10, None, None), ("a", "x", 10, 20, None, None), ("a", "x", 3, 4, None, None), ("a", "x", 30, None, None, None), (None, None, 1, 2, None, None), ("a", "y", None, 5, None, None)]
    assert found(spark, rows) == {("a", "x", "period", 0, 20), (None, None, "period", 1, 2)}
    assert found(spark, []) == set()
