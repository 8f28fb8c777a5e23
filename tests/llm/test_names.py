import random

import pytest

from praktika.llm.names import allowed, banded, distance, index_keys, link_spellings, person, probe_keys, spelling

ROSTER = [
    ("c", "p1", "Ευστράτιος Βρετογίνης"), ("c", "p2", "Αθανάσιος (Σάκης) Λιβουλέας"), ("c", "p3", "Σταυρούλα (Βούλα) Στεφολίδου"), ("c", "p4", "ΜΑΝΔΕΛΙΝΗ-ΓΚΙΝΕΛΟΠΟΥΛΟΥ ΔΗΜΗΤΡΑ"),
    ("c", "p5", "Βίκυ Στεφομούδη"), ("c", "p6", "Χαράλαμπος Φιλομάτος"), ("c", "p7", "Μιχαήλ Φιλομάτος"), ("c", "p8", "Κωνσταντίνος Σκουρανάτος"), ("c", "p9", "Ρένα Μελογέα"),
    ("d", "q1", "Ευστράτιος Βρετογίνης"), ("c", "p10", "Μονό"), ("c", None, "Άννα Ρήγα"), ("c", "p11", None), (None, "p12", "Άννα Ρήγα"),
]
LINKED = {
    "Βρετογίνης Ευσρτάτιος": "p1", "Στρατής Βρετογίνης": "p1", "Eystratios Vretoginis": "p1", "ΒΡΕΤΟΓΙΝΗΣ ΕΥΣΤΡΑΤΙΟΣ ΤΟΥ ΔΗΜΗΤΡΙΟΥ": "p1", "Λειβουλεας Νάσος": "p2", "Δρ. Λιβουλέας Θανάσης": "p2",
    "Στεφοληδου Ρούλα": "p3", "Μανδελίνη Δήμητρα": "p4", "Δήμητρα Μανδελίην-Γκινελοπούλου": "p4", "Vasiliki Stefomoydi": "p5", "ΣΤΕΦΟΜΟΥΔΗ ΒΑΣΙΛΙΚΗ (ΒΑΣΩ)": "p5", "Χαρ. Φιλομάτος": "p6",
    "Μ.ΦΙΛΟΜΑΤΟΣ": "p7", "ΦΙΛΟΜ. ΜΙΧΑ.": "p7", "Κ. Σκουρανάτος": "p8", "κ. Σκουρανάτος Κωνσταντίνος": "p8", "ΚΩΝΣΤΑΝΤΙΝΟΣΣΚΟΥΡΑΝΑΤΟΣ": "p8", "Ευστράτιος Βρετογίνης": "p1", "Μελογέα Ειρήνη": "p9",
}
NOBODY = ["Πέτρος Φιλομάτος", "Λένα Μελογέα", "Φιλομάτος", "Γεώργιος Ταδόπουλος", "", " ", "123", "Ν. Φιλομάτος", "ο" * 50_000]


def test_links(spark):
    rows = [("c", raw, "x") for raw in [*LINKED, *NOBODY]]
    typed = spark.createDataFrame(rows + rows[:4] + [("c", None, "x"), (None, "Άννα Ρήγα", "x")], "city string, raw_name string, name string")
    people = spark.createDataFrame(ROSTER + ROSTER[:2], "city string, person_id string, name string")
    got = link_spellings(typed, people, "city").collect()
    assert {r.raw_name: r.person_id for r in got} == LINKED and len(got) == len(LINKED)
    assert link_spellings(typed.limit(0), people, "city").count() == 0 and link_spellings(typed, people.limit(0), "city").count() == 0


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j - 1] + (x != y), old[j] + 1, row[j - 1] + 1))
    return row[-1]


def test_probes_miss_no_string_within_the_edits():
    rnd = random.Random(2)
    for _ in range(3000):
        a = "".join(rnd.choice("αβγ") for _ in range(rnd.randrange(4, 18)))
        b = list(a)
        for _ in range(rnd.randrange(3)):
            at = rnd.randrange(len(b) + 1)
            b[at : at + rnd.randrange(2)] = rnd.choice(["", "δ", "α"])
        b = "".join(b)
        if levenshtein(a, b) <= allowed(len(a)):
            assert set(index_keys(a, "x")) & set(probe_keys(b, "x")), (a, b)


def test_banded_distance():
    rnd = random.Random(3)
    for _ in range(2000):
        a, b = ("".join(rnd.choice("ab") for _ in range(rnd.randrange(9))) for _ in range(2))
        d = banded(a, b, 2)
        assert d <= levenshtein(a, b) and (levenshtein(a, b) > 2 or d <= 2)
    assert banded("abcd", "abdc", 2) == 1 and banded("abc", "xyz", 2) == 3 and banded("", "ab", 2) == 2


@pytest.mark.parametrize("raw,name", [("Λένα Μελογέα", "Ρένα Μελογέα"), ("Θεοδώρα Λαμέα", "Θεόδωρος Λαμέας"), ("Πέτρος Φιλομάτος", "Μιχαήλ Φιλομάτος")])
def test_other_given_names(raw, name):
    assert distance(raw, name) is None


def test_long_beginnings_of_surnames_are_looked_up(spark):
    raws = ["Παπακωνσταντ. Γ.", "Γ. ΠΑΠΑΚΩΝΣΤΑΝΤΙΝ.", "Παπακ. Γ."]
    typed = spark.createDataFrame([("c", r) for r in raws], "city string, raw_name string")
    people = spark.createDataFrame([("c", "p1", "Γεώργιος Παπακωνσταντίνου"), ("c", "p2", "Άννα Παπακωνσταντίνου")], "city string, person_id string, name string")
    assert {r.raw_name: r.person_id for r in link_spellings(typed, people, "city").collect()} == dict.fromkeys(raws, "p1")


def test_memory_does_not_grow_with_the_tables(spark, tmp_path):
    """Small files unfold into large indices: none is broadcast, whatever Catalyst thinks of their size; the workers remember a part."""
    from praktika.llm.plans.names import p2_found

    changes = "array<struct<name string>>"
    spark.createDataFrame([("m1", "c", ["Στρατής Βρετογίνης"], ["Χαρ. Φιλομάτος"], [])], f"meeting_id string, city_id string, present_members array<string>, absent_members array<string>, attendance_changes {changes}").write.parquet(f"{tmp_path}/raw_extractions.parquet")
    spark.createDataFrame([(i, n, c) for c, i, n in ROSTER[:6]], "id string, name string, city_id string").write.parquet(f"{tmp_path}/people.parquet")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        got = p2_found(spark, str(tmp_path))
        assert {(r.raw_name, r.person_id) for r in got.collect()} == {("Στρατής Βρετογίνης", "p1"), ("Χαρ. Φιλομάτος", "p6")}
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert max(f.cache_info().maxsize for f in (person, spelling)) <= 20_000
