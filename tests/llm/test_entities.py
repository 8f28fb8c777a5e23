import datetime as dt
import re

import pytest

from praktika.llm import entities
from praktika.llm.entities import city_key, link_records, tokens

S = "subject_id string, meeting_id string, city string, day date, position int, text string"
D = "ada string, city string, issued date, published date, number int, text string"
DAY = dt.date(2022, 1, 2)


def day(n):
    return DAY + dt.timedelta(days=n)


SUBJECTS = [
    ("s1", "m1", "Δήμος Καρλερής-Καρλούσας", DAY, 1, "Κοπή δέντρων στην οδό Γεφύρας Κάτω 67"),
    ("s2", "m1", "ΔΗΜΟΣ Καρλερής-Καρλούσας", DAY, 2, "Αποδοχή δωρεάς στη Λιμναία, αξίας 443.323,50 ευρώ"),
    ("s3", "m1", "Δήμος Καρλερής-Καρλούσας", DAY, 3, "Παράταση προθεσμίας έργου προμήθειας κάδων ανακύκλωσης (Λιμναία)"),
    ("s4", "m1", "Δήμος Καρλερής-Καρλούσας", DAY, 4, "60η αναμόρφωση προϋπολογισμού 2022"),
    ("s5", "m1", "Δήμος Καρλερής-Καρλούσας", DAY, 5, "Εκμίσθωση ακινήτου στην Αλωνίων 142"),
    ("s6", "m2", "Δήμος Καρλερής-Καρλούσας", day(21), 1, "Κοπή δέντρων στην οδό Γεφύρας Κάτω 67"),
    ("s7", "m3", "Δήμος Άλλης", DAY, 1, "60η αναμόρφωση προϋπολογισμού 2022"),
    ("s8", None, None, None, None, None),
]
DECISIONS = [
    ("a1", "Δ. Καρλερής - Καρλούσας", day(1), day(4), 531, "ΕΓΚΡΙΣΗ ΚΟΠΗΣ 32 ΔΕΝΤΡΩΝ ΛΟΓΩ ΕΠΙΚΙΝΔΥΝΟΤΗΤΑΣ ΕΠΙ ΤΗΣ ΟΔΟΥ ΓΕΦΥΡΑΣ ΚΑΤΩ 67"),
    ("a2", "Δημος Καρλερης Καρλουσας", None, day(9), 532, "ΘΕΜΑ 3ο: Αποδοχή δωρεάς αξίας 443323,50 € προς τη Δημοτική Κοινότητα Λιμναία και ένταξή της"),
    ("a3", "ΔΗΜΟΣ ΚΑΡΛΕΡΗΣ-ΚΑΡΛΟΥΣΑΣ", DAY, None, 533, "Χορήγηση παράτασης της συμβατικής προθεσμίας περαίωσης του έργου προμήθειας κάδων…"),
    ("a4", "Δήμος Καρλερής-Καρλούσας", None, None, 534, "Έγκριση 60ης αναμόρφωσης προϋπολογισμού και τεχνικού προγράμματος 2022"),
    ("a5", "Δήμος Καρλερής-Καρλούσας", DAY, day(2), None, "Καθορισμός όρων δημοπρασίας για την εκμίσθωση δημοτικού ακινήτου 45 m² επί της Γεφύρας 142"),
    ("a6", "Δήμος Καρλερής-Καρλούσας", day(22), day(24), 702, "Έγκριση κοπής 3 δέντρων επί της οδού Γεφύρας Κάτω 67"),
    ("a7", "Δήμος Άσχετης", DAY, day(1), 1, "Έγκριση 60ης αναμόρφωσης προϋπολογισμού"),
    ("a8", None, None, None, None, ""),
]
# plain pairs of other meetings, from which is learned that names of streets are repeated and turns of phrase are not
STREETS = ["Αλωνίων", "Γεφύρας", "Πηγής"]
SUBJECTS += [(f"t{k}", f"n{k}", "Δήμος Καρλερής-Καρλούσας", day(100 + 10 * k), 1, f"Εκμίσθωση ακινήτου στην οδό {STREETS[k % 3]} {k + 3}") for k in range(9)]
DECISIONS += [(f"b{k}", "Δ. Καρλερής - Καρλούσας", day(100 + 10 * k), None, None, f"Όροι για την εκμίσθωση δημοτικού ακινήτου επί της οδού {STREETS[k % 3]} {k + 3}") for k in range(9)]
PAIRS = {("s1", "a1"), ("s2", "a2"), ("s3", "a3"), ("s4", "a4"), ("s6", "a6"), *((f"t{k}", f"b{k}") for k in range(9))}


def test_cascade(spark):
    s, d = spark.createDataFrame(SUBJECTS + SUBJECTS[:2], S), spark.createDataFrame(DECISIONS + DECISIONS[:2], D)
    got = link_records(s, d).collect()
    assert {(r.subject_id, r.ada) for r in got} == PAIRS and len(got) == len(PAIRS)
    assert all(0 < r.confidence < 1 for r in got)


def test_labelled_precision_is_smoothed(spark):
    s, d = spark.createDataFrame(SUBJECTS, S), spark.createDataFrame(DECISIONS, D)
    labels = spark.createDataFrame([("s1", "a1"), ("s6", "other")], "subject_id string, ada string")
    got = {r.subject_id: r for r in link_records(s, d, labels).collect()}
    assert got["s1"].rule == got["s6"].rule == "number_and_words" and got["s1"].confidence == (1 + 1) / (2 + 2)
    assert {r.confidence for r in got.values() if r.rule != got["s1"].rule} <= {0.5}


def test_ties_stay_open_and_empty_tables(spark):
    s = spark.createDataFrame(SUBJECTS[:1], S)
    twice = spark.createDataFrame([DECISIONS[0], ("b1", *DECISIONS[0][1:])], D)
    assert link_records(s, twice).count() == 0
    assert link_records(s.limit(0), twice).count() == 0 and link_records(s, twice.limit(0)).count() == 0


def test_tokens():
    found, money, cut = tokens("Διαγραφή οφειλών ύδρευσης (2.000,37 €), 3η φορά")
    assert dict(found) == {"#2000.37": "", "#3.00": "", "διαγρ": "διαγραφη", "οφειλ": "οφειλων", "υδρευ": "υδρευσησ", "φορα": "φορα"} and money == ["#2000.37"] and not cut
    assert tokens("ποσού 2000,37 ευρώ")[1] == money
    assert tokens("έργο προμήθειας κάδ…") == ([("εργο", "εργο"), ("προμη", "προμηθειασ")], [], True)
    assert tokens(None) == tokens("") == ([], [], False) and len(tokens("έργο " * 50_000)[0]) == 1
    assert city_key("Δ. Καρλερής - Καρλούσας") == city_key("ΔΗΜΟΣ ΚΑΡΛΕΡΗΣ-ΚΑΡΛΟΥΣΑΣ") and city_key(None) is None


def test_the_same_title_of_an_unlisted_kind_is_linked(spark):
    s = spark.createDataFrame([("s1", "m1", "Δήμος Άλλης", DAY, 1, "Ωράριο νεκροταφείου Άνω Πόλης"), ("s2", "m1", "Δήμος Άλλης", DAY, 2, "Το α΄"), ("s3", "m2", "Δήμος Άλλης", day(30), 1, "Ωράριο νεκροταφείου Άνω Πόλης")], S)
    d = spark.createDataFrame([("a1", "Δ. Άλλης", day(1), None, None, "ΑΠΟΦΑΣΗ Δ.Σ.: ΩΡΑΡΙΟ ΝΕΚΡΟΤΑΦΕΙΟΥ, ΑΝΩ ΠΟΛΗΣ"), ("a2", "Δ. Άλλης", DAY, None, None, "Το α΄"), ("a3", "Δ. Άλλης", day(1), None, None, "Ωράριο βιβλιοθήκης Άνω Πόλης")], D)
    got = link_records(s, d).collect()
    assert [(r.subject_id, r.ada, r.rule) for r in got] == [("s1", "a1", "all_tokens")]


@pytest.mark.parametrize("kind", ["ab", "cd"])
def test_equal_titles_of_any_kind_and_undated_decisions(spark, kind):
    titles = {"a": "Ίδρυση φιλαρμονικής ορχήστρας", "b": "Opening hours of the municipal library", "c": "Ιστοσελίδα νέα του λιμενικού ταμείου", "d": "Plantarea arborilor pe strada Florilor"}
    s = spark.createDataFrame([(f"s{k}", "m1", "Δήμος Άλλης", DAY, i, titles[k]) for i, k in enumerate(kind)], S)
    d = spark.createDataFrame([(f"a{k}", "Δ. Άλλης", None, None if k in "bd" else day(3), None, titles[k].upper()) for k in kind], D)
    assert {(r.subject_id, r.ada) for r in link_records(s, d).collect()} == {(f"s{k}", f"a{k}") for k in kind}


def test_tables_of_records_are_not_gathered_on_the_driver(spark, monkeypatch):
    plans, cut, threshold = [], entities.cut, "spark.sql.autoBroadcastJoinThreshold"
    planned = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(entities, "cut", lambda df: planned(df) or cut(df))
    s, d = spark.createDataFrame(SUBJECTS, S), spark.createDataFrame(DECISIONS, D)
    old = spark.conf.get(threshold)
    spark.conf.set(threshold, "1g")
    try:
        planned(got := link_records(s, d))
        assert {(r.subject_id, r.ada) for r in got.collect()} == PAIRS
    finally:
        spark.conf.set(threshold, old)
    joins = [line for p in plans for line in p.split("\n") if "Broadcast" in line and "Join" in line]
    assert not [j for j in joins if re.search("subject_id|ada|meeting_id|slot|key", j)] and any("SortMergeJoin" in p for p in plans)
