import unicodedata

import pytest
from pyspark.sql import functions as F

from praktika.functions import numbers as N
from praktika.functions import text as X


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'double' if isinstance(v, float) else 'bigint'}" for k, v in values.items()))
    return row.select(column.alias("x")).first()[0]


@pytest.mark.parametrize(
    "name,want",
    [("ΚΡΑΝΙΩΤΗΣ ΧΑΡΑΛΑΜΠΟΣ (ΜΠΑΜΠΗΣ)", "κρανιωτησ χαραλαμποσ"), ("Αλεξάνδρη-Ζουμπουλάκη Ευσταθία", "αλεξανδρη-ζουμπουλακη ευσταθια"), ("Παπαΐωάννου", "παπαιωαννου"), ("Α – Β", "α β"), (None, None), ("", "")],
)
def test_normalize_name(spark, name, want):
    assert one(spark, X.normalize_name(F.col("n")), n=name) == want


def test_sort_keys_with_nickname(spark):
    keys = one(spark, X.sort_keys(F.col("n")), n="ΠΑΠΑΝΑΣΤΑΣΟΠΟΥΛΟΣ ΚΩΝΣΤΑΝΤΙΝΟΣ (ΚΩΣΤΗΣ)")
    assert keys == ["κωνσταντινοσ παπαναστασοπουλοσ", "κωστησ παπαναστασοπουλοσ"]
    assert one(spark, X.sort_keys(F.col("n")), n="Κωστής Παπαναστασόπουλος") == ["κωστησ παπαναστασοπουλοσ"]


def test_fold_agrees_with_decomposition(spark):
    text = "".join(chr(c) for r in (range(0xC0, 0x17F), range(0x386, 0x3CF)) for c in r if chr(c).isalpha())
    want = "".join(c for c in unicodedata.normalize("NFD", text.lower()) if not unicodedata.combining(c)).replace("ς", "σ")
    assert one(spark, X.fold(F.col("t")), t=text) == want
    assert one(spark, X.fold(F.col("t")), t=unicodedata.normalize("NFD", text)) == want


def test_similarity(spark):
    row = spark.createDataFrame([("Έγκριση προϋπολογισμού Δήμου", "Έγκριση προϋπολογισμού οικονομικού έτους Δήμου", "Άσχετο θέμα", "")], "a string, b string, c string, e string")
    a, b, c, e = (X.tokens(F.col(x)) for x in "abce")
    near, far, none, j = row.select(X.coverage(a, b), X.coverage(a, c), X.jaccard(e, e), X.jaccard(a, b)).first()
    assert (near, far, none, j) == (1.0, 0.0, 0.0, 3 / 5)


@pytest.mark.parametrize("word,want", [("σας.", True), ("απαρτία;", True), ("κ.", False), ("Κ.Κ.Ε.", False), ("αριθ.", False), ("τονίσω…", False), ("ναι", False), ("τι;", True)])
def test_sentence_ends(spark, word, want):
    assert one(spark, X.ends_sentence(F.col("w")), w=word) is want


@pytest.mark.parametrize("number,want", [("595/2025", ("", 595, "/2025")), ("ΑΔΣ 5/2026", ("ΑΔΣ ", 5, "/2026")), ("12", ("", 12, "")), ("12-3", None), (None, None)])
def test_protocol_parts(spark, number, want):
    got = one(spark, X.protocol_parts(F.col("n")), n=number)
    assert (got and tuple(got)) == want


def test_small_text_functions(spark):
    assert one(spark, X.clean_refs(F.col("t")), t="βλ. [Άννα](REF:PERSON:x1) και [β](http://z)") == "βλ. Άννα και [β](http://z)"
    assert one(spark, X.wrap(F.col("t"), 10), t="ένα δύο τρία τεσσερακοντα") == ["ένα δύο", "τρία", "τεσσερακοντα"]
    assert one(spark, X.until_line_end(F.col("t")), t="α\nβ\nγ") == "α\nβ\n"
    assert one(spark, X.escape_html(F.col("t")), t='<a href="x">&') == "&lt;a href=&quot;x&quot;&gt;&amp;"
    assert one(spark, X.bearer(F.col("t")), t="Bearer abc") == "abc" and one(spark, X.bearer(F.col("t")), t="Basic abc") is None
    assert one(spark, X.meeting_of_callback(F.col("t")), t="https://x/api/meetings/m7/cb") == "m7"
    assert one(spark, X.redact(F.col("t"), F.col("s")), t="key=abc", s="abc") == "key=***"


def test_numbers(spark):
    assert one(spark, N.round_half_up(F.col("x")), x=-2.5) == -2 and one(spark, N.round_half_up(F.col("x")), x=2.5) == 3
    assert one(spark, N.clock(F.col("x")), x=3661.9) == "01:01:01"
    assert [one(spark, N.token_label(F.col("x")), x=x) for x in (999, 1500, 2_500_000)] == ["999", "1.5k", "2.5M"]
    assert [one(spark, N.byte_label(F.col("x")), x=x) for x in (0, 1023, 1024, 1536, 1048576)] == ["0 Bytes", "1023 Bytes", "1 KB", "1.5 KB", "1 MB"]
    assert [one(spark, N.duration_label(F.col("x")), x=x) for x in (89, 90)] == ["89s", "1m30s"]
    assert one(spark, N.lsn_bytes(F.col("x")), x="16/B374D848") == (0x16 << 32) + 0xB374D848
    assert [one(spark, N.severity(F.col("s"), F.col("p")), s=s, p=p) for s, p in (("lost", 1.0), ("ok", 96.0), ("ok", 81.0), ("ok", 51.0), ("ok", 5.0))] == ["critical", "critical", "high", "warning", "ok"]
