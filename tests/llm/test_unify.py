import unicodedata

import pytest

from praktika.llm import unify as u

CASES = [
    ("Συγκρóτηση", "Συγκρότηση"),
    (unicodedata.normalize("NFD", "Έγκριση προϋπολογισμού"), "Έγκριση προϋπολογισμού"),
    ("άέ", "άέ"),
    ("Ονοματο­δοσία‎", "Ονοματοδοσία"),
    ("α β γ　δ", "α β γ δ"),
    ("Ｗｉ-Fi 5０", "Wi-Fi 50"),
    ("ΜΕΛΕΤΗΣ TOY ΔΗΜΟΥ", "ΜΕΛΕΤΗΣ ΤΟΥ ΔΗΜΟΥ"),
    ("Ο.Е. και К/Ξ του", "Ο.Ε. και Κ/Ξ του"),
    ("ΚΥΜΟΔΕΤΙΚΗ K/Ξ", "ΚΥΜΟΔΕΤΙΚΗ Κ/Ξ"),
    ("µέτρα Ωρες", "μέτρα Ωρες"),
    ("US‌B θύρα", "USB θύρα"),
    ("Wі-Fi στη Δρυερή", "Wi-Fi στη Δρυερή"),
    ("an ʜello and Ꭺpple", "an hello and Apple"),
    ("the hօuse", "the house"),
]
SAME = ["φωτιστικά LED και RFID, Wi-Fi 55 m² – «ποσό» 5 € Β΄ φάση…", "Εγκριση χωρις τονους", "e-Πολίτης", "υπηρεσία E…", "Москва в тексте", "", "TAXI at the ONE MINI", "ΟΔΟΣ  ΔΙΠΛΟ ΚΕΝΟ", "Ménage à trois", "ᎠᎢᎪ in Cherokee", "Հայաստան"]


@pytest.mark.parametrize("text,want", CASES)
def test_changed(text, want):
    assert u.unify(text) == want and u.unify(want) == want


@pytest.mark.parametrize("text", SAME)
def test_unchanged(text):
    assert u.unify(text) == text


def test_table_is_final_and_conflicts_are_found(monkeypatch):
    table = u.compiled()
    assert not any(v in table for v in table.values())
    monkeypatch.setitem(u.SYMBOLS, "Ａ", "Α")
    with pytest.raises(u.ConflictError):
        u.compiled()


def test_look_alikes_are_checked(monkeypatch):
    u.look_alikes()
    monkeypatch.setattr(u, "LATIN_AS_CHEROKEE", ("AB", "ᎪᎪ"))
    with pytest.raises(u.ConflictError):
        u.look_alikes()
    monkeypatch.setattr(u, "LATIN_AS_CHEROKEE", ("А", "Ꭺ"))  # Cyrillic, which is itself one
    with pytest.raises(u.ConflictError):
        u.look_alikes()


def test_one_pass_reads_a_text_in_its_script():
    assert u.unify("TO και TO και") == "ΤΟ και ΤΟ και" and u.unify("TO be or not TO be, και") == "TO be or not TO be, και"
    assert u.unify("K. και K/Ξ") == "K. και Κ/Ξ"


def test_column(spark):
    texts = [*[t for t, _ in CASES], *SAME, None, "α" * 50_000 + "​", CASES[0][0]]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "id int, text string, changed string")
    got = {r.id: r for r in u.unify_texts(df, "text").collect()}
    for i, t in enumerate(texts):
        assert got[i].unified == u.unify(t) and got[i].changed == (t is not None and u.unify(t) != t)
    assert u.unify_texts(df.limit(0), "text").count() == 0
