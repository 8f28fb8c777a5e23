import random

import pytest

from praktika.llm.encoding import FAMILIES, READ_AS, _multibyte, restore, restore_texts, signs_of

GREEK = "Η Οικονομική Επιτροπή γνωμοδότησε θετικά για το ποσό των 790.644,80 ευρώ.\nΘα γίνει νέα συζήτηση, είπε ο Γεώργιος Λαμεφίνης."
FRENCH = "Le conseil a approuvé à l'unanimité le budget modifié après la réponse."
ROMANIAN = "Îngrijirea spațiilor verzi din Nereri costă 658 lei pe lună."


def lenient(raw, codec):
    out = []
    for b in raw:
        try:
            out.append(bytes([b]).decode(codec))
        except UnicodeDecodeError:
            out.append(chr(b))
    return "".join(out)


@pytest.mark.parametrize("text", [GREEK, FRENCH, ROMANIAN])
@pytest.mark.parametrize("codec", ["cp1252", "latin-1", "cp1253", "cp437", "cp850", "cp1251"])
def test_multibyte_round_trip(text, codec):
    got = restore(lenient(text.encode("utf-8"), codec))
    assert got.garbled and got.text == text and got.whole


def test_twice_and_in_places():
    assert restore(lenient(lenient(GREEK.encode(), "cp1252").encode(), "cp1252")).text == GREEK
    mixed = GREEK + "\n" + lenient("Διαγράφει οφειλή".encode(), "cp1252") + "\n" + GREEK
    assert restore(mixed).text == GREEK + "\nΔιαγράφει οφειλή\n" + GREEK


@pytest.mark.parametrize("read,written", [("cp1252", "cp1253"), ("cp1251", "cp1253"), ("cp1253", "cp737"), ("latin-1", "cp1253")])
def test_one_byte_round_trip(read, written):
    got = restore(lenient(GREEK.encode(written), read))
    assert got.garbled and got.text.replace(" ", " ") == GREEK
    part = GREEK + "\n" + lenient("Καθορίζει το τέλος κατάληψης πεζοδρομίου".encode(written), read)
    assert restore(part).text.startswith(GREEK) and restore(part).garbled


SOUND = [GREEK, GREEK.upper(), FRENCH, FRENCH.upper(), ROMANIAN, "Β΄ φάση, άρθρο Ξ΄ και Γ΄ τάξη… «Ο…»", "NÃO HÁ SOLUÇÃO PARA SÃO BRÁS; ÀS 5", "м² в городе Москва", "55 m² – 5 €", "ΑΪΤΟΣ ΜΑΪΟΥ ΤΑΧΥΔΡΟΜΟΣ ΡΟΛΟΓΙΑ ΛΙΘΟΔΟΜΟΣ", ""]


@pytest.mark.parametrize("text", SOUND)
def test_sound_text_stays(text):
    got = restore(text)
    assert (got.garbled, got.text, got.whole) == (False, text, True)


def test_lost_text_counts_but_is_not_whole():
    got = restore("Το �������� έργο")
    assert got.garbled and not got.whole


def test_column(spark):
    bad = lenient(GREEK.encode(), "cp1253")
    rows = [(1, bad, "x"), (1, bad, "x"), (2, None, "x"), (3, "", "x"), (4, GREEK * 2000, "x"), (5, bad * 200, "x"), (6, "Το �� έργο", None)]
    df = spark.createDataFrame(rows, "id int, text string, restored string")
    got = restore_texts(df, "text").collect()
    assert sorted(r.id for r in got if r.garbled) == [1, 1, 5, 6]
    assert all(r.restored == GREEK for r in got if r.id == 1)
    assert {r.id: r.restored for r in got}[2] is None
    assert restore_texts(df.limit(0), "text").count() == 0


OTHERS = {
    "ru": "Совет утвердил бюджет на 2024 год.", "he": "המועצה אישרה את התקציב לשנת 2024.", "ar": "وافق المجلس على الميزانية لعام 2024.", "zh": "市议会批准了2024年的预算。", "ja": "市議会は2024年度の予算を承認しました。",
    "ko": "시의회는 2024년 예산을 승인했습니다.", "th": "สภาอนุมัติงบประมาณปี 2024", "pl": "Rada zatwierdziła budżet na rok 2024, żółć.", "vi": "Hội đồng đã phê duyệt ngân sách năm 2024.", "grc": "ἐν ἀρχῇ ἦν ὁ λόγος, καὶ ὁ λόγος ἦν πρὸς τὸν θεόν",
}


@pytest.mark.parametrize("lang", OTHERS)
@pytest.mark.parametrize("codec", ["cp1252", "latin-1", "cp1253", "cp1251", "cp437"])
def test_other_scripts(lang, codec):
    text = OTHERS[lang]
    got = restore(lenient(text.encode(), codec))
    assert got.garbled and got.text == text
    assert not restore(text).garbled or lang == "ru"


def test_russian_stays_russian():
    assert restore("Совет утвердил бюджет на 2024 год, сообщает «Ведомости» — 5 §.").text.startswith("Совет утвердил")


@pytest.mark.parametrize("layers", range(1, 9))
def test_any_number_of_layers(layers):
    text = "Η επιτροπή «ενέκρινε» το ποσό – ομόφωνα."
    bad = text
    for _ in range(layers):
        bad = lenient(bad.encode(), "cp1252")
    assert restore(bad).text == text


@pytest.mark.parametrize("sign", "–—“”‘’…•€™")
@pytest.mark.parametrize("codec", ["cp1252", "cp1253", "cp437", "mac_roman", "cp1251"])
def test_signs_alone(sign, codec):
    for text in (f"café {sign} noir", f"un{sign}deux", f"(12{sign} 15)"):
        assert restore(lenient(text.encode(), codec)).text == text


@pytest.mark.parametrize("written,text", [("gb2312", OTHERS["zh"]), ("big5", "市議會批准了二零二四年的預算並通過決議"), ("shift_jis", OTHERS["ja"]), ("euc_jp", OTHERS["ja"]), ("euc_kr", OTHERS["ko"])])
def test_legacy_multibyte(written, text):
    got = restore("Minutes 12: " + lenient(text.encode(written), "cp1252") + " (end)")
    assert got.garbled and text in got.text


@pytest.mark.parametrize("codec", READ_AS)
def test_no_strong_span_is_held_back(codec):
    """Every sequence of two bytes and of the signs, and many of others, alone, beside a letter and beside each other."""
    rnd = random.Random(codec)
    pool = [chr(c) for c in range(0x80, 0x800)] + [c for f in FAMILIES for c in rnd.sample(f, min(len(f), 150))] + list("–—“”‘’…•€™😀🎉")
    bad = {c: lenient(c.encode(), codec) for c in pool}
    texts = [t for c in pool for t in (bad[c], f"a{bad[c]}", f"{bad[c]}a", f"Α {bad[c]} ω", bad[c] + bad[rnd.choice(pool)], bad[rnd.choice(pool)] + bad[c])]
    may = [bool(x) for t in texts for x in signs_of([t])[0]]
    assert [t for t, m in zip(texts, may) if not m and _multibyte(t) is not None] == []
    assert list(signs_of(texts)[0]) == may
