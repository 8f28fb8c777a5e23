import random
import unicodedata

import pytest

from praktika.llm.leaks import Items, find_leaks, normalised

WORDS = ["γέφυρα", "χάρτη", "πηγή", "βόρεια", "κλειδί", "χώμα", "φύλακας", "βαρέλια", "λογιστής", "ζήτησε", "μύλος", "στάθμη", "θυρίδα", "ρολόγια", "πελαργό", "ελαιώνα", "λεμονιά", "σακιά", "πύλη", "εγκαίνια"]
FORMULA = "Αφού συντάχθηκε το παρόν πρακτικό αναγνώσθηκε, βεβαιώθηκε και υπογράφεται όπως ακολουθεί από τα μέλη του."


def sentence(rnd, n=14):
    return " ".join(rnd.choice(WORDS) + str(rnd.randrange(1000)) if rnd.random() < 0.3 else rnd.choice(WORDS) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def case():
    rnd = random.Random(5)
    items = {i: " ".join(sentence(rnd) for _ in range(5)) + " " + FORMULA for i in range(1, 6)}
    noise = lambda: " ".join(sentence(rnd) for _ in range(8))
    docs, leaks = {}, set()

    def add(text, *found):
        docs[len(docs) + 1] = text
        leaks.update((len(docs), i) for i in found)

    w = items[1].split()
    add(noise() + " " + " ".join(w[10:40]) + " " + noise(), 1)
    add(noise() + " " + unicodedata.normalize("NFD", " ".join(w[10:40]).upper()) + "\n", 1)
    changed = list(w[5:45])
    changed[8] = changed[19] = "άλλος"
    del changed[30]
    add("Αρχή. " + " , ".join(changed), 1)
    add(" ".join(w[0:12]) + " " + noise() + " " + " ".join(w[30:43]) + " " + noise(), 1)
    add(" ".join(w[10:24]) + " " + noise())
    add(noise() + items[2] + noise() + items[3], 2, 3)
    for _ in range(40):
        add(noise() + " " + FORMULA + " " + noise())
    other = "Η κυρία {} κληροδότησε τον ελαιώνα {} στους {} γείτονες που πότιζαν τη λεμονιά της πλατείας κάθε χρόνο πριν από την αυγή μαζί με {}."
    items[9] = other.format("Άννα Μελά", "Γ31", "72", "τον Νίκο")
    add(noise() + other.format("Ζωή Ρήγα", "Β99", "64", "τον Πάνο") + noise())
    add(other.format("Άννα Μελά", "Γ31", "72", "τον Νίκο"), 9)
    add(None)
    add("")
    add("λέξη " * 100_000)
    return items, docs, leaks


def test_planted_leaks(spark, case):
    items, docs, leaks = case
    rows = [(d, t, "x") for d, t in docs.items()]
    d = spark.createDataFrame(rows + rows[:3] + [(None, items[1], "x")], "doc_id bigint, text string, item_id string")
    b = spark.createDataFrame([*items.items(), (1, items[1]), (77, None), (78, "")], "item_id bigint, text string")
    got = find_leaks(d, b).collect()
    assert {(r.doc_id, r.item_id) for r in got} == leaks and len(got) == len(leaks)
    one = next(r for r in got if r.doc_id == 1)
    assert docs[1][one.spans[0].start : one.spans[0].end] == " ".join(items[1].split()[10:40]).strip()
    assert find_leaks(d.limit(0), b).count() == 0 and find_leaks(d, b.limit(0)).count() == 0


def test_blocks_give_the_same(spark, case, monkeypatch):
    import praktika.llm.leaks as m

    items, docs, leaks = case
    monkeypatch.setattr(m, "BLOCK_CHARS", 900)
    d = spark.createDataFrame([*docs.items()], "doc_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in find_leaks(d, spark.createDataFrame([*items.items()], "item_id bigint, text string")).collect()} == leaks


def test_automaton_finds_what_a_search_finds():
    rnd = random.Random(1)
    texts = {i: normalised(sentence(rnd)) for i in range(4)}
    items = Items(texts)
    doc = normalised(" ".join(t for i in range(4) for t in [sentence(rnd), *texts[i].words[3:9]]))
    assert all(len(items.gram(n).split()) == 3 for n in range(len(items.places)))
    want = {(d, n) for n, places in enumerate(items.places) for d in range(len(doc.words) - 2) if doc.words[d : d + 3] == texts[places[0][0]].words[places[0][1] : places[0][1] + 3]}
    assert set(items.scan(doc)) == want


def test_copies_of_a_leak_are_no_formula(spark, case):
    items, docs, leaks = case
    once = {d: t for d, t in docs.items() if t and len(t) < 10_000}
    want = {(d, i) for d, i in leaks if d in once}
    rnd = random.Random(7)
    passage = " ".join(items[4].split()[8:40])
    copies = {1000 + k: once[6] for k in range(len(once) // 2)}  # a third of the rows, leaks items 2 and 3
    reused = {2000 + k: f"{sentence(rnd)} {passage} {sentence(rnd)}" for k in range(30)}
    want |= {(d, i) for d in copies for i in (2, 3)} | {(d, 4) for d in reused}
    d = spark.createDataFrame([*(once | copies | reused).items()], "doc_id bigint, text string")
    got = find_leaks(d, spark.createDataFrame([*items.items()], "item_id bigint, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want


def test_a_long_formula_of_many_items_stays_one(spark):
    rnd = random.Random(9)
    formula = " ".join(sentence(rnd, 30).split())
    items = {i: f"{sentence(rnd, 30)} {formula} {sentence(rnd, 30)}" for i in range(1, 6)}
    docs = {d: f"{sentence(rnd, 20)} {formula} {sentence(rnd, 20)}" for d in range(1, 41)}
    docs[99] = items[1]
    d = spark.createDataFrame([*docs.items()], "doc_id bigint, text string")
    got = find_leaks(d, spark.createDataFrame([*items.items()], "item_id bigint, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(99, 1)}


@pytest.mark.parametrize("n_docs", [12, 13, 40, 100])
@pytest.mark.parametrize("n_items", [1, 2, 3, 5])
def test_no_number_of_leaks_or_of_equal_items_hides_them(spark, n_docs, n_items):
    rnd = random.Random(n_docs * 10 + n_items)
    text = " ".join(sentence(rnd) for _ in range(4))
    items = {f"i{k}": text for k in range(n_items)} | {"other": " ".join(sentence(rnd) for _ in range(4))}
    docs = {f"d{k}": f"{sentence(rnd)} {text if k < n_docs else ''} {sentence(rnd)}" for k in range(100)}
    got = find_leaks(spark.createDataFrame([*docs.items()], "doc_id string, text string"), spark.createDataFrame([*items.items()], "item_id string, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(f"d{k}", f"i{j}") for k in range(n_docs) for j in range(n_items)}


def test_a_passage_of_several_questions(spark):
    rnd = random.Random(3)
    passage = " ".join(sentence(rnd) for _ in range(3))
    items = {k: f"{passage} {sentence(rnd)}" for k in range(5)}
    docs = {k: sentence(rnd, 60) for k in range(50)} | {99: f"{sentence(rnd)} {passage}", 98: items[2]}
    got = find_leaks(spark.createDataFrame([*docs.items()], "doc_id int, text string"), spark.createDataFrame([*items.items()], "item_id int, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(d, i) for d in (98, 99) for i in range(5)}


@pytest.mark.parametrize("seed", range(20))
def test_chains_follow_changed_words(seed):
    from praktika.llm.leaks import stretches

    rnd = random.Random(seed)
    item = normalised(" ".join(f"λ{k}" for k in range(60)))
    words = item.words[10:50]
    for _ in range(4):
        k = rnd.randrange(2, len(words) - 2)
        words[k : k + 1] = rnd.choice([["άλλο"], [], ["ένα", "δύο"]])
    doc = normalised(" ".join(["πριν"] * 5 + words + ["μετά"] * 5))
    items = Items({0: item})
    found = stretches(item, doc, [(d, p) for d, n in items.scan(doc) for _, p in items.places[n]])
    kept = [w for w in item.words if w in doc.words]
    assert sum(len(s.matched) for s in found) >= len(kept) - 4 and all(item.words[p] in doc.words for s in found for p in s.matched)
