"""Passages of held-out items that stand in documents, whole or in part and not always letter by letter."""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property
from hashlib import blake2b

import ahocorasick
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from praktika.operators.lineage import cut

#: Words of a pattern of the automaton.
GRAM = 3
#: Patterns that stand in more different items than this are no evidence for one of them; a pair needs so many patterns.
OWN_ITEMS, MIN_PATTERNS = 2, 3
#: Words of a leak, and the share of words that must agree; words side by side up to this gap are one stretch.
MIN_WORDS, MIN_SHARE, GAP, MIN_STRETCH = 20, 0.85, 3, 6
#: Words between two runs of patterns that may be one stretch, if single words between them agree.
REACH = 2 * GAP + 2
#: The share that must agree of the words that belong to no standing formula.
OWN_SHARE = 0.8
#: A pattern in more than this share of all texts, and more than so many, is part of a standing formula.
FORMULA_SHARE, FORMULA_DOCUMENTS = 0.01, 12
#: Substitutions of a name by a name or a number by a number that a stretch may hold.
OTHER_NAMES = 1
#: Characters of item text in one automaton, of some 200 MB; more items make further ones, in the same pass.
BLOCK_CHARS = 4_000_000


class _Fold(dict):
    """Character to one character: a letter without case and accent, a digit, or a space."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        if c.isalnum():
            base = unicodedata.normalize("NFD", c.lower())[0]
            folded = {"ς": "σ"}.get(base, base)
        else:
            folded = " "
        self[code] = folded
        return folded


_FOLD = _Fold()
_WORDS = re.compile(r"\S+")


@dataclass
class Words:
    """The normalised words of a text; where they stand in it is found out only for texts that need it."""

    text: str
    folded: str  # a character for each of the text's
    words: list[str]

    @cached_property
    def spans(self) -> list[tuple[int, int]]:
        return [m.span() for m in _WORDS.finditer(self.folded)]

    @cached_property
    def mixed(self) -> bool:
        return any(c.islower() for c in self.text)

    def kind(self, k: int) -> str:
        """n: a number, c: capitalised in a text that has small letters, w: any other word."""
        i, j = self.spans[k]
        return "n" if self.words[k][0].isdigit() else "c" if self.mixed and self.text[i].isupper() and not self.text[i:j].isupper() else "w"


def normalised(text: str) -> Words:
    composed = text if unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text)
    folded = composed.translate(_FOLD)
    return Words(composed, folded, folded.split())


def grams(words: list[str]) -> Iterator[str]:
    return (" ".join(words[k : k + GRAM]) for k in range(len(words) - GRAM + 1))


@dataclass
class Entries:
    """What is searched for, by number: the different texts of items, and passages that several of them share."""

    texts: dict[int, Words] = field(default_factory=dict)
    items: dict[int, list] = field(default_factory=dict)  # the identifiers behind each
    passages: set[int] = field(default_factory=set)
    shared: set[str] = field(default_factory=set)  # patterns of more than OWN_ITEMS different texts
    blocks: list[list[int]] = field(default_factory=list)  # numbers for one automaton each


def entries_of(rows: list[tuple]) -> Entries:
    """Items of equal words are one entry. A passage of MIN_WORDS words or more whose every pattern stands in more
    than OWN_ITEMS different texts is an entry of its own: its words are evidence for none of them alone."""
    out, by_words = Entries(), {}
    for item, text in rows:
        w = normalised(text)
        if len(w.words) >= GRAM:
            n = by_words.setdefault(tuple(w.words), len(by_words))
            out.texts.setdefault(n, w)
            out.items.setdefault(n, []).append(item)
    owners = Counter(g for w in out.texts.values() for g in set(grams(w.words)))
    out.shared = {g for g, n in owners.items() if n > OWN_ITEMS}
    for n, w in list(out.texts.items()):
        begin = None
        for k, g in enumerate([*grams(w.words), None]):
            if g in out.shared:
                begin = k if begin is None else begin
                continue
            if begin is not None and (end := k + GRAM - 1) - begin >= MIN_WORDS and (begin > 0 or end < len(w.words)):
                words = tuple(w.words[begin:end])
                m = by_words.setdefault(words, len(by_words))
                if m not in out.texts:
                    out.texts[m] = normalised(w.text[w.spans[begin][0] : w.spans[end - 1][1]])
                    out.passages.add(m)
                out.items.setdefault(m, [])
                out.items[m] += [i for i in out.items[n] if i not in out.items[m]]
            begin = None
    size = BLOCK_CHARS
    for n, w in out.texts.items():
        if size >= BLOCK_CHARS:
            out.blocks.append([])
            size = 0
        out.blocks[-1].append(n)
        size += len(w.folded)
    return out


#: Codes of words are a character of the first range and two of the second, so that a match begins at a word.
_FIRST, _LATER, _DIGIT = 0x1000, 0x200, 64


@dataclass
class Items:
    """One automaton over the word patterns of a block of entries; a word is a code of three characters in it."""

    texts: dict[int, Words]
    codes: dict[str, str] = field(init=False)
    automaton: ahocorasick.Automaton = field(init=False)
    places: list[list[tuple[int, int]]] = field(init=False)

    def __post_init__(self) -> None:
        by_gram: dict[str, list[tuple[int, int]]] = defaultdict(list)
        self.codes, self.automaton = {}, ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for n, w in sorted(self.texts.items()):
            for k, g in enumerate(grams(w.words)):
                by_gram[g].append((n, k))
            for word in w.words:
                k = len(self.codes)
                self.codes.setdefault(word, chr(_FIRST + k // _DIGIT**2) + chr(_LATER + k // _DIGIT % _DIGIT) + chr(_LATER + k % _DIGIT))
        self.places = list(by_gram.values())
        for n, g in enumerate(by_gram):
            self.automaton.add_word("".join(self.codes[w] for w in g.split(" ")), n)
        if by_gram:
            self.automaton.make_automaton()

    def scan(self, doc: Words) -> list[tuple[int, int]]:
        """(word of the document, pattern) of every occurrence, in one pass over the text."""
        if not self.places:
            return []
        code = self.codes.get
        return [((end + 1) // 3 - GRAM, n) for end, n in self.automaton.iter("".join([code(w, "\0\0\0") for w in doc.words]))]

    def gram(self, n: int) -> str:
        item, k = self.places[n][0]
        return " ".join(self.texts[item].words[k : k + GRAM])


@dataclass
class Stretch:
    matched: list[int]  # words of the item found in order
    missed: list[int]  # words of the item between them that are not
    extra: int  # words of the document between them beyond those missed
    others: int  # names for names and numbers for numbers
    start: int  # characters of the document
    end: int


@dataclass
class Run:
    """Equal words side by side: from word ``d`` of the document and ``i`` of the item."""

    d: int
    i: int
    size: int


def runs_of(hits: list[tuple[int, int]]) -> list[Run]:
    """Maximal runs of equal words out of (word of the document, word of the item) of common patterns."""
    out: list[Run] = []
    for d, i in sorted(set(hits), key=lambda h: (h[0] - h[1], h[0])):
        if out and out[-1].d - out[-1].i == d - i and d <= out[-1].d + out[-1].size:
            out[-1].size = d + GRAM - out[-1].d
        else:
            out.append(Run(d, i, GRAM))
    return sorted(out, key=lambda r: (r.d, r.i))


def between(item: list[str], doc: list[str], a: Run, b: Run) -> list[Run] | None:
    """The words that agree, in order, between two runs; None where more than GAP side by side do not."""
    x, y = item[a.i + a.size : b.i], doc[a.d + a.size : b.d]
    most = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for p in reversed(range(len(x))):
        for q in reversed(range(len(y))):
            most[p][q] = most[p + 1][q + 1] + 1 if x[p] == y[q] else max(most[p + 1][q], most[p][q + 1])
    found, p, q = [], 0, 0
    while most[p][q]:
        if x[p] == y[q]:
            found.append(Run(b.d - len(y) + q, b.i - len(x) + p, 1))
            p, q = p + 1, q + 1
        elif most[p + 1][q] >= most[p][q + 1]:
            p += 1
        else:
            q += 1
    steps = [a, *found, b]
    if any(n.i - m.i - m.size > GAP or n.d - m.d - m.size > GAP for m, n in zip(steps, steps[1:])):
        return None
    return found


def beyond(item: list[str], doc: list[str], d: int, i: int, step: int) -> Run | None:
    """Two or more equal words that go on after up to GAP others, forwards or backwards from a word of each."""
    at = lambda words, k: words[k] if 0 <= k < len(words) else None
    for skip in range(1, GAP + 1):
        for over in sorted(range(GAP + 1), key=lambda o: abs(o - skip)):
            p, q = d + step * skip, i + step * over
            n = 0
            while n < GRAM and at(doc, p + step * n) is not None and at(doc, p + step * n) == at(item, q + step * n):
                n += 1
            if n >= 2:
                return Run(min(p, p + step * (n - 1)), min(q, q + step * (n - 1)), n)
    return None


def stretches(item: Words, doc: Words, hits: list[tuple[int, int]]) -> list[Stretch]:
    """Stretches of ``doc`` that follow ``item``; ``hits`` are (word of doc, word of item) of common patterns.

    Runs of patterns are chained where both texts go on: of all ways to reach a run the one with most words counts.
    """
    runs = runs_of(hits)
    score, back = [r.size for r in runs], [-1] * len(runs)
    links: dict[int, list[Run]] = {}
    first = 0
    longest = max((r.size for r in runs), default=0)
    for k, b in enumerate(runs):
        while runs[first].d + longest + REACH < b.d:
            first += 1
        for j in range(first, k):
            a = runs[j]
            gap_d, gap_i = b.d - a.d - a.size, b.i - a.i - a.size
            if 0 <= gap_d <= REACH and 0 <= gap_i <= REACH and score[j] + b.size > score[k]:
                inside = between(item.words, doc.words, a, b)
                if inside is not None:
                    score[k], back[k], links[k] = score[j] + b.size + len(inside), j, inside
    used, found = set(), []
    for k in sorted(range(len(runs)), key=lambda k: (-score[k], k)):
        chain: list[Run] = []
        while k >= 0 and k not in used:
            used.add(k)
            open_ = back[k] >= 0 and back[k] not in used
            chain = [*(links[k] if open_ else []), runs[k], *chain]
            k = back[k]
        if sum(r.size for r in chain) >= MIN_STRETCH:
            before = beyond(item.words, doc.words, chain[0].d - 1, chain[0].i - 1, -1)
            after = beyond(item.words, doc.words, chain[-1].d + chain[-1].size, chain[-1].i + chain[-1].size, 1)
            found.append(_stretch(item, doc, [*([before] if before else []), *chain, *([after] if after else [])]))
    return sorted(found, key=lambda s: (s.start, s.end))


def _stretch(item: Words, doc: Words, chain: list[Run]) -> Stretch:
    matched = [r.i + k for r in chain for k in range(r.size)]
    missed, extra, others = [], 0, 0
    for x, y in zip(chain, chain[1:]):
        a, b = range(x.i + x.size, y.i), range(x.d + x.size, y.d)
        missed += a
        extra += max(0, len(b) - len(a))
        kinds = Counter(map(item.kind, a)) & Counter(map(doc.kind, b))
        others += kinds["n"] + kinds["c"]
    last = chain[-1]
    return Stretch(matched, missed, extra, others, doc.spans[chain[0].d][0], doc.spans[last.d + last.size - 1][1])


def is_leak(parts: list[Stretch], formula: set[int]) -> list[Stretch]:
    """The one or two stretches, in order, that make a leak; none where there is none.

    Words of standing formulas count within a stretch that holds others as well, and only where those agree.
    """
    good = []
    for s in parts:
        own = sum(p not in formula for p in s.matched)
        lost = sum(p not in formula for p in s.missed) + s.extra
        whole = len(s.matched) / (len(s.matched) + len(s.missed) + s.extra)
        if own >= MIN_STRETCH and whole >= MIN_SHARE and own >= OWN_SHARE * (own + lost) and s.others <= OTHER_NAMES:
            good.append(s)
    best: list[Stretch] = []
    words = MIN_WORDS - 1
    for k, s in enumerate(good):
        for pair in [[s], *([s, t] for t in good[k + 1 :] if s.matched[-1] < t.matched[0] and s.end <= t.start)]:
            n = sum(len(x.matched) for x in pair)
            if n > words:
                best, words = pair, n
    return best


def in_leaks(doc: Words, hits: list[tuple[int, int]], items: Items, leaks: dict[int, list[Stretch]]) -> list[tuple[int, int]]:
    """(entry, pattern) for the patterns that the document holds only within passages it takes over from the entry.

    A passage that it would take over from more than OWN_ITEMS entries at once is a formula of theirs.
    """
    at: dict[int, list[int]] = defaultdict(list)
    for d, n in hits:
        at[n].append(d)
    found = []
    for n, begins in at.items() if leaks else ():
        owners = {i for i, _ in items.places[n]} & leaks.keys()
        inside = [{i for i in owners if any(s.start <= doc.spans[d][0] and doc.spans[d + GRAM - 1][1] <= s.end for s in leaks[i])} for d in begins]
        if all(len(x) <= OWN_ITEMS for x in inside):
            found += [(i, n) for i in sorted(set.intersection(*inside))]
    return found


_PARTS = "array<struct<matched array<int>, missed array<int>, extra int, others int, start int, end int>>"
_SCAN = f"body bigint, grams array<struct<block int, gram int>>, inside array<struct<block int, item int, gram int>>, pairs array<struct<item int, parts {_PARTS}>>"
_built: dict[tuple[str, int], Items] = {}


def _automaton(search: str, block: int, entries: Entries) -> Items:
    """The automaton of a block, built once in a worker, for the current search only."""
    for old in [k for k in _built if k[0] != search]:
        del _built[old]
    if (search, block) not in _built:
        _built[search, block] = Items({n: entries.texts[n] for n in entries.blocks[block]})
    return _built[search, block]


def find_leaks(documents: DataFrame, items: DataFrame, doc: str = "doc_id", doc_text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Every document that takes over MIN_WORDS or more words of an item, in order and in one or two stretches.

    The items make one automaton over the patterns of their normalised words (one for every BLOCK_CHARS characters of
    them), and every document is read, normalised and scanned once. Case, accents, punctuation and white space are no
    difference. A document's hits on an item that lie side by side in both are chained; a chain goes on over up to GAP
    words that differ, MIN_SHARE of its words must agree, and names or numbers put in the place of others make it a
    different sentence. How many texts hold a pattern is counted over all of them in the same scan: the words of
    standing formulas do not make a leak by themselves. Documents of the same normalised words are one text, and a text
    that takes a passage over from an item is no evidence that the item's words in it are a formula, so no number of
    copies makes a leak one. Items of the same words are one text and all of them leak. A passage that more than
    OWN_ITEMS different items share is searched for by itself: its items leak where it is taken over, unless it
    stands in so many texts that it is a standing formula.

    The items' texts are gathered on the driver and broadcast: held-out material, BLOCK_CHARS characters of which take
    some 200 MB in a worker. Null or empty texts and ids hold and leak nothing; repeated rows of documents or items
    count once; an empty table on either side gives an empty result; other columns are ignored; identifiers may be of
    any type.
    Out: ``doc_id``, ``item_id``, ``n_words``, ``spans`` (array of start and end in characters of the composed text).
    """
    spark = documents.sparkSession
    docs = documents.select(F.col(doc).alias("doc"), F.col(doc_text).alias("text")).where("doc is not null and text is not null")
    wanted = items.select(F.col(item).alias("item"), F.col(item_text).alias("text")).where("item is not null and text is not null").distinct().orderBy("item", "text")
    entries = entries_of([tuple(r) for r in wanted.toLocalIterator()])
    spans = "spans array<struct<start int, end int>>"
    doc_type, item_type = (df.schema[c].dataType.simpleString() for df, c in ((documents, doc), (items, item)))
    out = f"doc_id {doc_type}, item_id {item_type}, n_words int, {spans}"
    if not entries.texts:
        return spark.createDataFrame([], out)
    shipped, search, n_blocks = spark.sparkContext.broadcast(entries), uuid.uuid4().hex, len(entries.blocks)
    scanned = cut(docs.mapInPandas(_scanner(shipped, search, n_blocks), f"doc {doc_type}, {_SCAN}"))
    texts = cut(scanned.groupBy("body").agg(F.min_by(F.struct("grams", "inside"), "doc").alias("t")).select("t.*"))
    often = max(FORMULA_SHARE * texts.count(), FORMULA_DOCUMENTS)
    # at most one row per pattern, and one per pattern of an entry; a passage's row -1 counts its texts
    common = texts.select(F.explode("grams").alias("x")).groupBy("x.block", "x.gram").count().where(F.col("count") > often).collect()
    inside = {(r.item, r.gram): r["count"] for r in texts.select(F.explode("inside").alias("x")).groupBy("x.item", "x.gram").count().collect()}
    formula: dict[int, set[int]] = defaultdict(set)
    for block in sorted({r.block for r in common}):
        places = Items({n: entries.texts[n] for n in entries.blocks[block]}).places
        for r in common:
            for i, p in places[r.gram] if r.block == block else ():
                if r["count"] - inside.get((i, r.gram), 0) > often:
                    formula[i] |= set(range(p, p + GRAM))
    for n in entries.passages:
        if inside.get((n, -1), 0) > often:
            formula[n] = set(range(len(entries.texts[n].words)))
    found = scanned.select("doc", F.explode("pairs").alias("p")).select("doc", "p.*").mapInPandas(_judge(shipped, dict(formula)), out)
    # an item may leak by itself and by a passage that it shares
    return found.groupBy("doc_id", "item_id").agg(F.max(F.struct("n_words", "spans")).alias("r")).select("doc_id", "item_id", "r.*")


def _scanner(shipped: Broadcast, search: str, n_blocks: int):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        entries = shipped.value
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc"], batch["text"]):
                words = normalised(text)
                body = int.from_bytes(blake2b(" ".join(words.words).encode("utf-8", "surrogatepass"), digest_size=8).digest(), signed=True)
                seen, inside, pairs = [], [], []
                for block in range(n_blocks):
                    items = _automaton(search, block, entries)
                    hits = items.scan(words)
                    found = _pairs(words, hits, items, entries)
                    leaks = {i: kept for i, parts in found.items() if (kept := is_leak(parts, set()))}
                    seen += [{"block": block, "gram": n} for n in sorted({n for _, n in hits})]
                    inside += [{"block": block, "item": i, "gram": n} for i, n in in_leaks(words, hits, items, leaks)]
                    inside += [{"block": block, "item": i, "gram": -1} for i in sorted(leaks.keys() & entries.passages)]
                    pairs += [{"item": i, "parts": [vars(s) for s in parts]} for i, parts in sorted(found.items())]
                rows.append((doc_id, body, seen, inside, pairs))
            yield pd.DataFrame(rows, columns=["doc", "body", "grams", "inside", "pairs"])

    return scan


def _pairs(doc: Words, hits: list[tuple[int, int]], items: Items, entries: Entries) -> dict[int, list[Stretch]]:
    """Entries with the stretches that the document may take over from them."""
    own: Counter[int] = Counter()
    for _, n in hits:
        common = items.gram(n) in entries.shared
        own.update({i for i, _ in items.places[n] if not common or i in entries.passages})
    pairs = {i for i, c in own.items() if c >= MIN_PATTERNS}
    at: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for d, n in hits if pairs else ():
        for i, p in items.places[n]:
            if i in pairs:
                at[i].append((d, p))
    found = {i: stretches(items.texts[i], doc, h) for i, h in at.items()}
    return {i: parts for i, parts in found.items() if sum(len(s.matched) for s in parts) >= MIN_WORDS}


def _judge(shipped: Broadcast, formula: dict[int, set[int]]):
    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items = shipped.value.items
        for batch in batches:
            rows = []
            for d, n, parts in zip(batch["doc"], batch["item"], batch["parts"]):
                kept = is_leak([Stretch(list(p["matched"]), list(p["missed"]), p["extra"], p["others"], p["start"], p["end"]) for p in parts], formula.get(n, set()))
                if kept:
                    rows += [(d, i, sum(len(s.matched) for s in kept), [{"start": s.start, "end": s.end} for s in kept]) for i in items[n]]
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "n_words", "spans"])

    return judge
