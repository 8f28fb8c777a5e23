"""Variant spellings of people's names, linked to a roster by a segment join."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Edits that a spelling may be away from a name, in sounds; shorter strings allow fewer.
EDITS, LONG, SHORT = 2, 10, 6
#: Letters of an abbreviated surname that can stand for it.
STEM = 3
#: Names and words that a worker remembers of each kind, some 2 KB each: pairs come city by city.
CACHED = 10_000

# Given names and their short forms, without accents.
SHORT_FORMS = {
    "αναστασιοσ": "τασοσ αναστασησ τασησ", "ευαγγελοσ": "βαγγελησ", "μιχαηλ": "μιχαλησ μικεσ", "βασιλειοσ": "βασιλησ βασοσ", "χρυσουλα": "χρυσα",
    "εμμανουηλ": "μανωλησ μανοσ", "θεοδωροσ": "θοδωρησ θοδωροσ", "ιωαννησ": "γιαννησ", "ευστρατιοσ": "στρατησ", "αθανασιοσ": "θανασησ νασοσ σακησ θανοσ",
    "χαραλαμποσ": "χαρησ μπαμπησ λαμπησ", "γεωργιοσ": "γιωργοσ γιωργησ", "δημητριοσ": "τζιμησ δημητρησ μητσοσ μιμησ", "παναγιωτησ": "τακησ πανοσ", "στυλιανοσ": "στελιοσ",
    "ελευθεριοσ": "λευτερησ", "αλεξανδροσ": "αλεκοσ αλεξησ", "νικολαοσ": "νικολασ νικοσ", "πετροσ": "πετρησ", "κωνσταντινοσ": "κωστησ ντινοσ κωστασ", "σπυριδων": "σπυροσ",
    "βασιλικη": "βικυ βασω", "ευαγγελια": "ευα λιτσα", "ευσταθια": "εφη", "δημητρα": "μιμη", "αναστασια": "τασουλα νατασα", "φωτεινη": "φωφη", "μαρια": "μαιρη", "ελενη": "νιτσα λενα",
    "ειρηνη": "ρενα", "σταυρουλα": "ρουλα βουλα", "γεωργια": "γωγω", "αγγελικη": "κικη", "παναγιωτα": "γιωτα", "κωνσταντινα": "ντινα", "αικατερινη": "κατερινα καιτη", "σοφια": "σοφη",
    "θεοδωρα": "δωρα", "αντωνιοσ": "αντωνησ", "ηλιασ": "", "αποστολοσ": "τολησ", "γρηγοριοσ": "γρηγορησ", "ευθυμιοσ": "θυμιοσ", "ζωη": "", "ιωαννα": "γιαννα", "αννα": "", "λεωνιδασ": "λευτερισ", "σωτηριοσ": "σωτηρησ",
}
# What stands before a name, and Latin letters for Greek ones, longest first.
TITLES = frozenset("κ κοσ κυριοσ κα κυρια δρ dr mr mrs ms καθ καθηγητησ καθηγητρια".split())
LATIN = {"th": "θ", "ch": "χ", "ps": "ψ", "ks": "ξ", "oy": "ου", "ou": "ου", "ey": "ευ", "ay": "αυ", "a": "α", "b": "μπ", "c": "κ", "d": "δ", "e": "ε", "f": "φ", "g": "γ", "h": "η", "i": "ι", "j": "τζ", "k": "κ", "l": "λ", "m": "μ", "n": "ν", "o": "ο", "p": "π", "q": "κ", "r": "ρ", "s": "σ", "t": "τ", "u": "ου", "v": "β", "w": "ω", "x": "ξ", "y": "υ", "z": "ζ"}
SOUNDS = (("ου", "u"), ("αυ", "αβ"), ("ευ", "εβ"), ("αι", "ε"), ("ει", "ι"), ("οι", "ι"), ("υι", "ι"), ("η", "ι"), ("υ", "ι"), ("ω", "ο"))

READINGS = (lambda word: sound(word), str)
_FORMAL = {n: f for f, short in SHORT_FORMS.items() for n in [f, *short.split()]}
_LATIN_RE = re.compile("|".join(LATIN))


def fold(text: str) -> str:
    """Small letters without accents; Latin letters as the Greek ones they stand for."""
    plain = "".join(c for c in unicodedata.normalize("NFD", text.lower()) if not unicodedata.combining(c)).replace("ς", "σ")
    return _LATIN_RE.sub(lambda m: LATIN[m.group()], plain) if re.search("[a-z]", plain) else plain


@lru_cache(maxsize=CACHED)
def sound(word: str) -> str:
    """What a folded word sounds like: one letter per vowel sound, no doubled letter."""
    for spelled, heard in SOUNDS:
        word = word.replace(spelled, heard)
    return re.sub(r"(.)\1+", r"\1", word)


@lru_cache(maxsize=10_000)
def given_forms(word: str) -> frozenset[str]:
    """All forms of a given name; itself where it is not known."""
    formal = _FORMAL.get(word, word)
    return frozenset([word, formal, *SHORT_FORMS.get(formal, "").split()])


_KNOWN_SOUND = {sound(n): frozenset(sound(x) for x in given_forms(n)) for n in _FORMAL}


@dataclass(frozen=True)
class Person:
    given: tuple[str, ...]  # all forms of the given name, folded
    surnames: tuple[str, ...]  # the whole surname and its halves, folded
    main: frozenset[str]  # the forms that an initial means first: the roster's own and the full one

    def heard(self, how: Callable[[str], str]) -> tuple[tuple[str, ...], tuple[str, ...]]:
        return tuple(dict.fromkeys(map(how, self.given))), tuple(dict.fromkeys(map(how, self.surnames)))


@lru_cache(maxsize=CACHED)
def person(name: str) -> Person | None:
    """The parts of a roster name, in whatever order it has them."""
    inside = [fold(x) for x in re.findall(r"\(([^)]*)\)", name)]
    raw = re.sub(r"\([^)]*\)", " ", name)
    tokens = [t for t in re.split(r"[\s.,]+", fold(raw)) if t.strip("-") and t not in TITLES]
    if len(tokens) < 2:
        return None
    known = [t for t in tokens if t in _FORMAL]
    given = known[0] if known else tokens[-1] if raw.isupper() else tokens[0]
    rest = [t for t in tokens if t != given]
    forms = sorted(given_forms(given).union(*[given_forms(x.strip()) for x in inside]))
    halves = [h for t in rest for h in t.split("-") if h]
    whole = "".join(halves)
    return Person(tuple(forms), tuple(dict.fromkeys([whole, *(halves if len(halves) > 1 else [])])), frozenset([given, _FORMAL.get(given, given)]))


@dataclass(frozen=True)
class Spelling:
    words: tuple[str, ...]  # folded, titles, patronymics and brackets left out
    short: tuple[tuple[str, str], ...]  # abbreviated words as (beginning, end)


@lru_cache(maxsize=CACHED)
def spelling(raw: str) -> Spelling:
    """The words of a name as typed: whole ones and abbreviated ones (Ν., Χαρ., Βασ/κή)."""
    text = re.sub(r"\([^)]*\)?", " ", unicodedata.normalize("NFC", raw))
    text = re.split(r"\s(?:του|ΤΟΥ|Του)\s", text)[0]
    words, short = [], []
    for typed in re.findall(r"[^\W\d_]+(?:/[^\W\d_]+)?\.?", text):
        token = fold(typed)
        bare = token.rstrip(".")
        if bare in TITLES and (len(bare) > 1 or typed[0] == "κ"):  # a capital is an initial
            continue
        if "/" in bare:
            short.append(tuple(bare.split("/")))
        elif token.endswith(".") or len(bare) == 1:
            short.append((bare, ""))
        else:
            words.append(bare)
    return Spelling(tuple(words), tuple(short))


@lru_cache(maxsize=CACHED)
def _letters(text: str) -> frozenset[str]:
    return frozenset(text)


def banded(a: str, b: str, most: int) -> int:
    """Edit distance with neighbours swapped as one edit, in the band of ``most`` around the diagonal; most+1 beyond."""
    if a == b:
        return 0
    # a letter that the other lacks is an edit, and each edit brings in one such letter at most
    if not most or abs(len(a) - len(b)) > most or len(_letters(a) - _letters(b)) > most or len(_letters(b) - _letters(a)) > most:
        return most + 1
    # equal ends need no edits
    i, n = 0, min(len(a), len(b))
    while i < n and a[i] == b[i]:
        i += 1
    j = 0
    while j < n - i and a[-1 - j] == b[-1 - j]:
        j += 1
    a, b = a[i : len(a) - j], b[i : len(b) - j]
    if not a or not b:
        return len(a) + len(b)
    if most == 1:
        return 1 if len(a) == len(b) == 1 or (len(a) == 2 and a == b[::-1]) else 2
    far = most + 1
    two, one = None, [j if j <= most else far for j in range(len(b) + 1)]
    for i in range(1, len(a) + 1):
        row = [far] * (len(b) + 1)
        if i <= most:
            row[0] = i
        lo, hi = max(1, i - most), min(len(b), i + most)
        for j in range(lo, hi + 1):
            v = min(one[j - 1] + (a[i - 1] != b[j - 1]), one[j] + 1, row[j - 1] + 1)
            if two is not None and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                v = min(v, two[j - 2] + 1)
            row[j] = min(v, far)
        if min(row[lo - 1 : hi + 1], default=far) > most:
            return far
        two, one = one, row
    return one[-1]


def allowed(length: int) -> int:
    return EDITS if length >= LONG else 1 if length >= SHORT else 0


def segments(text: str, k: int) -> Iterator[tuple[int, int, str]]:
    """(number, place, text) of the k+1 even segments of a string."""
    base, longer = divmod(len(text), k + 1)
    at = 0
    for i in range(k + 1):
        size = base + (i >= k + 1 - longer)
        yield i, at, text[at : at + size]
        at += size


def index_keys(text: str, kind: str) -> list[str]:
    """The keys under which the inverted index holds a string."""
    k = allowed(len(text))
    return [f"{kind}{len(text)}:{i}:{part}" for i, _, part in segments(text, k)]


def probe_keys(text: str, kind: str) -> list[str]:
    """The substrings, shifted in place, that a string within the allowed edits must share with an indexed one.

    Segment i of k+1 can only be met by a substring whose shift leaves at most i edits to its left and k-i to its right.
    """
    keys, m = set(), len(text)
    for length in range(max(1, m - EDITS), m + EDITS + 1):
        k = allowed(length)
        if abs(m - length) > k:
            continue
        delta = m - length
        for i, at, part in segments("\0" * length, k):
            low = max(0, at - i, at + delta - (k - i))
            high = min(m - len(part), at + i, at + delta + (k - i))
            keys |= {f"{kind}{length}:{i}:{text[p : p + len(part)]}" for p in range(low, high + 1)}
    return sorted(keys)


def person_keys(name: str) -> list[str]:
    p = person(name)
    if p is None:
        return []
    keys: set[str] = set()
    for how in READINGS:  # under one name: where a word is read as it is heard, its keys are the same
        given, surnames = p.heard(how)
        keys |= {k for g in given for s in surnames for t in (g + s, s + g) for k in index_keys(t, "")}
        # a surname beside an abbreviated given name is looked up together with the latter's initial
        for initial in {g[0] for g in p.given}:
            keys |= {k for s in surnames for k in index_keys(s, f"S{initial}")}
            keys |= {f"P{initial}{s[:n]}" for s in surnames for n in range(STEM, len(s) + 1)}
    return sorted(keys)


def spelling_keys(raw: str) -> list[str]:
    s = spelling(raw)
    keys: set[str] = set()
    for how in READINGS:
        read = [how(w) for w in s.words]
        if read and not s.short:
            keys.update(probe_keys("".join(read), ""))
        elif read:
            initial = s.short[0][0][0]
            keys.update(k for w in {"".join(read), *read} for k in probe_keys(w, f"S{initial}"))
        elif len(s.short) == 2:
            keys |= {f"P{b[0][0]}{how(a[0])}" for a, b in (s.short, s.short[::-1]) if len(how(a[0])) >= STEM}
    return sorted(keys)


def distance(raw: str, name: str) -> float | None:
    """How far a spelling is from a roster name, as read or as heard; None where it does not stand for it."""
    p, s = person(name), spelling(raw)
    if p is None:
        return None
    found = [d for how in READINGS if (d := _distance(s, p, how)) is not None]
    return min(found, default=None)


def _distance(s: Spelling, p: Person, how: Callable[[str], str]) -> float | None:
    given_forms_, surnames = p.heard(how)
    best: float | None = None
    if s.words and not s.short:
        read = [how(w) for w in s.words]
        known = [_KNOWN_SOUND[h] for h in map(sound, s.words) if h in _KNOWN_SOUND]
        if known and not any(k & set(p.heard(sound)[0]) for k in known):
            return None  # it names somebody else's given name
        text = "".join(read)
        for last in surnames:
            for given in given_forms_:
                most = min(allowed(len(given) + len(last)), 1 if len(given) <= 3 else EDITS)
                for both in (given + last, last + given):
                    d = banded(text, both, most)
                    if d <= most and (len(read) == 1 or _parts_fit(read, given, last)):
                        best = d if best is None else min(best, d)
        return best
    if s.words:
        for last in surnames:
            for w in {"".join(map(how, s.words)), *(how(w) for w in s.words if len(s.words) == 1)}:
                most = min(1, allowed(len(last)))
                d = banded(w, last, most)
                fits = [g for g in p.given if _abbreviates(*s.short[0], g)]
                if d <= most and fits:
                    d += 0.25 if p.main & set(fits) else 0.5
                    best = d if best is None else min(best, d)
        return best
    if len(s.short) == 2:
        for a, b in (s.short, s.short[::-1]):
            if len(how(a[0])) >= STEM and any(last.startswith(how(a[0])) for last in surnames) and any(_abbreviates(*b, g) for g in p.given):
                best = 0.5
    return best


def _abbreviates(begin: str, end: str, word: str) -> bool:
    return word.startswith(begin) and word.endswith(end) and (len(word) > len(begin) or len(begin) >= STEM)


def _parts_fit(heard: list[str], given: str, last: str) -> bool:
    """Whether the words split into given name and surname with at most so many edits as each part bears."""
    for cut in range(1, len(heard)):
        for one, two in (("".join(heard[:cut]), "".join(heard[cut:])), ("".join(heard[cut:]), "".join(heard[:cut]))):
            few = 0 if len(given) <= 4 else 1 if len(given) <= 5 else EDITS
            if banded(one, given, few) <= few and banded(two, last, EDITS) <= EDITS:
                return True
    return False


def link_spellings(spellings: DataFrame, roster: DataFrame, within: str, raw: str = "raw_name", person_id: str = "person_id", name: str = "name") -> DataFrame:
    """The person of the roster that each distinct (``within``, ``raw``) stands for, with its distance.

    Roster names are indexed by the segments of their sounds, in either order of their parts, with every form of the
    given name and with halves of double surnames. A spelling probes the index with position-shifted substrings;
    whoever shares one is verified by banded edit distance on the whole and on the parts. The nearest person is
    taken; where two are as near, nobody is. Nulls and names without letters stand for nobody; repeated rows count
    once; a person whose name is one word is not indexed; very long spellings are compared whole; an empty table on
    either side gives none; other columns are ignored.
    """

    @F.pandas_udf("array<string>")
    def keys_of_person(names: pd.Series) -> pd.Series:
        return names.map(person_keys)

    @F.pandas_udf("array<string>")
    def keys_of_spelling(names: pd.Series) -> pd.Series:
        return names.map(spelling_keys)

    @F.pandas_udf("double")
    def away(raws: pd.Series, names: pd.Series) -> pd.Series:
        return pd.Series([distance(a, b) for a, b in zip(raws, names)], dtype="float64")

    # Catalyst would copy a deterministic function into the filters it infers and so call it two or three times
    keys_of_person, keys_of_spelling, away = (f.asNondeterministic() for f in (keys_of_person, keys_of_spelling, away))
    people = roster.select(F.col(within).alias("_in"), F.col(person_id).alias("_id"), F.col(name).alias("_name")).where("_in is not null and _id is not null and _name is not null").distinct()
    typed = spellings.select(F.col(within).alias("_in"), F.col(raw).alias("_raw")).where("_in is not null and _raw is not null").distinct()
    index = people.withColumn("_key", F.explode(keys_of_person("_name")))
    probes = typed.withColumn("_key", F.explode(keys_of_spelling("_raw")))
    # merged: Catalyst knows nothing of the many keys of a row and would send the whole index to the driver and on
    pairs = probes.join(index.hint("merge"), ["_in", "_key"]).select("_in", "_raw", "_id", "_name").distinct()
    # in this order the few names of a place recur, so that a worker need not remember all
    near = pairs.sortWithinPartitions("_in", "_raw").withColumn("_d", away("_raw", "_name")).where("_d is not null and not isnan(_d)").groupBy("_in", "_raw", "_id").agg(F.min("_d").alias("_d"))
    # one row per candidate person of one spelling: as many as share a segment with it
    rank = Window.partitionBy("_in", "_raw").orderBy("_d")
    first = near.withColumns({"_rank": F.row_number().over(rank), "_next": F.lead("_d").over(rank)}).where("_rank = 1 and (_next is null or _next > _d)")
    return first.select(F.col("_in").alias(within), F.col("_raw").alias(raw), F.col("_id").alias(person_id), F.col("_d").alias("distance"))
