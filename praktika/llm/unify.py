"""One form for text that looks the same: widths, accents, spaces, invisible characters and look-alike letters."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters that look alike, per pair of scripts, capitals before small letters.
GREEK_AS_LATIN = ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧο", "ABEZHIKMNOPTYXo")
GREEK_AS_CYRILLIC = ("ΑΒΓΕΗΙΚΜΟΠΡΤΦΧορα", "АВГЕНІКМОПРТФХора")
LATIN_AS_CYRILLIC = ("ABEHIKMOPCTXYSJaecopxyisj", "АВЕНІКМОРСТХУЅЈаесорхуіѕј")
LATIN_AS_CHEROKEE = ("ABCDEGHIJKLMPRSTVWZ", "ᎪᏴᏟᎠᎬᏀᎻᏆᎫᏦᏞᎷᏢᏒᏚᎢᏙᎳᏃ")
LATIN_AS_ARMENIAN = ("LOUShgoqu", "ԼՕՍՏհցօզս")
LATIN_AS_SMALL_CAPITAL = ("bghilnry", "ʙɢʜɪʟɴʀʏ")
#: Small letters that pass for Greek only inside a word that has Greek letters of its own.
INSIDE_GREEK = ("ανρυχκιωγη", "avpuxkiwyn")
INSIDE_GREEK_CYRILLIC = ("νυχκι", "vухкі")
# Letters with a form of their own in symbols and older print.
SYMBOLS = {"µ": "μ", "ϐ": "β", "ϑ": "θ", "ϕ": "φ", "ϖ": "π", "ϰ": "κ", "ϱ": "ρ", "ϲ": "σ", "ϵ": "ε", "ϒ": "Υ", "∆": "Δ", "∑": "Σ", "∏": "Π", "ſ": "s"}
#: Everything that never needs a change, as a class for the JVM's regular expressions.
PLAIN = r"[^ -@\[-`{-~«»\u2018-\u201f\u2010-\u2015\u2026€£²³¹°§·΄ʹ\u00ad\u0386\u0388-\u038a\u038c\u038e-\u03a1\u03a3-\u03ce]|\u00ad"

INVISIBLE = r"\p{Cf}\p{Cc}\u034f\u115f\u1160\u17b4\u17b5\u180b-\u180f\u3164\ufe00-\ufe0f\uffa0"


class ConflictError(ValueError):
    """Two rules map one cluster differently, or the result of a rule is changed by another."""


def compiled() -> dict[str, str]:
    """Cluster to cluster: compositions, widths and symbols, checked for conflicts and for being final."""
    table: dict[str, str] = {}

    def add(key: str, value: str) -> None:
        if key != value and table.setdefault(key, value) != value:
            raise ConflictError(f"{key!r}: {table[key]!r} and {value!r}")

    for code in [*range(0xC0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000), 0x2126, 0x212A, 0x212B]:
        one = chr(code)
        form = unicodedata.normalize("NFC", one)
        if unicodedata.category(one)[0] == "L":
            add(unicodedata.normalize("NFD", one), form)
            add(one, form)
    for code in [*range(0xFF01, 0xFFEF), *range(0x1D400, 0x1D800), *range(0x2160, 0x2180), *range(0xFB00, 0xFB07)]:
        one = chr(code)
        if unicodedata.category(one) != "Cn" and not regex.match(f"[{INVISIBLE}]", one):
            add(one, unicodedata.normalize("NFC", unicodedata.normalize("NFKC", one)))
    for key, value in SYMBOLS.items():
        add(key, value)
    for key, value in table.items():
        # what a chain of rules would give is stored at once
        table[key] = "".join(table.get(c, c) for c in value)
    for key, value in table.items():
        if value in table:
            raise ConflictError(f"{key!r} gives {value!r}, which is mapped again")
    return table


#: Bits of the scripts of a letter; LOOK is of those that only pass for another.
GREEK, LATIN, CYRILLIC, LOOK = 1, 2, 4, 8
_SCRIPTS = ((GREEK, regex.compile(r"\p{Greek}")), (LATIN, regex.compile(r"\p{Latin}")), (CYRILLIC, regex.compile(r"\p{Cyrillic}")))


def look_alikes() -> tuple[dict[str, str], dict[str, str], dict[str, str]]:
    """Letters to those they pass for: in Greek text, inside a word with Greek letters of its own, and in Latin words.

    Two letters for one, or one that is mapped again by the same table, is a conflict.
    """

    def table(*pairs: tuple[str, str]) -> dict[str, str]:
        out: dict[str, str] = {}
        for to, of in pairs:
            for value, key in zip(to, of, strict=True):
                if out.setdefault(key, value) != value:
                    raise ConflictError(f"{key!r} passes for {out[key]!r} and {value!r}")
        if again := [v for v in out.values() if v in out]:
            raise ConflictError(f"look-alikes are mapped to {again}, which are mapped again")
        return out

    to_greek = table(GREEK_AS_LATIN, GREEK_AS_CYRILLIC)
    in_greek = table(GREEK_AS_LATIN, GREEK_AS_CYRILLIC, INSIDE_GREEK, INSIDE_GREEK_CYRILLIC)
    to_latin = table(GREEK_AS_LATIN[::-1], LATIN_AS_CYRILLIC, LATIN_AS_CHEROKEE, LATIN_AS_ARMENIAN, LATIN_AS_SMALL_CAPITAL)
    return to_greek, in_greek, to_latin


class Cluster(NamedTuple):
    """What a grapheme cluster becomes, in each script that its word may be read in."""

    plain: str
    greek: str
    inside: str
    latin: str
    scripts: int
    shared: bool  # every letter passes for a Greek one
    own_latin: bool
    own_greek: bool


class Word(NamedTuple):
    """What a word becomes in a text of mostly Greek letters and in another, and how many letters of each it has."""

    in_greek: str
    in_other: str
    alone: str  # in Greek text, if it is one letter that nothing joins to Greek
    greek: int
    latin: int


class Transducer:
    """Reads a text once: words of letters, marks and what is invisible between them, by the longest cluster each.

    All that can become of a cluster is in one table, checked for conflicts; a cluster that the table lacks is added
    from its letters when it is first met.
    """

    def __init__(self) -> None:
        self.table = compiled()
        self.to_greek, self.in_greek, self.to_latin = look_alikes()
        self.special = frozenset(LATIN_AS_CHEROKEE[1] + LATIN_AS_ARMENIAN[1] + LATIN_AS_SMALL_CAPITAL[1])
        self.clusters: dict[str, Cluster] = {}
        self.cluster = regex.compile(r"\X")
        self.nothing = regex.compile(f"[{INVISIBLE}]")
        # a word and its neighbours, a space of another kind, or what is nothing to a reader
        self.token = regex.compile(rf"(?P<word>[\p{{L}}\p{{M}}µ∆∑∏\uFF21-\uFF3A\uFF41-\uFF5A](?:[{INVISIBLE}]*[\p{{L}}\p{{M}}µ∆∑∏])*)|(?P<space>[^\S ]|[\p{{Zs}}--\x20])|(?P<nothing>[{INVISIBLE}])|(?P<other>[\uFF01-\uFFEE\u2160-\u217F])", regex.V1)
        self.joined_left, self.joined_right = regex.compile(r"\p{Greek}[./]$"), regex.compile(r"^(?:[./]\p{Greek}|[΄ʹ])")
        self.word = lru_cache(maxsize=200_000)(self._word)

    def __call__(self, text: str) -> str:
        parts: list[str | tuple[Word, regex.Match]] = []
        at = greek = latin = 0
        for m in self.token.finditer(text):
            parts.append(text[at : m.start()])
            at = m.end()
            if m["word"]:
                word = self.word(m["word"])
                greek, latin = greek + word.greek, latin + word.latin
                parts.append(word.in_other if word.in_greek == word.in_other == word.alone else (word, m))
            elif m["space"]:
                parts.append(" ")
            elif m["other"]:
                parts.append(self.table.get(m["other"], m["other"]))
        parts.append(text[at:])
        in_greek = greek > 0 and greek >= latin
        return "".join(p if isinstance(p, str) else self._read(*p, in_greek) for p in parts)

    def _read(self, word: Word, m: regex.Match, in_greek_text: bool) -> str:
        if not in_greek_text:
            return word.in_other
        near = len(m["word"]) > 1 or self.joined_left.search(m.string, max(0, m.start() - 2), m.start()) or self.joined_right.search(m.string[m.end() : m.end() + 2])
        return word.in_greek if near else word.alone

    def _cluster(self, text: str) -> Cluster:
        form = self.table.get(text, text)
        plain = unicodedata.normalize("NFC", "".join(self.table.get(c, c) for c in form))
        bare = [(unicodedata.normalize("NFD", c)[0], unicodedata.normalize("NFD", c)[1:]) for c in plain]
        of = lambda c: LOOK if c in self.special else next((bit for bit, p in _SCRIPTS if p.match(c)), 0)
        scripts = 0
        for c in plain:
            scripts |= of(c)
        mapped = lambda table: unicodedata.normalize("NFC", "".join(table.get(b, b) + marks for b, marks in bare))
        return Cluster(
            plain, mapped(self.to_greek), mapped(self.in_greek), mapped(self.to_latin), scripts, all(b in self.to_greek for b, _ in bare),
            any(of(b) == LATIN and b not in self.in_greek for b, _ in bare), any(of(b) == GREEK and b not in self.to_latin for b, _ in bare),
        )

    def _word(self, word: str) -> Word:
        n_greek, n_latin = (sum(bool(p.match(c)) for c in word) for _, p in _SCRIPTS[:2])
        found = []
        for x in self.cluster.findall(self.nothing.sub("", word)):
            if x not in self.clusters:
                self.clusters[x] = self._cluster(x)
            found.append(self.clusters[x])
        plain = "".join(c.plain for c in found)
        scripts = 0
        for c in found:
            scripts |= c.scripts
        if scripts in (0, GREEK, LOOK):
            return Word(plain, plain, plain, n_greek, n_latin)
        if scripts in (LATIN, CYRILLIC):
            greek = "".join(c.greek for c in found) if all(c.shared for c in found) else plain
            return Word(greek, plain, greek if scripts == CYRILLIC else plain, n_greek, n_latin)
        if scripts & GREEK and (any(c.own_greek for c in found) or not any(c.own_latin for c in found)):
            plain = "".join(c.inside for c in found)
        elif scripts & LATIN:
            plain = "".join(c.latin for c in found)
        return Word(plain, plain, plain, n_greek, n_latin)


_transducer: Transducer | None = None


def unify(text: str | None) -> str | None:
    """``text`` in the one form; null stays null."""
    global _transducer
    if text is None:
        return None
    if _transducer is None:
        _transducer = Transducer()
    return _transducer(text)


def unified_column(text: Column) -> Column:
    """``text`` in the one form. Only texts with a character outside PLAIN leave the JVM, in Arrow batches."""

    @F.pandas_udf("string")
    def transduce(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(unify, na_action="ignore").astype("object")

    return F.coalesce(transduce(F.when(text.rlike(PLAIN), text)), text)


def unify_texts(df: DataFrame, text: str, out: str = "unified", changed: str = "changed") -> DataFrame:
    """``df`` with ``out``, the text in the one form, and ``changed``, whether it was not in it.

    Words are brought to composed letters of normal width; letters that look like those of the script the word is
    read in are replaced by them; every kind of space is the plain one; what is invisible goes. Case, missing
    accents, quotation marks, dashes, numeral marks and superscripts stay. A word wholly of letters that two scripts
    share is read as Greek in a text of mostly Greek letters; a single such letter only where it is joined to Greek
    by a point or slash or carries a numeral mark. Null gives null and is not changed; empty stays empty; repeated
    rows stay as they are; a column already named ``out`` or ``changed`` is replaced.
    """
    result = df.withColumn(out, unified_column(F.col(text)))
    return result.withColumn(changed, F.coalesce(F.col(out) != F.col(text), F.lit(False)))
