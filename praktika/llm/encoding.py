"""Text that was decoded with the wrong character encoding: finding it and restoring it span by span."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Encodings a text may have been read with, and pairs (read with, written in) of one byte a character.
READ_AS = ("cp1252", "cp1253", "iso8859_7", "cp437", "cp850", "cp737", "cp1251", "iso8859_2", "cp1250", "cp852", "cp866", "koi8_r", "mac_roman", "mac_greek", "cp1254")
ONE_BYTE = (("cp1252", "cp1253"), ("cp1252", "iso8859_7"), ("cp1251", "cp1253"), ("cp1253", "cp737"), ("cp1252", "cp737"), ("cp437", "cp1253"), ("cp850", "cp1253"), ("koi8_r", "cp1253"), ("cp866", "cp1253"), ("cp1251", "cp737"), ("mac_roman", "cp1253"), ("cp1250", "cp1253"), ("iso8859_2", "cp1253"), ("cp437", "cp737"))
#: Texts that are scanned for signs at once.
SCANNED = 64
#: A sequence so many characters from a span of the same encoding belongs to it.
NEAR = 4
#: Letters in words that make sense again before a one-byte span counts.
ONE_BYTE_LETTERS, ONE_BYTE_SHARE = 6, 0.6

_SEQUENCE = rb"(?:[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2})"
#: The byte-structure automaton: maximal runs of well-formed sequences of two or more bytes.
_SPAN = re.compile(_SEQUENCE + b"+")
_HIGH = re.compile(rb"[\x80-\xff]+")
_PARTS = re.compile(r"(\n+|(?<=[.;!?])\s+)")
_LETTERS = re.compile(r"[^\W\d_]+")
_FOREIGN = re.compile(r"[^A-Za-zÀ-ÖØ-öø-ɏͰ-ͳͶͷͻ-ͽΆΈ-Ͽ]")
def _chars(*ranges: tuple[int, int]) -> str:
    return "".join(chr(c) for a, b in ranges for c in range(a, b + 1))


_GREEK = "ΆΈΉΊΌΎΏΐΪΫάέήίΰϊϋόύώ" + _chars((0x391, 0x3A1), (0x3A3, 0x3A9), (0x3B1, 0x3C9))
_LATIN = _chars((0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x17F), (0x218, 0x21B), (0x1E00, 0x1EFF))
_SIGNS = "«»“”„‘’‚–—―…€·°²³§£΄´\xa0½¼×ªº©®™•†‡‰‹›№′″−→←"
_LAYER = _chars((0x80, 0xFF)) + bytes(b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)).decode("cp1252")
#: Scripts whose letters may come out of a span together, besides signs. The first also holds what is garbled once more.
FAMILIES = (
    _GREEK + _LATIN + _LAYER + _chars((0x1F00, 0x1FFE)),
    _chars((0x400, 0x45F), (0x490, 0x491)),
    _chars((0x5B0, 0x5C7), (0x5D0, 0x5EA)),
    _chars((0x60C, 0x60C), (0x61B, 0x61B), (0x61F, 0x61F), (0x621, 0x66D), (0x671, 0x6D3), (0x6F0, 0x6F9)),
    _chars((0x3000, 0x30FF), (0x4E00, 0x9FFF), (0xFF01, 0xFF65), (0xAC00, 0xD7A3)),
    _chars((0xE01, 0xE5B)),
    _chars((0x900, 0x97F)),
    _chars((0x531, 0x587)),
    _chars((0x10D0, 0x10FF)),
)
_PICTURES = _chars((0x2600, 0x27BF), (0x1F300, 0x1FAFF)) + "\ufe0f\u200d"
_MASKS: dict[str, int] = {}
for _k, _family in enumerate((*FAMILIES, _PICTURES)):
    for _c in _family:
        _MASKS[_c] = _MASKS.get(_c, 0) | 1 << _k
_MASKS |= dict.fromkeys(_SIGNS, (1 << len(FAMILIES) + 1) - 1)
_ALONE, _SIGN = frozenset(_LATIN + _SIGNS), frozenset(_SIGNS)


def _family_of(decoded: str) -> int:
    """The families that hold all of ``decoded``, as bits; 0 where none does."""
    mask = -1
    for c in decoded:
        mask &= _MASKS.get(c, 0)
    return mask


_BEYOND = re.compile("[\u0080-\uffff]")
_MIXED = re.compile("(?=[À-ɏ]*[Ͱ-Ͽ])(?=[Ͱ-Ͽ]*[À-ɏ])[À-ɏͰ-Ͽ]")
_ALL_GREEK = re.compile(f"[{_GREEK}]+")
_WORD = re.compile(rf"^(?:[{_GREEK}]?[α-ωάέήίόύώϊϋΐΰ]+|[Α-ΩΆΈΉΊΌΎΏΪΫ]+)$")
_LAST = frozenset("αεηιουωςνρξψάέήίόύώϊϋΑΕΗΙΟΥΩΣΝΡΞΨ")
_ACCENTS = frozenset("ΆΈΉΊΌΎΏΐάέήίΰόύώ")
_BROKEN = re.compile("[\x80-\x84\x86-\x9f�]|(?<=\\w)[─-▟](?=\\w)")


@dataclass
class Restored:
    garbled: bool
    text: str
    whole: bool  # nothing garbled is left


@lru_cache(maxsize=None)
def _to_bytes(codec: str) -> dict[int, int]:
    table = {b: b for b in range(0x80, 0xA0)}
    for b in range(0x80, 0x100):
        try:
            table[ord(bytes([b]).decode(codec))] = b
        except UnicodeDecodeError:
            table[b] = b  # lenient readers keep the number of a byte that the codec leaves open
    # a character that the codec lacks is no byte: it ends every span
    return {c: 0 for c in range(0xA0, 0x100) if c not in table} | table


def legacy_bytes(text: str, codec: str) -> bytes:
    """A byte for each character of ``text``, 1:1; 0x3f or 0 where the codec has none."""
    return text.translate(_to_bytes(codec)).encode("latin-1", "replace")


def _odd(text: str, i: int, j: int) -> int:
    """How many characters are of no word of the text's own scripts; Greek beside marked Latin letters makes one."""
    foreign = len(_FOREIGN.findall(text, i, j))
    return foreign or int(bool(_MIXED.search(text, i, j)))


def _fits(text: str, i: int, j: int, decoded: str) -> int:
    """The families that a span may be of; but the first only those of a span with nothing but ASCII beside it.

    Bytes of another script come side by side; a span amid other such bytes is chance in a text of one-byte words.
    """
    families = _family_of(decoded)
    return families if all(c.isascii() for c in text[max(0, i - 1) : i] + text[j : j + 1]) else families & 1


def _strong(text: str, i: int, j: int, decoded: str) -> bool:
    """Whether a span can hardly be anything but garbled text."""
    if not _fits(text, i, j, decoded):
        return False
    odd = _odd(text, i, j)
    if len(decoded) >= 2:
        # letters of the text's own scripts alone are words, whatever their bytes would be elsewhere
        return 3 * odd >= len(decoded)
    if j - i >= 3 and (decoded in _SIGN or j - i == 4):
        return odd > 0
    beside = text[max(0, i - 1) : i] + text[j : j + 1]
    return decoded in _ALONE and any(c.isascii() and c.isalpha() for c in beside) and odd > 0


def _belongs(text: str, i: int, j: int, decoded: str) -> bool:
    """Whether a sequence far from any span of its encoding is of it as well: a long one, or a letter in a word."""
    beside = text[max(0, i - 1) : i] + text[j : j + 1]
    return j - i >= 3 or (decoded in _LATIN and any(c.isascii() and c.isalpha() for c in beside))


def _patched(text: str, spans: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for i, j, decoded in spans:
        out += [text[at:i], decoded]
        at = j
    return "".join([*out, text[at:]])


def _multibyte(text: str) -> tuple[int, str] | None:
    """How much of ``text`` the spans of the one encoding that explains most of it cover, and the text with them decoded."""
    best: tuple[int, int, str] | None = None
    for codec in READ_AS:
        spans = [(m.start(), m.end(), m.group().decode("utf-8", "replace")) for m in _SPAN.finditer(legacy_bytes(text, codec))]
        strong = [k for k, s in enumerate(spans) if _strong(text, *s)]
        if not strong:
            continue
        families = 0
        for k in strong:
            families |= _fits(text, *spans[k])
        first, last = strong[0], strong[-1]
        while first and spans[first][0] - spans[first - 1][1] <= NEAR:
            first -= 1
        while last + 1 < len(spans) and spans[last + 1][0] - spans[last][1] <= NEAR:
            last += 1
        inside = [s for k, s in enumerate(spans) if _fits(text, *s) & families and (first <= k <= last or _belongs(text, *s))]
        covered = sum(j - i for i, j, _ in inside)
        if best is None or covered >= best[0]:
            fixed = _patched(text, inside)
            score = (covered, sum(len(w) for w in _LETTERS.findall(fixed) if sensible(w)), fixed)
            if best is None or score[:2] > best[:2]:
                best = score
    return best and (best[0], best[2])


def _table(chars: str | set[str], value: int = 1) -> np.ndarray:
    out = np.zeros(0x10000, np.uint32)
    out[[ord(c) for c in chars]] = value
    return out


@dataclass
class Signs:
    """What a character can be, for every character at once: a bit for each encoding in which it leads or follows."""

    lead: list[np.ndarray]  # of sequences of two, three and four bytes
    follow: np.ndarray
    odd: np.ndarray
    greek: np.ndarray
    latin: np.ndarray
    letter: np.ndarray  # of ASCII
    strange: np.ndarray  # what ordinary Greek and Latin text has only where something went wrong
    high: np.ndarray
    before: np.ndarray  # capitals and signs that rarely stand side by side
    after: np.ndarray


@lru_cache(maxsize=1)
def _signs() -> Signs:
    """Made of the encodings' tables, so that no sequence of any of them is missed."""
    lead, follow = [np.zeros(0x10000, np.uint32) for _ in range(3)], np.zeros(0x10000, np.uint32)
    for k, codec in enumerate(READ_AS):
        for c, b in _to_bytes(codec).items():
            for group, low, high in ((lead[0], 0xC2, 0xDF), (lead[1], 0xE0, 0xEF), (lead[2], 0xF0, 0xF4), (follow, 0x80, 0xBF)):
                if low <= b <= high:
                    group[c] |= 1 << k
    odd = _table([c for c in map(chr, range(0x80, 0x10000)) if _FOREIGN.match(c)])
    strange = _chars((0x80, 0x9F), (0x400, 0x4FF), (0x2500, 0x259F), (0xA1, 0xA6), (0xA8, 0xAA), (0xAC, 0xAC), (0xAE, 0xAF), (0xB1, 0xB1), (0xB3, 0xB6), (0xB8, 0xB8), (0xBA, 0xBA), (0xBC, 0xBF)) + "�ŒŠšŽžŸƒˆ˜΅―‚„†‡•‰‹›™₧₯⌐⌠"
    return Signs(
        lead, follow, odd, _table(_chars((0x370, 0x3FF))), _table(_chars((0xC0, 0x24F))), _table(_chars((0x41, 0x5A), (0x61, 0x7A))),
        _table(strange), _table(_chars((0xC0, 0xFF))), _table(_chars((0xC2, 0xDF), (0x392, 0x3A9))), _table(_chars((0xA0, 0xBF), (0x2010, 0x2026)) + "€"),
    )


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    """``x`` as seen from ``by`` characters before it."""
    none = np.zeros(min(abs(by), len(x)), x.dtype)
    return np.concatenate([x[by:], none]) if by >= 0 else np.concatenate([none, x[: len(x) + by]])[: len(x)]


def signs_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Per text whether it may hold a strong span, and whether it looks as words of one-byte encodings do.

    Sequences are found for all encodings at once, a bit for each. The first answer is never no where an encoding has
    a strong span: one with an odd character in it, which is long or stands beside a letter or another sequence.
    """
    joined = "\n".join(texts)
    c = np.minimum(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), 0xFFFF)
    ends = np.cumsum([len(t) + 1 for t in texts])
    z = _signs()
    follow, odd = z.follow[c], z.odd[c]
    f1, f2 = _shifted(follow, 1), _shifted(follow, 2)
    greek, latin = z.greek[c], z.latin[c]
    odd |= greek & _shifted(latin, 1) | latin & _shifted(greek, 1)
    o1 = odd | _shifted(odd, 1)
    two = z.lead[0][c] & f1
    three = z.lead[1][c] & f1 & f2
    four = z.lead[2][c] & f1 & f2 & _shifted(follow, 3)
    long = ((three != 0) & ((o1 | _shifted(odd, 2)) != 0)) | ((four != 0) & ((o1 | _shifted(o1, 2)) != 0))
    marked = np.where(o1 != 0, two, 0)
    letter = z.letter[c]
    beside = np.where(_shifted(letter, -1) | _shifted(letter, 2), 0xFFFFFFFF, 0).astype(np.uint32)
    beside |= _shifted(two | three | four, 2) | _shifted(two, -2) | _shifted(three, -3) | _shifted(four, -4)
    may = long | ((marked & beside) != 0)
    high = z.high[c]
    looks = (z.strange[c] | high & _shifted(high, 1) & _shifted(high, 2) | z.before[c] & _shifted(z.after[c], 1)) != 0

    def by_text(hits: np.ndarray) -> np.ndarray:
        out = np.zeros(len(texts), bool)
        out[np.searchsorted(ends, np.flatnonzero(hits), "right")] = True
        return out

    return by_text(may), by_text(looks)


def sensible(word: str) -> bool:
    """Whether a Greek word is spelled as words are: case, last letter, one accent, final sigma."""
    return bool(_WORD.match(word)) and word[-1] in _LAST and sum(c in _ACCENTS for c in word) <= 1 and "ς" not in word[:-1] and word[-1] != "σ"


def _one_byte(text: str) -> str | None:
    """Sentences of ``text`` decoded by the pair of encodings under which most high bytes become Greek words."""
    parts = _PARTS.split(text)
    best: tuple[int, str] | None = None
    for read, written in ONE_BYTE:
        raw, at = legacy_bytes(text, read), 0
        out, good, before = [], 0, False
        for part in parts:
            at, bytes_ = at + len(part), raw[at : at + len(part)]
            fine, all_, fixed = 0, 0, part
            spans = [(m.start(), m.end(), m.group().decode(written, "replace")) for m in _HIGH.finditer(bytes_)]
            spans = [s for s in spans if part[s[0] : s[1]] != s[2] and (read == "cp1253" or not _ALL_GREEK.fullmatch(part, s[0], s[1]))]
            for _, _, word in spans:
                bare = word.strip("«»·΄\xa0")
                all_ += len(word)
                fine += len(bare) if len(bare) >= 3 and sensible(bare) else 0
            sound = read == "cp1253" and sum(len(_FOREIGN.findall(part, i, j)) for i, j, _ in spans) < 0.2 * all_
            if fine >= 3 and fine >= ONE_BYTE_SHARE * all_ and not sound:
                good, fixed = good + fine, _patched(part, spans)
                good += fixed.count("€") - part.count("€")
                before = True
            elif spans and before and not sound and not _ALL_GREEK.search(part):
                fixed = _patched(part, spans)  # initials and other short words after a decoded sentence
            elif part.strip():
                before = False
            out.append(fixed)
        if good >= ONE_BYTE_LETTERS and (best is None or good > best[0]):
            best = (good, "".join(out))
    return best and best[1]


@dataclass(frozen=True)
class Legacy:
    """A multibyte encoding older than UTF-8: its byte structure, and the characters that make up most of its texts."""

    codec: str
    span: re.Pattern
    common: re.Pattern


# Byte structures of legacy encodings, and the rows of their tables that hold the common characters.
LEGACY = (
    Legacy("euc_jp", re.compile(rb"(?:[\xa1-\xf4][\xa1-\xfe]|\x8e[\xa1-\xdf])+"), re.compile(rb"[\xa1\xa4\xa5][\xa1-\xfe]")),
    Legacy("shift_jis", re.compile(rb"(?:[\x81-\x9f\xe0-\xea][\x40-\x7e\x80-\xfc])+"), re.compile(rb"\x81[\x40-\xac]|\x82[\x9f-\xf1]|\x83[\x40-\x96]")),
    Legacy("euc_kr", re.compile(rb"(?:[\xa1-\xfd][\xa1-\xfe])+"), re.compile(rb"[\xb0-\xc8][\xa1-\xfe]")),
    Legacy("gb2312", re.compile(rb"(?:[\xa1-\xf7][\xa1-\xfe])+"), re.compile(rb"[\xa1\xa3\xb0-\xd7][\xa1-\xfe]")),
    Legacy("big5", re.compile(rb"(?:[\xa1-\xf9][\x40-\x7e\xa1-\xfe])+"), re.compile(rb"\xa1[\x40-\xbf]|[\xa4-\xc6][\x40-\x7e\xa1-\xfe]")),
)
#: Characters that a text must give under a legacy encoding, characters of a span that counts, the share of high bytes
#: that may stand outside, and the share of common characters.
LEGACY_LETTERS, LEGACY_SPAN, LEGACY_LOST, LEGACY_SHARE = 8, 2, 0.1, {"euc_jp": 0.3, "shift_jis": 0.3, "euc_kr": 0.9, "gb2312": 0.9, "big5": 0.9}


def _legacy(text: str) -> str | None:
    """Spans of ``text``, read as western, decoded by the legacy multibyte encoding whose common characters they hold."""
    raw, best = legacy_bytes(text, "cp1252"), None
    high = lambda x: len(x) - len(_HIGH.sub(b"", x))
    for kind in LEGACY:
        spans, fine, all_ = [], 0, 0
        for m in kind.span.finditer(raw):
            try:
                decoded = m.group().decode(kind.codec)
            except UnicodeDecodeError:
                continue
            # by themselves two bytes are a character only where both are high
            if high(m.group()) >= max(2, (m.end() - m.start()) / 2) and (len(decoded) >= LEGACY_SPAN or high(m.group()) == len(m.group())):
                spans.append((m.start(), m.end(), decoded))
                if len(decoded) >= LEGACY_SPAN:
                    pairs = [m.group()[k : k + 2] for k in range(0, len(m.group()), 2)]
                    fine, all_ = fine + sum(bool(kind.common.fullmatch(p)) for p in pairs), all_ + len(pairs)
        # what is high in the text must lie in such spans, or the encoding is another
        lost = high(raw) - sum(high(raw[i:j]) for i, j, _ in spans)
        if all_ >= LEGACY_LETTERS and fine >= LEGACY_SHARE[kind.codec] * all_ and lost <= LEGACY_LOST * high(raw):
            score = (fine / all_ / LEGACY_SHARE[kind.codec], _patched(text, spans))
            best = score if best is None or score[0] > best[0] else best
    return best and best[1]


def restore(text: str) -> Restored:
    """``text`` with its garbled spans decoded, layer by layer until nothing changes."""
    now, seen = text, {text}
    while True:
        may, looks = (bool(x[0]) for x in signs_of([now]))
        covered, fixed = (_multibyte(now) if may else None) or (0, None)
        if fixed is None and looks:
            fixed = _one_byte(now)
        if looks and (fixed is None or 0 < 2 * covered < len(_BEYOND.findall(now))):
            fixed = _legacy(now) or fixed  # a few sequences are chance in a text of another structure
        if fixed is None or fixed in seen:
            break  # a layer of several bytes a character is shorter each time, one of single bytes may come back
        seen.add(fixed)
        now = fixed
    left = bool(_BROKEN.search(now))
    return Restored(now != text or left, now, not left)


def restore_texts(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``garbled``, ``restored`` (the text, its garbled spans decoded) and ``whole`` (nothing is left).

    Each text is mapped back to the bytes of the encodings it may have been read with. The automaton finds maximal
    spans of well-formed multibyte sequences; spans that give letters of one script or signs are decoded and nothing
    else, over again until nothing changes. Where there are none, words of high bytes are tried under pairs of one-byte
    encodings and kept if most become Greek words, then under legacy multibyte encodings and kept if most of what comes
    out is common there. Replacement and control characters that remain cannot be restored but count.
    Only texts with a character beyond ASCII leave the JVM; tables made of the encodings then tell which of them can
    hold a span. Null and empty texts are not garbled and stay; repeated rows stay; columns already named
    like the results are replaced.
    """

    @F.pandas_udf("garbled boolean, restored string, whole boolean")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t or "" for t in batch]
            found: list[Restored | None] = []
            # of each stretch of a batch at once; a sound text is not sent back
            for k in range(0, len(texts), SCANNED):
                some = texts[k : k + SCANNED]
                may, looks = signs_of(some)
                found += [restore(t) if m or x else None for t, m, x in zip(some, may, looks)]
            bad = [r if r and r.garbled else None for r in found]
            yield pd.DataFrame({"garbled": [r is not None for r in bad], "restored": [r and r.text for r in bad], "whole": [r is None or r.whole for r in bad]})

    judged = df.drop("garbled", "restored", "whole").withColumn("_judged", judge(F.when(suspect(F.col(text)), F.col(text))))
    return judged.withColumns(
        {"garbled": F.coalesce("_judged.garbled", F.lit(False)), "restored": F.coalesce("_judged.restored", F.col(text)), "whole": F.coalesce("_judged.whole", F.lit(True))}
    ).drop("_judged")


def suspect(text: Column) -> Column:
    """Whether a text has anything but ASCII, without which nothing is garbled."""
    return text.rlike(r"[\u0080-\uffff]")
