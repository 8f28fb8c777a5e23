"""Text functions as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

_ACCENTED = [chr(c) for r in (range(0xC0, 0x250), range(0x370, 0x400), range(0x1E00, 0x2000)) for c in r if unicodedata.category(chr(c)) in ("Lu", "Ll") and len(unicodedata.normalize("NFD", chr(c))) > 1]
_PLAIN = [unicodedata.normalize("NFD", c)[0] for c in _ACCENTED]

# Unicode dashes that part a name, abbreviations that end no sentence.
DASHES = "‐‑‒–—―"
ABBREVIATIONS = ("δηλ", "βλ", "σελ", "αριθ", "κεφ", "λεωφ", "τηλ")


def strip_accents(text: Column) -> Column:
    """Letters without their marks, composed or not."""
    return F.regexp_replace(F.translate(text, "".join(_ACCENTED), "".join(_PLAIN)), r"[\x{0300}-\x{036f}]", "")


def fold(text: Column) -> Column:
    """Small letters without accents; one sigma, so that it does not matter what lowered the text."""
    return F.translate(strip_accents(F.lower(text)), "ς", "σ")


def falsy(text: Column, other: Column) -> Column:
    """``text``, or ``other`` where it is null or empty."""
    return F.coalesce(F.nullif(text, F.lit("")), other)


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def normalize_text(text: Column) -> Column:
    """For comparison: folded, quotes gone, what is neither letter, digit nor space made a space."""
    return squeeze(F.regexp_replace(F.regexp_replace(fold(text), "[\"'«»“”‘’`]", ""), r"[^a-z0-9_\sα-ω]", " "))


def tokens(text: Column, least: int = 3) -> Column:
    """Distinct words of ``least`` letters or more of a normalised text."""
    return F.array_distinct(F.filter(F.split(normalize_text(text), " "), lambda t: F.length(t) >= least))


def name_tokens(text: Column) -> Column:
    """Distinct words of any length."""
    return F.array_distinct(F.filter(F.split(fold(text), r"[^a-z0-9α-ω]+"), lambda t: t != ""))


def normalize_name(name: Column) -> Column:
    """A person's name: no bracketed nickname, long dashes as spaces, folded."""
    return squeeze(fold(F.translate(F.regexp_replace(name, r"\s*\([^)]*\)", ""), DASHES, " " * len(DASHES))))


def sort_key(name: Column) -> Column:
    """The words of a name in order, hyphens parting words."""
    return F.array_join(F.array_sort(F.filter(F.split(F.translate(normalize_name(name), "-", " "), r"\s+"), lambda t: t != "")), " ")


def sort_keys(name: Column) -> Column:
    """The sort key and, for a bracketed nickname, the key with it in place of the word before."""
    nick = F.when(name.rlike(r"\S+\s*\([^)]+\)"), sort_key(F.regexp_replace(name, r"\S+\s*\(([^)]+)\)", "$1")))
    return F.array_distinct(F.array_compact(F.array(sort_key(name), nick)))


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) + F.size(b) == 0, 0.0).otherwise(both / F.greatest(F.size(a) + F.size(b) - both, F.lit(1)))


def coverage(a: Column, b: Column) -> Column:
    """Shared words against the shorter text; never below their Jaccard index."""
    return F.when(F.least(F.size(a), F.size(b)) == 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(F.least(F.size(a), F.size(b)), F.lit(1)))


def clean_refs(text: Column) -> Column:
    """[text](REF:TYPE:id) as its text; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"\[([^\]]*)\]\(REF:[A-Z]+:[^)]+\)", "$1")


def ends_sentence(word: Column) -> Column:
    """Whether a word ends a sentence; points of abbreviations and dotted acronyms do not, nor does an ellipsis."""
    core = F.substring(word, F.lit(1), F.length(word) - 1)
    short = (F.length(core) <= 2) | F.lower(core).isin(*ABBREVIATIONS) | core.rlike(r"^(\p{L}\.)+\p{L}{0,3}$")
    return word.rlike(r"[!?;\x{037E}]$") | (word.endswith(".") & ~short)


def protocol_parts(number: Column) -> Column:
    """prefix, num, suffix of a protocol number; null where it has another form."""
    pattern = r"^(\D*?)(\d+)(/.+)?$"
    part = lambda k: F.regexp_extract(number, pattern, k)
    return F.when(number.rlike(pattern), F.struct(part(1).alias("prefix"), part(2).try_cast("bigint").alias("num"), part(3).alias("suffix")))


def until_line_end(text: Column) -> Column:
    """Up to and with the last line break."""
    return F.regexp_replace(text, r"[^\n]*\z", "")


def escape_html(text: Column) -> Column:
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(sign), F.lit(entity))
    return text


def wrap(text: Column, width: int) -> Column:
    """Lines of at most ``width`` characters filled word by word; a longer word is a line of its own."""
    words = F.filter(F.split(text, " "), lambda w: w != "")
    step = lambda acc, w: F.when(
        (F.size(acc) > 0) & (F.length(F.element_at(acc, -1)) + 1 + F.length(w) <= width),
        F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.concat_ws(" ", F.try_element_at(acc, F.lit(-1)), w))),
    ).otherwise(F.concat(acc, F.array(w)))
    return F.aggregate(words, F.array().cast("array<string>"), step)


def bearer(header: Column) -> Column:
    return F.when(header.rlike(r"^Bearer\s+\S"), F.regexp_extract(header, r"^Bearer\s+(\S+)", 1))


def meeting_of_callback(url: Column) -> Column:
    return F.when(url.rlike(r"meetings/[^/?#]+"), F.regexp_extract(url, r"meetings/([^/?#]+)", 1)).otherwise(F.lit("unknown"))


def redact(text: Column, secret: Column) -> Column:
    return F.when(F.coalesce(F.length(secret), F.lit(0)) > 0, F.replace(text, secret, F.lit("***"))).otherwise(text)
