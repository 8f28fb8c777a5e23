"""Numbers, times and hashes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(x: Column) -> Column:
    """To the next whole number, halves towards plus infinity."""
    return F.floor(x + F.lit(0.5)).cast("bigint")


def clock(seconds: Column) -> Column:
    s = F.floor(seconds).cast("bigint")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60)))


def token_label(n: Column) -> Column:
    """Plain below a thousand, else thousands or millions with one decimal."""
    return F.when(n < 1000, n.cast("bigint").cast("string")).when(n < 1_000_000, F.format_string("%.1fk", n / 1e3)).otherwise(F.format_string("%.1fM", n / 1e6))


def byte_label(n: Column) -> Column:
    """Bytes in the largest unit of 1024 below them, two decimals without trailing zeros."""
    unit = F.least(F.lit(4), F.floor(F.log(2.0, F.greatest(n, F.lit(1))) / 10 + F.lit(1e-9)).cast("int"))
    names = F.array(*[F.lit(x) for x in ("Bytes", "KB", "MB", "GB", "TB")])
    digits = F.regexp_replace(F.format_string("%.2f", n / F.pow(F.lit(1024.0), unit)), r"\.?0+$", "")
    return F.when(n <= 0, F.lit("0 Bytes")).otherwise(F.concat(digits, F.lit(" "), F.get(names, unit)))


def duration_label(seconds: Column) -> Column:
    s = round_half_up(seconds)
    return F.when(s.isNull(), "running").when(s >= 90, F.format_string("%dm%ds", F.floor(s / 60), F.pmod(s, F.lit(60)))).otherwise(F.format_string("%ds", s))


def confidence(logprob: Column) -> Column:
    return F.coalesce(F.least(F.lit(1.0), F.exp(logprob)), F.lit(1.0))


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def rescale(percent: Column, low: float, high: float) -> Column:
    """0-100 onto ``low``-``high``."""
    return F.lit(low) + percent * ((high - low) / 100)


def lsn_bytes(lsn: Column) -> Column:
    """The byte position of a log sequence number such as 16/B374D848."""
    part = lambda k: F.conv(F.split(lsn, "/")[k], 16, 10).cast("bigint")
    return F.shiftleft(part(0), 32) + part(1)


def severity(status: Column, percent: Column) -> Column:
    return F.when(status.isin("lost", "unreserved") | (percent >= 95), "critical").when(percent >= 80, "high").when(percent >= 50, "warning").otherwise("ok")


def subject_hash(name: Column, description: Column, position: Column) -> Column:
    """The identifier of a subject from what it says."""
    return F.sha2(F.concat(F.coalesce(name, F.lit("")), F.coalesce(description, F.lit("")), F.coalesce(position.cast("string"), F.lit("NO_AGENDA"))), 256)


def fingerprint(hashes: Column) -> Column:
    """Twelve digits over a set of hashes, whatever their order."""
    return F.substring(F.sha2(F.array_join(F.array_sort(F.array_distinct(hashes)), ","), 256), 1, 12)


def is_complete(actual: Column, expected: Column) -> Column:
    """Whether a recording is as long as expected, but for two per cent or two minutes."""
    return F.coalesce((actual >= expected * 0.98) | (expected - actual <= 120), F.lit(True))
