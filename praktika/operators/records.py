"""Accepting, correcting and re-pointing records that came from outside."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Scores of the confidence labels that are accepted.
SCORES = {"high": 0.9, "medium": 0.7}


def score_of(label: Column) -> Column:
    """A label's score; null for those that are not accepted."""
    return F.create_map(*[F.lit(x) for kv in SCORES.items() for x in kv])[F.lower(label)]


def accept_matches(matches: DataFrame, known: DataFrame, subject: str, key: str, confidence: str, order: str, contradicts: Column) -> DataFrame:
    """Each proposed match with its score or the reason of its refusal.

    Reasons are tested in this order: a contradiction in its own explanation, low confidence, an unknown key, a key
    that an earlier accepted match has taken.
    """
    exists = known.select(F.col(key), F.lit(True).alias("_known")).distinct()
    tested = matches.join(exists, key, "left").withColumn(
        "reason", F.when(contradicts, "CONTRADICTION").when(score_of(F.col(confidence)).isNull(), "LOW_CONFIDENCE").when(F.col("_known").isNull(), "UNKNOWN")
    )
    fine = F.col("reason").isNull()
    first = F.min(F.when(fine, F.col(order))).over(Window.partitionBy(key))
    reason = F.coalesce("reason", F.when(F.col(order) > first, "DUPLICATE"))
    return tested.withColumn("reason", reason).select(subject, key, order, F.when(F.col("reason").isNull(), score_of(F.col(confidence))).alias("score"), "reason")


def candidate_pool(similar: DataFrame, gaps: DataFrame, subject: str, key: str) -> DataFrame:
    """Similar candidates and those of number gaps that are not among them."""
    a = similar.select(subject, key, F.lit(False).alias("is_gap"))
    return a.unionByName(gaps.select(subject, key, F.lit(True).alias("is_gap")).distinct().join(a, [subject, key], "left_anti"))


def point_to_primary(statuses: DataFrame, subjects: DataFrame, subject: str, primary: str) -> DataFrame:
    """Statuses of a subject that is discussed in another one are that one's, if it exists."""
    exists = subjects.select(F.col(subject).alias("_p")).distinct()
    links = subjects.select(subject, F.col(primary).alias("_p")).where("_p is not null").join(exists, "_p", "left_semi")
    return statuses.join(links.dropDuplicates([subject]), subject, "left").withColumn(subject, F.coalesce("_p", subject)).drop("_p")


def remap(df: DataFrame, column: str, mapping: DataFrame, old: str, new: str) -> DataFrame:
    """``column`` under its new identifier where it has one."""
    m = mapping.select(F.col(old).alias(column), F.col(new).alias("_new"))
    return df.join(m, column, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def keep_previous(now: DataFrame, before: DataFrame, key: str, value: str) -> DataFrame:
    """A value once known is not overwritten."""
    b = before.select(key, F.col(value).alias("_before"))
    return now.join(b, key, "left").withColumn(value, F.coalesce("_before", value)).drop("_before")


def by_speaker(df: DataFrame, keys: list[str], speaker_id: str, speaker_name: str, order: str) -> DataFrame:
    """Utterances grouped by speaker: by identifier, else by name; how many and where each first speaks."""
    who = F.coalesce(F.nullif(F.col(speaker_id), F.lit("")), F.concat(F.lit("name:"), F.col(speaker_name)))
    grouped = df.groupBy(*keys, who.alias("speaker_key")).agg(F.count("*").alias("n"), F.min(order).alias("first_ord"))
    return grouped.withColumn("position", F.row_number().over(Window.partitionBy(*keys).orderBy("first_ord", "speaker_key")) - 1)


def rewrite_links(df: DataFrame, key: str, text: str, dictionary: DataFrame) -> DataFrame:
    """[text](REF:TYPE:short) with the long identifier of the dictionary; one that it lacks stays.

    Links are taken apart, looked up by a join and put together again; the dictionary is never one map per row.
    """
    pattern = r"\[[^\]]*\]\(REF:[A-Z]+:[^)]+\)"
    pieces = df.select(key, F.split(text, pattern).alias("gaps"), F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1)).alias("links"))
    parts = pieces.select(key, F.posexplode_outer("links").alias("i", "link")).withColumn("short_id", F.regexp_extract("link", r"\(REF:[A-Z]+:([^)]+)\)", 1))
    found = parts.join(dictionary.select("short_id", "long_id"), "short_id", "left")
    link = F.coalesce(F.when(F.col("long_id").isNull(), F.col("link")).otherwise(F.concat(F.regexp_extract("link", r"^(.*REF:[A-Z]+:)", 1), "long_id", F.lit(")"))), F.lit(""))
    links = found.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("i", F.lit(0)).alias("i"), link.alias("l")))).alias("done"))
    both = pieces.join(links, key)
    rebuilt = F.array_join(F.transform("gaps", lambda g, i: F.concat(g, F.coalesce(F.get(F.col("done"), i)["l"], F.lit("")))), "")
    return both.select(key, rebuilt.alias(text))


def numbered_lines(text: Column) -> Column:
    """Lines numbered from 1 as an array, wrapped lines joined; null where a number is wrong or anything precedes.

    A line such as ``2.5 m`` goes on with the line before: a number needs a point and a space.
    """
    empty = F.struct(F.array().cast("array<string>").alias("a"), F.lit(True).alias("ok"))

    def step(acc: Column, line: Column) -> Column:
        n = F.regexp_extract(line, r"^(\d+)\.\s", 1).try_cast("int")
        rest = F.regexp_replace(line, r"^\d+\.\s+", "")
        grown = F.struct(F.concat(acc["a"], F.array(rest)).alias("a"), (acc["ok"] & (n == F.size(acc["a"]) + 1)).alias("ok"))
        joined = F.struct(F.concat(F.slice(acc["a"], F.lit(1), F.greatest(F.size(acc["a"]) - 1, F.lit(0))), F.array(F.concat_ws(" ", F.try_element_at(acc["a"], F.lit(-1)), F.trim(line)))).alias("a"), (acc["ok"] & (F.size(acc["a"]) > 0)).alias("ok"))
        return F.when(F.trim(line) == "", acc).when(n.isNotNull(), grown).otherwise(joined)

    folded = F.aggregate(F.split(text, "\n"), empty, step)
    return F.when(folded["ok"] & (F.size(folded["a"]) > 0), folded["a"])


def word_diff(before: str | None, after: str | None) -> list[tuple[str, str]]:
    """(=, - or +, words) from one text to another: common ends off, a longest common subsequence between them."""
    a, b = re.findall(r"\S+", before or ""), re.findall(r"\S+", after or "")
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    j = 0
    while j < min(len(a), len(b)) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    x, y = a[i : len(a) - j], b[i : len(b) - j]
    table = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for p in range(len(x) - 1, -1, -1):
        for q in range(len(y) - 1, -1, -1):
            table[p][q] = table[p + 1][q + 1] + 1 if x[p] == y[q] else max(table[p + 1][q], table[p][q + 1])
    steps, p, q = [("=", w) for w in a[:i]], 0, 0
    while p < len(x) or q < len(y):
        if p < len(x) and q < len(y) and x[p] == y[q]:
            steps.append(("=", x[p]))
            p, q = p + 1, q + 1
        elif p < len(x) and (q == len(y) or table[p + 1][q] >= table[p][q + 1]):
            steps.append(("-", x[p]))
            p += 1
        else:
            steps.append(("+", y[q]))
            q += 1
    steps += [("=", w) for w in a[len(a) - j :]] if j else []
    merged: list[list] = []
    for kind, word in steps:
        if merged and merged[-1][0] == kind:
            merged[-1][1].append(word)
        else:
            merged.append([kind, [word]])
    return [(k, " ".join(w)) for k, w in merged]


def diff_column(before: Column, after: Column) -> Column:
    @F.pandas_udf("array<struct<kind: string, words: string>>")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "words": w} for k, w in word_diff(x, y)] for x, y in zip(a, b)])

    return run(before, after)


def changed_texts(before: DataFrame, after: DataFrame, key: str, text: str) -> DataFrame:
    """Only the rows whose text is another, blanks at the ends aside."""
    b = before.select(key, F.col(text).alias("_before"))
    return after.join(b, key).where(~F.trim("_before").eqNullSafe(F.trim(text))).drop("_before")


def nearest_preset(height: Column, presets: dict[str, int]) -> Column:
    """The preset of nearest height, the larger on a tie."""
    options = F.array(*[F.struct(F.abs(F.lit(h) - height).alias("off"), F.lit(-h).alias("h"), F.lit(k).alias("name")) for k, h in presets.items()])
    return F.array_min(options)["name"]


def citations(urls: Column) -> Column:
    """Distinct addresses in the order in which they first appear."""
    return F.array_distinct(F.filter(urls, lambda u: F.coalesce(u, F.lit("")) != ""))


def without_sources(text: Column) -> Column:
    """A text without the list of sources at its end."""
    return F.rtrim(F.regexp_replace(text, r"(?isu)\n+\s*(?:#+\s*|\*\*)?(?:sources|πηγ[έε]ς)(?:\*\*)?\s*:?\s*\n.*\z", ""))


#: Kinds of errors and of those within them, by where they come from.
ERRORS = {"connection": ("APIConnectionError",), "server": ("InternalServerError",)}
INNER_SERVER, DROPPED = ("overloaded_error", "api_error"), "terminated"


def error_class(chain: Column) -> Column:
    """Whether an error came from the connection, the server or neither, by the first of its causes that tells.

    ``chain``: the error and its causes, outermost first, each with kind, inner (the type of the error that a service
    reports within it) and message.
    """
    of = lambda e: F.when(e["kind"].isin(*ERRORS["connection"]) | ((e["kind"] == "TypeError") & (e["message"] == DROPPED)), "connection").when(e["kind"].isin(*ERRORS["server"]) | e["inner"].isin(*INNER_SERVER), "server")
    return F.coalesce(F.get(F.array_compact(F.transform(chain, of)), 0), F.lit("none"))
