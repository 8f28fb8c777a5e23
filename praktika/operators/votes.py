"""Majorities over documents of one meeting, votes inferred, and checks of extractions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from praktika.functions.text import normalize_name

# Phrases of unanimous and majority results.
UNANIMOUS, MAJORITY = r"(?iu)[οό]μ[οό]φων", r"(?iu)κατ[άα]\s+πλειοψηφ[ίι]"


def _empty(c: Column) -> Column:
    return F.coalesce(F.size(c), F.lit(0)) <= 0


def roll_call_key(present: Column, absent: Column, mayor: Column) -> Column:
    """One string per roll call, whatever the order of its names."""
    names = lambda c: F.array_join(F.array_sort(F.coalesce(c, F.array().cast("array<string>"))), "|")
    return F.concat(F.lit("P:"), names(present), F.lit(";;A:"), names(absent), F.lit(";;M:"), F.coalesce(mayor.cast("string"), F.lit("unknown")))


def majority_roll_call(df: DataFrame, key: str, present: str, absent: str, mayor: str, order: str) -> DataFrame:
    """Per key the roll call that more than half of the documents with any names agree on."""
    shown = df.where(~_empty(F.col(present)) | ~_empty(F.col(absent))).select(key, roll_call_key(F.col(present), F.col(absent), F.col(mayor)).alias("roll_call"), F.col(order).alias("_o"))
    groups = shown.groupBy(key, "roll_call").agg(F.count("*").alias("n"), F.min("_o").alias("first_ord"))
    total = groups.withColumn("n_documents", F.sum("n").over(Window.partitionBy(key)))
    return total.where(2 * F.col("n") > F.col("n_documents"))


def consensus_changes(changes: DataFrame, key: str, identity: list[str], timing: str, documents: DataFrame, count: str) -> DataFrame:
    """Changes that more than half of a key's documents mention, with the timing most of them give.

    Mentions count, not documents. Of equally frequent timings during comes before after and both before none.
    """
    votes = changes.groupBy(key, *identity, timing).agg(F.count("*").alias("v"))
    rank = F.when(F.col(timing) == "during", 0).when(F.col(timing).isNotNull(), 1).otherwise(2)
    best = votes.groupBy(key, *identity).agg(F.min_by(timing, F.struct((-F.col("v")).alias("v"), rank.alias("r"))).alias("best_timing"), F.sum("v").alias("n_reports"))
    return best.join(documents.select(key, count), key).where(2 * F.col("n_reports") > F.col(count))


def order_vote(df: DataFrame, key: str, order: str) -> DataFrame:
    """Per key the discussion order that more than half of all documents share; an order counts for its extension.

    Merging by prefix is greedy, longest first; equal orders are counted before, so a key's table is small: one row
    per different order.
    """
    counted = df.groupBy(key, order).agg(F.count("*").alias("n"))

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        total = int(pdf["n"].sum())
        given = pdf[pdf[order].notna()]
        groups: list[list] = []
        for items, n in sorted(zip(map(list, given[order]), given["n"]), key=lambda g: (-len(g[0]), g[0])):
            for g in groups:
                if g[0][: len(items)] == items:
                    g[1] += n
                    break
            else:
                groups.append([items, n])
        best = max(groups, key=lambda g: g[1], default=None)
        rows = [(pdf[key].iloc[0], best[0], int(best[1]), total)] if best and 2 * best[1] > total else []
        return pd.DataFrame(rows, columns=[key, order, "n", "n_documents"])

    return counted.groupBy(key).applyInPandas(merge, f"{key} {df.schema[key].dataType.simpleString()}, {order} {df.schema[order].dataType.simpleString()}, n bigint, n_documents bigint")


def inferred_for_votes(df: DataFrame, decision: str, present: str, result: str, votes: str) -> DataFrame:
    """FOR votes of present members without a vote of their own, where the result was reached by all or most.

    Nothing is inferred where somebody's FOR is written down.
    """
    fits = F.col(result).rlike(UNANIMOUS) | F.col(result).rlike(MAJORITY)
    gated = df.where(fits & ~F.coalesce(F.exists(votes, lambda v: v["vote"] == "FOR"), F.lit(False)) & ~_empty(F.col(present)))
    named = F.transform(F.coalesce(F.col(votes), F.array().cast(df.schema[votes].dataType)), lambda v: normalize_name(v["name"]))
    rest = F.filter(present, lambda p: ~F.array_contains(F.col("_named"), normalize_name(p)))
    return gated.withColumn("_named", named).select(decision, F.explode(rest).alias("name")).withColumn("vote", F.lit("FOR"))


def extraction_warnings(df: DataFrame, key: str) -> DataFrame:
    """A row per rule that an extraction breaks, with its severity."""

    def rule(broken: Column, code: str, level: str) -> Column:
        return F.when(broken, F.struct(F.lit(code).alias("code"), F.lit(level).alias("severity")))

    excerpt = F.coalesce(F.trim("decision_excerpt"), F.lit(""))
    majority = F.coalesce(F.col("vote_result").rlike(MAJORITY), F.lit(False))
    other = F.coalesce(F.exists("vote_details", lambda v: v["vote"].isin("AGAINST", "ABSTAIN", "PRESENT", "DID_NOT_VOTE")), F.lit(False))
    rules = F.array_compact(
        F.array(
            rule(F.coalesce("incomplete", F.lit(False)), "EXTRACTION_INCOMPLETE", "error"),
            rule(excerpt == "", "EMPTY_EXCERPT", "warning"),
            rule(F.coalesce("decision_number", F.lit("")) == "", "MISSING_DECISION_NUMBER", "info"),
            rule(_empty(F.col("present_members")) & _empty(F.col("absent_members")), "NO_ATTENDANCE", "warning"),
            rule(F.col("vote_result").isNull() & excerpt.rlike("(?iu)ΑΠΟΦΑΣΙΖΕΙ"), "MISSING_VOTE_RESULT", "warning"),
            rule(majority & ~other, "NO_VOTE_DETAILS", "warning"),
        )
    )
    return df.select(key, F.explode(rules).alias("w")).select(key, "w.code", "w.severity")
