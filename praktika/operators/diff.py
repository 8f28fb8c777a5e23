"""Two runs over one meeting, subject by subject."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from praktika.functions.text import name_tokens
from praktika.operators.aggregates import last_wins

#: A change of the description's length or of the utterances beyond this share is one of structure.
DESCRIPTION_SHARE, UTTERANCE_SHARE, SAME_NAME = 0.3, 0.2, 0.6


def align_by_index(a: DataFrame, b: DataFrame, key: str, index: str, order: str) -> DataFrame:
    """Subjects of both runs side by side by agenda index; the last of equal indices counts, null ones are left out."""
    pick = lambda df, p: last_wins(df.where(F.col(index).isNotNull()), [key, index], [order]).select(key, index, *[F.col(c).alias(f"{p}_{c}") for c in df.columns if c not in (key, index)])
    both = pick(a, "a").withColumn("in_a", F.lit(True)).join(pick(b, "b").withColumn("in_b", F.lit(True)), [key, index], "full_outer")
    return both.withColumn("side", F.when(F.col("in_a") & F.col("in_b"), "both").when(F.col("in_a"), "a").otherwise("b")).drop("in_a", "in_b")


def verdict(changes: list[tuple[str, Column, Column]]) -> tuple[Column, Column]:
    """(verdict, changes) from (name, changed, structural) triples."""
    listed = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c, _ in changes]))
    structural = F.lit(False)
    for _, _, s in changes:
        structural = structural | F.coalesce(s, F.lit(False))
    return F.when(F.size(listed) == 0, "identical").when(structural, "structural").otherwise("cosmetic"), listed


def share_changed(a: Column, b: Column, limit: float) -> Column:
    return F.abs(b - a) / F.greatest(a, F.lit(1)) > limit


def match_leftovers(a: DataFrame, b: DataFrame, key: str, name: str, order: str, item: str) -> DataFrame:
    """Subjects that no index paired, paired greedily by their names, in the order of the first run.

    Each takes the most similar of what is left, at SAME_NAME or more, the first on ties; what is chosen depends on
    the choices before, so the leftovers of a meeting are one group.
    """
    rows = a.select(key, F.lit("a").alias("side"), F.col(order).alias("o"), F.col(item).alias("i"), name_tokens(F.col(name)).alias("t")).unionByName(b.select(key, F.lit("b").alias("side"), F.col(order).alias("o"), F.col(item).alias("i"), name_tokens(F.col(name)).alias("t")))

    def pair(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["o", "i"], kind="stable")
        left = [(i, set(t)) for i, t, s in zip(pdf.i, pdf.t, pdf.side) if s == "b"]
        out = []
        for i, t, s in zip(pdf.i, pdf.t, pdf.side):
            if s != "a" or not len(t):
                continue
            scored = [(len(u & set(t)) / len(u | set(t)), -k) for k, (_, u) in enumerate(left) if u]
            best = max(scored, default=(0.0, 0))
            if best[0] >= SAME_NAME:
                j, _ = left.pop(-best[1])
                out.append((pdf[key].iloc[0], i, j, round(best[0], 6)))
        return pd.DataFrame(out, columns=[key, "a_id", "b_id", "similarity"])

    k, i = a.schema[key].dataType.simpleString(), a.schema[item].dataType.simpleString()
    return rows.groupBy(key).applyInPandas(pair, f"{key} {k}, a_id {i}, b_id {i}, similarity double")
