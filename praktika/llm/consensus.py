"""Consensus of several annotators' labels by message passing between items and annotators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from praktika.operators.lineage import cut, drop

#: Pseudo-counts that draw an annotator's rates on a class to those in its space, and those to a neutral annotator.
CLASS_PRIOR, SPACE_PRIOR, NEUTRAL = 20.0, 4.0, 0.7
#: Reliabilities are broadcast to the label edges up to this many rows; beyond it the join shuffles.
BROADCAST_ROWS = 200_000
TOLERANCE, MAX_ROUNDS = 2e-3, 25
#: Rounds of halved steps that may follow MAX_ROUNDS whole ones.
DAMPED_ROUNDS = 75


@dataclass
class Consensus:
    items: DataFrame  # item, label, confidence, n_labels, agreement, disputed
    annotators: DataFrame  # annotator, space, reliability, n_labels
    rounds: int
    change: float  # of a reliability in the last round
    moved: float  # of a belief in the last round


def label_edges(df: DataFrame, item: str, annotator: str, space: Column, label: Column) -> DataFrame:
    """Distinct (item, annotator, space, label) of rows whose item, annotator and label are not null."""
    edges = df.select(F.col(item).alias("_item"), F.col(annotator).alias("_ann"), F.coalesce(space.cast("string"), F.lit("")).alias("_space"), label.alias("_label"))
    return edges.where("_item is not null and _ann is not null and _label is not null").distinct()


def _log_ratio(hit: Column, sens: Column, fall: Column) -> Column:
    return F.when(hit, F.log(sens / fall)).otherwise(F.log((1 - sens) / (1 - fall)))


def _clip(x: Column) -> Column:
    return F.greatest(F.lit(0.005), F.least(F.lit(0.995), x))


def _odds(x: Column) -> Column:
    """The probability of log-odds."""
    return 1 / (1 + F.exp(-x))


def _counts(edges: DataFrame) -> DataFrame:
    """Soft counts per annotator, space and class."""
    return edges.groupBy("_space", "_cls", "_ann").agg(
        F.sum(F.when(F.col("_hit"), F.col("_p")).otherwise(0.0)).alias("tp"),
        F.sum("_p").alias("pos"),
        F.sum(F.when(F.col("_hit"), 1 - F.col("_p")).otherwise(0.0)).alias("fp"),
        F.sum(F.col("_hit").cast("double")).alias("hits"),
    )


def _reliabilities(by_class: DataFrame) -> DataFrame:
    """Soft counts, with what belongs to the space and the class as a whole."""
    in_space = by_class.groupBy("_space", "_ann").agg(F.sum("tp").alias("tp_s"), F.sum("hits").alias("n_s"))
    of_class = by_class.groupBy("_space", "_cls").agg(F.sum("pos").alias("pos_c"))
    size = of_class.groupBy("_space").agg(F.count("*").alias("k"), F.sum("pos_c").alias("pos_all"))
    return by_class.join(in_space, ["_space", "_ann"]).join(of_class.join(size, "_space"), ["_space", "_cls"])


def consensus(df: DataFrame, item: str, annotator: str, space: Column, label: Column) -> Consensus:
    """A label per item, how far its labels agree, and each annotator's reliability in each space of labels.

    Each label seen on an item is one class against the rest: every annotator of the item sends a message for or
    against it, the logarithm of how much likelier its answer is if the class is right; the item answers with its
    belief from the other messages. An annotator's rates of right and false hits on a class come from the beliefs of
    its items without the one the message goes to, drawn towards its rate in the whole ``space`` (labels that can
    stand for one another). So one who always gives the same label sends nothing, one who is mostly wrong counts
    against its label. Rounds repeat until no reliability and no belief changes by more than TOLERANCE. After
    MAX_ROUNDS, where they may swing to and fro, beliefs go half the way only; if they have not settled within
    DAMPED_ROUNDS more, there is an error and no label.

    Sums are aggregated before they are shuffled, items and annotators of any size included. Rows with a null item,
    annotator or label are ignored; exact repetitions count once, two different labels of one annotator both count.
    Ties go to the label with more votes, then to the greater one. An empty table gives empty results.
    """
    labels = label_edges(df, item, annotator, space, label)
    votes = labels.groupBy("_item", "_space", "_label").agg(F.count("*").alias("_votes"))
    n = votes.groupBy("_item", "_space").agg(F.sum("_votes").alias("_n"), F.sum(F.col("_votes") * (F.col("_votes") - 1)).alias("_same"), F.count("*").alias("_classes"))
    classes = votes.join(n, ["_item", "_space"])
    edges = labels.join(classes.select("_item", "_space", F.col("_label").alias("_cls"), (F.col("_votes") / F.col("_n")).alias("_p")), ["_item", "_space"])
    edges = cut(edges.select("_item", "_space", "_ann", "_cls", (F.col("_label") == F.col("_cls")).alias("_hit"), "_p"))

    before, rounds, change, moved, small = None, 0, 0.0, 0.0, None
    while True:
        counts = cut(_counts(edges))  # the edges are read once for them
        rates = cut(_reliabilities(counts))
        drop(counts)
        now = rates.select("_space", "_ann", (F.col("tp_s") / F.col("n_s")).alias("now")).distinct()
        if before is not None:
            change = now.join(before, ["_space", "_ann"]).agg(F.max(F.abs(F.col("now") - F.col("was")))).first()[0] or 0.0
        if small is None:
            small = rates.count() <= BROADCAST_ROWS  # there are as many rows in every round
        beliefs = _messages(edges, F.broadcast(rates) if small else rates)
        total = beliefs.groupBy("_item", "_space", "_cls").agg((F.sum("_w") + F.max("_prior")).alias("_total"))
        if before is not None and change <= TOLERANCE and moved <= TOLERANCE:
            break
        if rounds >= MAX_ROUNDS + DAMPED_ROUNDS:
            raise RuntimeError(f"labels have not settled in {rounds} rounds: a reliability changes by {change:.2g}, a belief by {moved:.2g}")
        before, rounds = now.withColumnRenamed("now", "was"), rounds + 1
        own = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("_total") - F.col("_w")))
        step = own if rounds <= MAX_ROUNDS else (own + F.log(F.col("_p") / (1 - F.col("_p")))) / 2
        answers = beliefs.join(total, ["_item", "_space", "_cls"]).select("_item", "_space", "_ann", "_cls", "_hit", _odds(step).alias("_p"), F.abs(_odds(own) - F.col("_p")).alias("_moved"))
        old, edges = edges, cut(answers)
        moved = edges.agg(F.max("_moved")).first()[0] or 0.0
        drop(old)

    best = total.join(votes.withColumnRenamed("_label", "_cls"), ["_item", "_space", "_cls"]).groupBy("_item", "_space").agg(F.max(F.struct("_total", "_votes", "_cls")).alias("_best"))
    items = best.join(n, ["_item", "_space"]).select(
        F.col("_item").alias("item"),
        F.col("_space").alias("space"),
        F.col("_best._cls").alias("label"),
        (1 / (1 + F.exp(-F.col("_best._total")))).alias("confidence"),
        F.col("_n").alias("n_labels"),
        F.when(F.col("_n") > 1, F.col("_same") / (F.col("_n") * (F.col("_n") - 1))).otherwise(1.0).alias("agreement"),
        (F.col("_classes") > 1).alias("disputed"),
    )
    annotators = rates.select(F.col("_ann").alias("annotator"), F.col("_space").alias("space"), (F.col("tp_s") / F.col("n_s")).alias("reliability"), F.col("n_s").cast("bigint").alias("n_labels")).distinct()
    return Consensus(items, annotators, rounds, change, moved)


def _messages(edges: DataFrame, rates: DataFrame) -> DataFrame:
    """``edges`` with ``_w``, the annotator's message on the class, and ``_prior``, the class's own log-odds."""
    p, hit = F.col("_p"), F.col("_hit").cast("double")
    others = F.greatest(F.col("n_s") - 1, F.lit(0.0))
    right = F.greatest(F.col("tp_s") - p * hit, F.lit(0.0))
    sens_s = (right + SPACE_PRIOR * NEUTRAL) / (others + SPACE_PRIOR)
    wrong_s = (1 - sens_s) / F.greatest(F.col("k") - 1, F.lit(1))
    sens = (F.greatest(F.col("tp") - p * hit, F.lit(0.0)) + CLASS_PRIOR * sens_s) / (F.greatest(F.col("pos") - p, F.lit(0.0)) + CLASS_PRIOR)
    negative = F.greatest(others - F.greatest(F.col("pos") - p, F.lit(0.0)), F.lit(0.0))
    fall = (F.greatest(F.col("fp") - (1 - p) * hit, F.lit(0.0)) + CLASS_PRIOR * wrong_s) / (negative + CLASS_PRIOR)
    share = _clip(F.col("pos_c") / F.col("pos_all"))
    return edges.join(rates, ["_space", "_cls", "_ann"]).select(
        "_item", "_space", "_ann", "_cls", "_hit", "_p", _log_ratio(F.col("_hit"), _clip(sens), _clip(fall)).alias("_w"), F.log(share / (1 - share)).alias("_prior")
    )
