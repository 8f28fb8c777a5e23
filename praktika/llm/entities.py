"""Agenda subjects and published decisions without a common key: a cascade of exact joins."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from praktika.llm.unify import unify
from praktika.operators.lineage import cut, drop

#: Days from a meeting to the issue of its decisions, and to their publication; days of a bucket of the latter.
ISSUE_DAYS, PUBLISH_DAYS, BUCKET_DAYS = 2, 120, 30
#: Numbers of a meeting's decisions run on: so far from the resolved ones may an unresolved one be.
RUN_SLACK, RUN_KNOWN = 3, 2
#: Pseudo-counts of the labelled precision of a rule.
RIGHT, WRONG = 1.0, 1.0
#: Letters of a word that tell it, whatever its ending; words of fewer than three letters tell nothing.
STEM, LEAST_LETTERS = 5, 3
#: A token is faithful if in so large a share of plain pairs the other side has it too; pseudo-counts of that share.
FAITHFUL, FAITHFUL_PRIOR = 0.75, 2.0
#: What makes a plain pair, from which that is learned: the share of the subject's weight, and tokens in common.
PLAIN_SHARE, PLAIN_TOKENS = 0.7, 3
#: Pairs with less of the subject's weight are looked at no further, unless the decision's title was cut.
LEAST_SHARE = 0.3

# Fixed value: what stands before a city's name.
_CITY = re.compile(r"^(?:δημοσ|δημου|δ\.)\s*")
_NUMBER = re.compile(r"\d+(?:\.\d{3})*(?:,\d+)?")
_MONEY = re.compile(r"(\d+(?:\.\d{3})*(?:,\d+)?)\s*(?:€|ευρω|eur\b)")
_WORD = re.compile(rf"[^\W\d_]{{{LEAST_LETTERS},}}")
_CUT = re.compile(r"\S*…$")


def folded(text: str) -> str:
    """Look-alikes unified, small letters, no accents, single spaces."""
    plain = unicodedata.normalize("NFD", unify(text).lower())
    return re.sub(r"\s+", " ", "".join(c for c in plain if not unicodedata.combining(c)).replace("ς", "σ")).strip()


def city_key(name: str | None) -> str | None:
    return None if name is None else re.sub(r"[\W\d_]+", "", _CITY.sub("", folded(name))) or None


def _value(number: str) -> str:
    return f"#{float(number.replace('.', '').replace(',', '.')):.2f}"


def tokens(text: str | None) -> tuple[list[tuple[str, str]], list[str], bool]:
    """(token, word) of a name or title, its sums of money, and whether its end was cut off.

    A token is a number's value or the beginning of a word. The last word of a title that was cut is none.
    """
    if not text:
        return [], [], False
    whole = folded(text)
    t = _CUT.sub("", whole)
    found = dict.fromkeys((_value(n), "") for n in _NUMBER.findall(t)) | dict.fromkeys((w[:STEM], w) for w in _WORD.findall(_NUMBER.sub(" ", t)))
    return list(found), sorted({_value(n) for n in _MONEY.findall(t)}), whole != t


_TOKEN = T.StructType([T.StructField("t", T.StringType()), T.StructField("w", T.StringType())])
_READ = T.StructType([T.StructField("tokens", T.ArrayType(_TOKEN)), T.StructField("money", T.ArrayType(T.StringType())), T.StructField("cut", T.BooleanType())])


@F.pandas_udf(_READ)
def tokens_of(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        rows = [tokens(None if pd.isna(t) else t) for t in batch]
        yield pd.DataFrame({"tokens": [[{"t": t, "w": w} for t, w in r[0]] for r in rows], "money": [r[1] for r in rows], "cut": [r[2] for r in rows]})


@F.pandas_udf(T.StringType())
def city_of(names: pd.Series) -> pd.Series:
    return names.map(city_key, na_action="ignore").astype("object")


#: The rules, strongest first: which combination of attributes must be equal, besides the city and the date.
RULES: tuple[tuple[str, str], ...] = (
    ("all_tokens", "missing = 0 and n >= 2"),
    ("number_and_words", "against_s = 0 and numbers >= 1 and n >= 2 and share >= 0.4"),
    ("words", "against_s = 0 and n >= 2 and share >= 0.4"),
    ("mistyped", "known_against_s = 0 and n >= 3 and share >= 0.45"),
    ("beginning", "cut and against_d = 0 and n >= 2 and share >= 0.5"),
    ("in_run", "fits = 1 and (against_s = 0 or cut) and against_d = 0"),
)


def _bucket(day: Column) -> Column:
    return F.floor(F.unix_date(day) / BUCKET_DAYS)


def _day_keys() -> Column:
    """The keys of a meeting's day: itself, and its span of days."""
    return F.array(F.concat(F.lit("i"), F.col("day").cast("string")), F.concat(F.lit("p"), _bucket(F.col("day")).cast("string")))


def _meeting_keys() -> Column:
    """The keys of the days on which a decision's meeting may have been."""
    issue = F.transform(F.sequence(F.date_sub("issued", ISSUE_DAYS), F.col("issued")), lambda d: F.concat(F.lit("i"), d.cast("string")))
    spans = F.sequence(_bucket(F.date_sub("published", PUBLISH_DAYS)), _bucket(F.col("published")))
    return F.when(F.col("issued").isNotNull(), issue).otherwise(F.transform(spans, lambda b: F.concat(F.lit("p"), b.cast("string"))))


def _undated() -> Column:
    """Keys of a record where a date is missing: its tokens two by two."""
    ts = F.array_sort(F.array_distinct(F.transform("tokens", lambda x: x["t"])))
    return F.flatten(F.transform(ts, lambda a, i: F.transform(F.filter(ts, lambda b, j: j > i), lambda b: F.concat_ws(" ", a, b))))


def link_records(subjects: DataFrame, decisions: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """One decision per subject and one subject per decision, with the rule that found it and its confidence.

    ``subjects``: subject_id, meeting_id, city, day (date of the meeting), position, text. ``decisions``: ada, city,
    issued, published (dates, null where unknown), number (of the protocol, null where unknown), text.

    The attributes of a record are its numbers and words (``tokens``), whatever they are about; a token weighs the more
    the fewer records have it. Records meet in exact joins on city, date and a token: the day of issue, up to ISSUE_DAYS
    after the meeting, or where that is missing a span of publication, up to PUBLISH_DAYS after it; so a key holds the
    business of one meeting or a few, however many a city has. Decisions without any date meet subjects by two tokens
    at once. How often a token of one side stands on the other as well
    is learned from plain pairs: one that mostly does (a name, a sum) speaks against a pair where it is missing, one
    that does not (a turn of phrase) says nothing. A word of a few other letters is the same, mistyped.

    The RULES are passes over what the joins found, each asking for a weaker combination of equal attributes of
    records that are still open. Of several partners the one with most weight in common, then the nearest in time is
    taken if it is alone; pairs that are each other's choice are resolved and leave the later passes. The last pass
    takes pairs whose protocol number fits the run of numbers of the meeting's resolved pairs.

    Confidence is the share of a rule's pairs that are right by ``labels`` (subject_id, ada), smoothed. Without labels
    two attributes that a rule does not look at stand for them: for the rules before the last the run of numbers, by
    which they choose nothing; for the last one the pairs of the rules before it, on which it is tried.

    Null texts, cities and dates match nothing by themselves; repeated rows count once; ties stay open; empty tables
    give an empty result. Out: subject_id, ada, rule, confidence.

    Tables that grow with the records are merged: by their files, which are small beside what unfolds from them, Catalyst
    would take them for small enough to be gathered on the driver. Only tokens, cities and rules are left to it.
    """
    s = subjects.where("subject_id is not null").dropDuplicates(["subject_id"]).select("subject_id", "meeting_id", "day", "position", city_of("city").alias("city"), tokens_of("text").alias("f"))
    d = decisions.where("ada is not null").dropDuplicates(["ada"]).select("ada", "issued", "published", "number", city_of("city").alias("city"), tokens_of("text").alias("f"))
    s, d = (cut(x.select(*[c for c in x.columns if c != "f"], "f.*")) for x in (s, d))
    pairs = _features(_met(s, d), s, d)
    done, known = None, None
    for rule, wanted in RULES:
        open_ = pairs
        if done is not None:
            open_ = pairs.join(done.select("subject_id").hint("merge"), "subject_id", "left_anti").join(done.select("ada").hint("merge"), "ada", "left_anti")
        if "fits" in wanted:
            known = done
            open_ = _in_runs(open_, done)
        chosen = _each_other(open_.where(wanted)).select("subject_id", "ada", "meeting_id", "position", "number", F.lit(rule).alias("rule"))
        old, done = done, cut(chosen if done is None else done.unionByName(chosen))
        if old is not None and old is not known:
            drop(old)
    return _with_confidence(done, known, pairs, labels)


def _met(s: DataFrame, d: DataFrame) -> DataFrame:
    """(subject_id, ada, lag) of records that meet in a join, and what they have in common."""
    n = s.select(F.explode("tokens.t").alias("t")).unionByName(d.select(F.explode("tokens.t").alias("t"))).groupBy("t").agg(F.count("*").alias("df"))
    total = s.count() + d.count()
    weights = cut(n.select("t", F.log(1 + F.lit(float(total)) / F.col("df")).alias("weight")))
    ts = lambda x: F.explode(F.array_distinct(F.transform("tokens", lambda y: y["t"]))).alias(x)
    a = s.where("city is not null and day is not null").select("subject_id", "city", "day", ts("t")).select("subject_id", "city", "day", "t", F.explode(_day_keys()).alias("slot"))
    b = d.where("city is not null and (issued is not null or published is not null)").select("ada", "city", "published", F.col("issued").isNotNull().alias("dated"), "issued", _meeting_keys().alias("slots"), ts("t")).select("*", F.explode("slots").alias("slot")).drop("slots")
    lag_i, lag_p = F.datediff("issued", "day"), F.datediff("published", "day")
    lag = F.when(F.col("dated"), lag_i).otherwise(F.when(lag_p.between(0, PUBLISH_DAYS), lag_p + ISSUE_DAYS))
    dated = a.join(b.hint("merge"), ["city", "slot", "t"]).withColumn("lag", lag).where("lag is not null").select("subject_id", "ada", "t", "lag")
    late = d.where("city is not null and issued is null and published is null")
    x = s.join(late.select("city").distinct(), "city", "left_semi").select("subject_id", "city", "tokens", F.explode(_undated()).alias("key"))
    y = late.select("ada", "city", F.col("tokens").alias("other"), F.explode(_undated()).alias("key"))
    common = F.array_intersect(F.transform("tokens", lambda z: z["t"]), F.transform("other", lambda z: z["t"]))
    undated = x.join(y.hint("merge"), ["city", "key"]).select("subject_id", "ada", F.explode(common).alias("t"), F.lit(9999).alias("lag")).distinct()
    both = dated.unionByName(undated).join(weights, "t")
    met = both.groupBy("subject_id", "ada").agg(F.min("lag").alias("lag"), F.sum("weight").alias("w"), F.count("*").alias("n"), F.count_if(F.col("t").startswith("#")).alias("numbers"))
    whole = s.select("subject_id", ts("t")).join(weights, "t").groupBy("subject_id").agg(F.sum("weight").alias("all_w"), F.count("*").alias("all_n"))
    shared = met.join(whole.hint("merge"), "subject_id").select("subject_id", "ada", "lag", F.round("w", 1).alias("w"), "n", "numbers", (F.col("w") / F.col("all_w")).alias("share"), (F.col("all_n") - F.col("n")).alias("missing"))
    return shared


def _features(met: DataFrame, s: DataFrame, d: DataFrame) -> DataFrame:
    """Pairs worth a look, with the tokens that speak against them."""
    left = s.select("subject_id", "meeting_id", "position", F.col("tokens").alias("ts"), F.col("money").alias("ms"))
    right = d.select("ada", "number", F.col("tokens").alias("td"), F.col("money").alias("md"), "cut")
    kept = met.join(left.hint("merge"), "subject_id").join(right.hint("merge"), "ada").where(F.col("cut") | (F.col("share") >= LEAST_SHARE))
    # two sums of money that have none in common speak of two matters
    kept = kept.where((F.size("ms") == 0) | (F.size("md") == 0) | F.arrays_overlap("ms", "md"))
    names = lambda c: F.transform(c, lambda x: x["t"])
    lacks = lambda a, b: F.filter(a, lambda x: ~F.array_contains(names(b), x["t"]))
    kept = cut(kept.withColumns({"lacks_s": lacks("ts", "td"), "lacks_d": lacks("td", "ts")}))
    plain = _each_other(kept.where((F.col("share") >= PLAIN_SHARE) & (F.col("n") >= PLAIN_TOKENS)))
    seen = plain.where("not cut").select(F.lit("s").alias("side"), F.explode("ts").alias("x"), F.col("lacks_s").alias("l")).unionByName(plain.select(F.lit("d").alias("side"), F.explode("td").alias("x"), F.col("lacks_d").alias("l")))
    seen = cut(seen.select("side", "x.t", (~F.array_contains(names("l"), F.col("x.t"))).cast("int").alias("hit")).groupBy("side", "t").agg(F.sum("hit").alias("hits"), F.count("*").alias("seen")))
    base = seen.groupBy("side", F.col("t").startswith("#").alias("is_number")).agg((F.sum("hits") / F.sum("seen")).alias("base"))
    base = {(r.side, r.is_number): r.base for r in base.collect()}  # four rows at most
    prior = lambda side, t: F.when(t.startswith("#"), base.get((side, True), 1.0)).otherwise(base.get((side, False), 1.0))
    lost = kept.select("subject_id", "ada", F.lit("s").alias("side"), F.explode("lacks_s").alias("x"), F.col("td").alias("others")).unionByName(kept.select("subject_id", "ada", F.lit("d").alias("side"), F.explode("lacks_d").alias("x"), F.col("ts").alias("others")))
    lost = lost.select("subject_id", "ada", "side", "x.t", "x.w", "others").join(seen, ["side", "t"], "left")
    own = F.when(F.col("side") == "s", prior("s", F.col("t"))).otherwise(prior("d", F.col("t")))
    share = (F.coalesce("hits", F.lit(0)) + FAITHFUL_PRIOR * own) / (F.coalesce("seen", F.lit(0)) + FAITHFUL_PRIOR)
    edits = F.when(F.length("w") < 6, 1).otherwise(2)
    typed = (F.col("w") != "") & F.exists("others", lambda o: (o["w"] != "") & (F.abs(F.length(o["w"]) - F.length("w")) <= 2) & (F.levenshtein(o["w"], F.col("w")) <= edits))
    against = lost.where((share >= FAITHFUL) & ~typed).groupBy("subject_id", "ada").agg(F.count_if(F.col("side") == "s").alias("against_s"), F.count_if((F.col("side") == "s") & F.col("seen").isNotNull()).alias("known_against_s"), F.count_if(F.col("side") == "d").alias("against_d"))
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("against_s", "known_against_s", "against_d")}
    return cut(kept.drop("ts", "td", "ms", "md", "lacks_s", "lacks_d").join(against.hint("merge"), ["subject_id", "ada"], "left").withColumns(zero))


def _each_other(pairs: DataFrame) -> DataFrame:
    """Pairs that are the best of both sides, with no other as good: most weight in common, then the nearest in time.

    Where the run of numbers is known, as in the last pass, the nearest to it comes first after that.
    """
    score = F.struct((-F.col("w")).alias("w"), "lag", *(["off"] if "off" in pairs.columns else []))
    by = lambda c: Window.partitionBy(c)
    best = pairs.withColumn("_score", score).withColumns({"_s": F.min("_score").over(by("subject_id")), "_d": F.min("_score").over(by("ada"))}).where("_score = _s and _score = _d")
    alone = best.withColumns({"_ns": F.count("*").over(by("subject_id")), "_nd": F.count("*").over(by("ada"))})
    return alone.where("_ns = 1 and _nd = 1").drop("_score", "_s", "_d", "_ns", "_nd")


def _in_runs(pairs: DataFrame, done: DataFrame) -> DataFrame:
    """``pairs`` with ``fits``, whether the number lies in the run of the meeting's resolved pairs; null where unknown.

    The run begins at the middle of the resolved numbers less their positions, the pair's own left out of count.
    """
    runs = done.where("number is not null and position is not null").groupBy("meeting_id").agg(F.percentile_approx(F.col("number") - F.col("position"), 0.5).alias("begin"), F.count("*").alias("known"))
    off = F.abs(F.col("number") - F.col("position") - F.col("begin"))
    return pairs.join(runs.hint("merge"), "meeting_id", "left").withColumns({"off": off, "fits": F.when(F.col("known") >= RUN_KNOWN, (off <= RUN_SLACK).cast("int"))}).drop("begin", "known")


def _with_confidence(done: DataFrame, known: DataFrame, pairs: DataFrame, labels: DataFrame | None) -> DataFrame:
    last, wanted = RULES[-1]
    if labels is not None:
        marked = done.join(labels.select("subject_id", F.col("ada").alias("right_ada")).distinct().hint("merge"), "subject_id").select("rule", (F.col("ada") == F.col("right_ada")).cast("double").alias("good"))
    else:
        by_run = _in_runs(known, known).where("fits is not null").select("rule", F.col("fits").cast("double").alias("good"))
        tried = _each_other(_in_runs(pairs, known).where(wanted)).select("subject_id", F.col("ada").alias("tried"))
        by_pairs = known.join(tried.hint("merge"), "subject_id").select(F.lit(last).alias("rule"), (F.col("ada") == F.col("tried")).cast("double").alias("good"))
        marked = by_run.unionByName(by_pairs)
    precision = marked.groupBy("rule").agg(((F.sum("good") + RIGHT) / (F.count("*") + RIGHT + WRONG)).alias("confidence"))
    return done.join(precision, "rule", "left").select("subject_id", "ada", "rule", F.coalesce("confidence", F.lit(RIGHT / (RIGHT + WRONG))).alias("confidence"))
