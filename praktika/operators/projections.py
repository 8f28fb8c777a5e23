"""Shapes of records: fallbacks, merges, predicates and texts built of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from praktika.functions.text import fold, falsy

# The reasons for which an item has no place on the agenda.
OFF_AGENDA = ("BEFORE_AGENDA", "OUT_OF_AGENDA")
# How the names of municipalities begin, and the units of one whose decisions are a council's.
MUNICIPALITY = ("ΔΗΜΟΣ ", "ΔΗΜΟΣ-")
COUNCIL_UNITS = (
    r"ΔΗΜΟΤΙΚΟ ΣΥΜΒΟΥΛΙΟ",
    r"^Δ\.?Σ\.?\s+ΔΗΜΟΥ",
    r"ΔΗΜΟΤΙΚΗ ΕΠΙΤΡΟΠΗ",
    r"ΟΙΚΟΝΟΜΙΚΗ ΕΠΙΤΡΟΠΗ",
    r"ΕΠΙΤΡΟΠΗ ΠΟΙΟΤΗΤΑΣ ΖΩΗΣ",
    r"(?<!ΑΝΤΙ)ΔΗΜΑΡΧΟ[ΣΥ]",
)
# Signs that a filter of a media tool reads, and what stands for them, in the order of replacement.
FILTER_SIGNS = (("\\", "\\\\"), ("[", "\\["), ("]", "\\]"), (",", "\\,"), (";", "\\;"), (":", "\\:"), ("'", "’"), ("%", "\\%"))


def split_index(index: Column) -> Column:
    """A place that is a number or a reason, as two columns; neither counts as before the agenda."""
    number = index.try_cast("int")
    reason = F.when(index == "BEFORE_AGENDA", "beforeAgenda").when(index == "OUT_OF_AGENDA", "outOfAgenda").when(number.isNull(), "beforeAgenda")
    return F.struct(number.alias("agenda_item_index"), reason.alias("non_agenda_reason"))


def subject_view(df: DataFrame, index: str, name: str, description: str) -> DataFrame:
    """Subjects as both sides of a comparison see them: place split, type, defaults, withdrawn never null."""
    place = split_index(F.col(index))
    kind = F.when(place["agenda_item_index"].isNotNull(), "IN_AGENDA").when(place["non_agenda_reason"] == "outOfAgenda", "OUT_OF_AGENDA").otherwise("BEFORE_AGENDA")
    return df.withColumns({"agenda_item_index": place["agenda_item_index"], "non_agenda_reason": place["non_agenda_reason"], "type": kind, name: F.coalesce(name, F.lit("")), description: F.coalesce(description, F.lit("")), "withdrawn": F.coalesce("withdrawn", F.lit(False)), "topic_importance": falsy(F.col("topic_importance"), F.lit("normal")), "proximity_importance": falsy(F.col("proximity_importance"), F.lit("none"))})


def tag(tags: Column, prefix: str) -> Column:
    """The first tag prefix:value as its value."""
    hits = F.filter(tags, lambda t: t.startswith(f"{prefix}:"))
    return F.substring(F.get(hits, 0), len(prefix) + 2, 1_000_000)


def input_summary(df: DataFrame, most: int = 500) -> DataFrame:
    """Scalars kept, long texts cut with their length beside them, arrays as their counts; nested records dropped."""
    out = []
    for f in df.schema:
        kind, c = f.dataType.typeName(), F.col(f.name)
        if kind == "array":
            out.append(F.size(c).alias(f"{f.name}Count"))
        elif kind == "string":
            out += [F.when(F.length(c) > most, F.substring(c, 1, most)).otherwise(c).alias(f.name), F.when(F.length(c) > most, F.length(c)).alias(f"{f.name}Length")]
        elif kind not in ("struct", "map"):
            out.append(c)
    return df.select(*out)


def merge_parts(front: DataFrame, tail: DataFrame, key: str, lists: list[str], scalars: list[str]) -> DataFrame:
    """Two partial readings of a document: a list of the later part if it has anything, a scalar if it has one."""
    t = tail.select(key, *[F.col(c).alias(f"_{c}") for c in (*lists, *scalars)])
    both = front.join(t, key, "left")
    picked = {c: F.when(F.coalesce(F.size(f"_{c}"), F.lit(0)) > 0, F.col(f"_{c}")).otherwise(F.col(c)) for c in lists} | {c: F.coalesce(f"_{c}", c) for c in scalars}
    return both.withColumns(picked).select(*front.columns)


def too_quiet_or_loud(lufs: Column, target: float = -14.0, off: float = 1.0) -> Column:
    """Whether a recording needs its loudness changed; one that cannot be measured does."""
    x = lufs.try_cast("double")
    return F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")) | (F.abs(F.lit(target) - x) > off), F.lit(True))


def voice_known(match: Column, confidence: Column, least: float = 50.0) -> Column:
    """Whether a voice's match is one of its scored ones at ``least`` per cent."""
    return F.coalesce(F.try_element_at(confidence, match) >= least, F.lit(False))


def is_municipality(label: Column) -> Column:
    """Whether an organisation is a municipality by how its name begins; accents count."""
    upper = F.upper(label)
    return upper.startswith(MUNICIPALITY[0]) | upper.startswith(MUNICIPALITY[1])


def is_council_unit(label: Column) -> Column:
    """Whether a unit of a municipality is its council, a committee of it or its mayor."""
    return label.rlike("(?iu)" + "|".join(COUNCIL_UNITS))


def label_contains(label: Column, latin: Column, query: str) -> Column:
    q = fold(F.lit(query))
    return F.coalesce(fold(label).contains(q), F.lit(False)) | F.coalesce(fold(latin).contains(q), F.lit(False))


def is_public(path: Column, public: list[str]) -> Column:
    return F.exists(F.array(*map(F.lit, public)), lambda p: (path == p) | path.startswith(F.concat(p, F.lit("/"))))


def display_name(name: Column) -> Column:
    return falsy(name, F.lit("Unknown Speaker"))


def is_prefix(shorter: Column, longer: Column) -> Column:
    return (F.size(shorter) <= F.size(longer)) & (F.slice(longer, F.lit(1), F.greatest(F.size(shorter), F.lit(0))) == shorter)


def escape_filter_text(text: Column) -> Column:
    """Text that can stand inside a filter of a media tool."""
    for sign, instead in FILTER_SIGNS:
        text = F.replace(text, F.lit(sign), F.lit(instead))
    return text


def fitting_size(length: Column, width: float, largest: int, smallest: int, step: int = 2, ratio: float = 0.6) -> Column:
    """The largest of falling font sizes at which so many characters fit; the smallest where none does."""
    sizes = F.array(*[F.lit(s) for s in range(largest, smallest - 1, -step)][:20])
    return F.coalesce(F.get(F.filter(sizes, lambda s: length * s * ratio <= width), 0), F.lit(smallest))


def bullet_list(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda x: F.concat(F.lit("- "), x)), "\n")


def changed_segments(a: DataFrame, b: DataFrame, key: str, segment: str, order: str) -> DataFrame:
    """Segment summaries of both runs that differ in text or type; of equal segments of the second run the last counts."""
    last = b.groupBy(key, segment).agg(F.max_by(F.struct("summary", "type"), order).alias("to"))
    pairs = a.join(last, [key, segment])
    changed = ~(F.col("summary").eqNullSafe(F.col("to.summary")) & F.col("type").eqNullSafe(F.col("to.type")))
    return pairs.where(changed).withColumn("substantial", (F.col("type") == "SUBSTANTIAL") | (F.col("to.type") == "SUBSTANTIAL"))


def batch_load(df: DataFrame, batch: str, size: str, capacity: int) -> DataFrame:
    """Per batch how full it is, and which is the fullest of all, the first on ties."""
    load = df.groupBy(batch).agg(F.sum(size).alias("used"), F.count("*").alias("n")).withColumn("share", F.col("used") / F.lit(capacity))
    top = load.agg(F.max_by(batch, F.struct("share", (-F.col(batch)).alias("b"))).alias(batch)).withColumn("_top", F.lit(True))
    return load.join(top, batch, "left").withColumn("is_fullest", F.coalesce("_top", F.lit(False))).drop("_top")


def by_greek_order(df: DataFrame, label: str) -> DataFrame:
    """Rows in the order of a Greek dictionary."""
    return df.orderBy(F.collate(F.col(label), "el"), label)


def linking_state(decision: Column, extracted: Column) -> Column:
    """Whether a subject has a decision, has one that is not read yet, or has none."""
    return F.when(decision.isNull() | (decision == ""), "unlinked").when(F.coalesce(extracted, F.lit(False)), "linked").otherwise("needs_extraction")


def with_text(df: DataFrame, text: str) -> DataFrame:
    """Rows that say something."""
    return df.where(F.length(F.trim(F.coalesce(text, F.lit("")))) > 0)


def without_kinds(df: DataFrame, kind: str, left_out: list[str]) -> DataFrame:
    """Rows of any kind but the listed ones; those of no kind stay."""
    return df.where(F.col(kind).isNull() | ~F.col(kind).isin(*left_out)) if left_out else df


def paired(a: Column, b: Column) -> Column:
    """Two arrays by their places, as long as the first; what the second lacks is null."""
    return F.transform(a, lambda x, i: F.struct(x.alias("a"), F.get(b, i).alias("b")))


def months_before(day: Column, months: int = 3) -> Column:
    """Where a profile begins if nothing else is said."""
    return F.add_months(day, -months)


def with_settings(df: DataFrame, code: str, settings: DataFrame, default: str) -> DataFrame:
    """Each row with the settings of its language; of the default one where its own has none or is missing."""
    own = settings.withColumn("_known", F.lit(True))
    joined = df.join(own.select(F.col("code").alias(code), "_known").distinct(), code, "left")
    return joined.withColumn("settings_code", F.when(F.col("_known"), F.col(code)).otherwise(F.lit(default))).drop("_known").join(settings.withColumnRenamed("code", "settings_code"), "settings_code")


def first_filled(value: str, order: str) -> Column:
    """The first value in order that is neither null nor empty, as an aggregate."""
    v = F.col(value)
    return F.min_by(v, F.when(v.isNotNull() & (v != ""), F.col(order)))


def unknown_last(df: DataFrame, key: str, item: str, first_seen: DataFrame, order: str) -> DataFrame:
    """Items of a key in the order in which they are first seen elsewhere; those never seen come last, as they stand."""
    seen = first_seen.groupBy(key, item).agg(F.min(order).alias("_seen"))
    w = Window.partitionBy(key).orderBy(F.col("_seen").asc_nulls_last(), order)
    return df.join(seen, [key, item], "left").withColumn("position", F.row_number().over(w) - 1).drop("_seen")
