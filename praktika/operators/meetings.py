"""What a meeting's documents add up to: order of discussion, attendance along it, runs and their differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from praktika.functions.text import clean_refs
from praktika.operators.diff import DESCRIPTION_SHARE, UTTERANCE_SHARE, share_changed, verdict

#: Samples of changed segments in a report.
SAMPLES = 10
#: Seconds of audio of one recording, and by how much a reply may be longer before it is another recording's.
SEGMENT_SECONDS, SLACK_SECONDS = 900, 60


def complete_order(subjects: DataFrame, explicit: DataFrame, key: str) -> DataFrame:
    """The whole order of discussion: what is said about it, then what is left outside the agenda, then of the agenda.

    ``subjects``: ``key``, item_index, reason (null for the agenda's own), rows without an index have no place.
    ``explicit``: ``key``, position, item_index, reason. Without an explicit order a meeting takes the items outside
    the agenda first. Out: ``key``, item_index, reason ('' for the agenda's own), position from 0.
    """
    plain = lambda df: df.where("item_index is not null").withColumn("reason", F.coalesce("reason", F.lit("")))
    said, every = plain(explicit), plain(subjects)
    first = said.select(key, "item_index", "reason", F.lit(0).alias("_group"), F.col("position").cast("int").alias("_at"))
    rest = every.join(said.select(key, "item_index", "reason").distinct(), [key, "item_index", "reason"], "left_anti")
    rest = rest.where("reason in ('', 'outOfAgenda')").select(key, "item_index", "reason", F.when(F.col("reason") == "", 2).otherwise(1).alias("_group"), F.col("item_index").cast("int").alias("_at"))
    w = Window.partitionBy(key).orderBy("_group", "_at", "item_index")
    return first.unionByName(rest).withColumn("position", F.row_number().over(w) - 1).drop("_group", "_at")


def placed_changes(changes: DataFrame, order: DataFrame, key: str) -> DataFrame:
    """Attendance changes by the place of their item in the order of discussion, as ``attendance_at`` reads them.

    ``changes``: ``key``, name, change_type, item_index, reason, timing, ord. A change of the whole session has no
    item; one at an item that is not discussed changes nothing and is left out.
    """
    session = changes.where("item_index is null").select(key, "name", "change_type", F.lit(None).cast("int").alias("position"), "timing", "ord")
    at = changes.where("item_index is not null").withColumn("reason", F.coalesce("reason", F.lit("")))
    placed = at.join(order.select(key, "item_index", "reason", "position"), [key, "item_index", "reason"]).select(key, "name", "change_type", "position", "timing", "ord")
    return session.unionByName(placed)


def second_stage(left: DataFrame, free: DataFrame, proposals: DataFrame, within: str, name: str, person: str, order: str) -> DataFrame:
    """Proposals for names that a first pass left over, of people whom it did not take; per name the first one.

    ``left`` and ``free`` are what ``matching.leftovers`` gives. Out: ``within``, ``name``, ``person``.
    """
    fine = proposals.join(left.select(within, name).distinct(), [within, name], "left_semi").join(free.select(within, person).distinct(), [within, person], "left_semi")
    return fine.groupBy(within, name).agg(F.min_by(person, F.struct(order, person)).alias(person))


def roll_calls(df: DataFrame, key: str, roll_call: Column, order: str) -> DataFrame:
    """Every different roll call of a key with the documents behind it, and whether more than half of them agree."""
    groups = df.select(key, roll_call.alias("roll_call"), F.col(order).alias("_o")).groupBy(key, "roll_call").agg(F.count("*").alias("n"), F.min("_o").alias("first_ord"))
    return groups.withColumn("n_documents", F.sum("n").over(Window.partitionBy(key))).withColumn("selected", 2 * F.col("n") > F.col("n_documents"))


def subject_verdict(a: str = "a_", b: str = "b_") -> tuple[Column, Column]:
    """(verdict, changes) of two versions of a subject, the columns of which are prefixed.

    Columns: name, topic, withdrawn, topic_importance, proximity_importance, context, description, contributions
    (map of speaker to text), utterances. Another topic, a withdrawal, speakers come or gone, and a description or
    utterances changed by more than their share are of structure; the others are cosmetic.
    """
    x, y = (lambda c: F.col(a + c)), (lambda c: F.col(b + c))
    differ = lambda c: ~x(c).eqNullSafe(y(c))
    text = lambda c: clean_refs(F.coalesce(c, F.lit("")))
    before, after = text(x("description")), text(y("description"))
    empty = F.create_map().cast("map<string,string>")
    said_a, said_b = F.coalesce(x("contributions"), empty), F.coalesce(y("contributions"), empty)
    added, removed = F.array_except(F.map_keys(said_b), F.map_keys(said_a)), F.array_except(F.map_keys(said_a), F.map_keys(said_b))
    same = F.array_intersect(F.map_keys(said_a), F.map_keys(said_b))
    reworded = F.exists(same, lambda k: text(F.try_element_at(said_a, k)) != text(F.try_element_at(said_b, k)))
    spoken_a, spoken_b = F.coalesce(x("utterances"), F.lit(0)), F.coalesce(y("utterances"), F.lit(0))
    no = F.lit(False)
    return verdict(
        [
            ("name", differ("name"), no),
            ("topic", differ("topic"), differ("topic")),
            ("withdrawn", differ("withdrawn"), differ("withdrawn")),
            ("topicImportance", differ("topic_importance"), no),
            ("proximityImportance", differ("proximity_importance"), no),
            ("context", differ("context"), no),
            ("description", before != after, share_changed(F.length(before), F.length(after), DESCRIPTION_SHARE)),
            ("speakers added", F.size(added) > 0, F.size(added) > 0),
            ("speakers removed", F.size(removed) > 0, F.size(removed) > 0),
            ("contributions", reworded, no),
            ("utterances", spoken_a != spoken_b, share_changed(spoken_a, spoken_b, UTTERANCE_SHARE)),
        ]
    )


def evenly(df: DataFrame, key: str, order: str, most: Column) -> DataFrame:
    """At most ``most`` rows of a key, evenly spaced in ``order``, where ``most`` may differ from key to key."""
    ranked = df.withColumns({"_r": F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1, "_n": F.count("*").over(Window.partitionBy(key)), "_k": most})
    step = (F.col("_n") - 1) / F.greatest(F.col("_k") - 1, F.lit(1))
    i = F.greatest(F.lit(0), F.ceil((F.col("_r") - 0.5) / step))
    hit = (i < F.col("_k")) & (F.floor(i * step + 0.5) == F.col("_r"))
    picked = (F.col("_n") <= F.col("_k")) | F.when(F.col("_k") == 1, F.col("_r") == 0).otherwise((F.col("_k") > 1) & hit)
    return ranked.where(picked).drop("_r", "_n", "_k")


def segment_samples(changed: DataFrame, key: str, order: str, substantial: str = "substantial", most: int = SAMPLES) -> DataFrame:
    """Samples of changed segments, the substantial first; others only fill what is left of ``most``."""
    first = evenly(changed.where(substantial), key, order, F.lit(most))
    taken = first.groupBy(key).agg(F.count("*").alias("_taken"))
    others = changed.where(~F.col(substantial)).join(taken, key, "left").withColumn("_left", F.lit(most) - F.coalesce("_taken", F.lit(0)))
    return first.unionByName(evenly(others.where("_left > 0"), key, order, F.col("_left")).drop("_taken", "_left"))


def rejected(output: Column) -> Column:
    """Why a run's output (JSON) cannot be compared: none, of a failed run, cut off, or of another task; null if it can."""
    has = lambda name: F.array_contains(F.json_object_keys(output), name)
    is_object = F.json_object_keys(output).isNotNull()
    return (
        F.when(~F.coalesce(is_object, F.lit(False)), "NO_OUTPUT")
        .when(has("error") & ~has("subjects"), "FAILED")
        .when(has("resultTruncated"), "TRUNCATED")
        .when(~has("subjects"), "NOT_COMPARABLE")
    )


def span_lines(observations: DataFrame, key: str) -> DataFrame:
    """A run's observations in the order in which they are shown: spans by start with their generations, orphans, events.

    ``observations``: ``key``, id, parent (null at the root), kind (SPAN, GENERATION, EVENT), start. A generation under
    something that is no span is not shown. Out: ``key``, id, depth, line.
    """
    spans = observations.where("kind = 'SPAN'").select(key, F.col("id").alias("parent"), F.col("start").alias("_s"))
    under = observations.where("kind = 'GENERATION' and parent is not null").join(spans, [key, "parent"]).select(key, "id", F.lit(1).alias("depth"), F.lit(0).alias("_g"), "_s", F.col("parent").alias("_p"), F.lit(1).alias("_k"), "start")
    top = observations.where("kind = 'SPAN'").select(key, "id", F.lit(0).alias("depth"), F.lit(0).alias("_g"), F.col("start").alias("_s"), F.col("id").alias("_p"), F.lit(0).alias("_k"), "start")
    loose = observations.where("(kind = 'GENERATION' and parent is null) or kind = 'EVENT'").select(key, "id", F.lit(0).alias("depth"), F.when(F.col("kind") == "EVENT", 2).otherwise(1).alias("_g"), F.lit(None).cast(observations.schema["start"].dataType).alias("_s"), F.lit(None).cast(observations.schema["id"].dataType).alias("_p"), F.lit(0).alias("_k"), "start")
    w = Window.partitionBy(key).orderBy("_g", "_s", "_p", "_k", "start", "id")
    return top.unionByName(under).unionByName(loose).withColumn("line", F.row_number().over(w) - 1).select(key, "id", "depth", "line")


def numbered_speakers(df: DataFrame, key: str, match: str, speaker: str, order: str) -> DataFrame:
    """Speakers numbered from 1 as they first appear, by whom they match or else by their own label."""
    who = F.coalesce(F.col(match), F.col(speaker))
    first = df.select(key, who.alias("speaker_key"), F.col(order).alias("_o")).where("speaker_key is not null").groupBy(key, "speaker_key").agg(F.min("_o").alias("_o"))
    return first.withColumn("speaker_no", F.row_number().over(Window.partitionBy(key).orderBy("_o", "speaker_key"))).drop("_o")


def wrong_recording(duration: Column, n_segments: Column) -> Column:
    """Whether audio is longer than a recording of several can be; a single one may have any length."""
    return (n_segments > 1) & (duration > SEGMENT_SECONDS + SLACK_SECONDS)


def overlay(df: DataFrame, metadata: DataFrame, key: str) -> DataFrame:
    """Results with what a register knows of them: its title and date, and its protocol number before the one read."""
    m = metadata.select(key, F.col("title").alias("register_title"), F.col("publish_date").alias("register_date"), F.nullif("protocol_number", F.lit("")).alias("_number"))
    return df.join(m, key, "left").withColumn("protocol_number", F.coalesce("_number", "protocol_number")).drop("_number")


def decision_result(df: DataFrame) -> DataFrame:
    """Results with their defaults: empty texts for none, null for an empty vote or number."""
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    none = lambda c: F.nullif(F.col(c), F.lit("")).alias(c)
    made = {"excerpt": blank, "references": blank, "vote_result": none, "protocol_number": none}
    return df.select(*[made[c](c) if c in made else F.col(c) for c in df.columns])


def language_code(code: Column) -> Column:
    """A recogniser's three-letter code as two letters, where it is one of the two known; others stay."""
    return F.when(code == "ell", "el").when(code == "fra", "fr").otherwise(code)


def progress(start: Column, now: Column, at: Column) -> Column:
    """(seconds since the last word, seconds running) of a task."""
    since = lambda t: F.floor(now.cast("double") - t.cast("double") + F.lit(0.5)).cast("bigint")
    return F.struct(since(at).alias("quiet_seconds"), since(start).alias("running_seconds"))


def carried_state(batches: list[DataFrame], key: str, order: str) -> DataFrame:
    """What is known after one batch of subjects after another: a later version of a subject replaces an earlier one."""
    known = None
    for n, batch in enumerate(batches):
        rows = batch.withColumn("batch", F.lit(n))
        known = rows if known is None else known.unionByName(rows)
    return known.groupBy(key).agg(F.max_by(F.struct(*known.columns), F.struct("batch", order)).alias("r")).select("r.*")
