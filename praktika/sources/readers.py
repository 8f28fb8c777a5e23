"""Sources: JSON documents of two layouts, binary files, media addresses, probe lines, and a filtered scan of decisions."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThanOrEqual, InputPartition, LessThanOrEqual

SUBJECT = "struct<subjectId string, name string, agendaItemIndex int, nonAgendaReason string>"
WRAPPED = f"meeting struct<meetingId string, date string, unitIds array<string>, unitId string>, subjects array<{SUBJECT}>"


def read_subjects(spark: SparkSession, path: str, meeting_id: str | None = None, date: str | None = None) -> DataFrame:
    """Subjects of a file that is either {meeting, subjects} or a bare array; what is given overrides the file.

    Rows without an id or a name fail the read. A single unit id of older files becomes a list of one.
    """
    raw = spark.read.text(path, wholetext=True)
    whole = raw.select(F.from_json("value", WRAPPED, {"mode": "FAILFAST"}).alias("w")) if not _is_array(raw) else raw.select(F.struct(F.from_json("value", "struct<meetingId string, date string, unitIds array<string>, unitId string>").alias("meeting"), F.from_json("value", f"array<{SUBJECT}>", {"mode": "FAILFAST"}).alias("subjects")).alias("w"))
    rows = whole.select("w.meeting", F.posexplode("w.subjects").alias("ord", "s"))
    need = lambda c, n: F.when(F.coalesce(F.length(c), F.lit(0)) == 0, F.raise_error(F.lit(f"a subject has no {n}")).cast("string")).otherwise(c)
    units = F.coalesce("meeting.unitIds", F.when(F.col("meeting.unitId").isNotNull(), F.array("meeting.unitId")))
    return rows.select(
        F.coalesce(F.lit(meeting_id), "meeting.meetingId").alias("meeting_id"), F.coalesce(F.lit(date), "meeting.date").try_cast("date").alias("date"), units.alias("unit_ids"), "ord",
        need(F.col("s.subjectId"), "id").alias("subject_id"), need(F.col("s.name"), "name").alias("name"), F.col("s.agendaItemIndex").alias("agenda_item_index"), F.col("s.nonAgendaReason").alias("non_agenda_reason"),
    )


def _is_array(raw: DataFrame) -> bool:
    return bool(raw.where(F.ltrim("value").startswith("[")).limit(1).count())


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Files as bytes with a key for a cache: the first sixteen digits of the hash of the path."""
    return spark.read.format("binaryFile").load(path).withColumn("cache_key", F.substring(F.sha2("path", 256), 1, 16))


def page_slice(pages: Column, start: int, count: int) -> Column:
    """Pages from a 0-based start, as many as there are."""
    return F.slice(pages, start + 1, count)


def media_kind(url: Column) -> Column:
    """Where a recording lies: a video platform, with its id, a content network or a file."""
    video = F.regexp_extract(url, r"(?:youtube\.com/(?:watch\?(?:.*&)?v=|live/|embed/)|youtu\.be/)([\w-]{6,})", 1)
    kind = F.when(F.length(video) > 0, "video").when(url.rlike(r"^https?://[^/]*(?:cdn|digitaloceanspaces)[^/]*/"), "cdn").when(url.rlike(r"^https?://\S+\.(?:mp4|mp3|m4a|wav)(?:\?\S*)?$"), "direct").otherwise("unknown")
    return F.struct(kind.alias("kind"), F.nullif(video, F.lit("")).alias("video_id"))


def probe_line(text: Column) -> Column:
    """status|duration of the last line; NA and durations that are not positive are null."""
    last = F.split(F.element_at(F.split(F.trim(text), "\n"), -1), r"\|")
    known = lambda c: F.when(c != "NA", c)
    seconds = F.try_element_at(last, F.lit(2)).try_cast("double")
    return F.struct(known(F.try_element_at(last, F.lit(1))).alias("status"), F.when(seconds > 0, seconds).alias("duration"))


def loudness(text: Column) -> Column:
    """The four statistics of a loudness pass, from the JSON inside its log; null where one is missing."""
    found = F.from_json(F.regexp_extract(text, r"(?s)(\{[^{}]*\"input_i\"[^{}]*\})", 1), "input_i string, input_tp string, input_lra string, input_thresh string")
    return F.when(found["input_i"].isNotNull() & found["input_tp"].isNotNull() & found["input_lra"].isNotNull() & found["input_thresh"].isNotNull(), found)


class DecisionSource(DataSource):
    """Decisions of a register as a data source: filters on organisation and issue date go to the scan.

    A stand-in for a paginated service over landed parquet: one partition per page of files, as many rows a page as
    the service gives at once. Use: spark.dataSource.register(DecisionSource); spark.read.format("decisions").
    """

    PAGE = 500

    @classmethod
    def name(cls) -> str:
        return "decisions"

    def schema(self) -> str:
        return "ada string, subject string, protocol_number string, organization_id string, issue_date_ms bigint, publish_timestamp_ms bigint, status string"

    def reader(self, schema) -> DataSourceReader:
        return DecisionReader(self.options["path"], [f.name for f in schema])


class DecisionReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str]) -> None:
        self.path, self.columns, self.pushed = path, columns, []

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        for f in filters:
            if isinstance(f, EqualTo | GreaterThanOrEqual | LessThanOrEqual) and f.attribute[0] in ("organization_id", "issue_date_ms", "status"):
                self.pushed.append((f.attribute[0], {"EqualTo": "==", "GreaterThanOrEqual": ">=", "LessThanOrEqual": "<="}[type(f).__name__], f.value))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        import pyarrow.dataset as ds

        return [InputPartition((f.path, g.id)) for f in ds.dataset(self.path).get_fragments() for g in f.row_groups]

    def read(self, partition: InputPartition) -> Iterator:
        import pyarrow.compute as pc
        import pyarrow.dataset as ds

        path, group = partition.value
        wanted = None
        ops = {"==": lambda a, b: a == b, ">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b}
        for column, op, value in self.pushed:
            one = ops[op](pc.field(column), value)
            wanted = one if wanted is None else wanted & one
        fragment = next(iter(ds.dataset(path).get_fragments())).subset(row_group_ids=[group])
        yield from fragment.to_batches(columns=self.columns, filter=wanted, schema=ds.dataset(path).schema)


#: Layouts of the two files of a recording.
DIARIZATION = "diarization array<struct<start: double, end: double, speaker: string>>, speakers array<struct<speaker: string, match: string, confidence: map<string, double>>>"
TRANSCRIPT = "transcription struct<utterances: array<struct<text: string, start: double, end: double, speaker: int, confidence: double, words: array<struct<word: string, start: double, end: double, confidence: double>>>>>"


def read_recording(spark: SparkSession, diarization: str, transcript: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Segments, speakers and utterances of a recording's two files, each with its place; a file of another layout fails the read."""
    of = lambda path, layout: spark.read.text(path, wholetext=True).select(F.from_json("value", layout, {"mode": "FAILFAST"}).alias("r"))
    d, t = of(diarization, DIARIZATION), of(transcript, TRANSCRIPT)
    parts = [d.select(F.posexplode("r.diarization").alias("ord", "s")), d.select(F.posexplode("r.speakers").alias("ord", "s")), t.select(F.posexplode("r.transcription.utterances").alias("ord", "s"))]
    segments, speakers, utterances = (p.select("ord", "s.*") for p in parts)
    return segments, speakers, utterances


def read_through(asked: DataFrame, cache: DataFrame, url: str, skip: bool = False) -> tuple[DataFrame, DataFrame]:
    """What the cache holds of the addresses asked for, and the addresses that must be fetched; with ``skip`` all of them."""
    keyed = asked.withColumn("cache_key", F.substring(F.sha2(F.col(url), 256), 1, 16))
    if skip:
        return keyed.limit(0).join(cache, "cache_key"), keyed
    return keyed.join(cache, "cache_key"), keyed.join(cache, "cache_key", "left_anti")


def setting(name: str, path: str | None = None) -> str:
    """A setting from the environment, else from a JSON file of settings; an error where neither has it."""
    if found := os.environ.get(name):
        return found
    if path and os.path.exists(path):
        with open(path, encoding="utf-8") as f:
            if (found := json.load(f).get(name)) is not None:
                return found
    raise KeyError(f"{name} is neither in the environment nor in {path}")


def bytes_by_key(files: DataFrame, key: Column) -> DataFrame:
    """Bytes on disk per key of files (path, length) as Spark lists them."""
    return files.groupBy(key.alias("key")).agg(F.sum("length").alias("bytes"), F.count("*").alias("files"))


def counted_units(units: DataFrame, counts: DataFrame, failed: DataFrame, unit: str) -> DataFrame:
    """Decisions per unit, most first: none where nothing was counted, -1 where counting failed."""
    errors = failed.select(unit, F.lit(True).alias("_failed")).distinct()
    joined = units.select(unit).distinct().join(counts.groupBy(unit).agg(F.sum("n").alias("n")), unit, "left").join(errors, unit, "left")
    return joined.select(unit, F.when(F.col("_failed"), F.lit(-1)).otherwise(F.coalesce("n", F.lit(0))).cast("bigint").alias("n")).orderBy(F.desc("n"), unit)
