import json

import pytest
from pyspark.sql import functions as F

from praktika.operators import diff as D
from praktika.operators.lineage import cut, drop
from praktika.sources import readers as R
from praktika.sources import sinks as K
from praktika.streaming import events as E

SUBJECTS = [{"subjectId": "s1", "name": "Α", "agendaItemIndex": 1}, {"subjectId": "s2", "name": "Β", "nonAgendaReason": "outOfAgenda"}]


def test_two_layouts(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"meeting": {"meetingId": "m1", "date": "2024-05-01", "unitId": "u"}, "subjects": SUBJECTS}))
    (tmp_path / "b.json").write_text(json.dumps(SUBJECTS))
    a = R.read_subjects(spark, str(tmp_path / "a.json")).orderBy("ord").collect()
    assert [(r.meeting_id, str(r.date), r.unit_ids, r.subject_id, r.agenda_item_index) for r in a] == [("m1", "2024-05-01", ["u"], "s1", 1), ("m1", "2024-05-01", ["u"], "s2", None)]
    b = R.read_subjects(spark, str(tmp_path / "b.json"), "m9", "2024-06-02").collect()
    assert {(r.meeting_id, str(r.date)) for r in b} == {("m9", "2024-06-02")}
    (tmp_path / "c.json").write_text(json.dumps([{"subjectId": "", "name": "Α"}]))
    with pytest.raises(Exception, match="no id"):
        R.read_subjects(spark, str(tmp_path / "c.json")).collect()


def test_addresses_and_probes(spark):
    urls = ["https://www.youtube.com/watch?v=abcdef123", "https://youtu.be/abcdef123", "https://x.cdn.org/a", "https://e.org/a.mp3?x=1", "ftp://x", None]
    got = spark.createDataFrame([(u,) for u in urls], "u string").select(R.media_kind(F.col("u")).alias("m")).collect()
    assert [(r.m.kind, r.m.video_id) for r in got] == [("video", "abcdef123"), ("video", "abcdef123"), ("cdn", None), ("direct", None), ("unknown", None), ("unknown", None)]
    lines = ["x\nis_live|12.5", "NA|NA", "was_live|-3"]
    got = spark.createDataFrame([(u,) for u in lines], "u string").select(R.probe_line(F.col("u")).alias("p")).collect()
    assert [(r.p.status, r.p.duration) for r in got] == [("is_live", 12.5), (None, None), ("was_live", None)]
    log = 'x { "input_i" : "-23", "input_tp" : "-1", "input_lra" : "3", "input_thresh" : "-33" } y'
    got = spark.createDataFrame([(log,), ('{"input_i": "1"}',)], "u string").select(R.loudness(F.col("u")).alias("l")).collect()
    assert got[0].l.input_i == "-23" and got[1].l is None
    pages = spark.createDataFrame([(["a", "b", "c"],)], "p array<string>")
    assert pages.select(R.page_slice(F.col("p"), 1, 5)).first()[0] == ["b", "c"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("k1", "<b>"), ("k2", "x")], "k string, v string")
    assert "<" not in "".join(r[0] for r in K.embed_json(df).collect())
    K.put_once(df, "k", str(tmp_path / "o"))
    K.put_once(df.unionByName(spark.createDataFrame([("k3", "y")], "k string, v string")), "k", str(tmp_path / "o"))
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "o")).collect()) == ["k1", "k2", "k3"]
    K.append_log(spark.createDataFrame([("\x1b[31mred\x1b[0m",)], "t string"), "t", str(tmp_path / "l"))
    assert spark.read.text(str(tmp_path / "l")).first()[0] == "red"
    big = spark.createDataFrame([(["x" * 900_000],), (["y"],)], "output array<string>")
    sizes = sorted(len(r.output) for r in K.bounded_trace(big).collect())
    assert sizes[0] == 5 and sizes[1] < 1000


def test_cut_survives_and_drops(spark):
    df = cut(spark.range(10))
    assert df.count() == 10
    drop(df)
    with pytest.raises(Exception):
        df.count()


def test_streams(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00", "a", 1), (1, "2024-01-01 00:10:00", "a", 2), (1, "2024-01-01 02:00:00", "b", 3), (2, "2024-01-01 00:00:00", "b", 4)]
    df = spark.createDataFrame(rows, "user_id int, ts string, kind string, event_id int").withColumn("ts", F.col("ts").cast("timestamp"))
    df.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    stream = lambda: E.read_stream(spark, str(tmp_path), "events")
    counts = {(str(r.window_start), r.kind): r.n for r in E.materialise(E.windowed_counts(stream(), "ts", "kind"), "complete").collect()}
    assert counts == {("2024-01-01 00:00:00", "a"): 2, ("2024-01-01 00:00:00", "b"): 1, ("2024-01-01 02:00:00", "b"): 1}
    numbered = E.materialise(E.numbered_changes(stream(), "user_id", "ts", "kind"))
    assert {(r.user_id, r.kind, r.number) for r in numbered.collect()} == {(1, "a", 1), (1, "b", 2), (2, "b", 1)}
    E.run_once(stream(), "append", E.upsert_latest("user_id", ["ts", "event_id"], str(tmp_path / "state")))
    assert {(r.user_id, r.event_id) for r in spark.read.parquet(str(tmp_path / "state" / "v=0")).collect()} == {(1, 3), (2, 4)}
    at, again = str(tmp_path / "state2"), E.upsert_latest("user_id", ["ts", "event_id"], str(tmp_path / "state2"))
    one = lambda e, u, n: spark.createDataFrame([(u, e, n)], "user_id bigint, event_id bigint, ts int")
    for n, batch in enumerate([one(1, 7, 1), one(2, 8, 1), one(3, 7, 2)]):
        again(batch, n)
    again(one(3, 7, 2), 2)  # the same batch once more
    assert E.versions(spark, at) == [1, 2] and {(r.user_id, r.event_id) for r in spark.read.parquet(f"{at}/v=2").collect()} == {(7, 3), (8, 2)}
    assert K.delete_prefix(spark, at, "v=1") == 1 and E.versions(spark, at) == [2] and K.delete_prefix(spark, at, "") == 0
    asked = stream().where("kind = 'a'").select("user_id", F.col("ts").alias("t0"), F.col("event_id").alias("asked"))
    came = stream().where("kind = 'b'").select(F.col("user_id").alias("user_id_answered"), F.col("ts").alias("t1"), F.col("event_id").alias("came"))
    pairs = E.materialise(E.answered(asked, came, "user_id", "t0", "t1", "2 hours"))
    assert {(r.asked, r.came) for r in pairs.collect()} == {(1, 3), (2, 3)}


def test_verdicts(spark):
    df = spark.createDataFrame([("α", "α", 10, 10), ("α", "β", 10, 11), ("α", "α", 10, 50)], "a string, b string, x int, y int")
    a, b = F.col("x"), F.col("y")
    verdict, changes = D.verdict([("name", F.col("a") != F.col("b"), F.lit(False)), ("utterances", a != b, D.share_changed(a, b, D.UTTERANCE_SHARE))])
    assert [(r[0], r[1]) for r in df.select(verdict, changes).collect()] == [("identical", []), ("cosmetic", ["name", "utterances"]), ("structural", ["utterances"])]


def test_recordings_caches_settings_and_counts(spark, tmp_path, monkeypatch):
    import json as j

    (tmp_path / "d.json").write_text(j.dumps({"diarization": [{"start": 0, "end": 1.5, "speaker": "A"}], "speakers": [{"speaker": "A", "match": "p1", "confidence": {"p1": 80}}]}))
    (tmp_path / "t.json").write_text(j.dumps({"transcription": {"utterances": [{"text": "ναι", "start": 0.1, "end": 1, "speaker": 0, "words": [{"word": "ναι", "start": 0.1, "end": 1}]}]}}))
    segments, speakers, utterances = R.read_recording(spark, str(tmp_path / "d.json"), str(tmp_path / "t.json"))
    assert (segments.first().end, speakers.first().match, utterances.first().text) == (1.5, "p1", "ναι")
    asked = spark.createDataFrame([("u1",), ("u2",)], "url string")
    cache = asked.where("url = 'u1'").select(F.substring(F.sha2("url", 256), 1, 16).alias("cache_key"), F.lit("x").alias("body"))
    hits, misses = R.read_through(asked, cache, "url")
    assert [r.url for r in hits.collect()] == ["u1"] and [r.url for r in misses.collect()] == ["u2"]
    hits, misses = R.read_through(asked, cache, "url", skip=True)
    assert hits.count() == 0 and misses.count() == 2
    (tmp_path / "s.json").write_text('{"PRAKTIKA_KEY": "file"}')
    assert R.setting("PRAKTIKA_KEY", str(tmp_path / "s.json")) == "file"
    monkeypatch.setenv("PRAKTIKA_KEY", "env")
    assert R.setting("PRAKTIKA_KEY", str(tmp_path / "s.json")) == "env"
    with pytest.raises(KeyError):
        R.setting("PRAKTIKA_OTHER", str(tmp_path / "none.json"))
    files = spark.createDataFrame([("v1.mp3", 10), ("v1.json", 5), ("v2.mp3", 1)], "path string, length bigint")
    assert {(r.key, r.bytes, r.files) for r in R.bytes_by_key(files, F.substring_index("path", ".", 1)).collect()} == {("v1", 15, 2), ("v2", 1, 1)}
    units = spark.createDataFrame([("a",), ("b",), ("c",)], "u string")
    got = R.counted_units(units, spark.createDataFrame([("a", 3), ("a", 4)], "u string, n int"), units.where("u = 'b'"), "u").collect()
    assert [(r.u, r.n) for r in got] == [("a", 7), ("c", 0), ("b", -1)]
