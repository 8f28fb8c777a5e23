import datetime as dt

from praktika.plans import names as P
from praktika.plans.records import candidate_pool

D = "ord int, ada string, subject string, protocol_number string, issue_date_ms bigint, publish_timestamp_ms bigint, organization_id string, organization_label string, status string"


def ms(year, month=6):
    return int(dt.datetime(year, month, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)


def test_numbers_are_read_in_every_form(spark, tmp_path):
    numbers = [("10/2022", None), ("11/22", None), ("Αρ. πρωτ.: 12-2022", None), (" ΑΔΣ 14/2022", None), (" 15", 2022), ("90", 2022), ("7/2023", None), ("8/23", None), ("10", 2023), ("13", None), (None, 2022), ("χωρίς", 2022)]
    rows = [(k, f"a{k}", "Έγκριση", n, y and ms(y), ms(2022, 7), "o", "Δήμος Α", "PUBLISHED") for k, (n, y) in enumerate(numbers)]
    spark.createDataFrame(rows + rows[:3] + [(99, "b", "Έγκριση", "16/2022", None, None, "other", "Δήμος Β", "PUBLISHED")], D).write.parquet(str(tmp_path / "decisions.parquet"))
    subjects = [("s1", "m1", 1, "Έγκριση", 1, None, "Δήμος Α", dt.datetime(2022, 6, 30))]
    spark.createDataFrame(subjects, "subject_id string, meeting_id string, ord int, name string, agenda_item_index int, non_agenda_reason string, city_name string, meeting_date timestamp").write.parquet(str(tmp_path / "match_subjects.parquet"))
    at = str(tmp_path)
    got = P.islands(spark, at).collect()
    assert {(r.organization_id, r.suffix, r.num) for r in got if r.in_run and r.suffix == "/2022"} == {("o", "/2022", n) for n in (10, 11, 12, 14, 15)}
    assert {(r.suffix, r.num) for r in got if not r.in_run} == {("/2022", 90)}
    assert sorted((r.suffix, r.missing) for r in P.sequence_gaps(spark, at).collect()) == [("/2022", 13), ("/2023", 9)]
    assert sorted((r.suffix, r.missing, r.ada) for r in P.gap_candidates(spark, at).collect()) == [("/2022", 13, "a9"), ("/2023", 9, None)]
    assert ("s1", "a9") in {(r.subject_id, r.ada) for r in candidate_pool(spark, at).collect()}
