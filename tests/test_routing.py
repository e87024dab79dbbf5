"""What becomes of every message, answers joined back, phrases, replays, windows of late rows."""

from datetime import date, datetime

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from alertflow.operators import extraction, reports, storage
from alertflow.operators.extraction import DictionaryExtractor, PhraseExtractor
from alertflow.operators.scoring import LexiconScorer
from alertflow.plans import alerts as plans
from alertflow.schemas import ALERT
from alertflow.sinks import stores
from alertflow.sources import store, topics
from alertflow.streaming import jobs, retention, windows

SCORER = LexiconScorer(("flood",), weight=4.0)
EXTRACTOR = DictionaryExtractor(("houston",), ("flood",))


def test_every_envelope_has_one_kind(spark):
    values = ['{"id":"1","text":"flood in Houston"}', '{"id":"2","text":""}', '{"id":"3"}', "no json", None, '[{"id":"4","text":"flood"}]',
              '"flood"', '{"id":"5","text":" "}', ' {"id":"6","text":"calm"}', '{"id":"7","text":"flood', "", "{}"]
    rows = spark.createDataFrame([(v.encode() if v is not None else None, datetime(2024, 1, 1)) for v in values], "value binary, timestamp timestamp")
    found = plans.routed(rows, SCORER, EXTRACTOR)
    assert plan_of(found).count("from_json") == 1 and "json_object_keys" not in plan_of(found)
    dead = {(r.reason, r.id, r.payload) for r in plans.dead_letters(found).collect()}
    assert dead == {("undecodable", None, values[i]) for i in (3, 4, 5, 6, 9, 10)}
    counts = {r["kind"]: r["n"] for r in found.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {"alert": 1, "empty": 3, "undecodable": 6, "blank": 1, "quiet": 1}
    assert [tuple(r) for r in plans.alert_rows(found).collect()] == [("1", "flood in Houston", "flood", "houston", 0.9526, datetime(2024, 1, 1))]
    assert reports.totals(found).first().asDict() == {
        "n_rows": 3, "n_blank": 1, "n_positive": 1, "n_failed": 0, "n_empty": 3, "n_undecodable": 6,
    }


def test_longest_phrase_at_the_first_place(spark):
    texts = ["In New-York city and Houston", "new yorker, HOUSTON new york", "new", "york new york", "", None, "a.b new\nyork CITY hall", "city hall new"]
    places, types = ("new york", "new york city", "new", "houston", "york"), ("city hall", "city", "a b new")
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").withColumn("location", F.lit("clash"))
    want = [("new york city", "city"), ("new", "None"), ("new", "None"), ("york", "None"), ("None", "None"), ("None", "None"),
            ("new york city", "a b new"), ("new", "city hall")]
    lists = extraction.extract_fields(df, PhraseExtractor(places, types))
    assert [(r.location, r.disaster) for r in lists.orderBy("id").collect()] == want
    terms = spark.createDataFrame([("location", p) for p in places] + [("disaster", t) for t in types] * 2, "kind string, term string")
    for key in (None, ["id"]):
        table = extraction.extract_phrases(df, terms, key=key)
        assert [(r.location, r.disaster) for r in table.orderBy("id").collect()] == want
    assert {(r.location, r.disaster) for r in extraction.extract_phrases(df, terms.limit(0)).collect()} == {("None", "None")}
    with pytest.raises(ValueError, match="more than 16"):
        extraction.extract_phrases(df, terms.limit(1).select("kind", F.lit("a " * 16 + "b").alias("term")))
    with pytest.raises(ValueError, match="single spaces"):
        df.select(PhraseExtractor(("two  spaces",), types)(F.col("text"))).collect()


def test_a_token_that_begins_many_phrases_makes_no_group_of_its_own(spark):
    """Runs are joined whole: what the join is dealt by is the run, never its first token."""
    terms = spark.range(5000).select(F.lit("location").alias("kind"), F.concat(F.lit("new t"), F.col("id")).alias("term"))
    df = spark.range(2000).select("id", F.concat(F.lit("see new t"), F.col("id") * 3).alias("text"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = extraction.extract_phrases(df, terms, key=["id"])
        assert found.filter("location <> 'None'").count() == 1667
        assert "hashpartitioning(term" in plan_of(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_answers_join_back(spark):
    texts = ["same"] * 30 + ["a", "b", "c", "d", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").withColumn("disaster", F.lit("clash"))
    requests = extraction.request_table(df, "? {text}")
    keys = {r.request: r.request_key for r in requests.collect()}
    assert set(keys) == {"? same", "? a", "? b", "? c", "? d"} and requests.count() == 5
    good, other = '{"location":"x","disaster":"y"}', '{"location":"w"}'
    answers = [("? same", good), ("? same", good), ("? a", "prose"), ("? b", other), ("? b", good), ("? b", "prose"), ("? c", None)]
    told = spark.createDataFrame([(keys[q], a) for q, a in answers] + [("gone", good)], "request_key string, answer string")
    rows = {r.id: (r.location, r.disaster, r.answer_state) for r in extraction.attach_answers(df, told, "? {text}").collect()}
    assert len(rows) == len(texts) and {rows[i] for i in range(30)} == {("x", "y", "answered")}
    assert [rows[i] for i in range(30, 35)] == [
        (None, None, "malformed"), ("w", None, "repeated"), (None, None, "malformed"), (None, None, "unanswered"), (None, None, "unanswered"),
    ]
    assert {r.request for r in extraction.unanswered(requests, told).collect()} == {"? a", "? c", "? d"}


def alert_feed(spark, ids):
    data = [(str(i), f"text {i}", "flood", "x", 0.9, datetime(2024, 1, 1 + i % 3) if i else None) for i in ids]
    return spark.createDataFrame(data, ALERT)


def test_a_replay_adds_only_what_is_new(spark, tmp_path):
    path = str(tmp_path / "store")
    for ids in (range(6), [*range(6), 6, 6], [0, 0, 9]):
        stores.write_store(storage.storage_rows(storage.checked(alert_feed(spark, ids))), "new_files", path=path)
    assert sorted(r.tweet_id for r in store.read_files(spark, path).collect()) == ["0", "1", "2", "3", "4", "5", "6", "9"]
    known = stores.stored_days(spark, path, [date(2024, 1, 2)])
    assert "event_day" in plan_of(known).split("PartitionFilters: [")[1].split("]")[0]


def test_a_stream_takes_a_late_repeated_and_replayed_message_once(spark, tmp_path):
    source, path = str(tmp_path / "source"), str(tmp_path / "store")
    for ids in ([5, 6, 7], [0, 1, 5, 5], [2, 7, 8]):
        alert_feed(spark, ids).coalesce(1).write.mode("append").parquet(source)
    for run in ("one", "one", "two"):
        rows = topics.stream_files(spark, source, ALERT, max_files_per_trigger=1)
        jobs.wait(jobs.start_new_rows(rows, path, str(tmp_path / run), every=None))
        assert sorted(r.tweet_id for r in store.read_runs(spark, path).collect()) == ["0", "1", "2", "5", "6", "7", "8"]
    alert_feed(spark, [3]).write.mode("append").parquet(source)
    jobs.wait(jobs.start_new_rows(topics.stream_files(spark, source, ALERT), path, str(tmp_path / "two"), every=None))
    assert store.read_runs(spark, path).count() == 8


def test_windows_of_late_rows(spark, tmp_path):
    source, path, checkpoint = (str(tmp_path / name) for name in ("source", "windows", "checkpoint"))
    rows = [("a", 1.5, datetime(2024, 1, 3, 5, 10)), ("a", None, datetime(2024, 1, 3, 5, 59)), (None, 2.0, datetime(2024, 1, 3, 6)),
            ("b", 1.0, None), ("a", 0.1, datetime(2024, 1, 1)), ("a", 0.2, datetime(2024, 1, 3, 5, 30)), ("b", None, datetime(2024, 1, 2))]
    whole = spark.createDataFrame(rows, "disaster_type string, confidence double, kafka_timestamp timestamp_ntz")
    for part in range(0, len(rows), 2):
        spark.createDataFrame(rows[part : part + 2], whole.schema).coalesce(1).write.mode("append").parquet(source)
    for _ in range(2):
        stream = topics.stream_files(spark, source, whole.schema, max_files_per_trigger=1)
        jobs.wait(windows.start_windows(stream, path, checkpoint, every=None))
        found = windows.read_windows(spark, path)
        want = reports.type_by_window(whole.filter("kafka_timestamp IS NOT NULL"))
        assert sorted(map(str, found.collect())) == sorted(map(str, want.collect())) and found.schema.names == want.schema.names
    some = windows.read_windows(spark, path, datetime(2024, 1, 2), datetime(2024, 1, 3, 6))
    assert sorted((r.type, r.n) for r in some.collect()) == [("a", 3), ("b", 1)]
    assert "window_day" in plan_of(some).split("PartitionFilters: [")[1].split("]")[0]
    assert sorted(map(str, windows.merged(windows.window_parts(whole)).collect())) == sorted(map(str, want.collect()))


def test_top_n_reads_texts_of_its_rows_only(spark, tmp_path):
    path = str(tmp_path / "store")
    data = [(str(i), f"text {i}", "flood", "x", 0.9 - i / 1000, datetime(2024, 1, 1 + i % 5, 1)) for i in range(50)] + [("n", "t", "flood", "x", None, None)]
    stores.write_store(storage.storage_rows(storage.checked(spark.createDataFrame(data, ALERT))), "files", path=path)
    read = store.read_files(spark, path)
    top = reports.top_confidence(read, 3)
    plan = plan_of(top)
    assert [r.tweet_id for r in top.collect()] == ["0", "1", "2"]
    assert "In(row_key" in plan and "event_day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert [r.tweet_id for r in reports.top_confidence(read, 60).collect()][-1] == "n" and reports.top_confidence(read, 60).count() == 51
    assert reports.top_confidence(read.limit(0), 3).count() == 0


@pytest.mark.parametrize("listed", [1000, 1])
def test_top_n_by_literals_and_by_join(spark, monkeypatch, listed):
    monkeypatch.setattr(reports, "KEYS_LISTED", listed)
    data = [(str(i % 7), "same", "flood", "x", 0.5, datetime(2024, 1, 1)) for i in range(20)]
    rows = storage.stamped(storage.storage_rows(storage.checked(spark.createDataFrame(data, ALERT))))
    assert [r.tweet_id for r in reports.top_confidence(rows, 5).collect()] == ["6", "6", "5", "5", "5"]
    assert [r.tweet_id for r in reports.latest_predictions(rows, 4).collect()] == ["6", "6", "5", "5"]


def test_only_the_newest_folders_are_opened(spark, tmp_path):
    path = str(tmp_path / "documents")
    for day in range(1, 9):
        rows = alert_feed(spark, [day * 10 + i for i in range(3)]).withColumn("processing_timestamp", F.lit(datetime(2024, 1, day)).cast("timestamp_ntz"))
        stores.write_store(rows, "json", path=path)
    documents = store.read_documents(spark, path)
    newest = reports.newest_folders(documents, "processing_day", 4)
    assert {r.processing_day for r in newest.select("processing_day").distinct().collect()} == {date(2024, 1, 7), date(2024, 1, 8)}
    assert reports.newest_folders(documents, "processing_day", 100).count() == 24
    assert [r.id for r in reports.latest_documents(documents, 4).collect()] == ["82", "81", "80", "72"]


def test_files_go_when_every_sink_is_past_them(spark, tmp_path):
    """A fast sink and one that takes a file at a time: no row is lost, totals stay, the folder does not grow."""
    source, shared, counts = (str(tmp_path / name) for name in ("source", "shared", "counts"))
    rows = plans.routed(spark.createDataFrame([], "value binary, timestamp timestamp"), SCORER, EXTRACTOR)

    def send(part):
        values = [(f'{{"id":"{part}-{i}","text":"flood {part}"}}'.encode(), datetime(2024, 1, 1)) for i in range(3)] + [(b"no json", None)]
        spark.createDataFrame(values, "value binary, timestamp timestamp").coalesce(1).write.mode("append").parquet(source)

    def route():
        envelopes = topics.stream_files(spark, source, rows_schema, max_files_per_trigger=1)
        jobs.wait(*jobs.start_routed(plans.routed(envelopes, SCORER, EXTRACTOR), shared, str(tmp_path / "c0"), [], every=None))

    def sink(name):
        stream = spark.readStream.schema(rows.schema).parquet(shared)
        jobs.wait(jobs.start_files(plans.alert_rows(stream), str(tmp_path / name), str(tmp_path / f"c-{name}"), every=None))

    def files():
        return len(list((tmp_path / "shared").glob("kind=*/*.parquet")))

    checkpoints = [str(tmp_path / "c-fast"), str(tmp_path / "c-slow")]
    rows_schema = spark.createDataFrame([], "value binary, timestamp timestamp").schema
    for part in range(4):
        send(part)
        route()
        sink("fast")
        if part in (1, 3):
            sink("slow")
        before = files()
        gone = retention.retire(spark, shared, checkpoints, counts)
        assert (gone > 0) == (part in (1, 3)) and files() == before - gone
        told = retention.totals_so_far(spark, shared, counts).first()
        assert (told.n_rows, told.n_positive, told.n_undecodable) == (3 * (part + 1), 3 * (part + 1), part + 1)
    assert files() == 0 and retention.retire(spark, shared, checkpoints, counts) == 0
    for name in ("fast", "slow"):
        assert sorted(r.id for r in spark.read.schema(ALERT).json(str(tmp_path / name)).collect()) == [f"{p}-{i}" for p in range(4) for i in range(3)]
