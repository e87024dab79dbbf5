import time
from datetime import datetime, timedelta, timezone

import pytest
from conftest import plan_of
from pyspark.errors import StreamingQueryException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from alertflow.operators import messages, reports, storage
from alertflow.operators.extraction import DictionaryExtractor
from alertflow.operators.scoring import LexiconScorer, model_scorer
from alertflow.plans.alerts import alerts, failed_rows, scored_messages
from alertflow.schemas import ALERT, STORED
from alertflow.sinks import stores
from alertflow.sources import store, topics
from alertflow.streaming import jobs, scratch

SCORER = LexiconScorer(("flood", "fire"), weight=4.0)
EXTRACTOR = DictionaryExtractor(("houston", "texas"), ("flood", "fire"))


@pytest.fixture
def topic(spark, tmp_path):
    """Three files of envelopes, the last one with nothing to find."""
    path = str(tmp_path / "topic")
    texts = [["Flood in Houston", "a park", ""], ["fire! fire!", "Texas"], ["not", " "]]
    for n, part in enumerate(texts):
        rows = [(f"{n}-{i}", "k", t, datetime(2024, 1, 1, n, i)) for i, t in enumerate(part)]
        df = spark.createDataFrame(rows, "id string, keyword string, text string, kafka_timestamp timestamp")
        messages.encode_messages(df).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    return path


def stream(spark, topic, per_trigger=None):
    schema = spark.read.parquet(topic).schema
    return topics.stream_files(spark, topic, schema, max_files_per_trigger=per_trigger)


def found(envelopes):
    return alerts(envelopes, SCORER, EXTRACTOR)


def rows(df):
    return sorted(map(str, df.collect()))


def test_stream_equals_batch_and_a_second_start_adds_nothing(spark, topic, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    batch = found(spark.read.parquet(topic))
    assert batch.count() == 2
    for _ in range(2):
        jobs.wait(jobs.start_files(found(stream(spark, topic)), out, checkpoint, every=None))
        assert rows(spark.read.schema(batch.schema).json(out)) == rows(batch)


def test_new_files_are_picked_up_after_a_restart(spark, topic, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    jobs.wait(jobs.start_files(found(stream(spark, topic)), out, checkpoint, every=None))
    spark.read.parquet(topic).coalesce(1).write.mode("append").parquet(topic)
    jobs.wait(jobs.start_files(found(stream(spark, topic)), out, checkpoint, every=None))
    assert spark.read.json(out).count() == 4


def test_pacing(spark, topic, tmp_path):
    paced = messages.parse_messages(stream(spark, topic, per_trigger=1))
    query = jobs.start_files(paced, str(tmp_path / "out"), str(tmp_path / "checkpoint"), every=None)
    jobs.wait(query)
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [3, 2, 2]


def test_counters_of_a_stream(spark, topic, tmp_path):
    watched = reports.observed(scored_messages(stream(spark, topic), SCORER), "scores")
    query = jobs.start_files(watched, str(tmp_path / "out"), str(tmp_path / "checkpoint"), every=None)
    jobs.wait(query)
    seen = [p.observedMetrics["scores"].asDict() for p in query.recentProgress if p.numInputRows]
    assert seen == [{"n_rows": 6, "n_blank": 1, "n_positive": 2, "n_failed": 0}]


def test_console_and_a_bounded_wait(spark, topic, tmp_path):
    query = jobs.start_console(found(stream(spark, topic)), str(tmp_path / "checkpoint"), every="1 second")
    try:
        assert jobs.wait(query, 0.2) is False
        assert query.isActive
        query.processAllAvailable()
        assert query.exception() is None
    finally:
        query.stop()
    assert jobs.wait(query) is True


def test_fan_out_serves_every_sink_the_same_rows(spark, topic, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    sinks = [
        lambda df: jobs.start_files(df, one, str(tmp_path / "c1"), every=None),
        lambda df: jobs.start_store(df, two, str(tmp_path / "c2"), every=None),
        lambda df: jobs.start_quarantine(df, str(tmp_path / "three"), str(tmp_path / "c3"), every=None),
    ]
    first, *rest = jobs.start_fan_out(
        found(stream(spark, topic)), str(tmp_path / "scored"), str(tmp_path / "c0"), sinks, every=None
    )
    for query in rest:
        jobs.wait(query)
    batch = found(spark.read.parquet(topic))
    assert rows(spark.read.schema(batch.schema).json(one)) == rows(batch)
    kept = store.read_files(spark, two)
    assert sorted(r.tweet_id for r in kept.collect()) == sorted(r.id for r in batch.collect())
    assert kept.filter("event_day = DATE'2024-01-01'").count() == batch.count()


def test_fan_out_of_a_running_stream(spark, topic, tmp_path):
    """The sinks may start before the first file of scored rows is there."""
    one = str(tmp_path / "one")
    queries = jobs.start_fan_out(
        found(stream(spark, topic)),
        str(tmp_path / "scored"),
        str(tmp_path / "c0"),
        [lambda df: jobs.start_files(df, one, str(tmp_path / "c1"), "1 second")],
        every="1 second",
    )
    try:
        batch = found(spark.read.parquet(topic))
        for query in queries:
            query.processAllAvailable()
        assert rows(spark.read.schema(batch.schema).json(one)) == rows(batch)
    finally:
        for query in queries:
            query.stop()


def test_run_all_raises_the_failure_of_any_query(spark, topic, tmp_path):
    good = jobs.start_files(found(stream(spark, topic)), str(tmp_path / "a"), str(tmp_path / "c1"), "1 second")
    broken = stream(spark, topic).select(F.raise_error(F.lit("boom")).cast("string").alias("x"))
    bad = jobs.start_files(broken, str(tmp_path / "b"), str(tmp_path / "c2"), "1 second")
    with pytest.raises(StreamingQueryException, match="boom"):
        jobs.run_all([good, bad], poll_seconds=0.1)
    assert not good.isActive


def test_a_batch_written_twice_is_there_once(spark, topic, tmp_path):
    path, bad_path = str(tmp_path / "store"), str(tmp_path / "quarantine")
    run = jobs.run_id(spark, str(tmp_path / "checkpoint"))
    assert run == jobs.run_id(spark, str(tmp_path / "checkpoint"))
    write = jobs.file_batch_writer(path, bad_path, run)
    df = found(spark.read.parquet(topic))
    too_long = df.withColumn("location", F.repeat(F.lit("x"), 201))
    for batch_id, part in [(0, df), (1, df), (1, df), (2, too_long), (2, too_long)]:
        write(part, batch_id)
    counts = {r.batch_id: r["count"] for r in spark.read.parquet(path).groupBy("batch_id").count().collect()}
    assert counts == {0: 2, 1: 2}
    assert spark.read.parquet(bad_path).count() == 2

    other = jobs.run_id(spark, str(tmp_path / "other"))
    assert other != run
    jobs.file_batch_writer(path, bad_path, other)(df, 0)
    stored = store.read_files(spark, path)
    assert stored.count() == 6
    assert stored.columns == [*STORED.names, "event_day"]


def test_reports_agree_on_the_output_of_every_writer(spark, topic, tmp_path):
    df = found(spark.read.parquet(topic))
    kept = storage.storage_rows(storage.checked(df))
    paths = {kind: str(tmp_path / kind) for kind in ("batch", "files", "stream", "types")}
    jobs.file_batch_writer(paths["batch"], str(tmp_path / "bad"), "r")(df, 0)
    stores.write_store(kept, "files", path=paths["files"])
    stores.write_store(kept, "files", path=paths["types"], by_type=True)
    jobs.wait(jobs.start_store(found(stream(spark, topic)), paths["stream"], str(tmp_path / "c"), every=None))
    seen = set()
    for kind, path in paths.items():
        read = store.read_store(spark, "files", path=path, by_type=kind == "types")
        ranged = reports.time_range(read, datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 30))
        zoned = reports.time_range(
            read,
            datetime(2024, 1, 1, 2, tzinfo=timezone(timedelta(hours=2))),
            datetime(2023, 12, 31, 19, 30, tzinfo=timezone(timedelta(hours=-5))),
        )
        views = [ranged, zoned, reports.by_type(read, "flood"), reports.by_location(read, "houston")]
        views += [reports.latest_predictions(read).drop("processing_timestamp"), reports.top_confidence(read)]
        same = [c for c in kept.columns if c not in ("processing_timestamp", "created_at")]
        seen.add(tuple(str(rows(v.select(*[c for c in same if c in v.columns]))) for v in views))
    (only,) = seen
    assert only[0] == only[1] == only[2] != "[]"


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_documents_keep_their_message_time(spark, topic, tmp_path, zone):
    expected = rows(found(spark.read.parquet(topic)).select("id", "kafka_timestamp"))
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = found(spark.read.parquet(topic))
        stores.write_store(df, "json", path=str(tmp_path / "documents"))
        jobs.wait(jobs.start_files(found(stream(spark, topic)), str(tmp_path / "out"), str(tmp_path / "c"), every=None))
        documents = store.read_store(spark, "json", path=str(tmp_path / "documents"))
        assert rows(documents.select("id", "kafka_timestamp")) == expected
        assert rows(spark.read.schema(ALERT).json(str(tmp_path / "out")).select("id", "kafka_timestamp")) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("broken", ["fire", ""])
def test_failures_are_counted_and_kept(spark, topic, broken):
    """A model that fails on some rows, and one that fails on all."""

    def load():
        def predict(texts):
            if any(broken in t for t in texts):
                raise ValueError("cannot read this")
            return [1] * len(texts), [0.9] * len(texts)

        return predict

    good = spark.read.parquet(topic)
    bad = good.limit(1).withColumn("value", F.lit("no json").cast("binary"))
    sent = good.unionByName(bad)
    failed = failed_rows(sent, model_scorer(load))
    expected = [("undecodable", None, "no json")]
    texts = ["Flood in Houston", "a park", "fire! fire!", "Texas", "not"]
    ids = ["0-0", "0-1", "1-0", "1-1", "2-0"]
    expected += [("prediction_failed", i, t) for i, t in zip(ids, texts) if broken in t]
    assert sorted(map(str, expected)) == sorted(str((r.reason, r.id, r.payload)) for r in failed.collect())
    counters = Observation("scores")
    kept = alerts(sent, model_scorer(load), EXTRACTOR, counters)
    assert len(kept.collect()) == 5 - (len(expected) - 1)
    assert counters.get["n_failed"] == len(expected) - 1


def test_a_half_written_database_batch_is_completed(spark, topic, tmp_path):
    """Files stand in for the database table."""
    path = str(tmp_path / "table")
    once = found(spark.read.parquet(topic))
    df = once.unionAll(once).unionAll(once)
    half = storage.storage_rows(storage.checked(once)).withColumns({"run": F.lit("a"), "batch_id": F.lit(7)})
    half.unionAll(half.orderBy("tweet_id").limit(1)).write.parquet(path)
    def writer(run):
        return jobs.jdbc_batch_writer(
            lambda session: session.read.parquet(path), lambda rows: rows.write.mode("append").parquet(path), run
        )

    write = writer("a")
    for _ in range(2):
        write(df, 7)
        table = spark.read.parquet(path)
        assert [r["count"] for r in table.groupBy("row_key").count().collect()] == [3, 3]
        assert table.columns == half.columns
    write(df, 8)
    assert spark.read.parquet(path).groupBy("batch_id").count().orderBy("batch_id").collect() == [(7, 6), (8, 6)]
    writer("b")(df, 7)
    assert spark.read.parquet(path).groupBy("run").count().orderBy("run").collect() == [("a", 12), ("b", 6)]


def test_closed_windows_of_a_stream(spark, tmp_path):
    events = [(datetime(2024, 1, 1, h, m), k, v) for h, m, k, v in
              [(0, 5, "a", 1.0), (0, 55, "a", 2.5), (0, 59, "b", None), (1, 0, "a", 4.0), (2, 30, "a", 8.0)]]
    source = str(tmp_path / "events")
    df = spark.createDataFrame(events, "ts timestamp_ntz, kind string, v double")
    df.coalesce(1).write.parquet(source)
    batch = reports.type_by_window(df, "1 hour", "ts", "kind", "v")
    assert "partial_sum" in plan_of(batch)
    expected = {(0, "a"): (2, 3.5, 1.75), (0, "b"): (1, None, None), (1, "a"): (1, 4.0, 4.0), (2, "a"): (1, 8.0, 8.0)}
    assert {(r.window_start.hour, r.type): (r.n, r.total, r["mean"]) for r in batch.collect()} == expected

    out = str(tmp_path / "out")
    windows = reports.type_by_window(
        topics.stream_files(spark, source, df.schema), "1 hour", "ts", "kind", "v", "30 minutes"
    )
    jobs.wait(jobs.start_files(windows, out, str(tmp_path / "checkpoint"), None, "parquet"))
    closed = spark.read.parquet(out).collect()
    assert {(r.window_start.hour, r.type): (r.n, r.total, r["mean"]) for r in closed} == {
        k: v for k, v in expected.items() if k[0] < 2
    }


class Session:
    """As much of a session as the scratch folder asks for."""

    def __init__(self, master, **settings):
        self.sparkContext = self.conf = self
        self.master, self.applicationId = master, f"app-{id(self)}"
        self.settings = settings

    def getConf(self):
        return self.settings

    def get(self, name, default=None):
        return self.settings.get(name, default)


def test_scratch_folder_follows_the_setting():
    for master in ("yarn", "local[2]"):
        session = Session(master, **{"spark.checkpoint.dir": "hdfs://shared/folder/"})
        assert scratch.new_folder(session, "x").startswith("hdfs://shared/folder/x-")
    assert scratch.new_folder(session, "x") != scratch.new_folder(session, "x")


def test_scratch_folder_without_the_setting():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.shared_folder(Session("yarn"))
    local = Session("local[2]")
    assert scratch.shared_folder(local) == scratch.shared_folder(local)
