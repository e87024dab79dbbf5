from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from alertflow.functions.times import as_moment
from alertflow.operators import reports, storage
from alertflow.schemas import DATABASE_TYPES
from alertflow.sinks import clustered, stores
from alertflow.sources import store

SENT = datetime(2024, 1, 1, 12, 30)
ALERT_DDL = "id string, text string, disaster string, location string, confidence double, kafka_timestamp timestamp_ntz"

SAMPLES = [
    ("m1", "the ground shook for a minute", "quake", "Lisbon", 0.95671, SENT),
    ("m2", "water is over the lower bridge", "flood", "Leer", 0.81, SENT),
    ("m3", "smoke behind the ridge road", "wildfire", "Evora", 0.9209, SENT),
]


def alerts(spark, rows):
    return spark.createDataFrame(rows, ALERT_DDL)


def row(**changes):
    base = dict(id="1", text="t", disaster="flood", location="x", confidence=0.5, kafka_timestamp=SENT)
    return tuple({**base, **changes}.values())


def stored(spark, rows):
    return storage.storage_rows(storage.checked(alerts(spark, rows)))


def test_names_types_and_stamps(spark):
    df = stored(spark, SAMPLES)
    got = df.orderBy("tweet_id").collect()
    assert [(r.tweet_id, r.disaster_type, r.location, r.confidence) for r in got] == [
        ("m1", "quake", "Lisbon", Decimal("0.9567")),
        ("m2", "flood", "Leer", Decimal("0.8100")),
        ("m3", "wildfire", "Evora", Decimal("0.9209")),
    ]
    assert len({r.processing_timestamp for r in got}) == 1
    assert all(r.processing_timestamp == r.created_at for r in got)


def test_rows_that_do_not_fit_are_kept_with_their_reasons(spark):
    rows = [
        row(id="ok", confidence=0.95675),
        row(id="null id is fine", disaster=None, location=None, confidence=None, kafka_timestamp=None),
        row(id="i" * 51),
        row(id="i" * 50, location="é" * 200),
        row(id="far", location="é" * 201),
        row(id="kind", disaster="d" * 101),
        row(id="no text", text=None),
        row(id="big", confidence=12.5),
        row(id="edge", confidence=9.99995),
        row(id="nan", confidence=float("nan")),
        row(id="both", text=None, confidence=-10.0),
    ]
    checked = storage.checked(alerts(spark, rows))
    good = {r.tweet_id: r.confidence for r in storage.storage_rows(checked).collect()}
    assert good == {"ok": Decimal("0.9568"), "null id is fine": None, "i" * 50: Decimal("0.5000")}
    bad = {r.id: r.reason for r in storage.quarantine_rows(checked).collect()}
    assert bad == {
        "i" * 51: "tweet_id_too_long",
        "far": "location_too_long",
        "kind": "disaster_type_too_long",
        "no text": "text_missing",
        "big": "confidence_out_of_range",
        "edge": "confidence_out_of_range",
        "nan": "confidence_out_of_range",
        "both": "text_missing,confidence_out_of_range",
    }


def test_text_timestamps(spark):
    df = alerts(spark, [row(id="a"), row(id="b")]).withColumn(
        "kafka_timestamp", F.when(F.col("id") == "a", "2024-01-01T12:30:00.123456").otherwise("yesterday")
    )
    checked = storage.checked(df)
    assert storage.storage_rows(checked).collect()[0].kafka_timestamp == datetime(2024, 1, 1, 12, 30, 0, 123456)
    assert storage.quarantine_rows(checked).collect()[0].reason == "kafka_timestamp_unreadable"


def test_row_keys(spark):
    same = [row(id="1", text="t")] * 2
    different = [row(id="1;1", text="t"), row(id=None, text="t"), row(id="-", text="t"), row(id="", text="t"), row(id="1", text=";t")]
    keys = [r.row_key for r in storage.surrogate_id(alerts(spark, same + different)).collect()]
    assert keys[0] == keys[1]
    assert len(set(keys)) == len(keys) - 1


def test_times_and_keys_do_not_depend_on_the_session_zone(spark):
    """Zones with half an hour of offset and with clock changes, one hour of which comes twice."""
    sent = [datetime(2024, 11, 3, h, 30) for h in range(3, 9)] + [datetime(1969, 3, 1, 0, 0, 0, 5)]
    df = alerts(spark, [row(id=str(i), kafka_timestamp=t) for i, t in enumerate(sent)])
    expected = {r.tweet_id: (r.row_key, r.kafka_timestamp) for r in storage.storage_rows(storage.checked(df)).collect()}
    windows = {tuple(r) for r in reports.type_by_window(df, "1 hour", kind="disaster").collect()}
    assert {w[0] for w in windows} == {t.replace(minute=0, microsecond=0) for t in sent}
    try:
        for zone in ("UTC", "Asia/Kolkata", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            moments = as_moment(df, "kafka_timestamp")
            assert dict(moments.dtypes)["kafka_timestamp"] == "timestamp"
            got = storage.storage_rows(storage.checked(moments)).collect()
            assert {r.tweet_id: (r.row_key, r.kafka_timestamp) for r in got} == expected
            for frame in (df, moments):
                assert {tuple(r) for r in reports.type_by_window(frame, "1 hour", kind="disaster").collect()} == windows
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_files_read_back_whole_and_prune(spark, tmp_path):
    path = str(tmp_path / "store")
    odd = [
        row(id="a", disaster="", location=None, kafka_timestamp=datetime(2024, 1, 2)),
        row(id="b", disaster=None, location="None", kafka_timestamp=None),
        row(id="c", disaster="None", kafka_timestamp=datetime(2024, 1, 3)),
    ]
    rows = stored(spark, SAMPLES + odd)
    stores.write_store(rows, "files", path=path)
    read = store.read_files(spark, path)
    same = ["tweet_id", "text", "disaster_type", "location", "confidence", "kafka_timestamp", "row_key"]
    assert sorted(map(str, read.select(same).collect())) == sorted(map(str, rows.select(same).collect()))
    assert {r.event_day for r in read.collect()} == {date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3), None}

    ranged = reports.time_range(read, datetime(2024, 1, 2), datetime(2024, 1, 3))
    assert [r.tweet_id for r in ranged.collect()] == ["a"]
    assert "event_day" in plan_of(ranged).split("PartitionFilters: [")[1].split("]")[0]

    typed = reports.by_type(read, "flood")
    assert [r.tweet_id for r in typed.collect()] == ["m2"]
    assert "EqualTo(disaster_type,flood)" in plan_of(typed)
    assert "EqualTo(location,None)" in plan_of(reports.by_location(read, "None"))
    assert [r.tweet_id for r in reports.by_location(read, "None").collect()] == ["b"]
    assert "GreaterThanOrEqual(confidence,0.9000)" in plan_of(reports.confident(read, 0.9))
    assert sorted(r.tweet_id for r in reports.confident(read, 0.9).collect()) == ["m1", "m3"]


def test_folders_by_type(spark, tmp_path):
    path = str(tmp_path / "store")
    odd = [row(id="a", disaster=""), row(id="b", disaster=None), row(id="c", disaster="None"), row(id="d", disaster="x/y=z")]
    rows = stored(spark, SAMPLES + odd)
    stores.write_files(rows, path, by_type=True)
    read = store.read_files(spark, path, by_type=True)
    same = ["tweet_id", "text", "disaster_type", "row_key"]
    assert sorted(map(str, read.select(same).collect())) == sorted(map(str, rows.select(same).collect()))
    for kind, expected in {"flood": ["m2"], "": ["a"], "None": ["c"], "x/y=z": ["d"], "absent": []}.items():
        found = reports.by_type(read, kind)
        assert [r.tweet_id for r in found.collect()] == expected
        assert "type_folder" in plan_of(found).split("PartitionFilters: [")[1].split("]")[0]


def test_appending_and_compacting(spark, tmp_path):
    path = str(tmp_path / "store")
    for compact in (False, True):
        stores.write_files(stored(spark, SAMPLES), path, compact=compact)
    assert store.read_files(spark, path).count() == 2 * len(SAMPLES)


def test_reports_break_ties(spark):
    rows = [row(id=str(i), text="x" * 70, confidence=0.9) for i in range(10, 30)]
    df = stored(spark, rows)
    latest = reports.latest_predictions(df, 3)
    assert [r.tweet_id for r in latest.collect()] == ["29", "28", "27"]
    assert {len(r.text_preview) for r in latest.collect()} == {50}
    assert "TakeOrderedAndProject" in plan_of(latest)
    assert [r.tweet_id for r in reports.top_confidence(df, 2).collect()] == ["29", "28"]


def test_documents(spark, tmp_path):
    path = str(tmp_path / "documents")
    rows = [row(id=None, disaster=None, location=None, confidence=None), row(id="2", text="y" * 60)]
    stores.write_store(alerts(spark, rows), "json", path=path)
    documents = store.read_documents(spark, path)
    assert documents.filter(F.col("processing_timestamp").isNull()).isEmpty()
    shown = {r.id: r for r in reports.latest_documents(documents, 5).collect()}
    assert (shown["N/A"].disaster, shown["N/A"].location, shown["N/A"].confidence, shown["N/A"].text) == (
        "N/A", "N/A", "0.000", "t...",
    )
    assert (shown["2"].confidence, shown["2"].text) == ("0.500", "y" * 50 + "...")


def test_catalog_table(spark):
    spark.sql("DROP TABLE IF EXISTS predictions")
    stores.create_table(spark, "predictions")
    stores.create_table(spark, "predictions")
    stores.write_store(stored(spark, SAMPLES), "table", name="predictions")
    stores.write_store(stored(spark, SAMPLES[:1]), "TABLE", name="predictions")
    table = store.read_table(spark, "predictions")
    assert table.count() == 4
    assert dict(table.dtypes)["confidence"] == "decimal(5,4)"
    assert reports.by_type(table, "quake").count() == 2
    spark.sql("DROP TABLE predictions")


def test_store_kinds(spark):
    with pytest.raises(ValueError, match="unknown store 'cassandra'"):
        stores.write_store(alerts(spark, SAMPLES), "cassandra")


def test_database_writes(spark, monkeypatch):
    """Options and mode only: a database is not part of the tests."""
    from pyspark.sql import DataFrameWriter

    seen = {}

    def save(self, *args, **kwargs):
        seen["saved"] = True

    def options(self, **given):
        seen.update(given)
        return self

    def mode(self, how):
        seen["mode"] = how
        return self

    def fmt(self, name):
        seen["format"] = name
        return self

    for name, fake in {"save": save, "options": options, "mode": mode, "format": fmt}.items():
        monkeypatch.setattr(DataFrameWriter, name, fake)
    for kind in ("postgresql", "mysql", "sqlite", "jdbc"):
        seen.clear()
        stores.write_store(stored(spark, SAMPLES), kind, url=f"jdbc:{kind}://host/db", table="predictions", user="u")
        assert seen == {
            "format": "jdbc", "mode": "append", "saved": True, "url": f"jdbc:{kind}://host/db",
            "dbtable": "predictions", "user": "u", "batchsize": "10000", "numPartitions": "32",
            "isolationLevel": "READ_COMMITTED", "createTableColumnTypes": DATABASE_TYPES,
        }
    seen.clear()
    more = {"column_types": None, "truncate": "true", "row_key": False}
    stores.write_store(stored(spark, SAMPLES), "jdbc", url="jdbc:x://host/db", table="t", **more)
    assert seen["truncate"] == "true" and "createTableColumnTypes" not in seen
    seen.clear()
    stores.write_store(alerts(spark, SAMPLES), "mongodb", uri="mongodb://h", database="d", collection="c")
    assert seen == {
        "format": "mongodb", "mode": "append", "saved": True,
        "connection.uri": "mongodb://h", "database": "d", "collection": "c",
    }


def test_look_ups_open_few_files_of_a_clustered_store(spark, tmp_path):
    path = str(tmp_path / "store")
    kinds, places = ["flood", "fire", "quake", None, ""], [f"place {i}" for i in range(40)] + [None]
    rows = [
        row(id=str(i), disaster=kinds[i % 3 if i < 500 else i % 5], location=places[(i * 7) % 41], confidence=(i % 97) / 100)
        for i in range(2000)
    ]
    kept = stored(spark, rows)
    clustered.write_clustered(kept, path, rows_per_file=10)
    whole = clustered.read_clustered(spark, path)
    assert whole.count() == 2000 and len(clustered.files_met(spark, path, {})) == 200
    same = ["row_key", "tweet_id", "disaster_type", "location", "confidence"]
    for wanted, at_least in [({"disaster_type": "quake"}, {}), ({"location": "place 7"}, {}), ({}, {"confidence": 0.9}),
                             ({"disaster_type": "fire", "location": "place 3"}, {"confidence": 0.5}), ({"location": None}, {}), ({"disaster_type": "absent"}, {})]:
        found = clustered.read_clustered(spark, path, wanted, at_least)
        want = kept
        for c, v in wanted.items():
            want = want.filter(F.col(c).eqNullSafe(F.lit(v)))
        for c, v in at_least.items():
            want = want.filter(F.col(c) >= v)
        assert sorted(map(str, found.select(*same).collect())) == sorted(map(str, want.select(*same).collect()))
        files = clustered.files_met(spark, path, wanted, at_least)
        assert len(found.inputFiles()) == len(files) <= 100, (wanted, len(files))
    assert len(clustered.files_met(spark, path, {"location": "place 7"})) <= 80
    assert len(clustered.files_met(spark, path, {"disaster_type": "fire", "location": "place 7"}, {"confidence": 0.9})) <= 20
    with pytest.raises(ValueError, match="not clustered"):
        clustered.read_clustered(spark, path, {"tweet_id": "1"})
    clustered.write_clustered(kept.limit(0), str(tmp_path / "empty"))
    assert clustered.read_clustered(spark, str(tmp_path / "empty")).count() == 0


def test_a_clustered_store_computes_its_rows_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    kept = stored(spark, [row(id=str(i)) for i in range(200)])
    clustered.write_clustered(kept.withColumn("text", counted("text")), str(tmp_path / "store"), rows_per_file=10)
    assert clustered.read_clustered(spark, str(tmp_path / "store")).count() == seen.value == 200


def test_files_of_few_rows_are_bounded():
    assert [clustered.file_count(n, 20) for n in (0, 20, 21, 2_000, 10_000_000)] == [1, 1, 2, 100, 1024]
    assert clustered.file_count(3_000_000_000, 20) == clustered.file_count(3_000_000_000, 1_000_000) == 3_000
    assert clustered.file_count(30_000_000, 10_000_000) == 3
