import pytest
from pyspark.sql import functions as F

from alertflow.sinks import topics as topic_sinks
from alertflow.sources import csv_feed, news_feed, store, topics

CSV = (
    "id,keyword,location,text\n"
    '1,,,"He said ""fire"", run"\n'
    '2,k,"Here, there","two\nlines"\n'
    "3,k,,\n"
    "4,k\n"
    "5,feu,Orléans, spaces kept \n"
)
ROWS = [
    ("1", "", "", 'He said "fire", run'),
    ("2", "k", "Here, there", "two\nlines"),
    ("3", "k", "", ""),
    ("4", "k", "", ""),
    ("5", "feu", "Orléans", " spaces kept "),
]


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "csv"
    path.mkdir()
    (path / "a.csv").write_text(CSV, encoding="utf-8")
    return path


def test_csv_edge_rows(spark, folder):
    got = csv_feed.read_csv(spark, str(folder)).orderBy("id").collect()
    assert [tuple(r) for r in got] == ROWS


def test_columns_follow_the_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("text,id,extra\nhello,1,x\n")
    df = csv_feed.read_csv(spark, str(tmp_path))
    assert df.columns == ["text", "id", "extra"]
    assert df.collect()[0].id == "1"


def test_another_header_raises(spark, folder):
    (folder / "b.csv").write_text("id,location,keyword,text\n9,l,k,t\n")
    with pytest.raises(Exception, match="header"):
        csv_feed.read_csv(spark, str(folder)).collect()


def test_csv_stream_agrees_with_batch_and_is_paced(spark, folder, tmp_path):
    (folder / "b.csv").write_text("id,keyword,location,text\n6,k,l,t\n")
    schema = csv_feed.csv_schema(spark, str(folder))
    stream = csv_feed.stream_csv(spark, str(folder), schema, max_files_per_trigger=1)
    out = str(tmp_path / "out")
    query = (
        stream.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] in ([5, 1], [1, 5])
    got = spark.read.schema(schema).parquet(out).orderBy("id").collect()
    assert [tuple(r) for r in got] == [*ROWS, ("6", "k", "l", "t")]


def test_kafka_options():
    assert topics.kafka_read_options(["a:1", "b:2"], "tweets") == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "tweets",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    paced = topics.kafka_read_options("a:1", "t", "earliest", True, max_offsets_per_trigger=500, min_partitions=64)
    assert paced["startingOffsets"] == "earliest"
    assert paced["failOnDataLoss"] == "true"
    assert paced["maxOffsetsPerTrigger"] == "500"
    assert paced["minPartitions"] == "64"
    sent = topic_sinks.kafka_write_options("a:1", "t")
    assert (sent["kafka.bootstrap.servers"], sent["topic"], sent["kafka.retries"]) == ("a:1", "t", "3")


def test_split_database_reads_need_bounds(spark):
    with pytest.raises(ValueError, match="bounds"):
        store.read_jdbc(spark, "jdbc:x", "t", split_column="id")


def test_feed_payloads(spark):
    payloads = [
        (1, '{"results":[{"title":"a","published_date":"d","abstract":"x","more":1},{"title":"b"}],"n":2}'),
        (2, '{"results":[]}'),
        (3, '{"other":1}'),
        (4, "not json"),
        (5, None),
    ]
    df = spark.createDataFrame(payloads, "id int, payload string")
    got = news_feed.feed_items(df).collect()
    assert [tuple(r) for r in got] == [(1, "a", "d", "x"), (1, "b", None, None)]
    assert news_feed.feed_items(df.drop("id")).columns == ["title", "published_date", "abstract"]


def test_envelope_files(spark, tmp_path):
    df = spark.createDataFrame([(bytearray(b"{}"),)], "value binary").withColumn("timestamp", F.current_timestamp())
    topic_sinks.write_envelopes(df, str(tmp_path / "topic"))
    assert spark.read.parquet(str(tmp_path / "topic")).columns == ["value", "timestamp"]
