import json
from datetime import datetime

from pyspark.sql import functions as F

from alertflow.functions import codec
from alertflow.operators import messages

SENT = datetime(2024, 1, 1, 12)

# Message bytes -> decoded id, keyword, location, text.
DECODED = [
    ('{"id":"1","keyword":"","location":"x","text":"a"}', ("1", "", "x", "a")),
    ('{"id":7,"text":"num id","extra":1}', ("7", None, None, "num id")),
    ('{"id":"5","text":"  "}', ("5", None, None, "  ")),
    ('{"id":"4","text":""}', ("4", None, None, "")),
    ('{"id":"3","text":null}', ("3", None, None, None)),
    ('{"id":"2"}', ("2", None, None, None)),
    ("not json", (None, None, None, None)),
    ("null", (None, None, None, None)),
    ('[{"id":"6","text":"arr"}]', (None, None, None, None)),
    ('{"id":"8","text":"trunc', (None, None, None, None)),
    ("", (None, None, None, None)),
    (None, (None, None, None, None)),
]


def envelopes(spark, values):
    rows = [(None if v is None else bytearray(v.encode()), SENT, i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "value binary, timestamp timestamp, i int")


def test_decode_edge_rows(spark):
    df = envelopes(spark, [v for v, _ in DECODED])
    got = messages.expand(df, codec.decode_message(F.col("value"))).orderBy("i").collect()
    assert [(r.id, r.keyword, r.location, r.text) for r in got] == [e for _, e in DECODED]


def test_parsing_keeps_every_envelope_and_the_filter_drops_empty_texts(spark):
    df = envelopes(spark, [v for v, _ in DECODED])
    parsed = messages.parse_messages(df)
    assert parsed.columns == ["id", "keyword", "location", "text", "kafka_timestamp"]
    assert parsed.count() == len(DECODED)
    kept = messages.nonempty_text(parsed).collect()
    assert sorted(r.text for r in kept) == ["  ", "a", "num id"]
    assert {r.kafka_timestamp for r in kept} == {SENT}
    assert sorted(kept) == sorted(messages.parse_messages_explicit(df).collect())


def test_encoded_messages_read_back(spark):
    rows = [("1", None, 'say "é"\n\\', SENT), (None, "k\t", "\u0001 😀", SENT)]
    df = spark.createDataFrame(rows, "id string, keyword string, text string, kafka_timestamp timestamp")
    got = messages.encode_messages(df).collect()
    read = [json.loads(bytes(r.value).decode()) for r in got]
    assert read == [{"id": a, "keyword": b, "text": c} for a, b, c, _ in rows]
    assert "é" in bytes(got[0].value).decode()


def test_extraction_answers(spark):
    answers = [
        '{"location":"None","disaster":"flood"}',
        '```json\n{"location":"None","disaster":"flood"}\n```',
        '{"location":"a"}',
        None,
    ]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(answers)], "i int, a string")
    got = messages.expand(df, codec.decode_extraction(F.col("a"))).orderBy("i").collect()
    assert [(r.location, r.disaster) for r in got] == [("None", "flood"), (None, None), ("a", None), (None, None)]


def test_processed_rows_are_text(spark):
    df = spark.createDataFrame(
        [("1", "k", "l", "t", 1, 0.5, SENT), ("2", "k", "l", "t", 0, 0.98765, SENT)],
        "id string, keyword string, location string, text string, prediction int, confidence double, kafka_timestamp timestamp",
    )
    got = messages.processed_rows(df).orderBy("id").collect()
    assert [(r.confidence, r.disaster_label, r.timestamp) for r in got] == [
        ("0.5000", "DISASTER", "2024-01-01 12:00:00"),
        ("0.9877", "NOT_DISASTER", "2024-01-01 12:00:00"),
    ]
