import json

import pytest
from pyspark.sql import functions as F

from alertflow.operators import extraction

PLACES = ("houston", "california", "texas")
TYPES = ("flood", "wildfire", "quake")
TEXTS = [
    ("1", "Flood in Houston, Texas"),
    ("2", "wildfire"),
    ("3", "nothing here"),
    ("4", "TEXAS: quake, then flood"),
    ("5", ""),
    ("6", None),
    ("7", "floods near houstonville"),
]
FOUND = {
    "1": ("houston", "flood"),
    "2": ("None", "wildfire"),
    "3": ("None", "None"),
    "4": ("texas", "quake"),
    "5": ("None", "None"),
    "6": ("None", "None"),
    "7": ("None", "None"),
}


def texts(spark, rows=TEXTS):
    return spark.createDataFrame(rows, "id string, text string").withColumn("location", F.lit("dropped"))


def term_table(spark):
    rows = [("location", p) for p in PLACES] + [("disaster", t) for t in TYPES] + [("disaster", "flood")]
    return spark.createDataFrame(rows, "kind string, term string")


def result(df):
    return {r.id: (r.location, r.disaster) for r in df.collect()}


def test_word_lists(spark):
    df = extraction.extract_fields(texts(spark), extraction.DictionaryExtractor(PLACES, TYPES))
    assert df.columns == ["id", "text", "location", "disaster"]
    assert result(df) == FOUND


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
@pytest.mark.parametrize("key", [None, ["id"], ["id", "text"]])
def test_term_table_agrees_with_word_lists(spark, threshold, key):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        df = extraction.extract_with_table(texts(spark), term_table(spark), key=key)
        assert result(df) == FOUND
        assert df.count() == len(TEXTS)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_term_table_keeps_all_copies(spark):
    """One text on most rows, some of them equal in every column."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        copies = spark.range(3000).select((F.col("id") % 1000).cast("string").alias("id"), F.lit(TEXTS[0][1]).alias("text"))
        df = extraction.extract_with_table(copies, term_table(spark))
        assert df.groupBy("location", "disaster").count().collect() == [("houston", "flood", 3000)]
        assert df.groupBy("id").count().filter("count <> 3").isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_country_is_added_to_known_places_only(spark, threshold):
    places = spark.createDataFrame([("Texas", "USA"), ("Bavaria", "Germany")], "place string, country string")
    values = ["Texas", "Bavaria", "Paris", "None", None, "Texas"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, location string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        enriched = extraction.enrich_location(df, places)
        assert enriched.columns == ["i", "location"]
        got = [r.location for r in enriched.orderBy("i").collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == ["Texas, USA", "Bavaria, Germany", "Paris", "None", None, "Texas, USA"]


def test_places_of_any_number_with_the_default_threshold(spark):
    """A table whose file is small and whose rows are not; nothing is copied before it is sent."""
    places = spark.range(700_000).select(F.concat(F.lit("p"), "id").alias("place"), F.lit("c").alias("country"))
    df = spark.range(1000).select(F.concat(F.lit("p"), F.col("id") * 1000).alias("location"))
    got = extraction.enrich_location(df, places)
    assert got.filter(F.col("location").endswith(", c")).count() == 700
    assert got.count() == 1000


def test_requests(spark):
    got = extraction.build_requests(texts(spark), "Say: {text}!").orderBy("id").first()
    assert tuple(got) == ("1", "Say: Flood in Houston, Texas!")
    with pytest.raises(ValueError, match="slot"):
        extraction.request_text(F.lit("x"), "no place for it")


def test_model_answers(spark):
    def load():
        def answer(requests):
            if any("quake" in r for r in requests):
                raise TimeoutError("no answer")
            return [json.dumps({"location": "x", "disaster": "y"}) if "Flood" in r else "I do not know" for r in requests]

        return answer

    df = extraction.extract_fields(texts(spark, TEXTS[:4]).coalesce(1), extraction.model_extractor(load))
    assert result(df) == {"1": ("x", "y"), "2": (None, None), "3": (None, None), "4": (None, None)}
