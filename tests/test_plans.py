import re

from conftest import plan_of
from pyspark.sql import functions as F

from alertflow.operators import extraction, reports, scoring
from alertflow.plans import catalog, settings
from alertflow.plans.alerts import alerts


def model():
    return lambda texts: ([1] * len(texts), [0.9] * len(texts))


def test_alerts_need_no_shuffle_and_parse_and_score_once(spark, sf_dir):
    plan = plan_of(catalog.main_alerts(spark, sf_dir))
    assert "Exchange" not in plan
    assert plan.count("from_json(") == 1
    assert plan.count("regexp_extract_all(") == 1
    assert plan.count("invoke(StructsToJsonEvaluator") == 1
    parsed = re.search(r"from_json\((.*?)cast\(", plan).group(1)
    assert "text" in parsed and "id" in parsed
    assert "keyword" not in parsed and "location" not in parsed


def test_models_run_once_and_the_extractor_sees_positives_only(spark, sf_dir):
    scorer = scoring.model_scorer(model)
    extractor = extraction.model_extractor(lambda: lambda requests: ["{}"] * len(requests))
    plan = plan_of(alerts(catalog.envelopes(spark, sf_dir), scorer, extractor))
    assert plan.count("ArrowEvalPython") == 2
    extract, keep, score = (
        plan.index("ArrowEvalPython"), plan.index("prediction#"), plan.rindex("ArrowEvalPython")
    )
    filter_at = re.search(r"Filter \(isnotnull\(prediction#\d+\) AND \(prediction#\d+ = 1\)\)", plan).start()
    assert extract < filter_at < score and keep < score


def test_the_model_is_not_called_for_the_scan_of_other_columns(spark, sf_dir):
    df = scoring.score_text(catalog.feed(spark, sf_dir), scoring.model_scorer(model)).select("id", "prediction")
    assert re.search(r"ReadSchema: struct<doc_id:bigint,text:string>", plan_of(df))


def test_wide_rows_do_not_travel_with_the_tokens(spark, sf_dir):
    terms = spark.createDataFrame([("location", "orre")], "kind string, term string")
    plan = plan_of(extraction.extract_with_table(catalog.feed(spark, sf_dir), terms))
    carried = re.search(r"Generate posexplode\(array_distinct\(.*?\)\), \[(_key.*?)\]", plan).group(1)
    assert re.fullmatch(r"_key#\d+", carried)
    assert "partial_min(" in plan and "SortAggregate" not in plan


def test_a_list_of_any_length_needs_no_shuffle(spark, sf_dir):
    words = tuple(f"w{i}" for i in range(100_000)) + settings.LEXICON
    extractor = extraction.DictionaryExtractor(words, settings.TYPES)
    found = alerts(catalog.envelopes(spark, sf_dir), scoring.LexiconScorer(words), extractor)
    assert "Exchange" not in plan_of(found)
    same = {r.id: r.disaster for r in catalog.main_alerts(spark, sf_dir).collect()}
    assert {r.id: r.disaster for r in found.collect()} == same


def test_counts_combine_before_the_shuffle(spark, sf_dir):
    scored = catalog.scored_feed(spark, sf_dir)
    for df in (reports.positive_count(scored), reports.batch_metrics(scored)):
        assert "partial_count" in plan_of(df)
    events = catalog.table(spark, sf_dir, "events")
    plan = plan_of(reports.type_by_window(events, settings.WINDOW, "ts", "event_type", "value"))
    assert "partial_sum" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan


def test_by_type_reads_one_folder(spark, sf_dir):
    plan = plan_of(catalog.by_type(spark, sf_dir))
    assert "type_folder" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_look_ups_are_broadcast_by_size_only(spark, sf_dir):
    places = spark.createDataFrame([("a", "b")], "place string, country string")
    df = spark.range(10).select(F.col("id").cast("string").alias("location"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(extraction.enrich_location(df, places))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert "ExpandExec" not in plan and "explode" not in plan


def test_look_ups_read_only_the_columns_in_use(spark, sf_dir, tmp_path):
    places = spark.createDataFrame([("en", "b")], "place string, country string")
    df = extraction.enrich_location(catalog.feed(spark, sf_dir), places).select("id", "location")
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan_of(df)


def test_equal_rows_of_one_key_are_split_at_run_time(spark):
    """One place on nearly all rows, which have no other column."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        n = F.when(F.col("id") < 1000, F.col("id")).otherwise(0)
        df = spark.range(0, 200_000, 1, 16).select(F.concat(F.lit("p"), n).alias("location"))
        places = spark.range(1000).select(F.concat(F.lit("p"), "id").alias("place"), F.lit("c").alias("country"))
        found = extraction.enrich_location(df, places)
        assert len(found.collect()) == 200_000
        assert "SortMergeJoin(skew=true)" in plan_of(found)
    finally:
        for name in small:
            spark.conf.unset(name)
