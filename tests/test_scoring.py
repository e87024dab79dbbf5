import sys
import types

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from alertflow.functions import codec
from alertflow.operators import messages, reports, scoring

SAMPLE = [
    ("1", "the earthquake woke the whole street"),
    ("2", "tea with the neighbours"),
    ("3", "FLOOD at the lower bridge"),
    ("4", "new shoes and old songs"),
    ("5", "a wildfire behind the ridge road"),
]

LEXICON = scoring.LexiconScorer(("earthquake", "flood", "wildfire"), weight=4.0)


def sample(spark, rows=SAMPLE):
    return spark.createDataFrame(rows, "id string, text string")


def test_in_memory_rows_through_the_word_list(spark):
    scored = scoring.score_text(sample(spark), LEXICON)
    found = messages.positives(scored)
    assert not found.isEmpty()
    assert sorted(r.id for r in found.collect()) == ["1", "3", "5"]
    assert {r.confidence for r in found.collect()} == {0.9526}
    assert reports.positive_count(scored).collect()[0].n_positive == 3


@pytest.mark.parametrize("key", [None, ["id"]])
def test_a_word_table_agrees_with_the_word_list(spark, key):
    rows = [*SAMPLE, ("6", "flood, flood and Wildfire"), ("6", "flood, flood and Wildfire"), ("7", " "), ("8", None)]
    df = sample(spark, rows)
    terms = spark.createDataFrame([(t,) for t in (*LEXICON.terms, "flood")], "term string")
    by_table = scoring.score_with_table(df, terms, LEXICON.weight, LEXICON.bias, key=key)
    by_list = scoring.score_text(df, LEXICON)
    assert by_table.columns == by_list.columns
    assert sorted(map(str, by_table.collect())) == sorted(map(str, by_list.collect()))


def test_blank_texts_score_zero(spark):
    rows = [("a", None), ("b", ""), ("c", " 　\n"), ("d", "flood")]
    got = {r.id: (r.prediction, r.confidence, r.ok) for r in scoring.score_text(sample(spark, rows), LEXICON).collect()}
    assert got == {"a": (0, 0.0, True), "b": (0, 0.0, True), "c": (0, 0.0, True), "d": (1, 0.9526, True)}


def test_model_failures_and_blanks(spark):
    def load():
        def predict(texts):
            assert all(t is not None and t.strip() for t in texts), "a blank text was sent"
            if any("bad" in t for t in texts):
                raise RuntimeError("cannot read this")
            return [1] * len(texts), [0.98765] * len(texts)

        return predict

    rows = [("a", "fine"), ("b", "bad"), ("c", " "), ("d", None), ("e", "also fine")]
    df = sample(spark, rows).coalesce(1)
    scored = scoring.score_text(df, scoring.model_scorer(load))
    got = {r.id: (r.prediction, r.confidence, r.ok) for r in scored.collect()}
    assert got == {
        "a": (1, 0.9877, True),
        "b": (0, 0.0, False),
        "c": (0, 0.0, True),
        "d": (0, 0.0, True),
        "e": (1, 0.9877, True),
    }
    assert reports.batch_metrics(scored).collect()[0].asDict() == {
        "n_rows": 5, "n_blank": 2, "n_positive": 2, "n_failed": 1,
    }


def test_model_that_loses_rows_is_a_failure(spark):
    scored = scoring.score_text(sample(spark), scoring.model_scorer(lambda: lambda texts: ([], [])))
    assert {(r.prediction, r.confidence, r.ok) for r in scored.collect()} == {(0, 0.0, False)}


def test_model_is_loaded_once_per_process(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        import os
        import uuid

        open(f"{folder}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()
        return lambda texts: ([1] * len(texts), [0.5] * len(texts))

    df = spark.range(4000).select(F.col("id").cast("string"), F.lit("x").alias("text")).repartition(16)
    scored = scoring.score_text(df, scoring.model_scorer(load, batch_size=16))
    assert messages.positives(scored).count() == 4000
    loads = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert len(loads) == len(set(loads))


def test_transformer_model(monkeypatch):
    calls = {}

    def pipeline(task, **options):
        calls.update(options, task=task)

        def classify(texts):
            return [{"label": "LABEL_1" if "fire" in t else "LABEL_0", "score": 0.75} for t in texts]

        classify.model = types.SimpleNamespace(config=types.SimpleNamespace(label2id={"LABEL_0": 0, "LABEL_1": 1}))
        return classify

    monkeypatch.setitem(sys.modules, "transformers", types.SimpleNamespace(pipeline=pipeline))
    predict = scoring.transformer_model("folder")()
    assert predict(["fire", "park"]) == ([1, 0], [0.75, 0.75])
    assert calls["model"] == calls["tokenizer"] == "folder"
    assert (calls["truncation"], calls["max_length"]) == (True, 512)
    monkeypatch.setitem(sys.modules, "transformers", None)
    with pytest.raises(ImportError, match="every worker"):
        scoring.transformer_model("folder")()


def test_packed_scores(spark):
    rows = [("1", "flood"), ("2", "park"), ("3", " ")]
    packed = scoring.packed_scores(scoring.score_text(sample(spark, rows), LEXICON))
    assert packed.columns == ["id", "text", "prediction_result"]
    assert {r.id: r.prediction_result for r in packed.collect()} == {"1": "1,0.9526", "2": "0,0.7311", "3": "0,0.0"}


def test_unpacking_odd_scores(spark):
    values = ["1,0.9567", "0,0.0", "x,0.5", "1", "", None, "1,2,3"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = messages.expand(df, codec.unpack_score(F.col("v"))).orderBy("i").collect()
    assert [(r.prediction, r.confidence) for r in got] == [
        (1, 0.9567), (0, 0.0), (None, 0.5), (1, None), (None, None), (None, None), (1, 2.0),
    ]


def test_counters_ride_along(spark):
    seen = Observation("scores")
    reports.observed(scoring.score_text(sample(spark), LEXICON), seen).collect()
    assert seen.get == {"n_rows": 5, "n_blank": 0, "n_positive": 3, "n_failed": 0}
