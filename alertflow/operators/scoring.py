"""Text classification as a column: word-list default, pluggable batch models."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertflow.functions import text as txt
from alertflow.functions.binding import let
from alertflow.functions.codec import BLANK_PACKED, pack_score
from alertflow.functions.probability import top_class
from alertflow.operators.joins import KEY, POSITION, listed_tokens, with_key
from alertflow.operators.messages import expand
from alertflow.schemas import MODEL_SCORE

# text column -> struct<prediction, confidence, ok>
Scorer = Callable[[Column], Column]
# list of texts -> (classes, confidences)
Predict = Callable[[list[str]], tuple[Sequence[int], Sequence[float]]]


@dataclass(frozen=True)
class LexiconScorer:
    """Two-class score from the number of listed words: logits [0, weight * hits + bias]."""

    terms: tuple[str, ...]
    weight: float = 0.5
    bias: float = -1.0

    def logits(self, text: Column) -> Column:
        return hit_logits(txt.count_terms(text, self.terms), self.weight, self.bias)

    def __call__(self, text: Column) -> Column:
        return score_struct(top_class(self.logits(text)))


def hit_logits(hits: Column, weight: float, bias: float) -> Column:
    return F.array(F.lit(0.0), hits * F.lit(weight) + F.lit(bias))


def score_struct(top: Column) -> Column:
    """A class/probability struct as a score: confidence at four places, marked as computed."""

    def score(t: Column) -> Column:
        return F.struct(
            t["prediction"].alias("prediction"),
            F.round(t["confidence"], 4).alias("confidence"),
            F.lit(True).alias("ok"),
        )

    return let(top, score)


def _predict_rows(predict: Predict, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score one batch; if it fails, score its rows one by one so that only bad rows lose out."""
    n = len(texts)
    try:
        classes, confidences = predict(texts)
        if len(classes) != n or len(confidences) != n:
            raise ValueError("the model returned another number of rows")
        return np.asarray(classes, "int32"), np.asarray(confidences, "float64"), np.ones(n, "bool")
    except Exception:
        if n == 1:
            return np.zeros(1, "int32"), np.zeros(1), np.zeros(1, "bool")
        rows = [_predict_rows(predict, [t]) for t in texts]
        return tuple(np.concatenate(part) for part in zip(*rows))


def model_scorer(load_model: Callable[[], Predict], batch_size: int = 64) -> Scorer:
    """A scorer around any Python model.

    ``load_model`` runs in the worker, once per Python process, and the model gets Arrow
    batches of texts. Blank texts arrive as null and are never sent to it. A row whose
    prediction raises scores (0, 0.0) with ``ok`` false, so failures can be counted.
    """

    def make_predict() -> Callable[[np.ndarray], dict[str, np.ndarray]]:
        predict = load_model()

        def run(texts: np.ndarray) -> dict[str, np.ndarray]:
            n = len(texts)
            prediction, confidence = np.zeros(n, "int32"), np.zeros(n)
            ok = np.ones(n, "int32")
            sent = [i for i, t in enumerate(texts) if t is not None]
            if sent:
                prediction[sent], confidence[sent], ok[sent] = _predict_rows(predict, [texts[i] for i in sent])
            return {"prediction": prediction, "confidence": confidence, "ok": ok}

        return run

    udf = predict_batch_udf(make_predict, return_type=MODEL_SCORE, batch_size=batch_size)

    def scored(answer: Column) -> Column:
        return F.struct(
            answer["prediction"].alias("prediction"),
            F.round(answer["confidence"], 4).alias("confidence"),
            (answer["ok"] == 1).alias("ok"),
        )

    return lambda text: let(udf(F.when(~txt.is_blank(text), text)), scored)


def transformer_model(model_dir: str, batch_size: int = 64, device: int = -1) -> Callable[[], Predict]:
    """Loader for a fine-tuned sequence classifier, for ``model_scorer``.

    Needs the ``transformers`` package (and ``peft`` for adapter folders) on the workers.
    """

    def load() -> Predict:
        try:
            import transformers
        except ImportError as missing:
            raise ImportError("transformer_model needs the transformers package on every worker") from missing
        classify = transformers.pipeline(
            "text-classification",
            model=model_dir,
            tokenizer=model_dir,
            device=device,
            batch_size=batch_size,
            truncation=True,
            max_length=txt.MAX_TOKENS,
        )
        class_of = classify.model.config.label2id

        def predict(texts: list[str]) -> tuple[list[int], list[float]]:
            answers = classify(texts)
            return [class_of[a["label"]] for a in answers], [a["score"] for a in answers]

        return predict

    return load


def blank_guard(text: Column, score: Column) -> Column:
    """Blank texts score (0, 0.0) whatever the scorer says."""
    blank = F.struct(
        F.lit(0).alias("prediction"),
        F.lit(0.0).alias("confidence"),
        F.lit(True).alias("ok"),
    )
    return F.when(txt.is_blank(text), blank).otherwise(score)


def score_text(df: DataFrame, scorer: Scorer, text: str = "text") -> DataFrame:
    """Add ``prediction``, ``confidence`` and ``ok``; one pass over the texts, no shuffle."""
    return expand(df, blank_guard(F.col(text), scorer(F.col(text))))


def score_with_table(
    df: DataFrame,
    terms: DataFrame,
    weight: float = 0.5,
    bias: float = -1.0,
    text: str = "text",
    key: Sequence[str] | None = None,
) -> DataFrame:
    """``score_text`` by a word list in a table ``terms(term)`` of any size.

    ``key`` names columns that tell messages with different texts apart; without it, a hash of the
    text does. Copies of a message have one key and count their listed tokens once, by place.
    """
    keyed = with_key(df, text, key)
    words = F.split(F.lower(F.col(text)), txt.TOKEN_BREAK)
    hits = listed_tokens(keyed, terms.select("term"), words).groupBy(KEY).agg(F.count_distinct(POSITION).alias("_hits"))
    logits = hit_logits(F.coalesce("_hits", F.lit(0)), weight, bias)
    scored = blank_guard(F.col(text), score_struct(top_class(logits)))
    return expand(keyed.join(hits, KEY, "left"), scored).drop(KEY, "_hits")


def packed_scores(scored: DataFrame, text: str = "text") -> DataFrame:
    """Replace the score columns by the packed ``prediction_result`` text."""
    packed = F.when(txt.is_blank(F.col(text)), BLANK_PACKED).otherwise(
        pack_score(F.col("prediction"), F.col("confidence"))
    )
    return scored.withColumn("prediction_result", packed).drop("prediction", "confidence", "ok")
