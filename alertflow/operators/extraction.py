"""Location and event type of a positive text, from word lists, tables or a model."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alertflow.functions import text as txt
from alertflow.functions.codec import decode_extraction
from alertflow.operators.joins import KEY, LENGTH, POSITION, listed_phrases, listed_tokens, with_key
from alertflow.operators.messages import expand

# Fixed value: what an extractor answers when it finds nothing. Null means a malformed answer.
MISSING = "None"

# text column -> struct<location, disaster>
Extractor = Callable[[Column], Column]

REQUEST_TEMPLATE = (
    "Read the sentence and reply with one JSON object that has the keys location and disaster. "
    "location is where the event took place, as exact as the sentence allows, with the country "
    "added when only a state or province is given. disaster is the kind of event. "
    f'Use "{MISSING}" for whatever the sentence does not say.\nSentence: {{text}}'
)


@dataclass(frozen=True)
class DictionaryExtractor:
    """The first listed place and the first listed event type in the text."""

    places: tuple[str, ...]
    types: tuple[str, ...]

    def __call__(self, text: Column) -> Column:
        return F.struct(
            F.coalesce(txt.first_term(text, self.places), F.lit(MISSING)).alias("location"),
            F.coalesce(txt.first_term(text, self.types), F.lit(MISSING)).alias("disaster"),
        )


@dataclass(frozen=True)
class PhraseExtractor:
    """The first listed place and the first listed event type, each of one or more tokens; the longest one there."""

    places: tuple[str, ...]
    types: tuple[str, ...]

    def __call__(self, text: Column) -> Column:
        return F.struct(
            F.coalesce(txt.first_phrase(text, self.places), F.lit(MISSING)).alias("location"),
            F.coalesce(txt.first_phrase(text, self.types), F.lit(MISSING)).alias("disaster"),
        )


def model_extractor(
    load_model: Callable[[], Callable[[list[str]], Sequence[str]]],
    template: str = REQUEST_TEMPLATE,
    batch_size: int = 16,
) -> Extractor:
    """An extractor around any Python model that answers requests with JSON text.

    The model is loaded once per Python process and gets batches of requests. A request that
    raises has a null answer, which decodes like a malformed one.
    """

    def make_predict() -> Callable[[np.ndarray], np.ndarray]:
        answer = load_model()

        def one(request: str) -> str | None:
            try:
                return answer([request])[0]
            except Exception:
                return None

        def run(requests: np.ndarray) -> np.ndarray:
            try:
                answers = list(answer(list(requests)))
                if len(answers) != len(requests):
                    raise ValueError("the model returned another number of answers")
            except Exception:
                answers = [one(r) for r in requests]
            return np.array(answers, dtype=object)

        return run

    udf = predict_batch_udf(make_predict, return_type=T.StringType(), batch_size=batch_size)
    return lambda text: decode_extraction(udf(request_text(text, template)))


def request_text(text: Column, template: str = REQUEST_TEMPLATE) -> Column:
    before, marker, after = template.partition("{text}")
    if not marker:
        raise ValueError("the template has no {text} slot")
    return F.concat(F.lit(before), text, F.lit(after))


def build_requests(df: DataFrame, template: str = REQUEST_TEMPLATE, text: str = "text") -> DataFrame:
    """A table of requests for an offline model run."""
    return df.select("id", request_text(F.col(text), template).alias("request"))


# What became of a request.
ANSWERED, MALFORMED, REPEATED, UNANSWERED = "answered", "malformed", "repeated", "unanswered"


def request_key(request: Column) -> Column:
    return F.sha2(request, 256)


def request_table(df: DataFrame, template: str = REQUEST_TEMPLATE, text: str = "text") -> DataFrame:
    """``(request_key, request)``: each different request once, however many rows share it.

    Copies collapse where they are read, so a text that a third of the rows have is one row of the shuffle per task.
    Rows without a text ask nothing.
    """
    request = request_text(F.col(text), template)
    asked = df.select(request.alias("request")).filter(F.col("request").isNotNull())
    return asked.groupBy(request_key(F.col("request")).alias("request_key")).agg(F.first("request").alias("request"))


def unanswered(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """The requests that have no usable answer yet, to be asked again."""
    good = answer_table(answers).filter(F.col("answer_state") != MALFORMED)
    return requests.join(good.select("request_key"), "request_key", "left_anti")


def answer_table(answers: DataFrame) -> DataFrame:
    """``(request_key, location, disaster, answer_state)`` from ``answers(request_key, answer)``, one row per request.

    Answers may come more than once: equal ones, as a replay brings them, count once. Of different usable
    ones the smallest text is taken, whatever the order they came in, and the state says ``repeated``. A request with none that
    can be read is ``malformed``.
    """
    read = expand(answers.select("request_key", "answer"), decode_extraction(F.col("answer")))
    usable = F.col("location").isNotNull() | F.col("disaster").isNotNull()
    row = F.struct("answer", "location", "disaster")
    first = F.min(F.when(usable, row)).alias("first")
    per_request = read.groupBy("request_key").agg(first, F.max(F.when(usable, F.col("answer"))).alias("last"))
    state = F.when(F.col("first").isNull(), MALFORMED).when(F.col("first.answer") < F.col("last"), REPEATED).otherwise(ANSWERED)
    return per_request.select("request_key", "first.location", "first.disaster", state.alias("answer_state"))


def attach_answers(
    df: DataFrame,
    answers: DataFrame,
    template: str = REQUEST_TEMPLATE,
    text: str = "text",
) -> DataFrame:
    """Replace ``location`` and ``disaster`` by the answers of an offline run, and say in ``answer_state`` what became of them.

    ``answers(request_key, answer)`` answers a ``request_table`` made with the same template. Every row stays: one
    without an answer, or without a text, is ``unanswered``. The join meets one row per request, so a hot
    request makes a large partition on one side only, which adaptive execution splits.
    """
    df = df.drop("location", "disaster")
    keyed = df.withColumn("request_key", request_key(request_text(F.col(text), template)))
    joined = keyed.join(answer_table(answers), "request_key", "left")
    return joined.select(
        *df.columns, "location", "disaster", F.coalesce("answer_state", F.lit(UNANSWERED)).alias("answer_state")
    )


def extract_fields(df: DataFrame, extractor: Extractor, text: str = "text") -> DataFrame:
    """Replace ``location`` and ``disaster`` by what the extractor finds in the text."""
    return expand(df.drop("location", "disaster"), extractor(F.col(text)))


def extract_with_table(
    df: DataFrame,
    terms: DataFrame,
    text: str = "text",
    key: Sequence[str] | None = None,
) -> DataFrame:
    """``extract_fields`` with the word lists in a table ``terms(kind, term)`` of any size.

    ``kind`` is ``location`` or ``disaster``. ``key`` names columns that tell messages with
    different texts apart, such as an id; without it, a hash of the text does. Only key, token and
    place travel to the terms; copies collapse on the map side, the first places are joined back,
    one row per key, and become tokens there.
    """
    df = df.drop("location", "disaster")
    keyed = with_key(df, text, key)
    kinds = ("location", "disaster")
    first = [F.min(F.when(F.col("kind") == k, F.col(POSITION))).alias(f"_{k}") for k in kinds]
    words = txt.distinct_tokens(F.col(text))
    found = listed_tokens(keyed, terms.select("kind", "term"), words).groupBy(KEY).agg(*first)
    return keyed.join(found, KEY, "left").select(
        *df.columns, *[F.coalesce(F.get(words, F.col(f"_{k}")), F.lit(MISSING)).alias(k) for k in kinds]
    )


#: Longest phrase of a term table, in tokens.
LONGEST_PHRASE = 16


def extract_phrases(
    df: DataFrame,
    terms: DataFrame,
    text: str = "text",
    key: Sequence[str] | None = None,
) -> DataFrame:
    """``extract_with_table`` for terms of one to ``LONGEST_PHRASE`` tokens, with single spaces between them.

    Of the phrases of a kind the first in the text counts, and of those that begin there the longest. Every run of
    tokens of a length that the table has is looked up by one join on the whole run; the first of each kind is
    found with partial aggregation, so copies and hot phrases collapse before they are shuffled.
    """
    df = df.drop("location", "disaster")
    keyed = with_key(df, text, key)
    listed = terms.select("kind", "term")
    sizes = listed.select(F.size(F.split("term", " ")).alias("n")).distinct().orderBy("n")
    lengths = [row["n"] for row in sizes.limit(LONGEST_PHRASE + 1).collect()]
    if not lengths:
        return df.select(*df.columns, *[F.lit(MISSING).alias(k) for k in ("location", "disaster")])
    if lengths[-1] > LONGEST_PHRASE:
        raise ValueError(f"a term has {lengths[-1]} tokens, more than {LONGEST_PHRASE}")
    kinds = ("location", "disaster")
    found = listed_phrases(keyed, listed, txt.tokens(F.col(text)), lengths)
    place = F.struct(F.col(POSITION), (-F.col(LENGTH)).alias("less"), F.col("term"))
    first = found.groupBy(KEY).agg(*[F.min(F.when(F.col("kind") == k, place)).alias(f"_{k}") for k in kinds])
    return keyed.join(first, KEY, "left").select(
        *df.columns, *[F.coalesce(F.col(f"_{k}.term"), F.lit(MISSING)).alias(k) for k in kinds]
    )


def enrich_location(df: DataFrame, places: DataFrame, location: str = "location") -> DataFrame:
    """Append the country to a location that is only a known state or province.

    ``places`` has ``place`` and ``country``, one row per place, and any number of rows; locations
    it does not know stay as they are.
    """
    known = places.select(F.col("place").alias(location), F.col("country").alias("_country"))
    named = F.when(F.col(location).isNotNull(), F.concat_ws(", ", location, "_country"))
    return df.join(known, location, "left").select(
        *[named.alias(c) if c == location else F.col(c) for c in df.columns]
    )
