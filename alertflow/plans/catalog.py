"""The registered queries: every step of the library over the given tables."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertflow.functions import codec, probability
from alertflow.functions import text as txt
from alertflow.functions.times import as_moment, utc_time
from alertflow.operators import extraction, messages, reports, scoring, storage
from alertflow.plans import settings as st
from alertflow.plans.alerts import alerts as find_alerts
from alertflow.plans.alerts import failed_rows as failures
from alertflow.plans.alerts import routed, scored_messages
from alertflow.schemas import ALERT, ALERT_MESSAGE, MESSAGE
from alertflow.sinks import clustered, stores
from alertflow.sources import csv_feed, csv_ranges, news_feed, store, topics
from alertflow.streaming import jobs, windows
from alertflow.streaming.scratch import new_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


# Inputs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream; a brace pattern takes one file as well as a folder of files."""
    return topics.stream_files(spark, f"{sf_dir}/{{{name}}}.parquet", table(spark, sf_dir, name).schema)


def as_feed(documents: DataFrame) -> DataFrame:
    """The documents table as a feed of messages."""
    sent = F.timestamp_add(
        "SECOND",
        F.col("doc_id") * st.FEED_STEP_SECONDS,
        utc_time(st.FEED_START),
    )
    return documents.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("source").alias("keyword"),
        F.col("lang").alias("location"),
        "text",
        sent.alias("kafka_timestamp"),
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_feed(table(spark, sf_dir, "documents"))


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.encode_messages(feed(spark, sf_dir))


def stream_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.encode_messages(as_feed(stream_table(spark, sf_dir, "documents")))


def scored_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_text(feed(spark, sf_dir), st.SCORER)


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text between any two tags of a page, as a feed of short texts; many are empty."""
    parts = F.posexplode(F.split("html", "<[^>]*>")).alias("pos", "text")
    return table(spark, sf_dir, "pages").select("page_id", parts).select(
        F.concat_ws("-", "page_id", "pos").alias("id"), "text"
    )


def main_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_alerts(envelopes(spark, sf_dir), st.SCORER, st.EXTRACTOR)


def timed(rows: DataFrame) -> DataFrame:
    """Processing times that do not depend on the clock: the end of the message's minute."""
    minute = F.date_trunc("minute", "kafka_timestamp") + F.expr("INTERVAL 1 MINUTE")
    return rows.withColumn("processing_timestamp", minute.cast("timestamp_ntz"))


def shown(stored: DataFrame) -> DataFrame:
    """Stored rows without the clock column, decimals as doubles."""
    return stored.drop("created_at", "event_day", "type_folder").withColumn("confidence", F.col("confidence").cast("double"))


_stores: dict[tuple[str, str, bool], str] = {}


def write_alert_store(spark: SparkSession, sf_dir: str, by_type: bool = False) -> str:
    """Write the alerts of this table folder to a new store, which the reports of the session then share."""
    path = new_folder(spark, "store")
    rows = storage.storage_rows(storage.checked(timed(main_alerts(spark, sf_dir))))
    stores.write_store(rows, "files", path=path, by_type=by_type)
    _stores[spark.sparkContext.applicationId, sf_dir, by_type] = path
    return path


def stored_alerts(spark: SparkSession, sf_dir: str, by_type: bool = False) -> DataFrame:
    """The last store written in this session, or a first one."""
    path = _stores.get((spark.sparkContext.applicationId, sf_dir, by_type))
    path = path or write_alert_store(spark, sf_dir, by_type)
    return store.read_store(spark, "files", path=path, by_type=by_type)


# Sources


@registered
def csv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "csv")
    rows = feed(spark, sf_dir).select(*MESSAGE.names)
    whole = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rows.write.options(header="true", escape='"', **whole).csv(path)
    return csv_feed.read_csv(spark, path)


@contextmanager
def split_at(spark: SparkSession, size: str) -> Iterator[None]:
    """Read files in ranges of this size."""
    before = spark.conf.get(_RANGE_SIZE)
    spark.conf.set(_RANGE_SIZE, size)
    try:
        yield
    finally:
        spark.conf.set(_RANGE_SIZE, before)


_RANGE_SIZE = "spark.sql.files.maxPartitionBytes"


@registered
def csv_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files with line breaks inside quotes, each read in many ranges; a small table makes one, a large one as many as Spark reads it in."""
    path, read = new_folder(spark, "csv"), new_folder(spark, "rows")
    rows = feed(spark, sf_dir).select(*MESSAGE.names)
    whole = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rows.write.options(header="true", escape='"', **whole).csv(path)
    # The setting counts when the plan runs, so it runs here. Ranges are small enough to make many of the smallest table.
    with split_at(spark, "256k"):
        csv_ranges.read_csv_ranges(spark, path).write.parquet(read)
    return spark.read.parquet(read)


@registered
def kafka_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelopes(spark, sf_dir).select(F.col("value").cast("string").alias("value"), "timestamp")


@registered
def feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("kafka_timestamp", "yyyy-MM-dd").alias("published_date")
    items = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(txt.preview(line).alias("title"), day, line.alias("abstract")),
    )
    payloads = feed(spark, sf_dir).select("id", F.to_json(F.struct(items.alias("results"))).alias("payload"))
    return news_feed.feed_items(payloads)


# Message encode and decode


@registered
def encode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feed(spark, sf_dir)
    return rows.select("id", codec.encode_message(*MESSAGE.names).alias("value")).select(
        "id", F.octet_length("value").alias("n_bytes"), F.col("value").cast("string").alias("message")
    )


@registered
def parse_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.parse_messages(envelopes(spark, sf_dir))


@registered
def parse_messages_explicit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.parse_messages_explicit(envelopes(spark, sf_dir))


@registered
def decode_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that are JSON where a type was found and plain prose, so malformed, elsewhere."""
    found = extraction.extract_fields(feed(spark, sf_dir), st.EXTRACTOR)
    answer = F.to_json(F.struct("location", "disaster"))
    response = F.when(F.col("disaster") != extraction.MISSING, answer).otherwise(F.col("text"))
    return messages.expand(found.select("id", response.alias("response")), codec.decode_extraction(F.col("response")))


@registered
def pack_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.packed_scores(scoring.score_text(segments(spark, sf_dir), st.SCORER))


@registered
def unpack_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = scoring.packed_scores(scored_feed(spark, sf_dir)).select("id", "prediction_result")
    return messages.expand(packed, codec.unpack_score(F.col("prediction_result"))).drop("prediction_result")


# Projections and filters


@registered
def nonempty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.nonempty_text(segments(spark, sf_dir))


@registered
def positives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.positives(scored_messages(envelopes(spark, sf_dir), st.SCORER)).drop("ok")


@registered
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_alerts(spark, sf_dir)


def storage_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as an alert; long first lines and large sizes do not fit the store."""
    rows = feed(spark, sf_dir).select(
        "id",
        "text",
        F.col("keyword").alias("disaster"),
        F.substring_index("text", "\n", 1).alias("location"),
        (F.length("text") / F.lit(1000.0)).alias("confidence"),
        "kafka_timestamp",
    )
    return storage.checked(timed(rows))


@registered
def storage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(storage.storage_rows(storage_candidates(spark, sf_dir)))


@registered
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return storage.quarantine_rows(storage_candidates(spark, sf_dir))


@registered
def processed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.processed_rows(scored_feed(spark, sf_dir))


@registered
def preview_ellipsis(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return segments(spark, sf_dir).select("id", txt.preview_ellipsis(text).alias("text_preview"))


@registered
def surrogate_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return storage.surrogate_id(feed(spark, sf_dir)).select("row_key", "id", "kafka_timestamp")


# Scoring and extraction


@registered
def score_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_feed(spark, sf_dir).select("id", "prediction", "confidence")


def python_lexicon() -> scoring.Predict:
    """The word-list score as a Python model, to run through the batch path."""
    words, weight, bias = set(st.LEXICON), st.SCORER.weight, st.SCORER.bias
    token = re.compile("[a-z0-9]+")

    def predict(texts: list[str]) -> tuple[list[int], list[float]]:
        import numpy as np

        hits = np.array([sum(t in words for t in token.findall(x.lower())) for x in texts])
        logit = hits * weight + bias
        return list((logit > 0).astype(int)), list(1.0 / (1.0 + np.exp(-np.abs(logit))))

    return predict


@registered
def score_with_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scorer = scoring.model_scorer(python_lexicon)
    return scoring.score_text(feed(spark, sf_dir), scorer).select("id", "prediction", "confidence", "ok")


def two_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of the two halves of each vector, as the logits of two classes."""
    half = F.size("embedding") / 2
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    total = lambda part: F.aggregate(part, F.lit(0.0), lambda acc, x: acc + x)
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", doubles.alias("v"), half.cast("int").alias("half"))
    first = F.slice("v", F.lit(1), F.col("half"))
    second = F.slice("v", F.col("half") + 1, F.col("half"))
    return vectors.select("vec_id", F.array(total(first), total(second)).alias("logits"))


@registered
def softmax_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = two_logits(spark, sf_dir).select("vec_id", probability.softmax(F.col("logits")).alias("p"))
    return scores.select(
        "vec_id",
        F.round(F.get("p", F.lit(0)), 4).alias("p_negative"),
        F.round(F.get("p", F.lit(1)), 4).alias("p_positive"),
    )


@registered
def embedding_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = scoring.score_struct(probability.top_class(F.col("logits")))
    return messages.expand(two_logits(spark, sf_dir), top).select("vec_id", "prediction", "confidence")


@registered
def blank_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scoring.score_text(segments(spark, sf_dir), st.SCORER)
    return scored.select("id", txt.is_blank(F.col("text")).alias("blank"), "prediction", "confidence")


@registered
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed(spark, sf_dir).select("id", txt.normalize(F.col("text")).alias("normalized"))


@registered
def truncate_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = feed(spark, sf_dir).select("id", F.explode(F.array(txt.tokens(F.col("text")))).alias("t"))
    return words.select(
        "id",
        F.size("t").alias("n_tokens"),
        F.array_join(txt.first_tokens(F.col("t")), " ").alias("kept"),
        (F.size("t") > txt.MAX_TOKENS).alias("was_truncated"),
    )


@registered
def extract_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extraction.extract_fields(feed(spark, sf_dir), st.EXTRACTOR)
    return found.select("id", "location", "disaster")


def benchmark_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.explode(txt.tokens(F.col("text"))).alias("term"))


@registered
def extract_with_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.length("term") >= st.TYPE_LENGTH, "disaster").otherwise("location")
    terms = benchmark_words(spark, sf_dir).select(kind.alias("kind"), "term")
    found = extraction.extract_with_table(feed(spark, sf_dir), terms, key=["id"])
    return found.select("id", "location", "disaster")


@registered
def extract_phrase_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extraction.extract_fields(feed(spark, sf_dir), st.PHRASES)
    return found.select("id", "location", "disaster")


@registered
def extract_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first pair of words as a place, and of three words as a type, that some benchmark text has too; long single words are types as well."""
    words = table(spark, sf_dir, "benchmark").select(txt.tokens(F.col("text")).alias("t"))
    runs = words.select(F.explode(F.sequence(F.lit(1), F.size("t"))).alias("i"), F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("n"), "t")
    terms = runs.filter((F.col("i") + F.col("n") - 1 <= F.size("t"))).select(
        "n", F.array_join(F.slice("t", F.col("i"), F.col("n")), " ").alias("term")
    )
    terms = terms.filter((F.col("n") > 1) | (F.length("term") >= st.TYPE_LENGTH))
    kind = F.when(F.col("n") == 2, "location").otherwise("disaster")
    found = extraction.extract_phrases(feed(spark, sf_dir), terms.select(kind.alias("kind"), "term"), key=["id"])
    return found.select("id", "location", "disaster")


@registered
def score_with_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = benchmark_words(spark, sf_dir)
    scored = scoring.score_with_table(feed(spark, sf_dir), terms, st.TABLE_WEIGHT, st.TABLE_BIAS, key=["id"])
    return scored.select("id", "prediction", "confidence", "ok")


def python_extractor() -> Callable[[list[str]], list[str]]:
    """The word-list extraction as a Python model that answers requests with JSON."""
    token = re.compile("[a-z0-9]+")

    def one(request: str) -> str:
        words = token.findall(request.partition("\nSentence: ")[2].lower())
        first = lambda listed: next((w for w in words if w in listed), extraction.MISSING)
        return json.dumps({"location": first(st.PLACES), "disaster": first(st.TYPES)})

    return lambda requests: [one(r) for r in requests]


@registered
def extract_with_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    extractor = extraction.model_extractor(python_extractor, st.REQUEST)
    return find_alerts(envelopes(spark, sf_dir), st.SCORER, extractor).select("id", "location", "disaster")


@registered
def enrich_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = (table(spark, sf_dir, t) for t in ("nation", "region"))
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_name").alias("place"), F.col("r_name").alias("country")
    )
    where = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    rows = where.select(F.col("c_custkey").alias("id"), F.col("n_name").alias("location"))
    return extraction.enrich_location(rows, places)


@registered
def build_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.build_requests(messages.positives(scored_feed(spark, sf_dir)))


def asked_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short texts, many of which stand on many pages."""
    return messages.nonempty_text(segments(spark, sf_dir))


@registered
def request_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.request_table(asked_segments(spark, sf_dir), st.REQUEST)


@registered
def attach_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of a run that left some requests out, answered some in prose and some twice, and came a second time."""
    asked = asked_segments(spark, sf_dir)
    requests = extraction.request_table(asked, st.REQUEST)
    digit = F.substring("request_key", 1, 1)
    words = F.split_part("request", F.lit(" "), F.lit(-1))
    good = F.to_json(F.struct(words.alias("location"), digit.alias("disaster")))
    answer = F.when(digit.isin("2", "3"), F.col("request")).otherwise(good)
    answers = requests.filter(~digit.isin("0", "1")).select("request_key", answer.alias("answer"))
    other = requests.filter(digit.isin("3", "4")).select("request_key", F.lit('{"location":"aside"}').alias("answer"))
    return extraction.attach_answers(asked, answers.unionByName(other).unionByName(answers), st.REQUEST)


def half_read_model() -> scoring.Predict:
    """The word-list model, which cannot read texts with an at sign."""
    predict = python_lexicon()

    def careful(texts: list[str]) -> tuple[list[int], list[float]]:
        if any("@" in t for t in texts):
            raise ValueError("an address in the text")
        return predict(texts)

    return careful


def mixed_envelopes(rows: DataFrame) -> DataFrame:
    """Envelopes of a feed that sends texts with line breaks as they are, without JSON around them."""
    value = F.when(F.col("text").contains("\n"), F.col("text").cast("binary")).otherwise(
        codec.encode_message(*MESSAGE.names)
    )
    return rows.select(value.alias("value"), F.col("kafka_timestamp").alias("timestamp"))


@registered
def failed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failures(mixed_envelopes(feed(spark, sf_dir)), scoring.model_scorer(half_read_model))


@registered
def routed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts and dead letters in one pass over the feed, and how many messages were neither."""
    rows = routed(mixed_envelopes(feed(spark, sf_dir)), scoring.model_scorer(half_read_model), st.EXTRACTOR)
    return rows.groupBy("kind", "id", "disaster", "location", "confidence", "payload").agg(F.count(F.lit(1)).alias("n"))


@registered
def running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a stream of several micro-batches that is started again when it has ended."""
    path, checkpoint = new_folder(spark, "routed"), new_folder(spark, "checkpoint")
    sent = mixed_envelopes(as_feed(shuffled_stream(spark, sf_dir, "documents")))
    rows = routed(sent, scoring.model_scorer(half_read_model), st.EXTRACTOR)
    for _ in range(2):
        jobs.wait(*jobs.start_routed(rows, path, checkpoint, [], every=None))
    return jobs.running_totals(spark, path)


# Counts


@registered
def positive_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.positive_count(scored_feed(spark, sf_dir))


@registered
def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.batch_metrics(scoring.score_text(segments(spark, sf_dir), st.SCORER))


# Stores and the reports over them


@registered
def store_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_alert_store(spark, sf_dir)
    return shown(store.read_store(spark, "files", path=path))


def stored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "documents")
    stores.write_store(timed(main_alerts(spark, sf_dir)), "json", path=path)
    return store.read_documents(spark, path)


@registered
def document_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_documents(spark, sf_dir).drop("processing_day")


@registered
def document_roundtrip_zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents from messages whose times are moments, as a topic gives them."""
    path = new_folder(spark, "documents")
    sent = as_moment(envelopes(spark, sf_dir), "timestamp")
    stores.write_store(timed(find_alerts(sent, st.SCORER, st.EXTRACTOR)), "json", path=path)
    return store.read_store(spark, "json", path=path).drop("processing_day")


@registered
def latest_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = reports.latest_predictions(stored_alerts(spark, sf_dir), st.REPORT_ROWS)
    return latest.withColumn("confidence", F.col("confidence").cast("double"))


@registered
def latest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.latest_documents(stored_documents(spark, sf_dir), st.REPORT_ROWS)


@registered
def by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(reports.by_type(stored_alerts(spark, sf_dir, by_type=True), st.ONE_TYPE))


@registered
def by_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(reports.by_location(stored_alerts(spark, sf_dir), st.ONE_PLACE))


@registered
def confident(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(reports.confident(stored_alerts(spark, sf_dir), 0.95))


@registered
def top_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = reports.top_confidence(stored_alerts(spark, sf_dir), st.REPORT_ROWS)
    return top.withColumn("confidence", F.col("confidence").cast("double"))


@registered
def time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(reports.time_range(stored_alerts(spark, sf_dir), *st.RANGE))


@registered
def clustered_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three look-ups in one store, each of which opens only the files it needs."""
    path = new_folder(spark, "store")
    rows = storage.storage_rows(storage.checked(timed(main_alerts(spark, sf_dir))))
    clustered.write_clustered(rows, path, rows_per_file=st.ROWS_PER_FILE)
    asked = {
        "type": {"wanted": {"disaster_type": st.ONE_TYPE}},
        "place": {"wanted": {"location": st.ONE_PLACE}},
        "confident": {"at_least": {"confidence": 0.95}},
    }
    parts = [shown(clustered.read_clustered(spark, path, **a)).withColumn("asked", F.lit(name)) for name, a in asked.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@registered
def type_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return reports.type_by_window(events, st.WINDOW, "ts", "event_type", "value")


@registered
def alert_type_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.type_by_window(stored_alerts(spark, sf_dir), st.WINDOW)


# Streams


@registered
def stream_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed messages into JSON files, by a stream that is started twice on one checkpoint."""
    path, checkpoint = new_folder(spark, "parsed"), new_folder(spark, "checkpoint")
    parsed = messages.parse_messages_explicit(stream_envelopes(spark, sf_dir))
    for _ in range(2):
        jobs.wait(jobs.start_files(parsed, path, checkpoint, every=None))
    return spark.read.schema(parsed.schema).json(path)


def streamed_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_alerts(stream_envelopes(spark, sf_dir), st.SCORER, st.EXTRACTOR)


@registered
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, checkpoint = new_folder(spark, "alerts"), new_folder(spark, "checkpoint")
    jobs.wait(jobs.start_files(streamed_alerts(spark, sf_dir), path, checkpoint, every=None))
    return spark.read.schema(ALERT).json(path)


@registered
def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts scored once and served to two sinks: JSON documents and stored files."""
    documents, stored = new_folder(spark, "sink"), new_folder(spark, "sink")

    def as_documents(rows: DataFrame):
        return jobs.start_files(rows, documents, new_folder(spark, "checkpoint"), every=None)

    def as_stored(rows: DataFrame):
        return jobs.start_store(timed(rows), stored, new_folder(spark, "checkpoint"), every=None)

    for query in jobs.start_fan_out(
        streamed_alerts(spark, sf_dir),
        new_folder(spark, "alerts"),
        new_folder(spark, "checkpoint"),
        [as_documents, as_stored],
        every=None,
    ):
        jobs.wait(query)
    first = spark.read.schema(ALERT).json(documents).select("id", "disaster", "location", F.lit("json").alias("sink"))
    second = store.read_files(spark, stored).select(
        F.col("tweet_id").alias("id"), F.col("disaster_type").alias("disaster"), "location", F.lit("stored").alias("sink")
    )
    return first.unionByName(second)


#: Most rows in a file of a stream that is made of a table, and so in a task that writes one.
ROWS_PER_STREAM_FILE = 50_000


def shuffled_stream(spark: SparkSession, sf_dir: str, name: str, batches: int = 4) -> DataFrame:
    """The table as a stream of so many micro-batches, of one file each if the table is small, with rows of all times in every file."""
    folder, rows = new_folder(spark, name), table(spark, sf_dir, name)
    files = max(1, -(-rows.count() // (batches * ROWS_PER_STREAM_FILE)))
    rows.repartition(batches * files).write.parquet(folder)
    return topics.stream_files(spark, folder, rows.schema, max_files_per_trigger=files)


@registered
def type_by_window_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows of a stream whose rows come late, after several micro-batches."""
    path, checkpoint = new_folder(spark, "windows"), new_folder(spark, "checkpoint")
    report = {"width": st.WINDOW, "timestamp": "ts", "kind": "event_type", "measure": "value"}
    jobs.wait(windows.start_windows(shuffled_stream(spark, sf_dir, "events"), path, checkpoint, every=None, **report))
    return windows.read_windows(spark, path)


@registered
def replayed_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store after the same feed came twice, the second time with every message repeated."""
    path = new_folder(spark, "store")
    rows = storage.storage_rows(storage.checked(timed(main_alerts(spark, sf_dir))))
    stores.write_store(rows, "new_files", path=path)
    stores.write_store(rows.unionByName(rows), "new_files", path=path)
    return shown(store.read_store(spark, "files", path=path))


@registered
def replayed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by two runs of a stream, each with a checkpoint of its own and every message twice; all read alerts that were scored once."""
    path, scored = new_folder(spark, "store"), new_folder(spark, "alerts")
    jobs.wait(jobs.start_files(streamed_alerts(spark, sf_dir), scored, new_folder(spark, "checkpoint"), every=None, file_format="parquet"))
    sent = topics.stream_files(spark, scored, ALERT)
    for _ in range(2):
        jobs.wait(jobs.start_new_rows(timed(sent.unionByName(sent)), path, new_folder(spark, "checkpoint"), every=None))
    return shown(store.read_runs(spark, path))
