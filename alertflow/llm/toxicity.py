"""Toxicity by two class-conditional Kneser-Ney models of characters inside words.

Words of the labelled rows are counted per class, and from them character n-grams. The highest order
is counted for toxic and for ordinary rows apart; all lower orders are one shared model of
continuation counts, so an expression too rare in one class is smoothed by what both share. A word's
evidence is the difference of its two log-likelihoods; a document is compared by evidence per
character, over the whole text and over its strongest windows of words, and by its strongest different words. These
numbers are turned into a probability by a logistic curve fitted on labelled rows kept out of the counts; where these have
one class only, on all labelled rows.

Counts are made by Spark over all labelled rows, and all are kept, in written tables: documents are
dealt in blocks, each asks for its distinct n-grams once, and gets their values back. ``CALIBRATION_ROWS`` is
about how many labelled rows, those of lowest text hash, the curve is fitted to on the driver: a dozen numbers and
a label of each. ``docs`` must be dealt to tasks alike at each reading, as tables in files are.

Defined results: null and empty texts and texts without words get the evidence 0, and so the score
that the curve has there; words are runs of letters, digits and underscores in lower case; a document
labelled twice counts as toxic if any label is 1; null labels are ignored; repeated rows are scored
each; without labelled rows of both classes every score is the share of toxic labels (0 without labels);
other columns are carried along; a text of any length is read whole, by one task.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from alertflow.llm.common import drop, likely_in, parts, small_batches, written

ORDER = 5
DISCOUNT = 0.75
CALIBRATION_ROWS = 20_000
#: Entries after which a task hands on its counts, and words after which it ends its block of documents.
HELD = 300_000
#: Documents after which a block ends.
BLOCK_ROWS = 50_000
#: Bytes of text for which there is one range of n-grams.
RANGE_BYTES = 1 << 24

WORD = re.compile(r"\w+")


def label_fold(doc_id: Column) -> Column:
    """Remainder by five of the checksum of the id's text; rows of fold 0 are never learned from."""
    return F.crc32(doc_id.cast("string")) % 5


def _flushed(counts: Counter, columns: list[str]) -> pd.DataFrame:
    rows = [(*key, n) for key, n in counts.items()]
    counts.clear()
    return pd.DataFrame(rows, columns=columns)


def word_counts(labelled: DataFrame) -> DataFrame:
    """(word, toxic, ordinary): occurrences in texts of either label."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                held.update((word, toxic) for word in WORD.findall(text.lower()))
                if len(held) > HELD:
                    yield _flushed(held, ["word", "toxic", "n"])
        yield _flushed(held, ["word", "toxic", "n"])

    counted = labelled.select("text", "toxic").mapInPandas(count, "word string, toxic int, n long")
    return counted.groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("ordinary"),
    )


def grams(word: str) -> list[str]:
    """The n-gram that ends at each character of a marked word; shorter ones at its start."""
    marked = f"\x02{word}\x03"
    return [marked[max(0, i - ORDER + 1) : i + 1] for i in range(1, len(marked))]


def gram_counts(words: DataFrame) -> DataFrame:
    """(gram, toxic, ordinary) of the highest order."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()
        for batch in batches:
            for word, toxic, ordinary in zip(batch["word"], batch["toxic"], batch["ordinary"], strict=True):
                for gram in grams(word):
                    if toxic:
                        held[gram, 1] += toxic
                    if ordinary:
                        held[gram, 0] += ordinary
                if len(held) > HELD:
                    yield _flushed(held, ["gram", "toxic", "n"])
        yield _flushed(held, ["gram", "toxic", "n"])

    counted = words.mapInPandas(count, "gram string, toxic int, n long")
    return counted.groupBy("gram").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("ordinary"),
    )


class Counts(NamedTuple):
    """The written tables that a model reads; each has a row for each n-gram or context it names.

    ``top`` (gram, toxic, ordinary): occurrences in either class. ``after`` (context, toxic_total,
    ordinary_total, toxic_kinds, ordinary_kinds): those of all n-grams after a context, and how many different
    ones. ``low`` (gram, c): shared continuation counts. ``follow`` (context, total, kinds): the same of contexts.
    """

    top: DataFrame
    after: DataFrame
    low: DataFrame
    follow: DataFrame


def statistics(top: DataFrame) -> Counts:
    """All counts that the models need, of every n-gram in ``top``."""
    context = F.expr("substr(gram, 1, length(gram) - 1)").alias("context")
    after = top.groupBy(context).agg(
        F.sum("toxic").alias("toxic_total"), F.sum("ordinary").alias("ordinary_total"),
        F.count(F.when(F.col("toxic") > 0, 1)).alias("toxic_kinds"), F.count(F.when(F.col("ordinary") > 0, 1)).alias("ordinary_kinds"),
    )
    # Each different n-gram counts once for its end without the first character; one at a word's start
    # has itself before it.
    ends = F.transform(F.sequence(F.lit(2), F.least(F.length("gram"), F.lit(ORDER))), lambda n: F.expr("gram").substr(F.length("gram") - n + 1, n))
    longer = top.select(F.explode(ends).alias("gram")).distinct().select(F.expr("substr(gram, 2)").alias("gram"))
    starts = top.select("gram").filter((F.length("gram") < ORDER) & F.col("gram").startswith("\x02"))
    low = written(longer.unionByName(starts).groupBy("gram").agg(F.count(F.lit(1)).alias("c")), "low")
    follow = low.groupBy(context).agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("kinds"))
    return Counts(top, written(after, "after"), low, written(follow, "follow"))


def _smoothed(count: Column, kinds: Column, total: Column, lower: Column) -> Column:
    """The Kneser-Ney probability of a count in its context; ``lower`` where the context is unknown."""
    known = F.greatest(F.coalesce(count, F.lit(0)) - DISCOUNT, F.lit(0.0)) + DISCOUNT * kinds * lower
    return F.when(total > 0, known / total).otherwise(lower)


def shared(grams: DataFrame, counts: Counts) -> list[DataFrame]:
    """(gram, p) tables: the lower orders, what both classes back off to, for each distinct ``gram`` and its ends, by length."""
    ends = F.transform(F.sequence(F.lit(1), F.length("gram")), lambda n: F.expr("gram").substr(F.length("gram") - n + 1, n))
    asked = written(grams.select(F.explode(ends).alias("gram")).distinct(), "asked")
    tables: list[DataFrame] = []
    for size in range(1, ORDER):
        rows = asked.filter(F.length("gram") == size).withColumn("context", F.expr("substr(gram, 1, length(gram) - 1)"))
        rows = rows.join(counts.low, "gram", "left").join(counts.follow, "context", "left")
        if not tables:
            rows = rows.withColumn("_lower", F.lit(1e-3))
        else:
            shorter = tables[-1].select(F.col("gram").alias("_end"), F.col("p").alias("_lower"))
            rows = rows.withColumn("_end", F.expr("substr(gram, 2)")).join(shorter, "_end")
        p = _smoothed(F.col("c"), F.col("kinds"), F.col("total"), F.col("_lower"))
        tables.append(written(rows.select("gram", p.alias("p")), "lower"))
    drop(asked)
    return tables


def gram_evidence(grams: DataFrame, counts: Counts) -> DataFrame:
    """(gram, value), written: toxic minus ordinary log-likelihood of each distinct ``gram`` of words."""
    end = F.when(F.length("gram") == ORDER, F.expr("substr(gram, 2)")).otherwise(F.col("gram"))
    asked = grams.withColumn("_low", end)
    tables = shared(asked.select(F.col("_low").alias("gram")).distinct(), counts)
    lower = reduce(DataFrame.unionByName, tables)
    rows = asked.join(lower.select(F.col("gram").alias("_low"), "p"), "_low")
    rows = rows.withColumn("context", F.expr("substr(gram, 1, length(gram) - 1)"))
    rows = rows.join(counts.top, "gram", "left").join(counts.after, "context", "left")

    def log(kind: str) -> Column:
        p = _smoothed(F.col(kind), F.col(f"{kind}_kinds"), F.col(f"{kind}_total"), F.col("p"))
        return F.log(F.greatest(p, F.lit(1e-12)))

    values = written(rows.select("gram", (log("toxic") - log("ordinary")).alias("value")), "values")
    drop(*tables)
    return values


class Block:
    """The words of a run of documents of one task, numbered as they come; it ends by itself when it is large enough.

    Both passes over the documents make the same blocks.
    """

    def __init__(self, rows: int, words: int):
        self.most_rows, self.most_words = rows, words
        self.number, self.words, self.rows = 0, self._numbered(), 0

    @staticmethod
    def _numbered() -> defaultdict[str, int]:
        """A new word gets the number of words before it."""
        words: defaultdict[str, int] = defaultdict()
        words.default_factory = words.__len__
        return words

    def encode(self, text: str | None) -> list[int]:
        self.rows += 1
        return list(map(self.words.__getitem__, WORD.findall((text or "").lower())))

    def is_full(self) -> bool:
        return self.rows >= self.most_rows or len(self.words) > self.most_words

    def name(self, part: int) -> int:
        return part << 33 | self.number

    def close(self) -> None:
        # The words know themselves by their numbering, which would keep them until a collection.
        self.words.default_factory = None
        self.number, self.words, self.rows = self.number + 1, self._numbered(), 0


def _packed(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ``varints``, and how many each number takes."""
    # No more groups than the largest number has.
    shifts = np.arange(0, max(int(numbers.max(initial=1)).bit_length(), 1), 7)
    groups_of = numbers[:, None] >> shifts
    sizes = np.maximum((groups_of > 0).sum(1), 1)
    place = np.arange(len(shifts))
    raw = (groups_of & 127) | np.where(place < sizes[:, None] - 1, 128, 0)
    return raw[place < sizes[:, None]].astype(np.uint8), sizes


def varints(numbers: np.ndarray) -> bytes:
    """Numbers below 2**35 in as many bytes as they need, seven bits in each."""
    return _packed(numbers)[0].tobytes()


def varints_of_rows(rows: list[list[int]]) -> list[bytes]:
    """``varints`` of each row, worked out together."""
    raw, sizes = _packed(np.fromiter(itertools.chain.from_iterable(rows), np.int64))
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *map(len, rows)])].tolist()
    data = raw.tobytes()
    return [data[start:end] for start, end in itertools.pairwise(ends)]


def from_varints(raw: bytes) -> np.ndarray:
    data = np.frombuffer(raw, np.uint8)
    if not len(data):
        return np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.flatnonzero(data < 128)[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), starts)


def rows_from_varints(rows: list[bytes]) -> list[np.ndarray]:
    """``from_varints`` of each row, worked out together."""
    data = b"".join(rows)
    ended = np.concatenate([[0], np.cumsum(np.frombuffer(data, np.uint8) < 128)])
    return np.split(from_varints(data), ended[np.cumsum([len(raw) for raw in rows])][:-1])


def asked_grams(docs: DataFrame, ranges: int) -> DataFrame:
    """(block, range, names): the distinct n-grams of each block of ``docs`` (part, doc, text), by range of their hash."""
    rows, words = BLOCK_ROWS, HELD

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, part = Block(rows, words), 0

        def asked() -> pa.RecordBatch:
            names: list[list[str]] = [[] for _ in range(ranges)]
            for gram in {gram for word in block.words for gram in grams(word)}:
                names[zlib.crc32(gram.encode("utf-8", "surrogatepass")) % ranges].append(gram)
            used = [i for i in range(ranges) if names[i]]
            columns = [
                pa.array([block.name(part)] * len(used), pa.int64()), pa.array(used, pa.int32()),
                pa.array(["\n".join(sorted(names[i])) for i in used], pa.string()),
            ]
            block.close()
            return pa.RecordBatch.from_arrays(columns, ["block", "range", "names"])

        for batch in parts(batches):
            part = batch.column("part")[0].as_py()
            for text in batch.column("text").to_pylist():
                block.encode(text)
                if block.is_full():
                    yield asked()
        yield asked()

    return docs.select("part", "text").mapInArrow(ask, "block long, range int, names string")


def answered(asks: DataFrame, values: DataFrame, ranges: int) -> DataFrame:
    """(block, names, numbers): the asks with a value (double) of each name; what is the same for many blocks is looked up per range."""
    keyed = values.select(F.pmod(F.crc32("gram"), F.lit(ranges)).cast("int").alias("range"), "gram", "value")
    both = keyed.unionByName(asks, allowMissingColumns=True)
    both = both.repartition("range").sortWithinPartitions("range", "block")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, known = None, {}
        for batch in batches:
            names = ("range", "gram", "value", "block", "names")
            out: list[tuple] = []
            for name, gram, value, block, asked in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if name != current:
                    current, known = name, {}
                # Values have no block, and so come first.
                if block is None:
                    known[gram] = value
                else:
                    out.append((block, asked, np.array([known[gram] for gram in asked.split("\n")]).tobytes()))
            columns = list(zip(*out, strict=True)) or [[]] * 3
            kinds = (pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["block", "names", "numbers"])

    return both.mapInArrow(answer, "block long, names string, numbers binary")


#: Documents whose numbers are packed or unpacked together.
PACKED_ROWS = 128
#: Kinds of the rows of a block, in the order in which they are read.
ANSWER, WORDS, DOC = range(3)


def encoded(docs: DataFrame) -> DataFrame:
    """(block, kind, names, doc, numbers): the words of each block in one row, and each document as numbers of them."""
    rows, words = BLOCK_ROWS, HELD
    carried = docs.schema["doc"].dataType
    schema = StructType().add("block", "long").add("kind", "integer").add("names", "string").add("doc", carried).add("numbers", "binary")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, part, kind_of_doc = Block(rows, words), 0, None

        def of(kind: int, n: int, names: list | None, doc: pa.Array | None, numbers: list | None) -> pa.RecordBatch:
            columns = [
                pa.array([block.name(part)] * n, pa.int64()), pa.array([kind] * n, pa.int32()),
                pa.nulls(n, pa.string()) if names is None else pa.array(names, pa.string()),
                pa.nulls(n, kind_of_doc) if doc is None else doc,
                pa.nulls(n, pa.binary()) if numbers is None else pa.array(numbers, pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, schema.names)

        def closed() -> pa.RecordBatch:
            out = of(WORDS, 1, ["\n".join(block.words)], None, None)
            block.close()
            return out

        for batch in batches:
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            doc, start, numbers = batch.column("doc"), 0, []
            kind_of_doc = doc.type
            pending: list[list[int]] = []
            for at, text in enumerate(batch.column("text").to_pylist(), 1):
                pending.append(block.encode(text))
                full = block.is_full()
                if full or at == batch.num_rows or len(pending) == PACKED_ROWS:
                    numbers += varints_of_rows(pending)
                    pending = []
                if full:
                    yield of(DOC, at - start, None, doc.slice(start, at - start), numbers)
                    yield closed()
                    start, numbers = at, []
            if numbers:
                yield of(DOC, len(numbers), None, doc.slice(start), numbers)
        if block.rows:
            yield closed()

    return docs.select("part", "doc", "text").mapInArrow(encode, schema)


#: Windows of words, and numbers of strongest words, whose evidence is compared.
WINDOWS = (1, 2, 4, 8, 32)
STRONGEST = (1, 3, 5, 10)


def features(numbers: np.ndarray, logs: np.ndarray, sizes: np.ndarray) -> list[float]:
    """What a document is judged by, from the words it has, and the evidence and characters of every word.

    Evidence per ten characters of the whole text and of its strongest window of each width; mean evidence of its strongest
    different words; the logarithm of its length.
    """
    if not len(numbers):
        return [0.0] * (2 + len(WINDOWS) + len(STRONGEST))
    total, n = np.add.reduce, len(numbers)
    evidence_of, size_of = logs[numbers], sizes[numbers]
    whole = 10 * float(total(evidence_of) / total(size_of))
    out = [whole]
    running, lengths = np.zeros(n + 1), np.zeros(n + 1)
    np.cumsum(evidence_of, out=running[1:])
    np.cumsum(size_of, out=lengths[1:])
    for width in WINDOWS:
        if n <= width:
            out.append(whole)
        else:
            out.append(10 * float(((running[width:] - running[:-width]) / (lengths[width:] - lengths[:-width])).max()))
    ordered = np.sort(numbers)
    first = np.ones(n, bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    different = np.sort(logs[ordered[first]])[::-1]
    out += [float(total(different[:k]) / min(k, len(different))) for k in STRONGEST]
    return [*out, float(np.log(len(numbers) + 1))]


def evidence(docs: DataFrame, counts: Counts) -> DataFrame:
    """(doc, features) from (doc, text): the row's struct, and what its text is judged by.

    The distinct n-grams of each block of documents are looked up in the counts, and their values go back to
    the block, whose documents come as numbers of its words. No task has more of the model than its block's n-grams.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = 1 << max(size // RANGE_BYTES, 1).bit_length()
    given = docs.select(F.spark_partition_id().cast("long").alias("part"), "doc", "text")
    asks = written(asked_grams(given, ranges), "asks", compression="zstd")
    names = asks.select(F.explode(F.split("names", "\n")).alias("gram")).distinct()
    values = gram_evidence(names, counts)
    answers = answered(asks, values, ranges).withColumn("kind", F.lit(ANSWER))
    both = encoded(given).unionByName(answers, allowMissingColumns=True)
    both = both.repartition("block").sortWithinPartitions("block", "kind")
    schema = StructType().add("doc", docs.schema["doc"].dataType).add("features", ArrayType(DoubleType()))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, known, logs, sizes = None, {}, np.zeros(0), np.zeros(0)
        for batch in batches:
            block, kind = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((block[1:] != block[:-1]) | (kind[1:] != kind[:-1])) + 1
            for start, end in itertools.pairwise([0, *cuts.tolist(), len(block)]):
                if start == end:
                    continue
                if block[start] != current:
                    current, known = block[start], {}
                part = batch.slice(start, end - start)
                if kind[start] == ANSWER:
                    for asked, numbers in zip(part.column("names").to_pylist(), part.column("numbers").to_pylist(), strict=True):
                        known.update(zip(asked.split("\n"), np.frombuffer(numbers, float).tolist(), strict=True))
                elif kind[start] == WORDS:
                    words = part.column("names")[0].as_py().split("\n")
                    words = words if words != [""] else []
                    logs = np.array([sum(map(known.__getitem__, grams(word))) for word in words], float)
                    sizes = np.array([len(word) + 1 for word in words], float)
                    known = {}
                else:
                    for some in parts([part], PACKED_ROWS):
                        found = [features(numbers, logs, sizes) for numbers in rows_from_varints(some.column("numbers").to_pylist())]
                        yield pa.RecordBatch.from_arrays([some.column("doc"), pa.array(found, pa.list_(pa.float64()))], ["doc", "features"])

    out = written(both.mapInArrow(compare, schema), "features")
    drop(asks, values)
    return out


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic regression by Newton's method on features brought to one scale; a constant and a weight per feature as given."""
    mean, spread = x.mean(0), x.std(0) + 1e-9
    x = np.column_stack([np.ones(len(x)), (x - mean) / spread])
    weights = np.zeros(x.shape[1])
    keep = np.array([0.0] + [ridge] * (x.shape[1] - 1))
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + keep * weights
        bend = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(keep + 1e-9)
        step = np.linalg.solve(bend, slope)
        weights -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    scaled = weights[1:] / spread
    return np.concatenate([[weights[0] - (scaled * mean).sum()], scaled])


class ToxicityModel:
    """A fitted model: the tables of counts and the curve's weights, or a constant score."""

    def __init__(self, counts: Counts | None, weights: np.ndarray | None, constant: float):
        self.counts, self.weights, self.constant = counts, weights, constant

    def drop(self) -> None:
        """Delete the tables of counts; what ``score`` gave before stays."""
        if self.counts is not None:
            drop(*self.counts)

    def score(self, docs: DataFrame, carry: Sequence[str] | None = None) -> DataFrame:
        """The columns ``carry`` of ``docs``, by default all, with ``score`` (0 to 1) and ``predicted``."""
        names = docs.columns if carry is None else list(carry)
        if self.weights is None:
            scored = docs.select(*names).withColumn("score", F.lit(float(self.constant)))
        else:
            first, *others = map(float, self.weights)
            with small_batches(docs.sparkSession):
                compared = evidence(docs.select(F.struct(*names).alias("doc"), "text"), self.counts)
            terms = F.zip_with("features", F.array(*map(F.lit, others)), lambda x, w: x * w)
            score = 1 / (1 + F.exp(-F.aggregate(terms, F.lit(first), lambda total, x: total + x)))
            scored = compared.select(*(F.col("doc")[name].alias(name) for name in names), score.alias("score"))
        return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Fit on the documents (doc_id, text) whose label (doc_id, toxic) may be learned."""
    marks = labels.filter(F.col("toxic").isin(0, 1) & (label_fold(F.col("doc_id")) != 0))
    marks = marks.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Equal texts stay on one side, so copies never stand in both.
    split = F.xxhash64("text")
    marks = written(marks, "marks")
    labelled = likely_in(texts, "doc_id", marks).join(marks.hint("merge"), "doc_id")
    labelled = written(labelled.select("text", "toxic", split.alias("_split")), "labelled")
    count_part, curve_part = (F.col("_split") % 4 != 0), (F.col("_split") % 4 == 0)
    with small_batches(spark):
        words = written(word_counts(labelled.filter(count_part)), "words")
    top = written(gram_counts(words), "grams")
    totals = top.agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")).first()
    if not totals.toxic or not totals.ordinary:
        share = marks.agg(F.avg("toxic")).first()[0]
        return ToxicityModel(None, None, share or 0.0)
    counts = statistics(top)
    drop(words)
    # Lowest hashes by a threshold, so that no text comes to the driver; equal texts stay together.
    curve = labelled.filter(curve_part)
    if curve.select("toxic").distinct().count() < 2:
        # Too few labelled texts for a part of their own: the counted ones have both classes.
        curve = labelled
    rows = curve.count()
    part = F.pmod(F.xxhash64("_split", F.lit(1)), F.lit(1 << 20)) * rows < CALIBRATION_ROWS * (1 << 20)
    chosen = curve.filter(part if rows > CALIBRATION_ROWS else F.lit(True)).select(F.struct("toxic").alias("doc"), "text")
    with small_batches(spark):
        judged = evidence(chosen, counts)
    seen = judged.select("doc.toxic", "features").toArrow()
    drop(labelled, marks, judged)
    x = np.array(seen["features"].to_pylist(), float)
    return ToxicityModel(counts, fit_curve(x, seen["toxic"].to_numpy().astype(float)), 0.0)
