"""Spelling variants: words that differ by one letter, found in a trie of letter counts.

A word's vector counts its letters in ``LEVELS`` groups, common letters first. One inserted letter raises one count, one
deleted lowers one, one replaced does both or neither. So words at that distance lie in the trie of the vectors on
paths that spend a surplus and a deficit of one each, and no others are looked at:

* the first levels, as many as bring the subtrees below ``SUBTREE`` words, name a subtree. Spark sends each word into its own and,
  as a query, into those later ones that its budget reaches, so a pair meets once. A larger subtree is dealt in blocks;
* a task searches its subtree depth first, all queries at once, each with what is left of its budget, and compares
  small enough nodes by a map of the counts. Words that are left are compared letter by letter.

Each task hands on counts and the best partner per word, not pairs.

Defined results: null texts have no words; a null id counts as an empty text in the checksum; repeated rows count
each; words may have any length; the form is the near word with the largest count, ties to the smallest in the order of code points; other columns are
ignored; an empty table gives no rows. Long texts are read run by run.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertflow.llm.common import drop, groups, written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
DELETED_OF = 97
LEAST_LETTERS, LEAST_COUNT = 5, 3
#: A form is at least so many times as frequent as the word.
FORM_TIMES = 2

#: Letters by frequency. Each is a level; other letters share ``OTHERS`` more.
LETTERS = "etaoinsrhldcumfpgwybvkjxzq"
OTHERS = 6
LEVELS = len(LETTERS) + OTHERS
#: Bits of a level in the map of a word's counts; 64 in all.
WIDTHS = [3] * 12 + [2] * 8 + [1] * 12
MOST = 15
SUBTREE = 1 << 15
PREFIX_MOST = 8
#: Pairs of words in a node that is compared as a whole, and compared at a time.
NODE_PAIRS = 1 << 14
PAIRS_AT_ONCE = 1 << 20
HELD = 500_000
SHORT = 32
LONG_TEXT = 1 << 20

_LEVEL = np.array([LETTERS.find(chr(c)) if chr(c) in LETTERS else len(LETTERS) + c % OTHERS for c in range(256)], np.uint8)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of ``docs`` (doc_id, text) with enough letters and occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            arrays = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(arrays, ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if not text:
                    continue
                # bytes.lower changes A-Z only.
                text = text.encode().lower().decode()
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                found = RUN.findall(text) if len(text) < LONG_TEXT else (m[0] for m in RUN.finditer(text))
                for word, times in Counter(found).items():
                    checksum = zlib.crc32(word.encode(), start)
                    if checksum % DELETED_OF == 0:
                        at = checksum % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= LEAST_LETTERS:
                        held[word] += times
                if len(held) > HELD:
                    yield flushed()
        yield flushed()

    counted = docs.select("doc_id", "text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


class Vocabulary:
    """Words as bytes (every letter is one in Latin-1), with their vectors and maps of counts."""

    def __init__(self, words: list[str]):
        self.words = [word.encode("latin-1") for word in words]
        self.sizes = np.array([len(word) for word in self.words], np.int64)
        flat = _LEVEL[np.frombuffer(b"".join(self.words), np.uint8)].astype(np.int64)
        owner = np.repeat(np.arange(len(words)), self.sizes)
        counts = np.bincount(owner * LEVELS + flat, minlength=len(words) * LEVELS)
        self.vectors = np.minimum(counts, MOST).reshape(-1, LEVELS).astype(np.int8)
        self.maps = np.zeros(len(words), np.uint64)
        shift = 0
        for level, width in enumerate(WIDTHS):
            ones = (1 << np.minimum(self.vectors[:, level], width).astype(np.uint64)) - np.uint64(1)
            self.maps |= ones << np.uint64(shift)
            shift += width

    def letters(self) -> np.ndarray:
        """The first ``SHORT`` letters of every word, with zeros after its end."""
        return np.array(self.words, f"S{SHORT}").view(np.uint8).reshape(-1, SHORT)


def prefix_keys(vectors: np.ndarray, levels: int) -> np.ndarray:
    keys = np.zeros(len(vectors), np.int64)
    for level in range(levels):
        keys = (keys << 4) | vectors[:, level]
    return keys


def prefix_steps(levels: int) -> np.ndarray:
    """Changes of the first levels by a surplus and a deficit of at most one each, other than none."""
    unit = np.eye(levels, dtype=np.int8)
    one = [*unit, *-unit]
    both = [unit[i] - unit[j] for i in range(levels) for j in range(levels) if i != j]
    return np.array([*one, *both], np.int8)


def candidates(tree: Vocabulary, order: np.ndarray, queries: Vocabulary, node_pairs: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (word of the tree, query) whose counts differ by no more than one surplus and one deficit.

    ``order`` sorts the tree by its vectors, so that each node is a run.
    """
    vectors, maps = tree.vectors[order], tree.maps[order]
    asked = queries.vectors
    full = np.ones(len(asked), np.int8)
    stack = [(0, len(order), 0, np.arange(len(asked)), full, full)]
    while stack:
        low, high, level, live, surplus, deficit = stack.pop()
        if not len(live):
            continue
        if level == LEVELS or (high - low) * len(live) <= node_pairs:
            step = max(1, PAIRS_AT_ONCE // (high - low))
            mine = maps[low:high, None]
            for start in range(0, len(live), step):
                some = live[start : start + step]
                theirs = queries.maps[some][None]
                near = (np.bitwise_count(mine & ~theirs) <= 1) & (np.bitwise_count(theirs & ~mine) <= 1)
                at, other = np.nonzero(near)
                yield order[low + at], some[other]
            continue
        column = vectors[low:high, level]
        cuts = [0, *(np.flatnonzero(column[1:] != column[:-1]) + 1).tolist(), high - low]
        counts = asked[live, level]
        for start, end in zip(cuts, cuts[1:], strict=False):
            more = column[start] - counts
            kept = (more <= surplus) & (-more <= deficit)
            more = more[kept]
            stack.append(
                (low + start, low + end, level + 1, live[kept], surplus[kept] - np.maximum(more, 0), deficit[kept] - np.maximum(-more, 0))
            )


def one_apart(a: bytes, b: bytes) -> bool:
    """Whether one inserted, deleted or replaced letter makes ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


def verified(words: Vocabulary, letters: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Which of the pairs of words are one letter apart."""
    a, b = words.sizes[one], words.sizes[two]
    good = np.zeros(len(one), bool)
    short = np.maximum(a, b) < SHORT
    same = np.flatnonzero(short & (a == b))
    good[same] = (letters[one[same]] != letters[two[same]]).sum(1) == 1
    near = np.flatnonzero(short & (np.abs(a - b) == 1))
    less, more = np.where(a < b, one, two)[near], np.where(a < b, two, one)[near]
    x, y = letters[less], letters[more]
    first = (x != y).argmax(1)
    later = (x[:, :-1] != y[:, 1:]) & (np.arange(SHORT - 1) >= first[:, None])
    good[near] = ~later.any(1)
    for i in np.flatnonzero(~short).tolist():
        good[i] = one_apart(words.words[one[i]], words.words[two[i]])
    return good


PARTNER = "word string, n_near long, form string, form_n long"


def _search(batches: Iterator[pa.RecordBatch], node_pairs: int) -> Iterator[pa.RecordBatch]:
    for rows in groups(batches, "key"):
        rows = rows.combine_chunks()
        here = pc.invert(rows.column("asks"))
        size = pc.sum(here).as_py() or 0
        if not size:
            continue
        # Words of the tree come first.
        rows = pa.concat_tables([rows.filter(here), rows.filter(rows.column("asks"))])
        names = rows.column("word").to_pylist()
        every = Vocabulary(names)
        tree = Vocabulary(names[:size])
        letters = every.letters()
        best_first = pc.sort_indices(rows.select(["n", "word"]), [("n", "descending"), ("word", "ascending")]).to_numpy()
        rank = np.empty(len(names), np.int64)
        rank[best_first] = np.arange(len(names))
        near, best = np.zeros(len(names), np.int64), np.full(len(names), len(names))
        order = np.lexsort(tree.vectors.T[::-1])
        for one, two in candidates(tree, order, every, node_pairs):
            once = one < two
            one, two = one[once], two[once]
            good = verified(every, letters, one, two)
            one, two = one[good], two[good]
            for a, b in ((one, two), (two, one)):
                near += np.bincount(a, minlength=len(names))
                np.minimum.at(best, a, rank[b])
        found = np.flatnonzero(near)
        form = best_first[best[found]]
        columns = [rows.column("word").take(found), pa.array(near[found]), rows.column("word").take(form), rows.column("n").take(form)]
        yield from pa.table(columns, names=[c.split()[0] for c in PARTNER.split(", ")]).combine_chunks().to_batches()


def _depth(words: DataFrame) -> tuple[int, int]:
    """How many levels name a subtree, and how many words are in the largest."""

    deepest = PREFIX_MOST

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = prefix_keys(Vocabulary(batch.column("word").to_pylist()).vectors, deepest)
            values, n = np.unique(found, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(n)], ["key", "n"])

    depth = F.explode(F.sequence(F.lit(1), F.lit(deepest))).alias("depth")
    counted = words.select("word").mapInArrow(keys, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    # Shorter prefixes are sums over longer ones.
    shorter = counted.select("n", "key", depth).withColumn("key", F.expr(f"shiftright(key, 4 * ({deepest} - depth))"))
    largest = shorter.groupBy("depth", "key").agg(F.sum("n").alias("n")).groupBy("depth").agg(F.max("n").alias("n"))
    sizes = {row["depth"]: row["n"] for row in largest.collect()}
    enough = [depth for depth, n in sizes.items() if n <= SUBTREE]
    chosen = min(enough, default=deepest)
    return chosen, sizes.get(chosen, 0)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n) for the words of ``words`` (word, n) that have a near one; the form is the best of these."""
    levels, largest = _depth(words)
    steps = prefix_steps(levels)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 10_000):
                batch = whole.slice(low, 10_000)
                prefix = Vocabulary(batch.column("word").to_pylist()).vectors[:, :levels]
                own = prefix_keys(prefix, levels)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own), pa.array(np.zeros(len(own), bool)), *batch.columns], ["key", "asks", *batch.schema.names]
                )
                for step in steps:
                    moved = prefix + step
                    key = prefix_keys(moved, levels)
                    sent = np.flatnonzero((moved >= 0).all(1) & (moved <= MOST).all(1) & (key > own))
                    part = batch.take(pa.array(sent))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key[sent]), pa.array(np.ones(len(sent), bool)), *part.columns], ["key", "asks", *batch.schema.names]
                    )

    placed = words.select("word", "n").mapInArrow(place, "key long, asks boolean, word string, n long")
    if largest > SUBTREE:
        sizes = placed.filter("NOT asks").groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > SUBTREE)
        blocks = F.coalesce(F.ceil(F.col("size") / SUBTREE), F.lit(1)).cast("int")
        dealt = placed.join(sizes, "key", "left").withColumn("blocks", blocks)
        own = F.when(~F.col("asks"), F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
        # A word is in one block and asks the later ones; a query from elsewhere asks all.
        all_of = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: F.col("asks") | (b >= F.col("own")))
        dealt = dealt.withColumn("own", own).withColumn("block", F.explode(all_of))
        asks = F.col("asks") | (F.col("block") > F.col("own"))
        key = F.concat_ws(":", F.col("key").cast("string"), F.col("block").cast("string"))
        placed = dealt.select(key.alias("key"), asks.alias("asks"), "word", "n")
    search = partial(_search, node_pairs=NODE_PAIRS)
    found = placed.repartition("key").sortWithinPartitions("key").mapInArrow(search, PARTNER)
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("_best")
    ).select("word", "n_near", F.col("_best.form").alias("form"), (-F.col("_best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every row of ``forms`` (word, form): the last form on the way. Ways double in every round."""
    ways = written(forms.select("word", F.col("form").alias("root")), "ways")
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        longer = ways.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
        longer = written(longer, "ways")
        drop(ways)
        ways = longer.select("word", "root")
        if longer.filter("_moved").isEmpty():
            return ways


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of ``docs`` (doc_id, text)."""
    words = written(word_counts(docs), "words")
    near = near_words(words)
    joined = words.join(near, "word", "left")
    usual = F.col("form_n") >= FORM_TIMES * F.col("n")
    joined = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(usual, F.col("form")).alias("form"), F.when(usual, F.col("form_n")).alias("form_n"),
    )
    joined = written(joined, "near")
    drop(words)
    rooted = joined.join(roots(joined.filter("form IS NOT NULL")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
