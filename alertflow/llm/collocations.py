"""Collocations by partitioned (SON) mining: phrases of words that stand together more often than their parts do.

Documents are dealt into ``SHARDS`` shards. A phrase with ``support`` occurrences in all has at least
``ceil(support / SHARDS)`` in one of them, so

* the first pass mines every shard completely at that lower support. Tasks send hashes of phrases with counts, packed by
  range of hash, and each range is counted per shard. Two phrases with one hash only make each other
  candidates. The ranges follow the size of the texts, so one holds the same amount of work at every size;
* the union of what the shards found goes back to the blocks of documents that sent it, a block being what one task reads;
* the second pass counts these candidates over all documents, by their texts. A block has its own candidates at hand
  and no others, however many there are in all.

Every candidate is scored at each cut into two parts, in decimals, and the lowest score counts.

Defined results: null texts are empty, null languages are ``und``; repeated rows and ids count each; other columns are
ignored; equal scores are ordered by count, then by the bytes of the phrase; an empty table gives no rows.
Texts are worked on in parts cut at ends of pieces, so a text of any length is whole, and only a single piece
has to fit in a task. Counts up to 10^15 are exact in the scores. ``docs`` must be dealt to tasks alike at each
reading, as tables in files are.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import pairwise
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alertflow.llm.common import groups, written
from alertflow.llm.jaccard import mix, odd_factors

SUPPORT = 10
LONGEST = 3
#: A share of a candidate's occurrences that are inside one longer candidate, in hundredths, at which it goes.
INSIDE = 50
TOP = 2000
SHARDS = 4
NO_LANGUAGE = "und"
#: Bytes of text worked on at once, and for which the first pass has one range of hashes.
CHUNK = 1 << 20
RANGE_BYTES = 1 << 23
#: Phrases after which a task hands on its counts.
HELD = 3_000_000
HELD_TEXTS = 500_000

U = np.uint64
PIECE_END = re.compile(rb"[.,;:!?\n-\r]")
_KIND = np.full(256, 2, np.uint8)
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 0
_KIND[[32, 9]] = 1


def chunks(texts: list[bytes | None], size: int = CHUNK) -> Iterator[tuple[list[int], list[bytes]]]:
    """Numbers of texts with parts of them, about ``size`` bytes at a time; long texts are cut at ends of pieces."""
    rows, parts, held = [], [], 0
    for row, text in enumerate(texts):
        start, text = 0, text or b""
        while start < len(text):
            end = len(text)
            if end - start > size:
                found = PIECE_END.search(text, start + size)
                end = found.end() if found else end
            rows.append(row)
            parts.append(text[start:end])
            held, start = held + end - start, end
            if held >= size:
                yield rows, parts
                rows, parts, held = [], [], 0
    if rows:
        yield rows, parts


class Words:
    """The words of some texts: where they stand, which piece and text they are in, and two hashes of each."""

    def __init__(self, parts: list[bytes]):
        self.buffer = b"\n".join(parts)
        raw = np.frombuffer(self.buffer, np.uint8)
        kind = _KIND[raw]
        inside = kind == 2
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        self.starts, self.ends = edges[::2], edges[1::2]
        self.size = len(self.starts)
        ends = np.cumsum([len(part) + 1 for part in parts])
        self.text = np.searchsorted(ends, self.starts, "right")
        if not self.size:
            self.piece, self.one, self.two = np.zeros(0, int), np.zeros(0, U), np.zeros(0, U)
            return
        self.piece = np.cumsum(kind == 0)[self.starts]
        sizes = self.ends - self.starts
        letters = raw[inside].astype(U)
        letters[(letters >= 65) & (letters <= 90)] += U(32)
        letters += U(1)
        first = np.cumsum(sizes) - sizes
        place = np.arange(len(letters)) - np.repeat(first, sizes)
        longest = int(sizes.max())
        self.one, self.two = (
            mix(np.add.reduceat(letters * odd_factors(longest, seed)[place], first) + sizes.astype(U)) for seed in (1, 3)
        )

    def phrases(self, languages: np.ndarray, longest: int, second: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray | None]]:
        """(words, place of the first word, hash, other hash) of all phrases; ``languages`` has a hash per text."""
        known = languages[self.text] if self.size else np.zeros(0, U)
        one, two = mix(self.one ^ known), (self.two if second else None)
        at = np.arange(self.size)
        yield 1, at, one, two
        for words in range(2, longest + 1):
            if len(one) < 2:
                return
            n = len(one) - 1
            one = mix(one[:n] * U(0x9E3779B97F4A7C15) + self.one[words - 1 :])
            if second:
                two = mix(two[:n] * U(0xC2B2AE3D27D4EB4F) + self.two[words - 1 :])
            at = at[:n]
            same = self.piece[at] == self.piece[at + words - 1]
            yield words, at[same], one[same], two[same] if second else None

    def phrase(self, at: int, words: int) -> str:
        said = [self.buffer[self.starts[i] : self.ends[i]] for i in range(at, at + words)]
        # bytes.lower changes A-Z only.
        return b" ".join(said).lower().decode("utf-8", "surrogatepass")


def _language_hash(languages: list[str]) -> np.ndarray:
    return np.array([int(Words([language.encode() or b" "]).two.sum(dtype=U)) for language in languages], U)


def _input(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), text.cast("binary").alias("text"),
        F.pmod(F.xxhash64("text"), F.lit(SHARDS)).cast("int").alias("shard"), F.spark_partition_id().cast("long").alias("block"),
    )


def local_counts(docs: DataFrame, longest: int, ranges: int) -> DataFrame:
    """(range, shard, block, keys, counts): packed hashes of the phrases of each shard and block, with counts up to 255."""
    bits = max(ranges - 1, 1).bit_length()
    chunk, most = CHUNK, HELD

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[] for _ in range(SHARDS)]
        size = block = 0

        def packed() -> pa.RecordBatch:
            out: list[list] = [[], [], [], []]
            for shard, parts in enumerate(held):
                # The highest bits name the range, the next 32 are the key in it.
                keys = np.concatenate([*parts, np.zeros(0, U)]) >> U(32 - bits)
                parts.clear()
                keys, n = np.unique(keys, return_counts=True)
                n = np.minimum(n, 255).astype(np.uint8)
                names, first = np.unique((keys >> U(32)).astype(np.int32), return_index=True)
                ends = [*first[1:].tolist(), len(keys)]
                short = keys.astype(np.uint32)
                for name, start, end in zip(names.tolist(), first.tolist(), ends, strict=True) if len(keys) else ():
                    for column, value in zip(out, (name, shard, short[start:end].tobytes(), n[start:end].tobytes()), strict=True):
                        column.append(value)
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
            arrays = [pa.array(column, kind) for column, kind in zip((*out[:2], [block] * len(out[0]), *out[2:]), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["range", "shard", "block", "keys", "counts"])

        for batch in batches:
            block = batch.column("block")[0].as_py() if batch.num_rows else block
            names, shards = batch.column("lang").to_pylist(), batch.column("shard").to_numpy()
            known = {name: _language_hash([name])[0] for name in set(names)}
            for rows, parts in chunks(batch.column("text").to_pylist(), chunk):
                words = Words(parts)
                language = np.array([known[names[row]] for row in rows], U)
                shard_of = shards[rows]
                for _, at, keys, _ in words.phrases(language, longest, False):
                    mine = shard_of[words.text[at]]
                    for shard in range(SHARDS):
                        held[shard].append(keys[mine == shard])
                    size += len(keys)
                if size >= most:
                    yield packed()
                    size = 0
        yield packed()

    return docs.mapInArrow(count, "range int, shard int, block long, keys binary, counts binary")


def candidates(local: DataFrame, support: int) -> DataFrame:
    """(block, range, keys): for each block, what some shard finds frequent and may reach the support in all."""
    lowered = ceil(support / SHARDS)

    def union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, "range"):
            keys = [np.frombuffer(k, np.uint32) for k in rows.column("keys").to_pylist()]
            counts = [np.frombuffer(c, np.uint8) for c in rows.column("counts").to_pylist()]
            shards, blocks = rows.column("shard").to_numpy(), rows.column("block").to_numpy()
            sums, frequent = [], [np.zeros(0, np.uint32)]
            for shard in np.unique(shards).tolist():
                mine = np.flatnonzero(shards == shard).tolist()
                all_keys, n = np.concatenate([keys[i] for i in mine]), np.concatenate([counts[i] for i in mine])
                order = np.argsort(all_keys, kind="stable")
                all_keys, n = all_keys[order], n[order].astype(np.int64)
                first = np.flatnonzero(np.concatenate([[True], all_keys[1:] != all_keys[:-1]]))
                sums.append((all_keys[first], np.add.reduceat(n, first)))
                frequent.append(sums[-1][0][sums[-1][1] >= lowered])
            union_of = np.unique(np.concatenate(frequent))
            total = np.zeros(len(union_of), np.int64)
            for all_keys, n in sums:
                at = np.minimum(np.searchsorted(all_keys, union_of), len(all_keys) - 1)
                total += np.where(all_keys[at] == union_of, n[at], 0)
            good = union_of[total >= support]
            found: dict[int, list] = {}
            for sent, block in zip(keys, blocks.tolist(), strict=True):
                at = np.searchsorted(good, sent)
                found.setdefault(block, []).append(sent[good[np.minimum(at, len(good) - 1)] == sent] if len(good) else sent[:0])
            answers = [(block, np.unique(np.concatenate(parts)).tobytes()) for block, parts in found.items()]
            columns = [pa.array([a[0] for a in answers]), pa.array([rows.column("range")[0].as_py()] * len(answers), pa.int32()), pa.array([a[1] for a in answers], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "range", "keys"])

    return local.repartition("range").sortWithinPartitions("range").mapInArrow(union, "block long, range int, keys binary")


def counted(docs: DataFrame, wanted: DataFrame, support: int, longest: int, ranges: int) -> DataFrame:
    """(lang, words, phrase, n) of all ``wanted`` phrases that reach the support; one of no words counts a language's words.

    Blocks send their counts packed by range and language, and the phrases of a range are added up by their texts.
    """
    shift = U(32 - max(ranges - 1, 1).bit_length())
    chunk, most = CHUNK, HELD_TEXTS
    nothing = {"range": "int", "keys": "binary"}
    texts = docs.select("block", *[F.lit(None).cast(kind).alias(name) for name, kind in nothing.items()], "lang", "text")
    both = texts.unionByName(wanted, allowMissingColumns=True)
    # What a block asked for comes before its texts.
    both = both.repartition("block").sortWithinPartitions("block", F.desc("range"))

    def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray | pa.RecordBatch]:
        """The sorted keys of each block, then its texts."""
        current, held = None, []
        for batch in batches:
            block, asked = batch.column("block").to_numpy(), batch.column("range").is_valid().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((block[1:] != block[:-1]) | (asked[1:] != asked[:-1])) + 1
            for start, end in pairwise([0, *cuts.tolist(), len(block)]):
                if start == end:
                    continue
                if block[start] != current:
                    current, held = block[start], [np.zeros(0, U)]
                part = batch.slice(start, end - start)
                if asked[start]:
                    for name, keys in zip(part.column("range").to_pylist(), part.column("keys").to_pylist(), strict=True):
                        held.append(np.frombuffer(keys, np.uint32).astype(U) | U(name) << U(32))
                    continue
                if held:
                    yield np.sort(np.concatenate(held))
                    held = []
                yield part

    names_of = ["range", "lang", "words", "phrases", "counts"]
    kinds = (pa.int32(), pa.string(), pa.int32(), pa.string(), pa.binary())

    def packed(keys: np.ndarray, languages: list[str], sizes: np.ndarray, phrases: list[str], times: np.ndarray) -> pa.RecordBatch:
        codes = {name: code for code, name in enumerate(dict.fromkeys(languages))}
        of = np.array([codes[name] for name in languages], np.int64)
        places = (keys >> (shift + U(32))).astype(np.int64)
        order = np.lexsort((sizes, of, places))
        group = np.stack([places, of, sizes])[:, order]
        first = np.flatnonzero(np.concatenate([[True], (group[:, 1:] != group[:, :-1]).any(0)])[: len(order)]).tolist()
        # Words hold no line breaks.
        rows = [
            (int(group[0, i]), languages[order[i]], int(group[2, i]), "\n".join([phrases[k] for k in order[i:j]]), times[order[i:j]].tobytes())
            for i, j in pairwise([*first, len(order)])
        ] if first else []
        columns = list(zip(*rows, strict=True)) or [[]] * len(names_of)
        return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], names_of)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, int] = {}
        wanted_keys = np.zeros(0, U)
        # Number of each known hash, and what is known of it, in columns: objects of their own would take three times as much.
        known: dict[int, int] = {}
        others, times, sizes = array("Q"), array("q"), array("q")
        phrases: list[str] = []
        languages: list[str] = []

        def flushed() -> pa.RecordBatch:
            keys = np.fromiter(known, U, len(known))
            out = packed(keys, languages, np.array(sizes, np.int64), phrases, np.array(times, np.int64))
            known.clear()
            phrases.clear()
            languages.clear()
            return out

        for batch in by_block(batches):
            if isinstance(batch, np.ndarray):
                wanted_keys = batch
                continue
            names = batch.column("lang").to_pylist()
            hashes = {name: _language_hash([name])[0] for name in set(names)}
            for rows, parts in chunks(batch.column("text").to_pylist(), chunk):
                words = Words(parts)
                language = np.array([hashes[names[row]] for row in rows], U)
                for row, n in zip(rows, np.bincount(words.text, minlength=len(rows)).tolist(), strict=True):
                    totals[names[row]] = totals.get(names[row], 0) + n
                clashed = []
                for size, at, one, two in words.phrases(language, longest, True):
                    short = one >> shift
                    place = np.searchsorted(wanted_keys, short)
                    marked = wanted_keys[np.minimum(place, len(wanted_keys) - 1)] == short if len(wanted_keys) else np.zeros(len(at), bool)
                    at, one, two = at[marked], one[marked], two[marked]
                    order = np.argsort(one)
                    if ((one[order[1:]] == one[order[:-1]]) & (two[order[1:]] != two[order[:-1]])).any():
                        order = np.lexsort((two, one))
                    at, one, two = at[order], one[order], two[order]
                    new = np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])[: len(one)]
                    first = np.flatnonzero(new)
                    n = np.diff(np.append(first, len(one)))
                    for key, other, place, more in zip(one[first].tolist(), two[first].tolist(), at[first].tolist(), n.tolist(), strict=True):
                        number = known.get(key)
                        if number is None:
                            known[key] = len(phrases)
                            phrases.append(words.phrase(place, size))
                            languages.append(names[rows[words.text[place]]])
                            others.append(other)
                            times.append(more)
                            sizes.append(size)
                        elif others[number] == other:
                            times[number] += more
                        else:
                            clashed.append((key, names[rows[words.text[place]]], size, words.phrase(place, size), more))
                if clashed:
                    keys, of, lengths, said, n = zip(*clashed, strict=True)
                    yield packed(np.array(keys, U), list(of), np.array(lengths), list(said), np.array(n, np.int64))
                if len(known) > most:
                    yield flushed()
                    others, times, sizes = array("Q"), array("q"), array("q")
        yield flushed()
        zeros = np.zeros(len(totals), np.int64)
        yield packed(zeros.astype(U), list(totals), zeros, [""] * len(totals), np.array(list(totals.values()), np.int64))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, "range"):
            parts = []
            for lang, size, said, n in zip(*(rows.column(c).to_pylist() for c in names_of[1:]), strict=True):
                said = said.split("\n")
                parts.append(pa.table({"lang": [lang] * len(said), "words": pa.array([size] * len(said), pa.int32()), "phrase": said, "n": np.frombuffer(n, np.int64)}))
            total = pa.concat_tables(parts).group_by(["lang", "words", "phrase"], use_threads=False).aggregate([("n", "sum")])
            total = total.select(["lang", "words", "phrase", "n_sum"]).rename_columns(["lang", "words", "phrase", "n"])
            enough = pc.or_(pc.greater_equal(total.column("n"), support), pc.equal(total.column("words"), 0))
            yield from total.filter(enough).to_batches()

    rows = both.mapInArrow(count, "range int, lang string, words int, phrases string, counts binary")
    return rows.repartition("range").sortWithinPartitions("range").mapInArrow(add_up, "lang string, words int, phrase string, n long")


def _part(first: Column | int, size: Column) -> Column:
    return F.array_join(F.slice(F.col("_words"), first, size), " ")


def scored(counts: DataFrame, support: int, longest: int, inside: int) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of all candidates that no longer one holds."""
    usual = counts.filter((F.col("words") > 0) & (F.col("n") >= support)).select("lang", "words", "phrase", F.col("n").alias("a"))
    candidates = usual.filter("words > 1").withColumn("_words", F.split("phrase", " "))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select(
        "lang", "words", "phrase", "a", "k", _part(1, F.col("k")).alias("_left"), _part(F.col("k") + 1, F.col("words") - F.col("k")).alias("_right")
    )
    parts = usual.filter(F.col("words") < longest)
    left = parts.select("lang", F.col("phrase").alias("_left"), F.col("a").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("_right"), F.col("a").alias("r"))
    joined = cuts.join(left, ["lang", "_left"]).join(right, ["lang", "_right"])
    a, l, r = (F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r"))
    million = F.lit(1_000_000).cast("decimal(7,0)")
    # Spark's DIV of decimals is exact and gives a whole number.
    joined = joined.withColumns({"_top": a * a * million, "_below": l * r}).withColumn("score", F.expr("_top DIV _below"))
    lowest = joined.groupBy("lang", "phrase").agg(
        F.first("words").alias("words"), F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    longer = candidates.filter("words > 2")
    pieces = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda size: F.transform(F.sequence(F.lit(1), F.col("words") - size + 1), lambda first: F.array_join(F.slice(F.col("_words"), first, size), " ")),
        )
    )
    held = longer.select("lang", F.explode(pieces).alias("phrase"), F.col("a").alias("_a")).groupBy("lang", "phrase").agg(F.max("_a").alias("_a"))
    left_over = lowest.join(held, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("_a") < inside * F.col("a"), F.lit(True)))
    words = counts.filter("words = 0").select("lang", "n")
    return left_over.join(words, "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def mine(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, inside: int = INSIDE) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the collocations of ``docs`` (text, lang)."""
    given = _input(docs)
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = 1 << max(size // RANGE_BYTES, 1).bit_length()
    wanted = candidates(local_counts(given, longest, ranges), support)
    counts = written(counted(given, wanted, support, longest, ranges), "phrases")
    return scored(counts, support, longest, inside)


def ranked_phrases(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` rows of each language, with their rank."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = found.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
