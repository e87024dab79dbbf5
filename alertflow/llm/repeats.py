"""Repeated byte strings: bytes covered by a string of ``LENGTH`` bytes that also starts elsewhere are removed.

Every window of that length is named by its smallest ``GRAM``-byte hash, the leftmost on ties. Equal windows have equal
names, so only windows of one name need be compared:

* neighbouring windows with one name and place are a segment of at most 2 * ``LENGTH`` - ``GRAM`` bytes. Names that occur once are no
  repeat, and equal segments repeat whole;
* the different segments of a name meet in a shard. Windows that longer grams, halfway to ``LENGTH``, give a name of
  their own there are left out. Of the others the suffix array is made by induced sorting, and its permuted common
  prefixes tell which windows stand twice. A shard holds whole names up to ``SHARD_BYTES``; a name
  with more segments is dealt over several shards, and windows that no shard repeats are matched
  between these by digest.

Names first go through a map of ``BITS`` places that rules out most of those that occur once; a full map lets all
pass, and the exact counts decide. Digests have 128 bits of BLAKE2.

Defined results: null texts are empty; texts shorter than ``LENGTH`` stay whole; repeated rows are copies of each other and
go; ids may be null or repeated, each row is its own; other columns are ignored; an empty table gives no rows. Texts
are worked on in overlapping parts, so a long one is not held in more than its own bytes. ``docs`` must come
in the same order at each reading, as tables in files do.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from alertflow.llm.common import bitmap, drop, groups, in_bitmap, written
from alertflow.llm.jaccard import mix, odd_factors
from alertflow.llm.suffixes import common_prefixes, suffix_array

LENGTH = 200
GRAM = 64
#: Bytes of text worked on at once; places in it take ``PLACE_BITS``.
CHUNK = 1 << 20
PLACE_BITS = 24
BITS = 1 << 26
#: Places hashed at once.
PLACES = 1 << 14
SHARD_BYTES = 1 << 20
#: Segments of one name in a shard.
SEGMENTS = 2048
ROWS_AT_ONCE = 20_000

U = np.uint64
_PLACE = U((1 << PLACE_BITS) - 1)


def gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes (a multiple of 8) from each place."""
    n = len(raw) - gram + 1
    eight = np.ndarray((len(raw) - 7,), "<u8", np.ascontiguousarray(raw).data, strides=(1,))
    factors = odd_factors(gram // 8, 5)
    out = np.empty(n, U)
    # Eight bytes are mixed once for all places that they are part of, a few places at a time, which stay in the cache.
    for low in range(0, n, PLACES):
        size = min(PLACES, n - low)
        mixed = mix(eight[low : low + size + gram - 8])
        total, part = np.zeros(size, U), np.empty(size, U)
        for i, factor in enumerate(factors):
            total += np.multiply(mixed[8 * i : 8 * i + size], factor, out=part)
        out[low : low + size] = mix(total)
    return out


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, from the least of 2, 4, 8 and so on."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[: len(values) - rest], values[rest:])


def parts(texts: list[bytes | None], length: int, chunk: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """(row, start, bytes) of long enough texts, about ``chunk`` bytes at a time; parts overlap, so each window is in one."""
    rows, starts, held, size = [], [], [], 0
    for row, text in enumerate(texts):
        for start in range(0, len(text or b"") - length + 1, chunk):
            rows.append(row)
            starts.append(start)
            held.append(text[start : start + chunk + length - 1])
            size += len(held[-1])
            if size >= chunk:
                yield rows, starts, held
                rows, starts, held, size = [], [], [], 0
    if rows:
        yield rows, starts, held


def segments(held: list[bytes], length: int, gram: int = GRAM) -> tuple[memoryview, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, part, start in the buffer, windows, name) of the segments of some parts."""
    buffer = b"".join(held)
    raw = np.frombuffer(buffer, np.uint8)
    hashes = gram_hashes(raw, gram)
    placed = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=U)
    least = least_of(placed, length - gram + 1)
    sizes = np.array([len(part) for part in held])
    ends = np.cumsum(sizes)
    valid = np.ones(len(least) + 1, bool)
    for end in ends.tolist():
        valid[end - length + 1 : end] = False
    valid[-1] = False
    valid, last = valid[:-1], valid
    new = valid.copy()
    new[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    starts = np.flatnonzero(new)
    # A segment ends where the next begins, or before the first place without a window.
    stops = np.flatnonzero(~last)
    end = np.minimum(np.append(starts[1:], len(least)), stops[np.searchsorted(stops, starts)])
    names = hashes[(least[starts] & _PLACE).astype(np.int64)]
    return memoryview(buffer), np.searchsorted(ends, starts, "right"), starts, end - starts, names


def _slots(names: np.ndarray) -> np.ndarray:
    # Names are the least of many hashes, so they are spread again.
    return mix(names) >> U(64 - BITS.bit_length() + 1)


def repeated_names(docs: DataFrame, length: int) -> np.ndarray:
    """A map of the names that occur twice or share their place with another."""
    chunk = CHUNK

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, held in parts(batch.column("text").to_pylist(), length, chunk):
                slots, n = np.unique(_slots(segments(held, length)[4]).astype(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(np.minimum(n, 2).astype(np.int8))], ["slot", "n"])

    counted = docs.select("text").mapInArrow(found, "slot long, n byte").groupBy("slot").agg(F.sum("n").alias("n"))
    return bitmap(counted.filter("n > 1").select("slot"), "slot", BITS)


ANCHOR = "row long, start long, windows int, name long, d1 long, d2 long"


def anchors(docs: DataFrame, length: int, known: np.ndarray) -> DataFrame:
    """(row, start, windows, name, d1, d2) of the segments whose names are in the map."""
    shared, chunk = docs.sparkSession.sparkContext.broadcast(known), CHUNK

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column("row").to_numpy()
            for rows, begins, held in parts(batch.column("text").to_pylist(), length, chunk):
                buffer, part, starts, windows, names = segments(held, length)
                some = in_bitmap(shared.value, _slots(names))
                part, starts, windows, names = part[some], starts[some], windows[some], names[some]
                ends = starts + windows + length - 1
                digests = b"".join(
                    blake2b(buffer[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)
                )
                first = np.concatenate([[0], np.cumsum([len(p) for p in held])[:-1]])
                pair = np.frombuffer(digests, np.int64).reshape(-1, 2)
                columns = [
                    numbers[np.array(rows)[part]], starts - first[part] + np.array(begins)[part], windows.astype(np.int32),
                    names.view(np.int64), pair[:, 0].copy(), pair[:, 1].copy(),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [c.split()[0] for c in ANCHOR.split(", ")])

    return docs.select("row", "text").mapInArrow(found, ANCHOR)


def _cut_out(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(key, name, kind, bytes): the bytes of the ``wanted`` (row, start, windows, key, name, kind) segments."""
    grouped = wanted.groupBy("row").agg(F.collect_list(F.struct("start", "windows", "key", "name", "kind")).alias("cuts"))
    joined = _apart(docs, wanted.select("row"))[0].join(grouped, "row").select("text", "cuts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, cuts = batch.column("text").to_pylist(), batch.column("cuts")
            flat = cuts.flatten()
            owner = np.repeat(np.arange(len(cuts)), cuts.value_lengths().to_numpy(zero_copy_only=False))
            start, windows = flat.field("start").to_pylist(), flat.field("windows").to_pylist()
            for low in range(0, len(owner), 50_000):
                some = slice(low, low + 50_000)
                body = [texts[o][a : a + w + length - 1] for o, a, w in zip(owner[some].tolist(), start[some], windows[some], strict=True)]
                columns = [flat.field(c)[some] for c in ("key", "name", "kind")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(body, pa.binary())], ["key", "name", "kind", "bytes"])

    return joined.mapInArrow(cut, f"key string, name long, kind {KIND}, bytes binary")


#: What tells the different segments of a name apart, how many shards the name is dealt over, and whether the segment
#: stands once.
KIND = "struct<d1:long,d2:long,shards:int,alone:boolean>"
RANGE = "name long, d1 long, d2 long, offset int, count int"
WINDOW_RANGE = f"{RANGE}, w1 long, w2 long, shard string"


def _in_shard(bodies: list[bytes], length: int) -> list[np.ndarray]:
    """For each segment of a shard, which of its windows stand elsewhere in the shard."""
    # Named once more by longer grams: windows whose name is given once in the shard are no repeat and need not be sorted.
    whole = b"".join(bodies)
    at = np.cumsum([0, *(len(b) for b in bodies)])
    named = []
    for rows, begins, held in parts(bodies, length, CHUNK):
        _, part, starts, windows, names = segments(held, length, (GRAM + length) // 16 * 8)
        first = at[rows] + begins - np.cumsum([0, *(len(p) for p in held[:-1])])
        named.append((first[part] + starts, windows, names))
    starts, windows, names = (np.concatenate(c) for c in zip(*named, strict=True))
    _, which, given = np.unique(names, return_inverse=True, return_counts=True)
    again = given[which] > 1
    step = np.zeros(len(whole) + 1, np.int8)
    step[starts[again]] += 1
    step[(starts + windows)[again]] -= 1
    runs = _runs(np.cumsum(step[:-1], dtype=np.int8) > 0)
    out = np.zeros(len(whole), bool)
    if runs:
        found = _sorted_repeats([whole[a : a + n + length - 1] for a, n in runs], length)
        for (a, n), marks in zip(runs, found, strict=True):
            out[a : a + n] = marks
    return [out[a : b - length + 1] for a, b in itertools.pairwise(at.tolist())]


def _sorted_repeats(bodies: list[bytes], length: int) -> list[np.ndarray]:
    """For each of these byte strings, which of its windows stand elsewhere in them, by a suffix array of all."""
    # Bytes from 2 on, 1 between segments, 0 at the end.
    s = np.frombuffer(b"\x00".join(bodies) + b"\x00\x00", np.uint8).astype(np.int16) + np.int16(2)
    ends = np.cumsum([len(b) + 1 for b in bodies])
    s[ends - 1] = 1
    s[-1] = 0
    sa = suffix_array(s)
    long = common_prefixes(s, sa) >= length
    with_last = sa[np.flatnonzero(long[sa])[:, None] - 1].ravel()
    long[with_last] = True
    starts = ends - [len(b) + 1 for b in bodies]
    return [long[a : a + len(b) - length + 1] for a, b in zip(starts.tolist(), bodies, strict=True)]


def _runs(marks: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], marks, [False]]).astype(np.int8)))
    return list(zip(edges[::2].tolist(), (edges[1::2] - edges[::2]).tolist(), strict=True))


def repeated_in_shards(cut: DataFrame, length: int) -> DataFrame:
    """Ranges of windows that a shard repeats (w1 null), and digests of windows where a name has several shards.

    A digest has a count of 1 for a window that no shard has repeated yet, of 0 for one that others may meet.
    """
    most = SHARD_BYTES

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def packed(out: list[tuple]) -> pa.RecordBatch:
            names = [c.split()[0] for c in WINDOW_RANGE.split(", ")]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
            columns = list(zip(*out, strict=True)) if out else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        def flushed() -> Iterator[pa.RecordBatch]:
            out: list[tuple] = []
            targets: set[tuple] = set()
            for (name, kind, body, key), marks in zip(held, _in_shard([h[2] for h in held], length) if held else [], strict=True):
                here = (name, kind["d1"], kind["d2"])
                if kind["alone"]:
                    out += [(*here, offset, count, None, None, None) for offset, count in _runs(marks)]
                if kind["shards"] > 1:
                    for i, marked in enumerate(marks.tolist()):
                        w1, w2 = np.frombuffer(blake2b(body[i : i + length], digest_size=16).digest(), np.int64).tolist()
                        if kind["alone"] and not marked:
                            out.append((*here, i, 1, w1, w2, key))
                        elif (key, w1, w2) not in targets:
                            # What is known to repeat only has to be met by windows of other shards.
                            targets.add((key, w1, w2))
                            out.append((*here, i, 0, w1, w2, key))
                if len(out) > ROWS_AT_ONCE:
                    yield packed(out)
                    out = []
            yield packed(out)

        for rows in groups(batches, "key"):
            held += zip(*(rows.column(c).to_pylist() for c in ("name", "kind", "bytes", "key")), strict=True)
            size += rows.column("bytes").nbytes
            if size >= most:
                yield from flushed()
                held, size = [], 0
        yield from flushed()

    return cut.repartition("key").sortWithinPartitions("key").mapInArrow(search, WINDOW_RANGE)


def repeated_windows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(row, start, count): runs of windows of ``docs`` (row, text as binary) that also start elsewhere."""
    found = written(anchors(docs, length, repeated_names(docs, length)), "anchors")
    here = F.struct("row", "start", "windows")
    kinds = written(found.groupBy("name", "d1", "d2").agg(F.count(F.lit(1)).alias("n"), F.min(here).alias("at")), "kinds")
    # Segments that stand more than once repeat whole; a name needs a shard for those that stand alone.
    several = kinds.groupBy("name").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).filter("kinds > 1 AND least = 1")
    shards = F.ceil(F.col("kinds") / SEGMENTS).cast("int").alias("shards")
    wanted = kinds.join(several, "name").select("at.*", "name", "d1", "d2", shards, (F.col("n") == 1).alias("alone"))
    wanted = written(wanted, "wanted")
    # A key names a shard of a name; the digest deals its segments.
    key = F.concat_ws(":", F.col("name").cast("string"), F.pmod("d2", "shards").cast("string")).alias("key")
    cut = _cut_out(docs, wanted.select("row", "start", "windows", key, "name", F.struct("d1", "d2", "shards", "alone").alias("kind")), length)
    ranges = written(repeated_in_shards(cut, length), "ranges")
    across = ranges.filter("w1 IS NOT NULL")
    met = across.groupBy("name", "w1", "w2").agg(F.min("shard").alias("lo"), F.max("shard").alias("hi")).filter("lo <> hi")
    between = across.filter("count > 0").join(met.select("name", "w1", "w2"), ["name", "w1", "w2"])
    between = between.select("name", "d1", "d2", "offset", "count")
    whole = kinds.filter("n > 1").select("name", "d1", "d2", F.lit(0).alias("offset"), F.col("at.windows").alias("count"))
    parts_of = ranges.filter("w1 IS NULL").select("name", "d1", "d2", "offset", "count").unionByName(between)
    marked = found.join(parts_of.unionByName(whole), ["name", "d1", "d2"]).select("row", (F.col("start") + F.col("offset")).alias("start"), "count")
    marked = written(marked, "windows")
    for table in (found, kinds, wanted, ranges):
        drop(table)
    return marked


def _apart(docs: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` whose row may be in ``rows``, and those whose row is surely not; the map has a fixed size."""
    slot = F.pmod(F.xxhash64("row"), F.lit(BITS)).alias("slot")
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(rows.select(slot), "slot", BITS))

    @F.pandas_udf("boolean")
    def known(slots: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(shared.value, slots.to_numpy(U)))

    marked = docs.withColumn("_known", known(slot))
    return marked.filter("_known").drop("_known"), marked.filter("NOT _known").drop("_known")


def _take_out(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, spans = [], []
            for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                merged: list[dict] = []
                for run in runs or ():
                    start, end = run["start"], run["start"] + run["count"] + length - 1
                    if merged and start <= merged[-1]["end"]:
                        merged[-1]["end"] = max(merged[-1]["end"], end)
                    else:
                        merged.append({"start": start, "end": end})
                edges = [0, *(edge for span in merged for edge in (span["start"], span["end"])), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                spans.append(merged)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            columns = [batch.column("doc"), batch.column("text"), pa.array(kept, pa.binary()), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "text", "kept", "removed"])

    return run


SPANS = "array<struct<start:long,end:long>>"


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, kept, removed, n_bytes): the other columns of ``docs`` as a struct, the bytes that stay, the runs that go."""
    others = [c for c in docs.columns if c != "text"]
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.struct(*others).alias("doc"), F.coalesce("text", F.lit("")).cast("binary").alias("text")
    )
    marked = repeated_windows(numbered.select("row", "text"), length)
    spans = marked.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "count"))).alias("runs"))
    some, none = _apart(numbered, marked.select("row"))
    schema = StructType().add("doc", numbered.schema["doc"].dataType).add("text", "binary").add("kept", "binary")
    schema.add("removed", numbered.sparkSession.range(0).select(F.lit(None).cast(SPANS).alias("removed")).schema["removed"].dataType)
    cut = some.join(spans, "row", "left").select("doc", "text", "runs").mapInArrow(_take_out(length), schema)
    whole = none.select("doc", "text", F.col("text").alias("kept"), F.array().cast(SPANS).alias("removed"))
    return cut.unionByName(whole).select("doc", "kept", "removed", F.octet_length("text").cast("long").alias("n_bytes"))
