"""Similarity join of texts on word shingles: a size-aware heavy-light join, exact up to hash clashes.

A text's set holds the 64-bit hashes of its distinct shingles; equal sets become one node. Two nodes
link when their Jaccard similarity reaches a threshold. That fixes, for two sizes, how many shingles
they must share, so:

* light sets (no larger than a boundary) enumerate their subsets of just that many shingles, for each
  partner size. Sets that meet in a subset are linked without looking at them again, by a star, so a
  group of any size gives as many links as it has rows;
* heavy sets put a prefix of their shingles into inverted lists, rare shingles first, as counted over all rows; what no other row
  has needs no list. Lists are scanned in rounds: members are compared with the list's leader, and what is linked becomes one component. When
  few pairs are left, every pair of a list that is in two components is compared, unless its bits, or the number and places
  of the lists that it shares, rule a link out. A set's bits tell, for each part of the range of hashes, whether
  it has an odd number there; where two sets differ in a bit, each such part holds a shingle that only one of them has. Groups
  of near copies collapse in the first rounds, and those of them that do not link differ in their bits while their lists
  are joined, so their pairs are never all made; no link between components is left out.

The boundary is the size at which the summed cost of both ways, taken from the counts of sizes, is least.
Counts are made by range of hash, and go back to the blocks of rows that sent the shingles, a block being what one task
reads; ranges follow the size of the texts. Results depend on the order only in that all sets have the same one. ``docs`` must come
in the same order at each reading, as tables in files do.

Defined results: texts without words (or null) have no shingles and link with nothing; fewer words than
a shingle make the whole sequence the only one; letters A-Z are lower-cased, nothing else; repeated
rows and repeated ids get a row each; a null id is carried and never chosen as a component's id while
another id is there; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from alertflow.llm.common import blocks, components, drop, groups, in_bitmap, parts, place_map, small_batches, written

WORDS = 5
#: Similarity as a fraction of whole numbers.
SHARE = (80, 100)
#: Bytes of text for which there is one range of hashes, and hashes a task holds before it hands them on.
RANGE_BYTES = 1 << 23
HELD = 1_000_000
#: No light boundary is looked for above this size; subsets grow too fast there.
LIGHT_MOST = 32
#: Cost of an entry of an inverted list against that of a subset: it is shuffled twice and compared.
ENTRY_COST = 4
#: Rounds with leaders go on while pairs of open lists are more than so many times their entries.
PAIRS_PER_ENTRY = 4
ROUNDS = 2
#: Places past the first possible one at which shared shingles are counted: more of them rule out more pairs
#: before their sets are compared, but make more rows for each pair. No link depends on it.
MORE_PLACES = 0
#: Numbers of 64 bits that tell sets apart. More of them rule out more pairs of large sets; no link depends on it.
MARKS = 16

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits (the finaliser of SplitMix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def odd_factors(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed)) | U(1)


def word_hashes(text: str) -> np.ndarray:
    """A hash for each word of a text, A-Z in lower case, from its bytes."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.zeros(0, U)
    letters = raw[inside].astype(U)
    letters[(letters >= 65) & (letters <= 90)] += U(32)
    first = np.cumsum(sizes) - sizes
    place = np.arange(len(letters)) - np.repeat(first, sizes)
    factors = odd_factors(int(sizes.max()), 1)
    return mix(np.add.reduceat((letters + U(1)) * factors[place], first) + sizes.astype(U))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted hashes of a text's distinct shingles."""
    found = word_hashes(text or "")
    if not len(found):
        return found
    width = min(words, len(found))
    factors = odd_factors(width, 2)
    total = np.zeros(len(found) - width + 1, U)
    for i in range(width):
        total += found[i : len(found) - width + 1 + i] * factors[i]
    return np.unique(mix(total + U(width)))


def needed(n: int, m: int, share: tuple[int, int] = SHARE) -> int:
    """Shingles that sets of these sizes share at least if they link: least i with i/(n+m-i) >= share."""
    a, b = share
    return -(-a * (n + m) // (a + b))


def prefix_size(n: int, share: tuple[int, int] = SHARE) -> int:
    return n + share[0] * n // -share[1] + 1


def partners(n: int, share: tuple[int, int] = SHARE) -> list[int]:
    """Sizes that a set of size ``n`` can link with."""
    sizes = range(1, n * share[1] // share[0] + 1)
    return [m for m in sizes if needed(n, m, share) <= min(n, m)]


def boundary(counts: dict[int, int], share: tuple[int, int] = SHARE) -> int:
    """The largest light size: the one with the least summed cost of subsets and list entries."""

    def cost(light: int) -> int:
        total = 0
        for n, rows in counts.items():
            subsets = sum(comb(n, needed(n, m, share)) for m in partners(n, share) if min(n, m) <= light)
            total += rows * (subsets + (ENTRY_COST * prefix_size(n, share) if n > light else 0))
        return total

    return min(range(LIGHT_MOST + 1), key=cost)


def marks(keys: np.ndarray) -> np.ndarray:
    """A bit for each part of the range of hashes, set where the set has an odd number of them, as ``MARKS`` numbers."""
    odd = np.bincount((keys >> U(64 - (64 * MARKS - 1).bit_length())).astype(np.int64), minlength=64 * MARKS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _longs(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)


def shared_levels(docs: DataFrame, words: int, ranges: int) -> DataFrame:
    """(block, range, keys, levels): the shingles of each block that more than one row has, with the logarithm of their count."""
    bits, most = max(ranges - 1, 1).bit_length(), HELD

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = block = 0

        def packed() -> pa.RecordBatch:
            # The highest bits name the range, the next 32 are the key in it.
            keys, n = np.unique(np.concatenate([*held, np.zeros(0, U)]) >> U(32 - bits), return_counts=True)
            held.clear()
            names, first = np.unique((keys >> U(32)).astype(np.int32), return_index=True)
            spans = list(itertools.pairwise([*first.tolist(), len(keys)]))
            short, few = keys.astype(np.uint32), np.minimum(n, 255).astype(np.uint8)
            columns = [
                pa.array(names), pa.array([block] * len(names), pa.int64()),
                pa.array([short[a:b].tobytes() for a, b in spans], pa.binary()), pa.array([few[a:b].tobytes() for a, b in spans], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["range", "block", "keys", "counts"])

        for batch in parts(batches):
            block = batch.column("block")[0].as_py()
            for text in batch.column("text").to_pylist():
                held.append(shingles(text, words))
                size += len(held[-1])
                if size >= most:
                    yield packed()
                    size = 0
        yield packed()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, "range"):
            sent = [np.frombuffer(k, np.uint32) for k in rows.column("keys").to_pylist()]
            keys, n = np.concatenate(sent), np.concatenate([np.frombuffer(c, np.uint8) for c in rows.column("counts").to_pylist()])
            order = np.argsort(keys, kind="stable")
            keys, n = keys[order], n[order].astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
            n = np.add.reduceat(n, first) if len(first) else n
            several = n > 1
            keys, levels = keys[first][several], np.minimum(np.log2(n[several]), 255).astype(np.uint8)
            found: dict[int, list] = {}
            for block, mine in zip(rows.column("block").to_pylist(), sent, strict=True):
                at = np.minimum(np.searchsorted(keys, mine), max(len(keys) - 1, 0))
                found.setdefault(block, []).append(at[keys[at] == mine] if len(keys) else at[:0])
            places = {block: np.unique(np.concatenate(parts)) for block, parts in found.items()}
            columns = [
                pa.array(list(places), pa.int64()), pa.array([rows.column("range")[0].as_py()] * len(places), pa.int32()),
                pa.array([keys[at].tobytes() for at in places.values()], pa.binary()), pa.array([levels[at].tobytes() for at in places.values()], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["block", "range", "keys", "levels"])

    sent = docs.select(block_of("row"), "text").mapInArrow(count, "range int, block long, keys binary, counts binary")
    return sent.repartition("range").sortWithinPartitions("range").mapInArrow(answer, "block long, range int, keys binary, levels binary")


def block_of(row: str) -> Column:
    """The rows that one task reads, from the number that ``monotonically_increasing_id`` gives."""
    return F.shiftright(row, 33).alias("block")


SET = "row long, node long, n long, keys array<long>, places array<int>, small array<long>, marks array<long>"


def _set_rows(docs: DataFrame, levels: DataFrame, words: int, share: tuple[int, int], ranges: int) -> DataFrame:
    """``SET`` with doc_id: the shared shingles of each document's prefix with their places, the whole set of a small one, and its bits."""
    most_small = LIGHT_MOST * share[1] // share[0]
    shift = U(32 - max(ranges - 1, 1).bit_length())
    texts = docs.select(block_of("row"), F.lit(None).cast("int").alias("range"), "row", "doc_id", "text")
    both = texts.unionByName(levels, allowMissingColumns=True)
    both = both.repartition("block").sortWithinPartitions("block", F.desc("range"))
    schema = StructType([*StructType.fromDDL(SET).fields, StructField("doc_id", docs.schema["doc_id"].dataType)])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, level, held = np.zeros(0, U), np.zeros(0, np.uint8), []
        for is_answer, batch in blocks(parts(batches), "range"):
            if is_answer:
                if not batch.num_rows:
                    known, level, held = np.zeros(0, U), np.zeros(0, np.uint8), [(np.zeros(0, U), np.zeros(0, np.uint8))]
                columns = (batch.column(c).to_pylist() for c in ("range", "keys", "levels"))
                for name, keys, of in zip(*columns, strict=True):
                    held.append((np.frombuffer(keys, np.uint32).astype(U) | U(name) << U(32), np.frombuffer(of, np.uint8)))
                continue
            if held:
                # Ranges come in descending order, and keys are sorted in each.
                known, level = (np.concatenate(part[::-1]) for part in zip(*held, strict=True))
                held = []
            node, n, keys_of, places_of, small, marks_of = [], [], [], [], [], []
            for text in batch.column("text").to_pylist():
                keys = shingles(text, words)
                n.append(len(keys))
                node.append(int(_longs(mix(mix(keys).sum(keepdims=True, dtype=U) + U(len(keys))))[0]) if len(keys) else None)
                small.append(_longs(keys) if len(keys) <= most_small else None)
                marks_of.append(marks(keys) if len(keys) else None)
                of = np.zeros(len(keys), np.int16)
                if len(known) and len(keys):
                    short = keys >> shift
                    at = np.minimum(np.searchsorted(known, short), len(known) - 1)
                    there = known[at] == short
                    # One that a single row has comes first, at level -1.
                    of = np.where(there, level[at].astype(np.int16), -1)
                else:
                    of -= 1
                first = np.lexsort((keys, of))[: prefix_size(len(keys), share)] if len(keys) else np.zeros(0, np.int64)
                places = np.flatnonzero(of[first] >= 0)
                keys_of.append(_longs(keys[first[places]]))
                places_of.append(places.astype(np.int32))
            arrays = [
                batch.column("row"), pa.array(node, pa.int64()), pa.array(n, pa.int64()), pa.array(keys_of, pa.list_(pa.int64())),
                pa.array(places_of, pa.list_(pa.int32())), pa.array(small, pa.list_(pa.int64())),
                pa.array(marks_of, pa.list_(pa.int64())), batch.column("doc_id"),
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return both.mapInArrow(build, schema)


def _light_links(sets: DataFrame, light: int, share: tuple[int, int]) -> DataFrame:
    """Links of all pairs whose smaller set is light: stars over sets that meet in a subset."""

    def subsets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for node, keys in zip(batch["node"], batch["small"], strict=True):
                keys = np.asarray(keys, np.int64).view(U)
                n, one, two = len(keys), mix(keys), mix(keys ^ U(0x9E3779B97F4A7C15))
                for m in partners(n, share):
                    if min(n, m) <= light:
                        for gone in combinations(range(n), n - needed(n, m, share)):
                            out = list(gone)
                            a, b = one.sum(dtype=U) - one[out].sum(dtype=U), two.sum(dtype=U) - two[out].sum(dtype=U)
                            rows.append((min(n, m), max(n, m), a.view(np.int64), b.view(np.int64), n <= m, node))
            yield pd.DataFrame(rows, columns=["low", "high", "a", "b", "is_low", "node"])

    largest = light * share[1] // share[0]
    small = sets.filter((F.col("n") > 0) & (F.col("n") <= largest)).select("node", "small").dropDuplicates(["node"])
    met = small.mapInPandas(subsets, "low int, high int, a long, b long, is_low boolean, node long")
    keys = ["low", "high", "a", "b"]
    stars = met.groupBy(*keys).agg(
        F.min(F.when(F.col("is_low"), F.col("node"))).alias("first_low"),
        F.min(F.when(~F.col("is_low") | (F.col("low") == F.col("high")), F.col("node"))).alias("first_high"),
    )
    stars = stars.filter("first_low IS NOT NULL AND first_high IS NOT NULL")
    linked = met.join(stars, keys)
    other = F.when(F.col("is_low"), F.col("first_high")).otherwise(F.col("first_low"))
    return linked.select(F.col("node").alias("src"), other.alias("dst")).filter("src <> dst")


def _whole_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, set) for the ``wanted`` (node, row), worked out from their texts again."""
    place, bits = place_map("row", wanted)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            some = batch.filter(pa.array(in_bitmap(bits.value, batch.column("place").to_numpy().astype(U))))
            sets = [shingles(text, words).tobytes() for text in some.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([some.column("row"), pa.array(sets, pa.binary())], ["row", "set"])

    found = docs.select("row", "text", place).mapInArrow(whole, "row long, set binary")
    return found.join(wanted, "row").select("node", "set")


def _verified(pairs: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """The pairs (src, dst, low, high) that link, by counting what their whole sets share."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = []
            for one, two in zip(batch["one"], batch["two"], strict=True):
                a, b = np.frombuffer(one, U), np.frombuffer(two, U)
                both = len(np.intersect1d(a, b, assume_unique=True))
                good.append(both * share[1] >= share[0] * (len(a) + len(b) - both))
            yield batch.loc[np.array(good, bool), ["src", "dst", "low", "high"]]

    one = sets.select(F.col("node").alias("src"), F.col("set").alias("one"))
    two = sets.select(F.col("node").alias("dst"), F.col("set").alias("two"))
    return pairs.join(one, "src").join(two, "dst").mapInPandas(check, "src long, dst long, low long, high long")


def _met_early(met: DataFrame, share: tuple[int, int], more: int) -> DataFrame:
    """The rows of ``met`` whose shared shingle stands early enough in both sets, with the smaller node first.

    Sets that link share at least so many shingles that the first lies no later than what they may lack
    of each other. Shingles up to ``more`` places later are counted too; ``after`` is what can be shared
    past the places that count.
    """
    a, b = share
    n, m, i, j = (F.col(c) for c in ("n", "m", "i", "j"))
    turned = F.col("a") > F.col("b")
    least = F.ceil((n + m) * a / (a + b))

    def counted(size: Column) -> Column:
        return F.least(size - F.ceil(size * a / b) + 1, size - least + 1 + more)

    early = met.filter((F.least(n, m) * b >= F.greatest(n, m) * a) & (i < counted(n)) & (j < counted(m)))
    return early.select(
        F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"), "low", "high",
        *(F.when(turned, F.col(y)).otherwise(F.col(x)).alias(x) for x, y in (("n", "m"), ("i", "j"))),
        *(F.when(turned, F.col(x)).otherwise(F.col(y)).alias(y) for x, y in (("n", "m"), ("i", "j"))),
        F.greatest(n - counted(n), m - counted(m)).alias("after"),
    )


def _possible(met: DataFrame, share: tuple[int, int], more: int = MORE_PLACES) -> DataFrame:
    """Distinct pairs (src, dst, low, high) of ``met`` (a, n, i, b, m, j per shared list, and their components) that may link.

    After the last list that two sets share, at places i and j, they can share no more than what is left
    of either; and past the places that count, no more than ``after``.
    """
    a, b = share
    n, m, i, j = (F.col(c) for c in ("n", "m", "i", "j"))
    counted = _met_early(met, share, more).groupBy("src", "dst").agg(
        F.count(F.lit(1)).alias("both"), F.first("n").alias("n"), F.first("m").alias("m"),
        F.max("i").alias("i"), F.max("j").alias("j"), F.first("after").alias("after"), F.first("low").alias("low"), F.first("high").alias("high"),
    )
    most = F.col("both") + F.least(n - i - 1, m - j - 1, "after")
    return counted.filter(most * (a + b) >= (n + m) * a).select("src", "dst", "low", "high")


def _differ(one: str, two: str) -> Column:
    """How many bits differ between two columns of ``marks``: so many shingles at least are in one of both sets only."""
    return reduce(Column.__add__, (F.bit_count(F.col(one)[i].bitwiseXOR(F.col(two)[i])) for i in range(MARKS)))


def _pair(one: str, two: str) -> list[Column]:
    return [F.least(one, two).alias("low"), F.greatest(one, two).alias("high")]


def _heavy_links(docs: DataFrame, sets: DataFrame, light: int, words: int, share: tuple[int, int], known: DataFrame) -> DataFrame:
    """Links that join all heavy sets which link, the ``known`` ones included."""
    heavy = sets.filter(F.col("n") > light)
    entries = heavy.select("node", F.col("n").cast("int").alias("n"), F.explode(F.arrays_zip("places", "keys")).alias("e"))
    # Equal sets have equal entries, which combine before they are shuffled.
    entries = entries.groupBy(F.col("e.keys").alias("key"), "node").agg(F.min("n").alias("n"), F.min("e.places").alias("at"))
    entries = written(entries, "entries")
    shared = entries.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi").select("key")
    label = components(known).select("node", F.col("component").alias("_component"))
    listed = entries.join(shared, "key").join(label, "node", "left")
    members = written(listed.select("key", "node", "n", "at", F.coalesce("_component", "node").alias("component")), "members")
    drop(entries)
    rows = written(heavy.groupBy("node").agg(F.min("row").alias("row")), "rows")

    links, compared, turn = [known], [], 0
    while True:
        split = members.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        open_lists = written(members.join(split.filter("lo <> hi").select("key"), "key"), "open")
        drop(members)
        parts = open_lists.groupBy("key", "component").agg(F.count(F.lit(1)).alias("rows"))
        lists = parts.groupBy("key").agg(F.max_by("component", "rows").alias("main"), F.max("rows").alias("most"), F.sum("rows").alias("rows"))
        lists = written(lists, "sizes")
        work = lists.agg(F.sum((F.col("rows") - F.col("most")) * F.col("rows")), F.sum("rows")).first()
        last = not work[0] or work[0] <= PAIRS_PER_ENTRY * work[1] or turn == ROUNDS
        if last:
            marks_of = rows.join(heavy.select("row", "marks"), "row").select("node", "marks")
            marked = written(open_lists.join(lists.select("key", "main"), "key").join(marks_of, "node"), "marked")
            others = marked.filter("component <> main").select(
                "key", F.col("node").alias("a"), "n", F.col("at").alias("i"), F.col("component").alias("mine"), F.col("marks").alias("one")
            )
            theirs = marked.select(
                "key", F.col("node").alias("b"), F.col("n").alias("m"), F.col("at").alias("j"), "component",
                (F.col("component") == F.col("main")).alias("is_main"), F.col("marks").alias("two"),
            )
            # Sets share at most half of what is left of both sizes without the shingles that one of them has alone.
            sizes = F.col("n") + F.col("m")
            shared_enough = (sizes - _differ("one", "two")) * sum(share) >= sizes * (2 * share[0])
            met = others.join(theirs, "key").filter(
                (F.col("mine") != F.col("component")) & (F.col("is_main") | (F.col("a") < F.col("b"))) & shared_enough
            )
            met = met.select("a", "n", "i", "b", "m", "j", *_pair("mine", "component"))
        else:
            chosen = F.xxhash64("node", F.lit(turn))
            lead = open_lists.groupBy("key").agg(F.min_by(F.struct("node", "n", "at", "component"), chosen).alias("lead"))
            met = open_lists.join(lead, "key").filter(F.col("component") != F.col("lead.component")).select(
                F.col("node").alias("a"), "n", F.col("at").alias("i"), F.col("lead.node").alias("b"), F.col("lead.n").alias("m"),
                F.col("lead.at").alias("j"), *_pair("component", "lead.component"),
            )
        pairs = _possible(met, share)
        for before in compared:
            pairs = pairs.join(before.select("src", "dst"), ["src", "dst"], "left_anti")
        pairs = written(pairs, "pairs")
        ends = pairs.select(F.col("src").alias("node")).unionByName(pairs.select(F.col("dst").alias("node"))).distinct()
        wanted = written(ends.join(rows, "node"), "wanted")
        whole = written(_whole_sets(docs, wanted, words), "sets")
        found = written(_verified(pairs, whole, share), "links")
        drop(wanted, whole, lists)
        links.append(found.select("src", "dst"))
        compared.append(pairs)
        turn += 1
        if last:
            drop(open_lists, rows, marked, *compared)
            return reduce(DataFrame.unionByName, links)
        # Components grow together by the new links alone.
        step = components(found.select(F.col("low").alias("src"), F.col("high").alias("dst")))
        step = step.select(F.col("node").alias("component"), F.col("component").alias("_next"))
        members = open_lists.join(step, "component", "left").withColumn("component", F.coalesce("_next", "component")).drop("_next")
        members = written(members, "members")
        drop(open_lists)


def _components(docs: DataFrame, words: int, share: tuple[int, int]) -> DataFrame:
    """(row, doc_id, n_shingles, component) of ``docs`` (row, doc_id, text); texts without words have none."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = 1 << max(size // RANGE_BYTES, 1).bit_length()
    sets = written(_set_rows(docs, shared_levels(docs, words, ranges), words, share, ranges), "shingles")
    # Sizes above the bound have no part in the boundary: they are heavy at any of them.
    most = LIGHT_MOST * share[1] // share[0]
    sizes = sets.filter((F.col("n") > 0) & (F.col("n") <= most)).groupBy("n").count().collect()
    light = boundary({row["n"]: row["count"] for row in sizes}, share)
    known = written(_light_links(sets, light, share), "links")
    joined = components(_heavy_links(docs, sets, light, words, share, known)).select("node", "component")
    placed = sets.select("row", "doc_id", "node", F.col("n").alias("n_shingles")).join(joined, "node", "left")
    placed = placed.select("row", "doc_id", "n_shingles", F.coalesce("component", "node").alias("component"))
    placed = written(placed, "placed")
    drop(sets, known)
    return placed


def join_similar(docs: DataFrame, words: int = WORDS, share: tuple[int, int] = SHARE) -> DataFrame:
    """(doc_id, n_shingles, component_id): each document's component under links of similar sets."""
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    with small_batches(docs.sparkSession):
        placed = _components(numbered, words, share)
    smallest = placed.filter(F.col("component").isNotNull()).groupBy("component")
    named = placed.join(smallest.agg(F.min("doc_id").alias("_first")), "component", "left")
    return named.select("doc_id", "n_shingles", F.coalesce("_first", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, words: int = WORDS, share: tuple[int, int] = SHARE) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id (the first of its rows).

    Texts without words are no copies of each other and all stay.
    """
    packed = docs.select(F.struct(*docs.columns).alias("doc"), F.monotonically_increasing_id().alias("row"))
    with small_batches(docs.sparkSession):
        placed = _components(packed.select("row", "doc.doc_id", "doc.text"), words, share)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("first")
    firsts = placed.filter(F.col("component").isNotNull()).groupBy("component").agg(first).select("first.row")
    stay = firsts.unionByName(placed.filter(F.col("component").isNull()).select("row"))
    return packed.join(stay, "row", "left_semi").select("doc.*")
