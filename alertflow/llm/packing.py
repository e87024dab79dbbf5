"""Best-fit packing of tokenised documents into sequences of fixed length.

Documents are tokenised, only longer ones are cut, and pieces are packed by length. Lengths are whole
numbers up to the capacity, so an instance of any size is a histogram with at most ``capacity`` numbers;
that is all the driver sees. On it, Martello and Toth's dominance rules fix sets of one, two or three
pieces that are at least as good as any other set with the same largest piece, many at once; the rest is
packed best fit, longest first. The plan comes back as runs: the pieces of one length with ranks from a
to b go to so many sequences at one offset. Ranks are counted in Spark without gathering a length.

Defined results: null and empty texts are the end token alone; repeated rows are packed each, and ids, null ones too, come back as
they are; long texts are tokenised whole, and so held by one task; ties of length are ordered by place in the written table; other columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from alertflow.llm.common import ranked

CAPACITY = 2048
END_TOKEN = 0
#: Words whose ids a task remembers before it starts anew, and characters it splits at a time.
HELD_WORDS = 300_000
CHARS_AT_ONCE = 1_000_000

# Pieces of Latin-1 text that the tokenizer treats one by one: contractions, runs of letters, single digits,
# runs of other signs. Texts with any other character go through the tokenizer whole.
LATIN = [chr(c) for c in range(256)]
LETTERS = "".join(c for c in LATIN if c.isalpha())
NUMBERS = "".join(re.escape(c) for c in LATIN if c.isnumeric())
SPACES = r"\t\n\x0b\x0c\r \x85\xa0"
PIECES = re.compile(f"[{LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")
ODD = re.compile(r"[\x1c-\x1f]|<\|")


class WordIds:
    """Ids of texts as little-endian bytes, by the tokenizer, with a memory of words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.path, self.tokenizer, self.known = path, Tokenizer.from_file(path), {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        split: list[list[str] | None] = []
        for text in texts:
            try:
                text.encode("latin-1")
                split.append(None if ODD.search(text) else PIECES.findall(text.lower()))
            except UnicodeEncodeError:
                split.append(None)
        known = self.known
        if len(known) > HELD_WORDS:
            known.clear()
        new = list({word for words in split if words for word in words if word not in known})
        parts = [new[start : start + 2_000] for start in range(0, len(new), 2_000)]
        coded = self.tokenizer.encode_batch_fast([" ".join(part) for part in parts], add_special_tokens=False)
        for part, found in zip(parts, coded, strict=True):
            ids = np.asarray(found.ids, "<u4")
            ends = (4 * (np.flatnonzero(self.ends_word[ids]) + 1)).tolist()
            if len(ends) != len(part):
                known.update((word, self._whole(word)) for word in part)
                continue
            raw, start = ids.tobytes(), 0
            for word, end in zip(part, ends, strict=True):
                known[word] = raw[start:end]
                start = end
        return [
            self._whole(text) if words is None else b"".join(map(known.__getitem__, words))
            for text, words in zip(texts, split, strict=True)
        ]


_loaded: list[WordIds] = []


def tokenised(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces (doc_id, piece, start, length, ids_crc32) of all documents, and ``ids`` if asked for."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _loaded or _loaded[0].path != path:
            _loaded[:] = [WordIds(path)]
        end = np.asarray([END_TOKEN], "<u4").tobytes()
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            share = np.cumsum([len(text) for text in texts]) // CHARS_AT_ONCE
            cuts = [0, *(np.flatnonzero(np.diff(share)) + 1).tolist(), len(texts)]
            coded = (ids for a, b in zip(cuts, cuts[1:], strict=False) for ids in _loaded[0].encode(texts[a:b]))
            row_of, piece_of, start_of, length_of, sums, parts = [], [], [], [], [], []
            for row, ids in enumerate(coded):
                ids += end
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[start : start + 4 * capacity]
                    row_of.append(row)
                    piece_of.append(piece)
                    start_of.append(start // 4)
                    length_of.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
                    if with_ids:
                        parts.append(part)
            # Ids go along as they are: a column with a null among large ids would not come back the same from pandas.
            columns = [batch.column("doc_id").take(pa.array(row_of, pa.int64())), pa.array(piece_of, pa.int32())]
            columns += [pa.array(values, pa.int64()) for values in (start_of, length_of, sums)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(parts, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    schema = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), *StructType.fromDDL(schema).fields])
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


@dataclass(frozen=True)
class Run:
    """``bins`` sequences from ``base`` each hold one piece of ``length`` at ``offset``, by rank from ``rank``."""

    length: int
    rank: int
    bins: int
    base: int
    offset: int


class Plan:
    """Takes pieces out of a histogram into sequences, many alike at once."""

    def __init__(self, counts: np.ndarray, capacity: int):
        self.left = counts.astype(np.int64).copy()
        self.taken = np.zeros_like(self.left)
        self.capacity, self.bins = capacity, 0
        self.runs: list[Run] = []

    def place(self, length: int, base: int, bins: int, offset: int) -> None:
        self.runs.append(Run(length, int(self.taken[length]), bins, base, offset))
        self.taken[length] += bins
        self.left[length] -= bins

    def fill(self, lengths: tuple[int, ...], bins: int) -> int:
        """``bins`` new sequences with one piece of each length; their first number."""
        base, offset = self.bins, 0
        for length in lengths:
            self.place(length, base, bins, offset)
            offset += length
        self.bins += bins
        return base


def dominant(lengths: np.ndarray, left: np.ndarray, capacity: int, length: int) -> tuple[int, ...] | None:
    """A set with the piece ``length`` that dominates every other such set, by Martello and Toth's rules.

    ``lengths`` are those with pieces left, ascending. Alone, if nothing else fits; with the largest
    second piece that fits, if that fills the sequence, if no two others fit, or if the best two together
    are no longer than it (no three others fitting); with the largest second and a third that no other
    pair's smaller piece exceeds (no three others fitting).
    """
    left[length] -= 1
    try:
        rest = lengths[left[lengths] > 0]
        room = capacity - length
        smallest = int(rest[0]) if len(rest) else capacity + 1
        if smallest > room:
            return (length,)
        second = int(rest[np.searchsorted(rest, room, "right") - 1])
        if second == room:
            return (length, second)
        low = rest[:3]
        least = np.repeat(low, np.minimum(left[low], 3))
        if len(least) < 2 or least[0] + least[1] > room:
            return (length, second)
        if len(least) > 2 and least[:3].sum() <= room:
            return None
        # For each longer piece of a pair, the largest other one that fits beside it.
        fit = np.searchsorted(rest, np.minimum(room - rest, rest), "right") - 1
        other = np.where(fit >= 0, rest[np.maximum(fit, 0)], 0)
        twice = (other == rest) & (left[rest] < 2)
        lower = np.where(fit > 0, rest[np.maximum(fit - 1, 0)], 0)
        other = np.where(twice, lower, other)
        pair = np.where(other > 0, rest + other, 0)
        if second >= pair.max():
            return (length, second)
        third = int(other[rest == second][0])
        if third > 0 and third >= other.max():
            return (length, second, third)
        return None
    finally:
        left[length] += 1


def reduce_dominated(plan: Plan) -> int:
    """Fix dominating sets, largest piece first; sequences fixed.

    A length for which no rule says anything is left as it is, and the next one is examined.
    """
    before = plan.bins
    for length in range(plan.capacity, 0, -1):
        while plan.left[length]:
            chosen = dominant(np.flatnonzero(plan.left), plan.left, plan.capacity, length)
            if chosen is None:
                break
            uses = {piece: chosen.count(piece) for piece in chosen}
            times = min(int(plan.left[piece]) // n for piece, n in uses.items())
            # While three of a length are left, what the rules for three look at stays the same.
            plan.fill(chosen, max(1, times if len(chosen) < 3 else times - 3))
    return plan.bins - before


def best_fit(plan: Plan) -> None:
    """Best fit, longest first: each piece goes where the least room is left that holds it."""
    rooms: dict[int, list[tuple[int, int]]] = {}
    for length in range(plan.capacity, 0, -1):
        while plan.left[length] > 0:
            count = int(plan.left[length])
            room = min((r for r, held in rooms.items() if r >= length and held), default=None)
            if room is None:
                each = min(plan.capacity // length, count)
                bins = count // each
                base = plan.fill((length,) * each, bins)
                rooms.setdefault(plan.capacity - each * length, []).append((base, bins))
                continue
            base, bins = rooms[room].pop()
            each = min(room // length, count)
            used = min(bins, count // each)
            for k in range(each):
                plan.place(length, base, used, plan.capacity - room + k * length)
            rooms.setdefault(room - each * length, []).append((base, used))
            if used < bins:
                rooms[room].append((base + used, bins - used))


def plan_packing(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """The whole plan for a histogram ``counts[length]``."""
    plan = Plan(counts, capacity)
    reduce_dominated(plan)
    best_fit(plan)
    return plan


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``length`` is 1 to ``capacity``."""
    placed = ranked(pieces, ["length"], "_rank", "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for row in placed.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    runs = sorted(plan_packing(counts, capacity).runs, key=lambda r: (r.length, r.rank))
    table = np.array([[r.length, r.rank, r.bins, r.base, r.offset] for r in runs], np.int64).reshape(-1, 5)
    # Runs follow from at most ``capacity`` counts, so this stays small whatever the number of pieces.
    shared = pieces.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        run = shared.value
        firsts = np.searchsorted(run[:, 0], length.to_numpy())
        # Ranks of a length start at 0, so length and rank make one ascending key.
        scale = int(run[:, 1].max(initial=0)) + int(rank.max() or 0) + 2 if len(rank) else 1
        key = run[:, 0] * scale + run[:, 1]
        at = np.maximum(np.searchsorted(key, length.to_numpy() * scale + rank.to_numpy(), "right") - 1, firsts)
        return pd.DataFrame({"sequence_id": run[at, 3] + rank.to_numpy() - run[at, 1], "offset": run[at, 4]})

    out = placed.withColumn("_place", place("length", "_rank"))
    return out.select(*pieces.columns, F.col("_place.sequence_id"), F.col("_place.offset"))
