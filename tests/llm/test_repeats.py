"""Suffix arrays and repeated strings against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from alertflow.llm import repeats, suffixes
from alertflow.llm.queries import QUERIES


@pytest.mark.parametrize("waves", [1024, 3])
def test_induced_sorting_equals_sorted_suffixes(monkeypatch, waves):
    monkeypatch.setattr(suffixes, "WAVES_MOST", waves)
    random = np.random.default_rng(0)
    for turn in range(400):
        s = random.integers(1, int(random.integers(2, 6)), int(random.integers(0, 40)))
        s = np.append(np.tile(s[:9], 5) if turn % 3 == 0 else s, 0)
        wanted = sorted(range(len(s)), key=lambda i: s[i:].tolist())
        found = suffixes.suffix_array(s)
        assert found.tolist() == wanted
        prefixes = suffixes.common_prefixes(s, found)
        for a, b in zip(wanted, wanted[1:], strict=False):
            assert prefixes[b] == next(n for n in range(len(s)) if s[a + n] != s[b + n])


def brute(texts, length):
    """(bytes, removed, spans, digest of what stays) of each text."""
    bodies = [(t or "").encode() for t in texts]
    counts = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for body in bodies:
        gone = np.zeros(len(body) + 1, bool)
        for i in range(len(body) - length + 1):
            if counts[body[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((gone[:-1] & ~np.append([False], gone[:-2])).sum()) if body else 0
        kept = bytes(b for b, g in zip(body, gone, strict=False) if not g)
        out.append((len(body), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def rows_of(found):
    rows = found.select(
        "doc.doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("gone"), F.size("removed").alias("spans"),
        F.sha2("kept", 256).alias("sha"), "doc.place",
    )
    return [(r.n_bytes, r.gone, r.spans, r.sha) for r in sorted(rows.collect(), key=lambda r: r.place)]


def texts_with_passages():
    random = np.random.default_rng(1)

    def prose(n):
        return " ".join("".join(random.choice(list("abcdeéñ"), int(random.integers(2, 8)))) for _ in range(n))

    passage, other = prose(60), prose(45)
    texts = [None, "", "x", prose(30), passage, passage, "a" * 700, "ab" * 300, prose(20) + "a" * 260]
    texts += [prose(int(random.integers(5, 30))) + " " + passage + " " + prose(9) for _ in range(30)]
    texts += [prose(12) + other[int(random.integers(0, 20)) :] + passage[: int(random.integers(150, 300))] for _ in range(30)]
    texts += [other[:199] + prose(3), other[:199] + "é" + prose(3), prose(800), "=" * 199, "-" * 201]
    return texts


@pytest.mark.parametrize("segments", [2048, 4])
def test_repeats_equal_brute_force(spark, monkeypatch, segments):
    """Passages with different surroundings, overlaps inside a text, names with many segments over several shards."""
    monkeypatch.setattr(repeats, "SEGMENTS", segments)
    monkeypatch.setattr(repeats, "SHARD_BYTES", 3000 if segments == 4 else 1 << 20)
    monkeypatch.setattr(repeats, "CHUNK", 1000 if segments == 4 else 1 << 22)
    texts = texts_with_passages()
    data = [(2**53 + 1 if i % 5 == 0 else None, i, t, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(data, "doc_id long, place long, text string, name string").repartition(3, "place")
    found = repeats.without_repeats(docs)
    assert rows_of(found) == brute(texts, repeats.LENGTH)
    assert {r.doc_id for r in found.select("doc.doc_id").collect()} == {None, 2**53 + 1}
    assert repeats.without_repeats(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    wanted = dict(zip([r.doc_id for r in rows], brute([r.text for r in rows], 200), strict=True))
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op12_repeats"](spark, sf_dir).collect()}
    assert found == wanted and sum(r[1] for r in wanted.values()) > 0


def test_windows_without_an_equal_name_are_not_sorted(monkeypatch):
    """Strings that share 110 bytes have a name in common but no window of 200; those that share 230 have 31."""
    sorted_places = []
    monkeypatch.setattr(repeats, "suffix_array", lambda s: sorted_places.append(len(s)) or suffixes.suffix_array(s))
    random = np.random.default_rng(2)

    def noise(n):
        return random.integers(0, 256, n, np.uint8).tobytes()

    short, long = noise(110), noise(230)
    bodies = [noise(100) + short + noise(100) for _ in range(50)]
    assert not any(marks.any() for marks in repeats._in_shard(bodies, 200)) and sum(sorted_places) == 0
    bodies += [noise(50) + long + noise(50), noise(40) + long + noise(60)]
    found = repeats._in_shard(bodies, 200)
    assert [np.flatnonzero(m).tolist() for m in found[50:]] == [list(range(50, 81)), list(range(40, 71))]
    assert not any(m.any() for m in found[:50]) and sum(sorted_places) < 1000


@pytest.mark.parametrize("chunk", [1 << 20, 150])
@pytest.mark.parametrize("length", [64, 71, 100, 200])
def test_shard_equals_brute_force(monkeypatch, length, chunk):
    """Zero bytes, runs, overlaps inside a string and equal strings among the segments."""
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    random = np.random.default_rng(length)
    pool = random.integers(0, 3, 900).astype(np.uint8)
    bodies = [b"\x00" * (length + 5), b"\xff" * length, b"ab" * length]
    for _ in range(60):
        a, b = random.integers(0, 900 - length, 2).tolist()
        bodies.append(pool[a : a + length + int(random.integers(0, 99))].tobytes() + pool[b : b + int(random.integers(1, 80))].tobytes())
    windows = [[body[i : i + length] for i in range(len(body) - length + 1)] for body in bodies]
    counts = Counter(w for own in windows for w in own)
    assert [m.tolist() for m in repeats._in_shard(bodies, length)] == [[counts[w] > 1 for w in own] for own in windows]


def test_bytes_are_mixed_once(monkeypatch):
    """However many of its bytes a gram has, a place costs two rounds of mixing."""
    mixed = []
    monkeypatch.setattr(repeats, "mix", lambda x, f=repeats.mix: mixed.append(len(x)) or f(x))
    raw = np.random.default_rng(3).integers(0, 256, 100_000).astype(np.uint8)
    wanted = repeats.gram_hashes(raw[40_000:50_000], 128)
    mixed.clear()
    found = repeats.gram_hashes(raw, 128)
    assert sum(mixed) < 2.1 * len(raw)
    assert found[40_000 : 40_000 + len(wanted)].tolist() == wanted.tolist()
    values = found[:5000]
    for width in (1, 2, 73, 128):
        assert repeats.least_of(values, width).tolist() == [min(values[i : i + width].tolist()) for i in range(len(values) - width + 1)]


def test_shard_of_more_bytes_than_places(monkeypatch):
    """Segments of long windows can make a shard larger than the places that a part of it is named by."""
    monkeypatch.setattr(repeats, "CHUNK", 1 << 11)
    monkeypatch.setattr(repeats, "_PLACE", np.uint64((1 << 13) - 1))
    random = np.random.default_rng(4)
    passage = random.integers(0, 256, 220).astype(np.uint8).tobytes()
    bodies = [random.integers(0, 256, 90).astype(np.uint8).tobytes() + passage for _ in range(200)]
    assert all(m[90:111].all() and not m[:80].any() for m in repeats._in_shard(bodies, 200))
