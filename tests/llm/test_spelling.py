"""Spelling variants against brute force."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from alertflow.llm import spelling
from alertflow.llm.queries import QUERIES


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            checksum = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if checksum % 97 == 0:
                at = checksum % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: set() for w in words}
    shorter: dict = {}
    for w in words:
        for i in range(len(w)):
            gone = w[:i] + w[i + 1 :]
            if gone in words:
                near[w].add(gone)
                near[gone].add(w)
            shorter.setdefault((i, gone), []).append(w)
    for same in shorter.values():
        for w in same:
            near[w].update(x for x in same if x != w)
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = {}
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] = (forms[w], root, n, len(near[w]), words.get(forms[w]))
    return out


def found_of(df):
    rows = df.collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


def test_one_apart():
    pairs = [("ab", "ab", 0), ("ab", "abc", 1), ("abc", "bc", 1), ("abc", "axc", 1), ("abc", "acb", 0), ("a", "abc", 0), ("aab", "ab", 1)]
    assert all(spelling.one_apart(a.encode(), b.encode()) == bool(want) for a, b, want in pairs)


@pytest.mark.parametrize("subtree", [1 << 15, 7])
def test_variants_equal_brute_force(spark, monkeypatch, subtree):
    """Words of all lengths, many with equal counts of letters, one subtree larger than the rest."""
    monkeypatch.setattr(spelling, "SUBTREE", subtree)
    if subtree == 7:
        monkeypatch.setattr(spelling, "PREFIX_MOST", 2)
        monkeypatch.setattr(spelling, "NODE_PAIRS", 16)
    random = np.random.default_rng(2)
    base = ["".join(random.choice(list("abeétÿ"), int(random.integers(4, 9)))) for _ in range(120)]
    base += ["z" * 31 + "abc", "z" * 32, "z" * 31, "z" * 40 + "q", "z" * 40, "y" * 20, "y" * 19 + "x", "THEREIN", "therein", "thereÌn"]
    rows = []
    for i in range(300):
        words = []
        for w in random.choice(base, 40, p=(p := 1 / np.arange(1, len(base) + 1)) / p.sum()):
            at = int(random.integers(0, len(w)))
            words.append(w if random.random() < 0.7 else w[:at] + str(random.choice(["", "a", "é"])) + w[at + int(random.integers(0, 2)) :])
        rows.append((2**53 + i if i % 3 else None, " ".join(words) + " × 12 ÷ a_b", "clash"))
    rows += [(1, None, "x"), (2, "", "x"), (1, "same again same again same again", "y")] + [(5, "repeated rows", "n")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string").withColumn("n", F.lit("clash")).repartition(3)
    want = brute([r[:2] for r in rows])
    assert found_of(spelling.variants(docs)) == want
    assert sum(w[0] is not None for w in want.values()) > 20 and any(w[0] != w[1] for w in want.values() if w[0])
    assert spelling.variants(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert found_of(QUERIES["op13_spelling"](spark, sf_dir)) == brute([tuple(r) for r in rows])
