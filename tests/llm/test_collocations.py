"""Collocations against brute force on edge rows; the whole table is compared with SQL."""

import re
from collections import Counter

import numpy as np
import pytest

from alertflow.llm import collocations


def brute(rows, support, longest):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    usual = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= support}
    out = set()
    for (lang, words), a in usual.items():
        def inside(longer):
            return any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))

        if any(m == lang and len(w) > len(words) and inside(w) and 100 * b >= 50 * a for (m, w), b in usual.items()):
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1_000_000 * a * a // (l * r), k, l, r))
        score, _, l, r = min(cuts)
        out.add((lang, " ".join(words), a, l, r, totals[lang], score))
    return out


@pytest.mark.parametrize(("longest", "chunk"), [(3, 1 << 22), (4, 50)])
def test_collocations_equal_brute_force(spark, monkeypatch, longest, chunk):
    """Null languages and texts, long and repeated texts, other columns."""
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    if chunk == 50:
        monkeypatch.setattr(collocations, "HELD", 500)
        monkeypatch.setattr(collocations, "HELD_TEXTS", 20)
        monkeypatch.setattr(collocations, "RANGE_BYTES", 512)
    random = np.random.default_rng(3)
    words = ["New", "york", "Ärger", "É", "a", "\x0b", "b.", "c,d", "new york", "x\ty", "ÿ　z", "<|x|>"]
    rows = []
    for i in range(200):
        text = " ".join(random.choice(words, int(random.integers(0, 30)), p=(p := 1 / np.arange(1, 13)) / p.sum()))
        rows.append((text, [None, "en", "und", ""][i % 4]))
    rows += [(None, "en"), ("", None), ("long one. " * 3000, "en"), ("word" * 5000, "en"), ("solo", "xx")] + [("same text here", "de")] * 12
    data = [(i % 7 or None, text, lang, 1) for i, (text, lang) in enumerate(rows)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, n int").repartition(3)
    found = collocations.mine(docs, 10, longest)
    assert {tuple(r) for r in found.collect()} == brute(rows, 10, longest)
    ranked = collocations.ranked_phrases(found, 3).collect()
    best = {}
    for row in sorted(brute(rows, 10, longest), key=lambda r: (-r[6], -r[2], r[1].encode())):
        best.setdefault(row[0], []).append(row[1])
    assert {(r.lang, r["rank"], r.phrase) for r in ranked} == {(k, i, p) for k, v in best.items() for i, p in enumerate(v[:3], 1)}
    assert collocations.ranked_phrases(collocations.mine(docs.limit(0))).count() == 0


def test_scores_past_64_bits(spark):
    counts = [("en", 1, "a", 10**15 - 1), ("en", 1, "b", 10**15 - 2), ("en", 2, "a b", 10**15 - 3), ("en", 0, None, 5 * 10**15)]
    rows = spark.createDataFrame(counts, "lang string, words int, phrase string, n long")
    found = collocations.scored(rows, 10, 3, 50).first()
    assert found.score == 1_000_000 * (10**15 - 3) ** 2 // ((10**15 - 1) * (10**15 - 2)) and found.n == 5 * 10**15
