"""Mixing against numpy on the given tables, and the recall of hashing at the border of similarity."""

import re

import numpy as np
import xxhash

from alertflow.llm import mixing, polytope, toxicity
from alertflow.llm.queries import TARGETS, quality_domains


def buckets(text):
    words = [w for w in re.split(r"[ \t\n\x0b\f\r]+", (text or "").lower()) if w]
    hashed = (xxhash.xxh64(w.encode(), seed=42).intdigest() for w in words)
    return [(h - (1 << 64) if h >= 1 << 63 else h) % mixing.BUCKETS for h in hashed]


def brute_rates(docs, labelled, targets, lowest):
    """(posteriors, rates) by plain loops over all documents."""
    domains = [d for d in targets if any(d == domain for _, domain in labelled)]
    words = {i: buckets(text) for i, text in docs}
    counts, sizes = np.full((mixing.BUCKETS, len(domains)), 0.5), np.zeros(len(domains))
    for doc_id, domain in labelled:
        if doc_id in words:
            np.add.at(counts[:, domains.index(domain)], words[doc_id], 1)
            sizes[domains.index(domain)] += 1
    weights = np.log(counts / counts.sum(0))
    weights = (weights - weights.mean(1, keepdims=True)).round(9)
    tokens = np.array([len(words[i]) for i, _ in docs], float)
    scores = np.zeros((len(docs), len(domains)))
    for n, (i, _) in enumerate(docs):
        scale = min(tokens[n], mixing.EVIDENCE_WORDS) / max(tokens[n], 1)
        scores[n] = weights[words[i]].sum(0) * scale + np.log(sizes / sizes.sum())
    p = np.exp(scores - scores.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    held = tokens[:, None] * p
    have, gram = held.sum(0), held.T @ p
    shares = np.array([targets[d] for d in domains]) / sum(targets[d] for d in domains)
    wanted = shares * (have.sum() if lowest <= 0 else lowest * (have / shares).max())
    rate, reached = np.ones(len(docs)), have
    for _ in range(mixing.STEPS):
        if np.abs(reached - wanted).max() <= mixing.CLOSE * max(wanted.sum(), 1.0):
            break
        rate = np.maximum(lowest, rate - p @ (np.linalg.pinv(gram, rcond=1e-9) @ (reached - wanted)))
        reached = (rate[:, None] * held).sum(0)
    return p, rate


def test_mixing_equals_numpy(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = [tuple(r) for r in table.collect()]
    marks = quality_domains(spark, sf_dir)
    labelled = list(dict.fromkeys(tuple(r) for r in marks.collect()))
    for lowest in (0.0, 1.0):
        model = mixing.fit(table, marks, TARGETS, lowest)
        found = {r.doc_id: (r._p, r._rate) for r in model.rates(table).collect()}
        p, rate = brute_rates(docs, labelled, TARGETS, lowest)
        assert np.allclose([found[i][0] for i, _ in docs], p, atol=1e-6)
        assert np.allclose([found[i][1] for i, _ in docs], rate, atol=1e-3)
        total = sum(np.array(found[i][0]) * found[i][1] * len(buckets(t)) for i, t in docs)
        assert np.allclose(total / total.sum(), [0.9, 0.1], atol=1e-3)


def test_hashing_finds_pairs_at_the_border(spark):
    """Pairs of cosine 0.98 to 0.985 among vectors without other near ones, some ids large, some rows with clashing columns."""
    random = np.random.default_rng(9)
    base = random.normal(size=(1500, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    other = random.normal(size=(1000, 64))
    other -= (other * base[:1000]).sum(1, keepdims=True) * base[:1000]
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cosine = random.uniform(0.9801, 0.985, (1000, 1))
    near = cosine * base[:1000] + np.sqrt(1 - cosine**2) * other
    rows = [(2**53 + 1 + i, v.tolist(), 0, "clash") for i, v in enumerate(np.concatenate([base, near]))]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, bucket string")
    found = {r.vec_id - 2**53 - 1: r for r in polytope.near_duplicates(data).collect()}
    linked = np.array([found[i].n_links for i in range(2500)])
    recall = linked[:1000].mean()
    assert recall >= 0.98 and linked[1000:1500].sum() == 0 and linked.max() == 1
    assert all(found[1500 + i].component_id == 2**53 + 1 + i for i in range(1000) if linked[i])


def test_numbers_packed_together_are_those_packed_alone():
    rows = [[], [0, 127, 128], [], [2**35 - 1, 5], []]
    packed = toxicity.varints_of_rows(rows)
    assert packed == [toxicity.varints(np.array(row, np.int64)) for row in rows]
    assert [x.tolist() for x in toxicity.rows_from_varints(packed)] == rows
    assert toxicity.varints_of_rows([[]]) == [b""] and toxicity.rows_from_varints([b""])[0].tolist() == []
