"""Near copies that do not link, and the bits that tell them apart."""

import numpy as np
from test_operators import brute_jaccard, docs_of

from alertflow.llm import common, jaccard


def test_bits_differ_no_more_than_sets():
    random = np.random.default_rng(3)
    for size in (1, 5, 146, 5000):
        keys = np.unique(jaccard.mix(random.integers(0, 1 << 60, size).astype(np.uint64)))
        other = np.unique(np.concatenate([keys[size // 5 :], jaccard.mix(np.arange(size // 3, dtype=np.uint64))]))
        bits = jaccard.marks(keys) ^ jaccard.marks(other)
        assert len(bits) == jaccard.MARKS and not (jaccard.marks(keys) ^ jaccard.marks(keys)).any()
        assert np.bitwise_count(bits).sum() <= len(np.setxor1d(keys, other))


def test_near_copies_that_do_not_link_are_not_paired(spark, monkeypatch):
    random = np.random.default_rng(4)
    base = [f"w{k}" for k in range(146)]
    texts = []
    for copy in range(120):
        words = list(base)
        # Three words in different shingles: each text alone may still link, no two of them do.
        for slot in random.choice(28, 3, replace=False):
            words[5 * slot + 4] = f"v{copy}x{slot}"
        texts.append(" ".join(words))
    texts += [" ".join(base), texts[0]]
    pairs = []

    def counted(df, purpose, **options):
        out = common.written(df, purpose, **options)
        if purpose == "pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "written", counted)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join_similar(docs_of(spark, texts)).collect()}
    assert [found[i] for i in range(len(texts))] == brute_jaccard(texts)
    # There are 7,140 pairs of near copies.
    assert sum(pairs) < 10 * len(texts)
