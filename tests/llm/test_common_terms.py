"""Toxicity's search: common terms are no lists to walk, and what is chosen by products is compared exactly."""

import numpy as np

from gasledger.llm import toxicity


def vectors_of(rng, n, n_terms):
    out = []
    for _ in range(n):
        terms = np.unique(np.concatenate([np.arange(8), rng.zipf(1.3, rng.integers(0, 60)) % n_terms]))
        w = rng.random(len(terms)) + 0.01
        out.append((terms, w / np.sqrt(w @ w)))
    return out


def test_common_terms_are_not_listed(monkeypatch):
    monkeypatch.setattr(toxicity, "COMMON", 16, raising=False)
    vectors = vectors_of(np.random.default_rng(3), 700, 900)
    index = toxicity.BlockMaxIndex(vectors, 900, np.arange(700))
    held = np.sort(np.bincount(np.concatenate([t for t, _ in vectors]), minlength=900))
    assert len(index.doc) == held[:-16].sum() < 0.7 * held.sum()


def test_equal_examples_tie_and_the_lower_ids_win(monkeypatch):
    for common in (0, 5, 40, 900):
        monkeypatch.setattr(toxicity, "COMMON", common, raising=False)
        rng = np.random.default_rng(common)
        some = vectors_of(rng, 90, 900)
        vectors = [some[i] for i in rng.integers(0, 90, 1001)] + [(np.zeros(0, np.int64), np.zeros(0))]
        ids = rng.permutation(1002)
        index = toxicity.BlockMaxIndex(vectors, 900, ids)
        dense = np.zeros((1002, 900))
        for i, (t, w) in enumerate(vectors):
            dense[i, t] = w
        for i in range(0, 1002, 13):
            for without in (-1, i):
                near, similar = index.nearest(*vectors[i], 24, without)
                rounded = [(-round(float(s), 9), e) for s, e in zip(dense @ dense[i], ids)]
                want = sorted(x for j, x in enumerate(rounded) if x[0] < 0 and j != without)[:24]
                assert [(-round(float(s), 9), ids[n]) for s, n in zip(similar, near)] == want
