"""The trees of the near-duplicate join: coordinates of their own, and the loss they are counted for."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gasledger.llm import near_dedup


def test_no_coordinate_serves_two_trees():
    trees = near_dedup.trees_for(0.99999, 0.8)
    tokens = np.random.default_rng(1).integers(0, 2**32, (200, trees * near_dedup.POOL), dtype=np.uint32)
    before = near_dedup.second_level(tokens, trees).reshape(200, trees, -1)
    used = np.zeros(trees, int)
    for c in range(tokens.shape[1]):
        other = tokens.copy()
        other[:, c] += np.uint32(1)
        changed = (near_dedup.second_level(other, trees).reshape(200, trees, -1) != before).any(axis=(0, 2))
        assert changed.sum() <= 1
        used += changed
    assert used.min() > 2


@pytest.mark.parametrize("similarity", [0.8, 0.85])
def test_a_tree_loses_what_is_stated(similarity):
    levels, n, trees = near_dedup.MAX_LEVELS + 2, 1500, 4
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2**32, (n, trees * near_dedup.POOL), dtype=np.uint32)
    y = np.where(rng.random(x.shape) < similarity, x, x ^ np.uint32(1))
    missed = np.zeros((n, trees), bool)
    for r in range(trees):      # the nodes that hold both records of a pair, level by level
        pair = np.arange(n)
        node = np.full(n, np.uint64(r))
        for _ in range(levels):
            both = near_dedup.children(node, x[pair]), near_dedup.children(node, y[pair])
            row, branch = np.nonzero(both[0] == both[1])
            pair, node = pair[row], both[0][row, branch]
            keep = np.concatenate([np.flatnonzero(pair == p)[:64] for p in np.unique(pair)])   # enough to survive
            pair, node = pair[keep], node[keep]
        missed[:, r] = ~np.isin(np.arange(n), pair)
    stated = near_dedup.lost(similarity, levels)
    assert abs(missed.mean() - stated) < 5 * np.sqrt(stated / missed.size)
    # trees are independent: two are missed together as often as chance has it
    together = np.mean([(missed[:, a] & missed[:, b]).mean() for a in range(trees) for b in range(a)])
    assert together < missed.mean() ** 2 + 5 * missed.mean() / np.sqrt(missed.size)
    assert stated ** near_dedup.trees_for(0.99999, similarity) <= 1e-5


def test_what_records_lack_bounds_what_they_share(spark):
    rng = np.random.default_rng(5)
    whole = rng.integers(0, 2**64, 300, dtype=np.uint64)
    sets = {0: whole, 1: whole[:0]} | {i: np.concatenate([whole[rng.random(300) < keep], rng.integers(0, 2**64, 9, dtype=np.uint64)])
                                      for i, keep in enumerate([1, 0.98, 0.95, 0.9, 0.8, 0.5, 0.1, 0], 2)}
    stored = spark.createDataFrame([(i, np.sort(s).tobytes()) for i, s in sets.items()], "id long, shingles binary")
    pairs = spark.createDataFrame([(i, 0) for i in sets if i], "a long, b long")
    found = {r["a"]: r for r in near_dedup._overlap(pairs, stored).collect()}
    held = {i: set(s.tolist()) for i, s in sets.items()}
    for i, r in found.items():
        assert (r["both"], r["either"]) == (len(held[i] & held[0]), len(held[i] | held[0]))
    for i, x in found.items():
        for j, y in found.items():
            bound = 300 - sum((((a | b) & (2**64 - 1)).bit_count()) for a, b in zip(x["lacks"], y["lacks"]))
            assert bound >= len(held[i] & held[j] & held[0])
            if i != j and {i, j} <= {3, 4, 5, 6}:     # those that lack a twentieth to a fifth, each its own
                assert bound < min(x["both"], y["both"])


def test_rows_keep_columns_of_any_name(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text), (2, text), (3, "other words here")], "doc_id long, text string")
    docs = docs.select("doc_id", "text", *[F.lit(7).alias(c) for c in ("gone", "_gone", "id", "row", "comp", "size")])
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]
