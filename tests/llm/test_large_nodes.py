"""The near-duplicate join where a text has many edited copies, some just too far for a link."""

import numpy as np
import pytest

from gasledger.llm import near_dedup

from . import brute


@pytest.fixture(scope="module")
def copies():
    """A text, 60 copies of it within the similarity and most of 1,200 out of it, a few of these linked with one another."""
    rng = np.random.default_rng(8)
    base, rows = [f"w{i}" for i in range(100)], []
    for n in (0, *([1, 2] * 30), *([4] * 1200)):
        words = list(base)
        for at in rng.choice(100, n, replace=False):
            words[at] = f"c{at}"      # so what a copy lacks of the text, others share
        if len(rows) in (100, 200):     # near copies of the record before, which is out of reach of the text
            words = rows[-1][1].split()
            words[50] = "z"
        rows.append((len(rows), " ".join(words)))
    return rows


def _found(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_components(docs, 3, 85).collect()}


@pytest.fixture(scope="module")
def want(copies):
    out = brute.near(copies)
    assert sum(c == d for d, (_, c) in out.items()) > 900 and out[100][1] == out[99][1]
    return out


def test_many_records_out_of_reach_take_one_level(spark, monkeypatch, copies, want):
    names, real = [], near_dedup.stored
    monkeypatch.setattr(near_dedup, "stored", lambda df, name: names.append(name) or real(df, name))
    assert _found(spark, copies) == want
    assert names.count("nodes") == 1


def test_small_blocks_and_tiles_find_the_same(spark, monkeypatch, copies, want):
    for name, value in (("OUTSIDE", 70), ("INSIDE", 90), ("TILE", 64)):
        monkeypatch.setattr(near_dedup, name, value)
    assert _found(spark, copies) == want


def test_the_last_level_compares_any_number_of_pairs(spark, monkeypatch, copies, want):
    monkeypatch.setattr(near_dedup, "PAIRS", 0)
    monkeypatch.setattr(near_dedup, "MAX_LEVELS", 1)
    assert _found(spark, copies) == want


def test_the_typical_record_is_the_middle_not_the_one_most_shared(spark):
    rng = np.random.default_rng(4)
    signed = lambda bits: int(np.packbits(bits.astype(np.uint8)).view("<i8")[0])
    base, rows = rng.integers(0, 2, 128), []
    for id_ in range(40):
        bits = base.copy()
        bits[rng.choice(128, 0 if id_ == 7 else 9, replace=False)] ^= 1
        rows.append((5, id_, id_, signed(bits[:64]), signed(bits[64:]), 90, 100, 95))
    far = rng.integers(0, 2, 128)
    rows.append((5, 99, 99, signed(far[:64]), signed(far[64:]), 90, 100, 100))    # all of it is shared, with whom ever
    large = spark.createDataFrame(rows, "node long, comp long, id long, s1 long, s2 long, size long, `all` long, shared long")
    end = near_dedup._ends(large).first()
    assert end.high.id == 7 and end.low.id == 0


def test_what_may_reach_is_bounded_by_sets(copies):
    """Every pair at the similarity stays possible; of the others few do."""
    sets = near_dedup.shingle_sets([t.encode() for _, t in copies], 3)
    multiply, add = near_dedup.factors(near_dedup.BITS)
    bits = [np.packbits((near_dedup.minwise(s, multiply, add) & 1).astype(np.uint8)).view(np.uint64) for s in sets]
    whole, ids = sets[0], np.arange(len(sets))
    lacks = np.zeros((len(sets), 16), np.uint64)
    for row, s in zip(lacks, sets):
        for place in np.flatnonzero(~np.isin(whole, s)):
            row[place // 64] |= np.uint64(1) << np.uint64(place % 64)
    tokens, times = np.unique(np.concatenate(sets), return_counts=True)
    both, shared, size = (np.array([n(s) for s in sets]) for n in (
        lambda s: int(np.isin(whole, s).sum()), lambda s: int(np.isin(s, tokens[times > 1]).sum()), len))
    rows = {"id": ids, "comp": ids, "top": np.zeros_like(ids), "s1": np.array([b[0] for b in bits]), "s2": np.array([b[1] for b in bits]),
            "size": size, "all": size, "shared": shared, "both": both, "lacks": lacks, "whole": np.full(len(ids), len(whole))}
    outer = {c: v[1:] for c, v in rows.items()}
    got = {(min(p), max(p)) for p in zip(*(x.tolist() for x in near_dedup._may_reach(outer, rows, 85)))}
    linked = {(a, b) for a in ids for b in ids if a < b and 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))}
    assert linked <= got and {a for a, _ in linked} > {0} and len(got) < 0.1 * len(ids) ** 2
