"""Operators against brute force, the tokenizer library and DuckDB."""

import math
import zlib

import duckdb
import numpy as np
import pytest

from gasledger.llm import near_dedup, packing, quality_rules, queries, repeats, substring_dedup, suffix_dedup, tokens, toxicity
from tests.conftest import SF_MID, SF_SMALL
from tests.llm import brute
from tools.compare import TABLES, rows_of


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.queries()[name](spark, SF_SMALL)
    got, gcols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(queries.oracle_sql()[name])
    want, wcols = rows_of(rel.columns, rel.fetchall())
    assert gcols == wcols
    assert got == want


def test_substring_dedup_equals_brute_force(spark, docs):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op6_substring_dedup(spark, SF_SMALL).collect()}
    assert got == brute.passages(docs)


def test_suffix_arrays_equal_brute_force(spark, docs):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in queries.op8_suffix_array_dedup(spark, SF_SMALL).collect()}
    assert got == brute.byte_strings(docs)


def periodic(rng, n):
    """Texts of few words, so that windows repeat inside and between them in many ways."""
    out = []
    for d in range(n):
        words = [["a", "b", "ab", "ba "][i] for i in rng.integers(0, 2 + d % 3, rng.integers(0, 160))]
        out.append((d, " ".join(words) * int(rng.integers(1, 3))))
    return out + [(n, "x" * 700), (n + 1, "x" * 199), (n + 2, "xy" * 300), (n + 3, "\x00" * 450), (n + 4, "\x00x" * 130)]


@pytest.mark.parametrize("hot", [4096, 1])
def test_repeats_in_periodic_texts(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = periodic(np.random.default_rng(5), 30)
    got = {r.doc_id: (r.n_units, r.n_removed, r.kept_sha256) for r in substring_dedup.repeated_passages(frame(spark, rows)).collect()}
    assert got == brute.passages(rows)
    got = {r.doc_id: (r.n_units, r.n_removed, len(r.spans), r.kept_sha256)
           for r in suffix_dedup.repeated_bytes(frame(spark, rows)).collect()}
    assert got == brute.byte_strings(rows)


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(0, 3, n).astype(np.uint8)) for n in (0, 1, 5, 40, 40, 90)] + [b"abcabcabc" * 9] * 2
    key, starts, ends = suffix_dedup.joined(texts)
    order, rank = suffix_dedup.suffix_array(key, starts, ends)
    suffixes = {int(s + i): (t[i:], n) for n, (t, s) in enumerate(zip(texts, starts)) for i in range(len(t) + 1)}
    want = sorted(suffixes, key=lambda p: ([b + 1 for b in suffixes[p][0]] + [0], p))
    # among texts' ends only the order is free
    assert [suffixes[int(p)][0] for p in order] == [suffixes[p][0] for p in want]
    shared = suffix_dedup.common_prefixes(key, starts, ends, order, rank, 50, ends - starts)
    for place in range(1, len(order)):
        a, b = suffixes[int(order[place - 1])][0], suffixes[int(order[place])][0]
        if b:
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared[order[place]] == min(n, 50)


def test_near_dedup_with_deep_nodes(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL", 3)
    rng, rows = np.random.default_rng(2), []
    for group in range(4):
        base = [f"w{group}x{i}" for i in range(120)]
        for _ in range(25):
            words = list(base)
            for at in rng.integers(0, 120, rng.integers(0, 4)):
                words[at] = f"c{rng.integers(0, 10**6)}"
            rows.append((len(rows), " ".join(words)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_components(frame(spark, rows), 3, 85).collect()}
    assert got == brute.near(rows)


def test_trees_reach_the_recall():
    assert near_dedup.trees_for(0.99999, 0.85) >= 3
    assert near_dedup.trees_for(0.99999, 0.8) >= near_dedup.trees_for(0.9, 0.8)


def test_rules_measure_like_brute_force(spark, docs):
    rows = [*docs, (-1, None), (-2, ""), (-3, "a b a b a b c"), (-4, "x\n \nx\n\nx | <y>"), (-5, "one two")]
    got = {r.doc_id: tuple(r.m)[:3] + tuple(r.m)[4:] for r in
           frame(spark, rows).select("doc_id", quality_rules.measures(__import__("pyspark").sql.functions.col("text")).alias("m")).collect()}
    assert got == {d: brute.measures(t) for d, t in rows}


def test_binomial_tail_is_exact(spark):
    from pyspark.sql import functions as F

    rows = [(n, k) for n in (1, 50, 4000) for k in (0, 1, 7, 30) if k <= n]
    df = spark.createDataFrame(rows, "n long, k long").select("n", "k", quality_rules.binomial_tail(F.col("n"), F.col("k"), 0.01).alias("p"))
    for r in df.collect():
        want = 1.0 if r.k >= r.n * 0.01 else sum(math.comb(r.n, j) * 0.01**j * 0.99 ** (r.n - j) for j in range(r.k + 1))
        assert r.p == pytest.approx(want, rel=1e-9)


def test_cutoffs_keep_good_documents(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(60)) + (" ***" * (i % 7 == 0) * 50), "en") for i in range(9000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 7 != 0)) for i in range(9000)], "doc_id long, quality int")
    out = {r.doc_id: r.kept for r in quality_rules.judged(table, labels).select("doc_id", "kept").collect()}
    assert sum(not v for d, v in out.items() if d % 7) <= 0.01 * 9000
    assert not any(v for d, v in out.items() if d % 7 == 0)


def test_token_counts_equal_the_library(spark, docs):
    rows = [*docs, (-1, None), (-2, ""), (-3, "a\x1cb c\x85d ½Ⅷ²"), (-4, "x<|endoftext|>y <|startoftext|"), (-5, "ΑΣ ΟΔΟΣ İ É é_-_ it's"),
            (-6, "<|endoftext|>" * 3)]
    library = tokens.load(tokens.default_path())
    want = {d: len(library.encode(t or "", add_special_tokens=False).ids) for d, t in rows}
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.token_counts(frame(spark, rows), tokens.default_path()).collect()}
    assert got == {d: (len((t or "").encode()), want[d], want[d] > 2048) for d, t in rows}


def test_pieces_are_the_library_s_ids(spark, docs):
    rows = [*docs, (-1, None), (-2, "q\x85<|endoftext|>z ½\x1c"), (-3, "ΑΣ é " * 3000)]
    library = tokens.load(tokens.default_path())
    ids = {d: [*library.encode(t or "", add_special_tokens=False).ids, 1] for d, t in rows}
    out = packing.pack_documents(frame(spark, rows), tokens.default_path()).collect()
    for r in out:
        part = ids[r.doc_id][r.start: r.start + r.length]
        assert len(part) == r.length and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    assert sum(r.length for r in out) == sum(map(len, ids.values()))
    check_sequences(out, 2048, 256)


def check_sequences(rows, most, segments):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= most and len(parts) <= segments


def test_vectors_respect_every_limit():
    rng = np.random.default_rng(4)
    demand = np.stack([rng.integers(0, 60, 500), np.ones(500, int), rng.integers(0, 30, 500)], axis=1)
    capacity = np.array([100, 4, 35])
    bins, order = packing.pack_vectors(demand, capacity)
    for b in range(bins.max() + 1):
        inside = bins == b
        assert inside.any() and (demand[inside].sum(axis=0) <= capacity).all()
        assert sorted(order[inside]) == list(range(inside.sum()))
    with pytest.raises(ValueError):
        packing.pack_vectors(np.array([[101, 1, 0]]), capacity)


def test_packing_instruction_data(spark):
    from pyspark.sql import functions as F

    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    size = F.size(F.split("text", " "))
    examples = turns.groupBy("conv_id").agg(F.least(F.sum(size), F.lit(512)).alias("length"),
                                            F.least(F.sum(F.when(F.col("role") == "assistant", size)), F.lit(300)).alias("loss"))
    out = packing.pack(examples, max_tokens=512, max_segments=8, max_loss_tokens=300, loss_col="loss").collect()
    assert len(out) == examples.count()
    check_sequences(out, 512, 8)
    loss = {}
    for r in out:
        loss[r.sequence_id] = loss.get(r.sequence_id, 0) + (r.loss or 0)
    assert max(loss.values()) <= 300


def test_block_max_search_equals_comparing_all():
    rng = np.random.default_rng(6)
    vectors = []
    for _ in range(700):
        terms = np.unique(rng.zipf(1.4, rng.integers(0, 60)) % 900)
        w = rng.random(len(terms))
        vectors.append((terms, w / np.sqrt(w @ w) if len(w) else w))
    index = toxicity.BlockMaxIndex(vectors, 900, np.arange(700))
    dense = np.zeros((700, 900))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for i in range(0, 700, 7):
        near, similar = index.nearest(*vectors[i], 10)
        all_of = dense @ dense[i]
        best = np.argsort(-all_of, kind="stable")[:10]
        best = best[all_of[best] > 0]
        assert np.allclose(similar, all_of[best])
        assert np.allclose(all_of[near], all_of[best])


def held_out_auc(spark, rows, label):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    known = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, y in known if y == 1], [s for s, y in known if y == 0]
    return np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])


def test_held_out_accuracy(spark):
    for query, label, least, cut in ((queries.op1_toxicity, "toxic", 0.75, 0.5), (queries.op2_quality_classifier, "quality", 0.9, 0.3)):
        rows = query(spark, SF_MID).collect()
        assert len({r.doc_id for r in rows}) == 1000
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= cut) for r in rows)
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
        assert held_out_auc(spark, rows, label) > least


def test_held_out_labels_are_not_learnt(spark):
    from pyspark.sql import functions as F

    table, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic"))
                                .otherwise(F.col("toxic")).cast("int"))
    a, b = ({r.doc_id: r.score for r in toxicity.score_toxicity(table, x).collect()} for x in (labels, flipped))
    assert a == b
