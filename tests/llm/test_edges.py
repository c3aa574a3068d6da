"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gasledger.llm import (
    decontaminate,
    line_dedup,
    near_dedup,
    packing,
    quality_model,
    quality_rules,
    substring_dedup,
    suffix_dedup,
    tokens,
    toxicity,
)
from tests.conftest import SF_SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long, hash long, length int, comp string, node double, words string"
LONG = " ".join(f"long{i % 7919}" for i in range(40_000))


def odd(spark):
    text = " ".join(f"plain{i}" for i in range(70)) + "\nsecond line here\nthird line here"
    rows = [(1, text), (2, text), (2, text), (3, None), (4, ""), (5, " \n\t "), (None, text), (None, None),
            (6, LONG), (7, "one"), (8, "one two"), (9, "ñ \x00 <|endoftext|>"), (10, "a " * 500)]
    return spark.createDataFrame([(d, t, None if d == 2 else "en", None, None, 1, 2, "c", 0.5, "w") for d, t in rows], DOCS)


def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1), (7, 0, 1), (8, 1, 0), (99, 1, 1), (10, 0, 1)],
                                 "doc_id long, quality int, toxic int")


def items(spark):
    return spark.createDataFrame([(1, "plain1 plain2 plain3"), (1, "plain1 plain2 plain3"), (2, None), (3, ""), (None, "one two"), (4, "...")],
                                 "item_id long, text string")


PATH = tokens.default_path()
OPERATORS = {
    "toxicity": lambda s, d: toxicity.score_toxicity(d, labels(s)),
    "quality": lambda s, d: quality_model.score_quality(d, labels(s)),
    "near": lambda s, d: near_dedup.near_components(d),
    "lines": lambda s, d: line_dedup.dedup_lines(d),
    "contamination": lambda s, d: decontaminate.contamination(d, items(s)),
    "passages": lambda s, d: substring_dedup.repeated_passages(d),
    "rules": lambda s, d: quality_rules.judged(d, labels(s)),
    "bytes": lambda s, d: suffix_dedup.repeated_bytes(d),
    "tokens": lambda s, d: tokens.token_counts(d, PATH),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_one_row_for_each_row(spark, name):
    table = odd(spark)
    out = OPERATORS[name](spark, table)
    got = sorted((-1 if r.doc_id is None else r.doc_id) for r in out.select("doc_id").collect())
    assert got == sorted((-1 if r.doc_id is None else r.doc_id) for r in table.select("doc_id").collect())


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, odd(spark).limit(0)).count() == 0


@pytest.mark.parametrize("name", ["toxicity", "quality", "rules"])
def test_empty_labels(spark, name):
    run = {"toxicity": toxicity.score_toxicity, "quality": quality_model.score_quality, "rules": quality_rules.judged}[name]
    out = run(odd(spark), labels(spark).limit(0))
    assert out.count() == 13
    if name != "rules":
        assert {r.score for r in out.collect()} == {0.5}


def test_defined_results(spark):
    table = odd(spark)
    near = {r.doc_id: r for r in near_dedup.near_components(table).collect() if r.doc_id is not None}
    assert [near[d].component_id for d in (1, 2, 3, 4, 5, 7, 8)] == [1, 1, 3, 4, 5, 7, 8]
    assert near[3].n_shingles == near[4].n_shingles == near[5].n_shingles == 0 and near[7].n_shingles == near[8].n_shingles == 1
    hits = {r.doc_id: r for r in decontaminate.contamination(table, items(spark)).collect() if r.doc_id is not None}
    assert (hits[1].n_hit, hits[1].item_ids) == (3, ["1"]) and hits[8].item_ids == [""] and hits[7].n_hit == hits[3].n_words == 0
    cut = {r.doc_id: r for r in substring_dedup.repeated_passages(table).collect() if r.doc_id is not None}
    assert cut[1].n_removed == 0 and cut[2].n_removed == cut[2].n_units == 76 and cut[10].n_removed == 499
    lines = {r.doc_id: r for r in line_dedup.dedup_lines(table).collect() if r.doc_id is not None}
    assert lines[3].text is None and lines[3].line_dedup.n_lines == 0 and lines[4].line_dedup.n_lines == 1


def test_empty_benchmark(spark):
    out = decontaminate.contamination(odd(spark), items(spark).limit(0)).collect()
    assert {r.n_hit for r in out} == {0}
    assert decontaminate.drop_contaminated(odd(spark), items(spark).limit(0)).count() == 13


def test_pieces_of_odd_texts(spark):
    out = packing.pack_documents(odd(spark), PATH).collect()
    assert [(r.start, r.length, r.doc_tokens) for r in out if r.doc_id == 3] == [(0, 1, 1)]
    assert sum(r.length for r in out if r.doc_id == 6) == next(r.doc_tokens for r in out if r.doc_id == 6) > 2048
    assert packing.pack_documents(odd(spark).limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pack(odd(spark).select(F.lit(1).alias("length"), F.lit(2).alias("offset")))


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_the_columns(spark, name, stage):
    table = odd(spark)
    out = stage(spark, table, SF_SMALL)
    assert out.dtypes == table.dtypes
    assert 0 < out.count() <= table.count()
    assert stage(spark, table.limit(0), SF_SMALL).count() == 0
