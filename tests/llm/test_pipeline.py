"""The pipeline against plain versions of its stages."""

import corpus_pipeline
from gasledger.llm import decontaminate, tokens
from tests.conftest import SF_SMALL
from tests.llm import brute


def test_pipeline_equals_plain_stages(spark):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    before = {r.doc_id: r.text for r in table.collect()}
    stages = dict(corpus_pipeline.STAGES)

    def kept(text):
        n, _, _, _, again = brute.measures(text)
        return n >= 50 and 100 * again <= 50 * n

    rules = stages["quality_rules"](spark, table, SF_SMALL).cache()
    # so few labels certify no cutoff: what goes fails a base rule
    assert {r.doc_id for r in rules.collect()} == {d for d, t in before.items() if kept(t)}

    lines = stages["line_dedup"](spark, rules, SF_SMALL).cache()
    texts = {r.doc_id: r.text for r in lines.collect()}
    assert set(texts) == {r.doc_id for r in rules.collect()}
    assert all(len(t) <= len(before[d]) for d, t in texts.items()) and any(t != before[d] for d, t in texts.items())

    near = stages["near_dedup"](spark, lines, SF_SMALL).cache()
    want = brute.near(list(texts.items()), 5, 80)
    assert {r.doc_id for r in near.collect()} == {d for d, (_, c) in want.items() if c == d}

    clean = stages["decontamination"](spark, near, SF_SMALL).cache()
    patterns = {tuple(w[i: i + 10]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
                for w in [decontaminate.words_of(r.text.encode())] for i in range(max(1, len(w) - 9)) if w}

    def hit(text):
        w = decontaminate.words_of(text.encode())
        return any(tuple(w[i: i + n]) in patterns for n in {len(p) for p in patterns} for i in range(len(w) - n + 1))

    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in near.collect() if not hit(r.text)}

    library = tokens.load(tokens.default_path())
    pieces = corpus_pipeline.run(spark, SF_SMALL).collect()
    sizes = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in clean.collect()}
    assert {r.doc_id: r.doc_tokens for r in pieces} == sizes
    assert sum(r.length for r in pieces) == sum(sizes.values())
