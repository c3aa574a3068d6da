"""The pipeline's line stage against brute force over repeated runs of lines."""

import numpy as np

import corpus_pipeline
from gasledger.llm import line_dedup
from tests.conftest import SF_SMALL
from tests.llm import brute


def stage(spark, table):
    return {r.doc_id: r.text for r in dict(corpus_pipeline.STAGES)["line_dedup"](spark, table, SF_SMALL).collect()}


def test_line_stage_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    before = [(r.doc_id, r.text) for r in table.collect() if r.text is not None]
    got = stage(spark, table)
    assert {d: got[d] for d, _ in before} == brute.line_runs(before)


def test_every_repeated_run_goes_wherever_it_begins(spark):
    rng = np.random.default_rng(8)
    pool = [f"line {i}" for i in range(12)] + ["", " \t", "x"]
    rows = [(d, "\n".join(pool[i] for i in rng.integers(0, len(pool), rng.integers(0, 40)))) for d in range(40)]
    rows += [(40, "\n".join(["same"] * 50)), (41, "\n".join(f"run {i}" for i in range(5))),
             (42, "\n".join(["before", *(f"run {i}" for i in range(5)), "after"])), (43, None)]
    table = spark.createDataFrame([(d, t, "gone", 1, "row") for d, t in rows],
                                  "doc_id long, text string, gone string, b int, row string")
    got = stage(spark, table)
    assert got.pop(43) is None
    assert got == brute.line_runs(rows[:-1])
    assert got[40] == "same" and got[42] == "before\nafter"


def test_rows_that_share_an_id_are_told_apart_by_their_text(spark):
    """Lines that occur once stay, whatever another row of the same id loses."""
    rows = [(0, "a b\nc d\ne f"), (1, "a b\nc d\nq r"), (1, "x1 y1\nx2 y2\nx3 y3"), (1, "x1 y1\nx2 y2\nx3 y3"),
            (None, "n1 n\nn2 n"), (5, "n1 n\nn2 n")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    out = line_dedup.drop_repeated_runs(table).collect()
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.text) for r in out)
    assert got == [(-1, "n1 n\nn2 n"), (0, "a b\nc d\ne f"), (1, "q r"), (1, "x1 y1\nx2 y2\nx3 y3"), (1, "x1 y1\nx2 y2\nx3 y3"), (5, "")]
    texts = [r.text for r in line_dedup.dedup_lines(table).where("doc_id = 1").collect()]
    assert texts.count("x1 y1\nx2 y2\nx3 y3") == 2


def test_chunks_beside_columns_of_the_same_names(spark):
    names = ["gone", "b", "row", "key", "id", "h", "line_dedup"]
    table = spark.createDataFrame([(i, "one two\nthree four\nfive six\nseven eight", *names) for i in range(3)],
                                  "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    for r in line_dedup.dedup_lines(table).select("doc_id", *names[:-1]).collect():
        assert list(r)[1:] == names[:-1]
    assert [list(r)[2:] for r in line_dedup.drop_repeated_runs(table).collect()] == [names] * 3
