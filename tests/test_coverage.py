"""Gaps between fetched block ranges against a plain set of blocks."""

import random

import pytest

from gasledger import jobs
from gasledger.operators import coverage

RUNS = "run_id long, block_from long, block_to long"


def plain_gaps(runs, lo, hi):
    covered = {b for _, x, y in runs if x is not None and y is not None for b in range(max(x, lo), min(y, hi) + 1)}
    gaps, open_at = [], None
    for b in range(lo, hi + 2):
        free = b <= hi and b not in covered
        if free and open_at is None:
            open_at = b
        elif not free and open_at is not None:
            gaps.append((open_at, b - 1, b - open_at))
            open_at = None
    return gaps


def gaps(spark, runs, lo, hi, width):
    found = coverage.coverage_gaps(spark.createDataFrame(runs, RUNS), lo, hi, width)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("runs,lo,hi,width", [
    ([], 10, 99, 7),                                                   # nothing fetched: one gap over all buckets
    ([(1, 0, 500)], 10, 99, 7),                                        # one run over everything
    ([(1, 20, 29), (2, 22, 25), (3, 25, 40), (1, 20, 29)], 10, 99, 10),  # nested, overlapping, repeated
    ([(1, 10, 19), (2, 30, 39)], 10, 49, 10),                          # gaps from border to border
    ([(1, 9, 9), (2, 50, 50), (3, 12, 11), (4, None, 20), (5, 20, None)], 10, 49, 10),   # outside, reversed, null
    ([(1, 5, 5)], 5, 5, 3),
    ([], 5, 4, 3),
])
def test_gaps(spark, runs, lo, hi, width):
    assert gaps(spark, runs, lo, hi, width) == plain_gaps([r for r in runs if None not in r and r[1] <= r[2]], lo, hi)


def test_random_runs(spark):
    rng = random.Random(11)
    for width in (3, 16, 1000):
        runs = [(i, a, a + rng.choice([0, 1, 5, 40])) for i, a in enumerate(rng.choices(range(90, 420), k=25))]
        assert gaps(spark, runs, 100, 400, width) == plain_gaps(runs, 100, 400)


def test_landing_runs_record_what_they_asked_for(spark, scratch):
    from gasledger.sources import testdata as td
    from tests.conftest import SF_SMALL

    for kind, table in (("l", td.raw_logs), ("b", td.raw_blocks), ("r", td.raw_receipts)):
        table(spark, SF_SMALL).limit(3).write.parquet(f"{scratch}/{kind}")
    for run, lo, hi in (("1", "100", "199"), ("2", "150", "220"), ("3", "300", "310"), ("3", "300", "320")):
        jobs.main(["land", "--logs", f"{scratch}/l", "--blocks", f"{scratch}/b", "--receipts", f"{scratch}/r",
                   "--out", f"{scratch}/out", "--run-id", run, "--from-block", lo, "--to-block", hi], spark)
    jobs.main(["gaps", "--coverage", f"{scratch}/out/coverage", "--from-block", "90", "--to-block", "400",
               "--out", f"{scratch}/gaps"], spark)
    found = sorted(tuple(r) for r in spark.read.parquet(f"{scratch}/gaps").collect())
    assert found == [(90, 99, 10), (221, 299, 79), (321, 400, 80)]
