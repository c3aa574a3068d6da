"""Amounts of wei beyond 38 digits are an error in either ANSI mode."""

import pytest

from gasledger.operators import metrics
from gasledger.plans import sql

from .test_daily_totals import A, frame, row


def with_gas(r, gas):
    return (*r[:5], gas, *r[6:])


HUGE = [with_gas(row(1, 1, price=2**64 - 1), 2**63 - 1), row(2, 1)]
MANY = [with_gas(row(i, 1, price=10**19), 9 * 10**18) for i in range(1, 4)]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("rows", [HUGE, MANY])
def test_overflow_raises(spark, ansi, rows):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = frame(spark, rows)
        for query in (lambda: metrics.daily_gas_cost(df), lambda: sql.run_analytics(spark, df, "daily_gas_cost", A)):
            with pytest.raises(Exception):
                query().collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
