"""The SQL text of the analytics equals the DataFrame operators."""

import pytest

from gasledger.operators import metrics
from gasledger.plans.sql import ANALYTICS_SQL, run_analytics
from gasledger.sources import testdata as td

from .conftest import SF_SMALL

WALLET = td.test_wallet(13)


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("name", sorted(ANALYTICS_SQL))
def test_sql_equals_dataframe(spark, name):
    ledger = td.transfers(spark, SF_SMALL)
    got = run_analytics(spark, ledger, name, WALLET)
    want = {
        "daily_gas_cost": lambda: metrics.daily_gas_cost(ledger, WALLET),
        "ma7_gas_price": lambda: metrics.ma7_gas_price(ledger, WALLET, per_address=False),
        "cumulative_gas_cost": lambda: metrics.cumulative_gas_cost(ledger, WALLET, per_address=False),
        "address_summary": lambda: metrics.address_summary(ledger, WALLET),
        "combined_daily_metrics": lambda: metrics.combined_daily_metrics(ledger, WALLET),
    }[name]()
    assert got.count() > 0
    assert _rows(got, got.columns) == _rows(want, got.columns)
