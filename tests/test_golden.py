"""Golden values of the published sample report (four days, one wallet)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from gasledger.functions.units import double_text, wei_to_gwei
from gasledger.operators import metrics, report

WALLET = "0xAbCdEf0123456789aBcDeF0123456789AbCdEf01"

DAYS = ["2025-10-08", "2025-10-09", "2025-10-10", "2025-10-11"]
WEI = ["15844775107618619", "85427764809765545", "1204722328312217503", "204969998565175954"]
ETH = ["0.01584477510761862", "0.08542776480976555", "1.2047223283122177", "0.20496999856517598"]
CUM = ["0.01584477510761862", "0.10127253991738416", "1.3059948682296019", "1.510964866794778"]
MEANS = [387418460.85333335, 591627975.4102564, 10491998882.671053, 4113317433.077671]
MA7_WEI = ["387418460.85333335", "489523218.13179487", "3823681772.9782143", "3896090688.0030785"]
MA7_GWEI = ["0.38741846085333337", "0.4895232181317949", "3.8236817729782144", "3.8960906880030786"]


def ledger(spark, prices):
    """One ledger row per day: gas 1, price = the day's value."""
    rows = [
        (23534907 + i, f"0x{i:064x}", WALLET, "0x" + "0" * 40,
         dt.datetime.fromisoformat(d + "T12:00:00"), 1, str(p), dt.datetime(2025, 10, 12))
        for i, (d, p) in enumerate(zip(DAYS, prices))
    ]
    return spark.createDataFrame(
        rows,
        "block_number long, transaction_hash string, from_address string, to_address string, "
        "timestamp timestamp_ntz, receipt_gas_used long, receipt_effective_gas_price string, "
        "updated_at timestamp_ntz",
    )


def test_daily_cost_and_sequential_cumulative(spark):
    t = ledger(spark, WEI)
    daily = metrics.daily_gas_cost(t, WALLET).select("gas_cost_wei", double_text("gas_cost_eth").alias("e"))
    got = daily.collect()
    assert [r.gas_cost_wei for r in got] == WEI
    assert [r.e for r in got] == ETH
    cum = metrics.cumulative_gas_cost(t, WALLET, mode="sequential").select(double_text("cum_eth").alias("c"))
    assert [r.c for r in cum.collect()] == CUM


def test_exact_cumulative_differs_by_one_ulp_only(spark):
    t = ledger(spark, WEI)
    cum = [r.cum_eth for r in metrics.cumulative_gas_cost(t, WALLET, mode="exact").collect()]
    for got, want in zip(cum, CUM):
        assert math.isclose(got, float(want), rel_tol=1e-15)


def test_moving_average_of_daily_means(spark):
    df = spark.createDataFrame(
        [(dt.date.fromisoformat(d), WALLET, m) for d, m in zip(DAYS, MEANS)], "date date, address string, m double"
    )
    out = df.select("date", metrics.moving_average(F.col("m")).alias("ma7_wei")).orderBy("date")
    out = out.select(
        "ma7_wei",
        wei_to_gwei("ma7_wei").alias("ma7_gwei"),
        double_text("ma7_wei").alias("wei_text"),
        double_text(wei_to_gwei("ma7_wei")).alias("gwei_text"),
    )
    got = out.collect()
    for r, w in zip(got, MA7_WEI):
        assert math.isclose(r.ma7_wei, float(w), rel_tol=1e-12)
    # gwei is ma7_wei / 1e9 exactly
    assert [r.ma7_wei / 1e9 for r in got] == [r.ma7_gwei for r in got]
    assert [r.wei_text for r in got] == MA7_WEI
    assert [r.gwei_text for r in got] == MA7_GWEI


def test_report_document(spark):
    t = ledger(spark, WEI)
    rep = report.metrics_report(t, WALLET).collect()
    assert len(rep) == 1
    r = rep[0]
    assert r.address == WALLET and r.network == "ethereum-mainnet" and r.token == "USDC"
    assert r.summary.events_collected == 4
    assert r.summary.blocks_scanned == [23534907, 23534910]
    assert r.summary.period_utc == ["2025-10-08", "2025-10-11"]
    assert [e.date for e in r.daily_gas_cost] == DAYS
    assert [e.gas_cost_wei for e in r.daily_gas_cost] == WEI
    assert [e.gas_cost_eth for e in r.daily_gas_cost] == ETH
    assert [e.cum_eth for e in r.cumulative_gas_cost_eth] == CUM
    js = report.report_json(report.metrics_report(t, WALLET)).first().json
    assert '"gas_cost_wei":"1204722328312217503"' in js
