"""The nested per-address metrics report (one JSON document per address).

Shape: ``address, network, token``, a ``summary`` (event count, first/last
block, first/last day) and three date-ordered arrays -- daily gas cost,
7-row moving average of the gas price, cumulative cost.  Metric values are
text.

Each array holds one element per *day with data* of the address (never per
event), so the largest array is bounded by the length of the ledger in days.
The arrays are built with ``collect_list`` after the daily aggregate and
sorted inside the row; no data passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gasledger.constants import NETWORK, TOKEN
from gasledger.functions.units import double_text
from gasledger.operators import metrics
from gasledger.operators.wallets import Wallets


def metrics_report(
    transfers: DataFrame,
    wallets: Wallets = None,
    network: str = NETWORK,
    token: str = TOKEN,
    mode: str = "sequential",
    normalize: bool = False,
) -> DataFrame:
    """One row per address with the nested report columns (``schemas.REPORT``).

    ``mode="sequential"`` adds the daily ETH values in date order, which is how
    the published sample report was computed; ``"exact"`` divides the exact
    running wei instead.
    """
    totals = metrics.daily_totals(transfers, wallets, normalize)
    daily = metrics.combined_from_totals(
        totals, mode=mode, ordered=False, keep=("events_collected", "block_min", "block_max")
    )
    day = F.date_format("date", "yyyy-MM-dd")
    # one aggregate per address on top of the window output, which is already
    # partitioned by address: no further exchange, and the summary comes from
    # the daily rows instead of a second pass over the ledger
    per_address = daily.groupBy("address").agg(
        F.sum("events_collected").alias("events_collected"),
        F.min("block_min").alias("blocks_scanned_start"),
        F.max("block_max").alias("blocks_scanned_end"),
        F.date_format(F.min("date"), "yyyy-MM-dd").alias("period_start"),
        F.date_format(F.max("date"), "yyyy-MM-dd").alias("period_end"),
        F.array_sort(F.collect_list(F.struct(
            day.alias("date"),
            F.col("gas_cost_wei").alias("gas_cost_wei"),
            double_text("gas_cost_eth").alias("gas_cost_eth"),
        ))).alias("daily_gas_cost"),
        F.array_sort(F.collect_list(F.struct(
            day.alias("date"),
            double_text("ma7_wei").alias("ma7_wei"),
            double_text("ma7_gwei").alias("ma7_gwei"),
        ))).alias("ma7_effective_gas_price"),
        F.array_sort(F.collect_list(F.struct(
            day.alias("date"),
            double_text("cum_eth").alias("cum_eth"),
        ))).alias("cumulative_gas_cost_eth"),
    )
    return per_address.select(
        "address",
        F.lit(network).alias("network"),
        F.lit(token).alias("token"),
        F.struct(
            F.col("events_collected"),
            F.array("blocks_scanned_start", "blocks_scanned_end").alias("blocks_scanned"),
            F.array("period_start", "period_end").alias("period_utc"),
        ).alias("summary"),
        "daily_gas_cost",
        "ma7_effective_gas_price",
        "cumulative_gas_cost_eth",
    )


def report_json(report: DataFrame) -> DataFrame:
    """``address, json``: each report row as one JSON document."""
    return report.select("address", F.to_json(F.struct(*report.columns)).alias("json"))


def write_reports(report: DataFrame, path: str) -> None:
    """One JSON document per line (JSON Lines), any number of files."""
    report.write.mode("overwrite").json(path)
