"""Gas-cost metrics over the stored ledger.

Five analyses: daily cost (wei and ETH), the daily mean gas price and its
7-row moving average, the cumulative cost, a per-address summary, and all of
them combined.  Each takes the ledger DataFrame (``schemas.TRANSFERS``) and a
``wallets`` selection (see ``operators.wallets``): ``None`` computes every
address in one pass.

Semantics kept from the original queries:

* the wallet is ``from_address`` -- the token sender, which is not necessarily
  the account that paid the gas;
* wei = gas_used * effective_gas_price, computed exactly in ``decimal(38,0)``
  (a 64-bit product/sum would wrap or overflow), ETH = wei / 1e18 as double;
* the daily mean price is ``double(sum) / count`` of exact integers;
* the moving average is over the current and 6 preceding *rows* (days with
  data), not 7 calendar days, and it is an unweighted mean of daily means;
* the running sum is over rows in date order, per address.

Plan shape (all addresses): scan (pruned to 5 columns, wallet predicate
pushed) -> partial hash aggregate -> exchange(address, date) -> final
aggregate -> exchange(address) -> sort -> one Window node for both frames.
The first exchange carries at most one row per (address, date, map task): a
hot wallet is pre-aggregated before the shuffle.  The window input is one row
per (address, day), so even the hottest wallet is a few thousand rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gasledger.constants import MA_ROWS_PRECEDING
from gasledger.functions.units import (
    exact_mean,
    normalize_address,
    to_uint,
    utc_date,
    wei,
    wei_sum,
    wei_to_eth,
    wei_to_gwei,
)
from gasledger.operators.wallets import Wallets, select_wallets

CUM_MODES = ("exact", "sequential")


def own_rows(transfers: DataFrame) -> DataFrame:
    """Rows that count for the wallet they were exported for: those it sent.

    A transfer between two tracked wallets is stored once for each; its gas
    belongs to the sender's export only.  Tables without ``wallet_address``
    are taken as they are.
    """
    if "wallet_address" not in transfers.columns:
        return transfers
    return transfers.where(F.col("from_address") == F.col("wallet_address"))


def priced(transfers: DataFrame, wallets: Wallets = None, normalize: bool = False) -> DataFrame:
    """Ledger rows reduced to what the metrics need (column pruning happens here)."""
    t = select_wallets(own_rows(transfers), wallets, "from_address", normalize=normalize)
    address = normalize_address("from_address") if normalize else F.col("from_address")
    return t.select(
        utc_date("timestamp").alias("date"),
        address.alias("address"),
        F.col("block_number"),
        to_uint("receipt_effective_gas_price").alias("price"),
        wei("receipt_gas_used", "receipt_effective_gas_price").alias("wei"),
    )


def daily_totals(
    transfers: DataFrame, wallets: Wallets = None, normalize: bool = False, per_address: bool = True
) -> DataFrame:
    """One row per (address, date): event count, exact wei, price sum and count,
    first and last block."""
    keys = ["address", "date"] if per_address else ["date"]
    return priced(transfers, wallets, normalize).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("events_collected"),
        wei_sum("wei").alias("wei"),
        F.sum("price").alias("price_sum"),
        F.count("price").alias("price_n"),
        F.min("block_number").alias("block_min"),
        F.max("block_number").alias("block_max"),
    )


def _window(per_address: bool) -> Window:
    w = Window.orderBy("date")
    return Window.partitionBy("address").orderBy("date") if per_address else w


def moving_average(col, per_address: bool = True):
    """Mean of ``col`` over the current and the 6 preceding rows in date order."""
    frame = _window(per_address).rowsBetween(-MA_ROWS_PRECEDING, Window.currentRow)
    return F.avg(col).over(frame)


def _ordered(df: DataFrame, ordered: bool, per_address: bool = True) -> DataFrame:
    if not ordered:
        return df
    return df.orderBy("date", "address") if per_address and "address" in df.columns else df.orderBy("date")


def daily_gas_cost(
    transfers: DataFrame, wallets: Wallets = None, normalize: bool = False, ordered: bool = True
) -> DataFrame:
    """Daily gas cost per (date, address): ``gas_cost_wei`` (exact, text), ``gas_cost_eth``."""
    d = daily_totals(transfers, wallets, normalize)
    out = d.select(
        "date",
        "address",
        wei_to_eth("wei").alias("gas_cost_eth"),
        F.col("wei").cast("string").alias("gas_cost_wei"),
    )
    return _ordered(out, ordered)


def daily_avg_gas_price(
    transfers: DataFrame,
    wallets: Wallets = None,
    normalize: bool = False,
    per_address: bool = True,
    ordered: bool = True,
) -> DataFrame:
    """Mean effective gas price (wei, double) per day."""
    d = daily_totals(transfers, wallets, normalize, per_address)
    keys = ["date", "address"] if per_address else ["date"]
    out = d.select(*keys, exact_mean(F.col("price_sum"), F.col("price_n")).alias("avg_gas_price_wei"))
    return _ordered(out, ordered, per_address)


def ma7_gas_price(
    transfers: DataFrame,
    wallets: Wallets = None,
    normalize: bool = False,
    per_address: bool = True,
    ordered: bool = True,
) -> DataFrame:
    """7-row moving average of the daily mean gas price: ``ma7_wei``, ``ma7_gwei``.

    With ``per_address=False`` the days of all selected wallets are pooled and
    the window has no partition (the original single-wallet form); its input
    is one row per day.
    """
    daily = daily_avg_gas_price(transfers, wallets, normalize, per_address, ordered=False)
    keys = ["date", "address"] if per_address else ["date"]
    out = daily.select(*keys, moving_average(F.col("avg_gas_price_wei"), per_address).alias("ma7_wei"))
    out = out.withColumn("ma7_gwei", wei_to_gwei("ma7_wei"))
    return _ordered(out, ordered, per_address)


def _cumulative(daily: DataFrame, per_address: bool, mode: str) -> DataFrame:
    if mode not in CUM_MODES:
        raise ValueError(f"cum mode must be one of {CUM_MODES}")
    frame = _window(per_address).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if mode == "exact":
        # exact running wei, divided once: identical on every engine
        return daily.withColumn("cum_eth", wei_to_eth(F.sum("wei").over(frame)))
    # running sum of the daily double ETH values, in date order (what a
    # row-by-row engine prints; can differ from the exact form in the last digit)
    return daily.withColumn("cum_eth", F.sum(wei_to_eth("wei")).over(frame))


def cumulative_gas_cost(
    transfers: DataFrame,
    wallets: Wallets = None,
    normalize: bool = False,
    per_address: bool = True,
    mode: str = "exact",
    ordered: bool = True,
) -> DataFrame:
    """Running total of the daily gas cost in ETH: ``daily_gas_cost_eth``, ``cum_eth``."""
    d = daily_totals(transfers, wallets, normalize, per_address)
    out = _cumulative(d, per_address, mode)
    keys = ["date", "address"] if per_address else ["date"]
    out = out.select(*keys, wei_to_eth("wei").alias("daily_gas_cost_eth"), "cum_eth")
    return _ordered(out, ordered, per_address)


def address_summary(transfers: DataFrame, wallets: Wallets = None, normalize: bool = False) -> DataFrame:
    """Per address: event count, first/last block, first/last day, total ETH."""
    p = priced(transfers, wallets, normalize)
    return p.groupBy("address").agg(
        F.count(F.lit(1)).alias("events_collected"),
        F.min("block_number").alias("blocks_scanned_start"),
        F.max("block_number").alias("blocks_scanned_end"),
        F.min("date").alias("period_start"),
        F.max("date").alias("period_end"),
        wei_to_eth(wei_sum("wei")).alias("total_gas_cost_eth"),
    )


def combined_daily_metrics(
    transfers: DataFrame,
    wallets: Wallets = None,
    normalize: bool = False,
    mode: str = "exact",
    ordered: bool = True,
) -> DataFrame:
    """All daily metrics per (date, address) in one plan.

    Both window frames share one partitioning and ordering, so Spark evaluates
    them in a single Window operator after a single exchange.
    """
    return combined_from_totals(daily_totals(transfers, wallets, normalize), mode, ordered)


def combined_from_totals(
    d: DataFrame, mode: str = "exact", ordered: bool = True, keep: tuple[str, ...] = ()
) -> DataFrame:
    """:func:`combined_daily_metrics` from precomputed daily totals.

    ``d`` has the columns of :func:`daily_totals` (e.g. maintained by a stream);
    ``keep`` carries more of its columns to the output.
    """
    d = d.withColumn("ma7_wei", moving_average(exact_mean(F.col("price_sum"), F.col("price_n"))))
    d = _cumulative(d, True, mode)
    out = d.select(
        "date",
        "address",
        F.col("wei").cast("string").alias("gas_cost_wei"),
        wei_to_eth("wei").alias("gas_cost_eth"),
        "ma7_wei",
        wei_to_gwei("ma7_wei").alias("ma7_gwei"),
        "cum_eth",
        *keep,
    )
    return _ordered(out, ordered)
