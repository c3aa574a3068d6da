"""The five ledger analytics as Spark SQL text.

For users who keep their analytics as SQL: each statement runs over a view
named ``transfers`` (the ledger schema) and takes the wallet as the named
parameter ``:wallet``.  They compute exactly what ``operators.metrics``
computes (wei exact in ``decimal(38,0)``, ROWS frames, mean of daily means);
``run_analytics`` binds the view and the parameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gasledger.operators.metrics import own_rows



def _uint(col: str) -> str:
    """``col`` as an unsigned 64-bit integer; anything else fails, in ANSI mode or not."""
    number = f"TRY_CAST({col} AS DECIMAL(20,0))"
    return (f"CASE WHEN {col} IS NULL THEN NULL WHEN {number} BETWEEN 0 AND 18446744073709551615 THEN {number} "
            f"ELSE CAST(raise_error(concat('not an unsigned 64-bit integer: ', {col})) AS DECIMAL(20,0)) END")


_PRICED = f"""
  SELECT to_date(`timestamp`) AS date,
         from_address AS address,
         block_number,
         {_uint('receipt_effective_gas_price')} AS price,
         coalesce(CAST({_uint('receipt_gas_used')} * {_uint('receipt_effective_gas_price')} AS DECIMAL(38,0)),
                  CASE WHEN receipt_gas_used IS NOT NULL AND receipt_effective_gas_price IS NOT NULL
                  THEN CAST(raise_error('an amount of wei exceeds 38 digits') AS DECIMAL(38,0)) END) AS wei
  FROM {{transfers}}
  WHERE from_address = :wallet"""

# a sum beyond 38 digits fails, in ANSI mode or not
_TOTAL = """coalesce(CAST(sum(wei) AS DECIMAL(38,0)), CASE WHEN count(wei) > 0
       THEN CAST(raise_error('an amount of wei exceeds 38 digits') AS DECIMAL(38,0)) END)"""

ANALYTICS_SQL = {
    "daily_gas_cost": f"""
WITH priced AS ({_PRICED})
SELECT date, address,
       CAST({_TOTAL} AS DOUBLE) / 1e18 AS gas_cost_eth,
       CAST({_TOTAL} AS STRING) AS gas_cost_wei
FROM priced GROUP BY date, address ORDER BY date""",
    "ma7_gas_price": f"""
WITH priced AS ({_PRICED}),
daily AS (SELECT date, CAST(sum(price) AS DOUBLE) / count(price) AS avg_gas_price_wei
          FROM priced GROUP BY date)
SELECT date, ma7_wei, ma7_wei / 1e9 AS ma7_gwei FROM (
  SELECT date, avg(avg_gas_price_wei) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma7_wei
  FROM daily)
ORDER BY date""",
    "cumulative_gas_cost": f"""
WITH priced AS ({_PRICED}),
daily AS (SELECT date, {_TOTAL} AS wei FROM priced GROUP BY date)
SELECT date,
       CAST(sum(wei) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / 1e18 AS cum_eth
FROM daily ORDER BY date""",
    "address_summary": f"""
WITH priced AS ({_PRICED})
SELECT address, count(*) AS events_collected,
       min(block_number) AS blocks_scanned_start, max(block_number) AS blocks_scanned_end,
       min(date) AS period_start, max(date) AS period_end,
       CAST({_TOTAL} AS DOUBLE) / 1e18 AS total_gas_cost_eth
FROM priced GROUP BY address""",
    "combined_daily_metrics": f"""
WITH priced AS ({_PRICED}),
daily AS (
  SELECT date, address, count(*) AS events_collected, {_TOTAL} AS wei,
         CAST(sum(price) AS DOUBLE) / count(price) AS avg_price
  FROM priced GROUP BY date, address),
windowed AS (
  SELECT date, address, wei,
         avg(avg_price) OVER (PARTITION BY address ORDER BY date
                              ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma7_wei,
         sum(wei) OVER (PARTITION BY address ORDER BY date
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_wei
  FROM daily)
SELECT date, address, CAST(wei AS STRING) AS gas_cost_wei, CAST(wei AS DOUBLE) / 1e18 AS gas_cost_eth,
       ma7_wei, ma7_wei / 1e9 AS ma7_gwei, CAST(cum_wei AS DOUBLE) / 1e18 AS cum_eth
FROM windowed ORDER BY date""",
}


def run_analytics(spark: SparkSession, ledger: DataFrame, name: str, wallet: str) -> DataFrame:
    """Run one of :data:`ANALYTICS_SQL` over ``ledger`` for ``wallet``."""
    return spark.sql(ANALYTICS_SQL[name], args={"wallet": wallet}, transfers=own_rows(ledger))
