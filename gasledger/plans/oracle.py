"""Independent SQL (DuckDB dialect) for every query of ``plans.catalog``.

Each statement re-derives its inputs from the driver's tables with the same
rules as ``sources.testdata`` and computes the answer with plain SQL: window
functions, ``row_number()`` for last-wins, ``NOT EXISTS`` for anti joins.
Exact wei is ``decimal(38,0)`` and is returned as text; ETH is
``double(wei) / 1e18``.
"""

from __future__ import annotations

from gasledger.constants import TRANSFER_TOPIC, USDC_CONTRACT
from gasledger.sources.testdata import (
    APPROVAL_TOPIC,
    BLOCK_BASE,
    K_BLOCK_FETCH,
    K_EMPTY_PRICE,
    K_FAILED_FETCH,
    K_NEGATIVE_PRICE,
    K_NO_PRICE,
    K_NO_RECEIPT,
    K_REREAD,
    K_TEXT_PRICE,
    K_WIDE_FETCH,
    OTHER_CONTRACT,
    test_wallet,
)

WALLET = test_wallet(13)
LOG_WALLET = test_wallet(3)


K = "cast(json_extract_string(props, '$.k') AS int)"


def _addr(expr: str) -> str:
    return f"('0x' || lpad(cast({expr} AS varchar), 40, '0'))"


TRANSFERS = f"""
transfers AS (
  SELECT event_id + {BLOCK_BASE} AS block_number,
         '0x' || lpad(cast(event_id AS varchar), 64, '0') AS transaction_hash,
         {_addr('user_id')} AS from_address,
         {_addr('(user_id * 7 + event_id) % 150')} AS to_address,
         ts AS "timestamp",
         21000 + event_id % 100000 AS receipt_gas_used,
         cast(cast(round(value * 100) AS bigint) * 10000000 AS varchar) AS receipt_effective_gas_price,
         ts AS updated_at
  FROM events
)"""


TRANSFERS_K = f"""
transfers_k AS (
  SELECT event_id + {BLOCK_BASE} AS block_number,
         '0x' || lpad(cast(event_id AS varchar), 64, '0') AS transaction_hash,
         {_addr('user_id')} AS from_address,
         {_addr('(user_id * 7 + event_id) % 150')} AS to_address,
         ts AS "timestamp",
         21000 + event_id % 100000 AS receipt_gas_used,
         cast(cast(round(value * 100) AS bigint) * 10000000 AS varchar) AS receipt_effective_gas_price,
         ts AS updated_at,
         {K} AS k
  FROM events
)"""


def _priced(source: str = "transfers", where: str = "") -> str:
    return f"""
priced AS (
  SELECT cast("timestamp" AS date) AS date,
         from_address AS address,
         block_number,
         cast(receipt_effective_gas_price AS decimal(20,0)) AS price,
         cast(cast(receipt_gas_used AS decimal(20,0)) * cast(receipt_effective_gas_price AS decimal(20,0))
              AS decimal(38,0)) AS wei
  FROM {source} {where}
)"""


DAILY = """
daily AS (
  SELECT address, date, count(*) AS events_collected, sum(wei) AS wei,
         sum(price) AS price_sum, count(price) AS price_n,
         min(block_number) AS block_min, max(block_number) AS block_max
  FROM priced GROUP BY address, date
)"""

W_MA = "OVER (PARTITION BY address ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
W_CUM = "OVER (PARTITION BY address ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _metric_sql() -> dict[str, str]:
    base = _with(TRANSFERS, _priced(), DAILY)
    one = _with(TRANSFERS, _priced(where=f"WHERE from_address = '{WALLET}'"), DAILY)
    daily_cost = """
SELECT date, address, cast(wei AS double) / 1e18 AS gas_cost_eth, cast(wei AS varchar) AS gas_cost_wei
FROM daily ORDER BY date, address"""
    combined = f"""
SELECT date, address, cast(wei AS varchar) AS gas_cost_wei, cast(wei AS double) / 1e18 AS gas_cost_eth,
       avg(cast(price_sum AS double) / price_n) {W_MA} AS ma7_wei,
       (avg(cast(price_sum AS double) / price_n) {W_MA}) / 1e9 AS ma7_gwei,
       cast(sum(wei) {W_CUM} AS double) / 1e18 AS cum_eth
FROM daily ORDER BY date, address"""
    return {
        "daily_gas_cost": base + daily_cost,
        "wallet_daily_gas_cost": one + daily_cost,
        "daily_avg_gas_price": base + """
SELECT date, address, cast(price_sum AS double) / price_n AS avg_gas_price_wei FROM daily""",
        "ma7_gas_price": base + f"""
SELECT date, address, avg(cast(price_sum AS double) / price_n) {W_MA} AS ma7_wei,
       (avg(cast(price_sum AS double) / price_n) {W_MA}) / 1e9 AS ma7_gwei
FROM daily""",
        "cumulative_gas_cost": base + f"""
SELECT date, address, cast(wei AS double) / 1e18 AS daily_gas_cost_eth,
       cast(sum(wei) {W_CUM} AS double) / 1e18 AS cum_eth
FROM daily""",
        "address_summary": _with(TRANSFERS, _priced()) + """
SELECT address, count(*) AS events_collected, min(block_number) AS blocks_scanned_start,
       max(block_number) AS blocks_scanned_end, min(date) AS period_start, max(date) AS period_end,
       cast(sum(wei) AS double) / 1e18 AS total_gas_cost_eth
FROM priced GROUP BY address""",
        "wallet_ma7_gas_price": _with(TRANSFERS, _priced(where=f"WHERE from_address = '{WALLET}'")) + """,
daily_avg AS (SELECT date, cast(sum(price) AS double) / count(price) AS avg_gas_price_wei FROM priced GROUP BY date)
SELECT date, ma7_wei, ma7_wei / 1e9 AS ma7_gwei FROM (
  SELECT date, avg(avg_gas_price_wei) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma7_wei
  FROM daily_avg)
ORDER BY date""",
        "wallet_cumulative_gas_cost": _with(TRANSFERS, _priced(where=f"WHERE from_address = '{WALLET}'")) + """,
daily_wei AS (SELECT date, sum(wei) AS wei FROM priced GROUP BY date)
SELECT date, cast(sum(wei) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS double) / 1e18
       AS cum_eth
FROM daily_wei ORDER BY date""",
        "wallet_address_summary": _with(TRANSFERS, _priced(where=f"WHERE from_address = '{WALLET}'")) + """
SELECT address, count(*) AS events_collected, min(block_number) AS blocks_scanned_start,
       max(block_number) AS blocks_scanned_end, min(date) AS period_start, max(date) AS period_end,
       cast(sum(wei) AS double) / 1e18 AS total_gas_cost_eth
FROM priced GROUP BY address""",
        "combined_daily_metrics": one + combined,
        "combined_all_wallets": base + combined,
    }


# Raw logs, decoded straight from the rules (the Spark side slices topics/hex instead).
LOGS = f"""
logs AS (
  SELECT CASE WHEN event_type = 'error' THEN '{OTHER_CONTRACT}' ELSE '{USDC_CONTRACT}' END AS address,
         CASE WHEN event_type = 'signup' THEN '{APPROVAL_TOPIC}' ELSE '{TRANSFER_TOPIC}' END AS topic0,
         {BLOCK_BASE} + cast(floor(event_id / 12) AS bigint) AS block_number,
         '0x' || lpad(cast(cast(floor(event_id / 12) AS bigint) + {BLOCK_BASE} AS varchar), 64, 'b') AS block_hash,
         '0x' || lpad(cast(cast(floor(event_id / 3) AS bigint) AS varchar), 64, '0') AS transaction_hash,
         cast(cast(floor(event_id / 3) AS bigint) % 4 AS int) AS transaction_index,
         cast(event_id % 3 AS int) AS log_index,
         {_addr('user_id % 10')} AS from_address,
         {_addr('(user_id * 7 + event_id) % 10')} AS to_address,
         cast(cast(round(value * 100) AS bigint) AS varchar) AS value,
         '0x' || lpad(lower(hex(cast(round(value * 100) AS bigint))), 64, '0') AS data,
         cast(round(value * 100) AS bigint) AS amount
  FROM events
)"""

DECODED = f"""
decoded AS (
  SELECT address, block_number, block_hash, transaction_hash, transaction_index, log_index,
         from_address, to_address, value, data
  FROM logs WHERE address = '{USDC_CONTRACT}' AND topic0 = '{TRANSFER_TOPIC}'
)"""

UNION = """
u AS (
  SELECT *, from_address AS wallet_address, 0 AS src FROM decoded
  UNION ALL
  SELECT *, to_address AS wallet_address, 1 AS src FROM decoded
)"""

DEDUP = """
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY wallet_address, transaction_hash
                                 ORDER BY src DESC, log_index DESC) AS rn
    FROM u) WHERE rn = 1
)"""

RECEIPTS = f"""
receipts AS (
  SELECT '0x' || lpad(cast(tx AS varchar), 64, '0') AS transaction_hash, block_number,
         cast(gas AS varchar) AS gas_used,
         CASE WHEN no_price = 0 THEN cast(price AS varchar) END AS effective_gas_price
  FROM (
    SELECT cast(floor(event_id / 3) AS bigint) AS tx,
           {BLOCK_BASE} + cast(floor(event_id / 12) AS bigint) AS block_number,
           sum(21000 + event_id % 100000) AS gas,
           max(cast(round(value * 100) AS bigint) * 10000000) AS price,
           max(CASE WHEN {K} = {K_NO_RECEIPT} THEN 1 ELSE 0 END) AS lost,
           max(CASE WHEN {K} = {K_NO_PRICE} THEN 1 ELSE 0 END) AS no_price
    FROM events GROUP BY 1, 2) WHERE lost = 0
)"""

BLOCKS = f"""
blocks AS (
  SELECT {BLOCK_BASE} + cast(floor(event_id / 12) AS bigint) AS block_number, min(ts) AS "timestamp"
  FROM events GROUP BY 1
)"""

ENRICHED = """
enriched AS (
  SELECT d.*, b."timestamp", r.gas_used, r.effective_gas_price
  FROM dedup d JOIN receipts r ON r.transaction_hash = d.transaction_hash
               JOIN blocks b ON b.block_number = d.block_number
)"""

INGEST_BASE = _with(LOGS, DECODED, UNION, DEDUP)
ENRICHED_BASE = _with(LOGS, DECODED, UNION, DEDUP, RECEIPTS, BLOCKS, ENRICHED)

DIRTY = f"""
dirty AS (
  SELECT transaction_hash,
         CASE WHEN k = {K_EMPTY_PRICE} THEN ''
              WHEN k = {K_TEXT_PRICE} THEN 'abc'
              WHEN k = {K_NEGATIVE_PRICE} THEN '-1'
              ELSE receipt_effective_gas_price END AS receipt_effective_gas_price
  FROM transfers_k
)"""

LEDGER_FROM_LOGS = """
ledger AS (
  SELECT block_number, transaction_hash, from_address, to_address, "timestamp",
         cast(gas_used AS bigint) AS receipt_gas_used,
         coalesce(effective_gas_price, '0') AS receipt_effective_gas_price
  FROM enriched WHERE from_address = wallet_address   -- each wallet's own export
)"""


def _ingest_sql() -> dict[str, str]:
    dec_cols = ("address, block_number, block_hash, transaction_hash, transaction_index, log_index, "
                "from_address, to_address, value, data")
    range_lo, range_hi = BLOCK_BASE + 100, BLOCK_BASE + 499
    return {
        "decode_transfer_logs": _with(LOGS, DECODED) + "SELECT * FROM decoded",
        "logs_by_sender": _with(LOGS, DECODED) + f"SELECT * FROM decoded WHERE from_address = '{LOG_WALLET}'",
        "logs_by_receiver": _with(LOGS, DECODED) + f"SELECT * FROM decoded WHERE to_address = '{LOG_WALLET}'",
        "logs_in_block_range": _with(LOGS, DECODED)
        + f"SELECT * FROM decoded WHERE block_number BETWEEN {range_lo} AND {range_hi}",
        "transfers_union": _with(LOGS, DECODED, UNION) + f"SELECT {dec_cols}, wallet_address, src FROM u",
        "wallet_transfers_dedup": INGEST_BASE + f"SELECT * FROM dedup WHERE wallet_address = '{LOG_WALLET}'",
        "transfers_dedup_last": INGEST_BASE + "SELECT * FROM dedup",
        "transfers_enriched": ENRICHED_BASE + """
SELECT wallet_address, block_number, transaction_hash, log_index, from_address, to_address, value,
       "timestamp", gas_used AS receipt_gas_used, effective_gas_price AS receipt_effective_gas_price
FROM enriched""",
        "landed_wallet_enriched": ENRICHED_BASE + f"""
SELECT wallet_address, block_number, transaction_hash, log_index, from_address, to_address, value,
       "timestamp", gas_used AS receipt_gas_used, effective_gas_price AS receipt_effective_gas_price
FROM enriched WHERE wallet_address = '{LOG_WALLET}'""",
        "missing_receipts": _with(LOGS, DECODED, UNION, DEDUP, RECEIPTS) + """
SELECT * FROM dedup d WHERE NOT EXISTS (SELECT 1 FROM receipts r WHERE r.transaction_hash = d.transaction_hash)""",
        "receipt_logs_array": _with(LOGS, RECEIPTS) + """
SELECT r.transaction_hash, l.log_index AS pos, l.address, cast(l.log_index AS varchar) AS log_index,
       cast(l.block_number AS varchar) AS block_number,
       '0x' || lpad(lower(hex(l.amount)), 64, '0') AS data,
       '0x' || lpad(substr(l.from_address, 3), 64, '0') AS topic1
FROM receipts r JOIN logs l USING (transaction_hash)""",
        "transfers_flat": ENRICHED_BASE + """
SELECT block_number, transaction_hash, from_address, to_address, "timestamp",
       cast(gas_used AS bigint) AS receipt_gas_used,
       coalesce(effective_gas_price, '0') AS receipt_effective_gas_price,
       wallet_address, src, log_index
FROM enriched""",
        "decode_large_amounts": _with(LOGS, DECODED) + """
SELECT block_number, transaction_hash, log_index,
       cast(cast(value AS hugeint) * cast('20282409603651670423947251286016' AS hugeint) AS varchar) AS value
FROM decoded""",
        "quarantine_rows": _with(TRANSFERS_K, DIRTY) + """
SELECT transaction_hash, receipt_effective_gas_price, 'bad effective_gas_price' AS reason
FROM dirty WHERE try_cast(receipt_effective_gas_price AS decimal(20,0)) IS NULL
              OR try_cast(receipt_effective_gas_price AS decimal(20,0)) < 0""",
        "ledger_metrics_from_logs": _with(LOGS, DECODED, UNION, DEDUP, RECEIPTS, BLOCKS, ENRICHED, LEDGER_FROM_LOGS,
                                          _priced("ledger"), DAILY) + f"""
SELECT date, address, cast(wei AS varchar) AS gas_cost_wei, cast(wei AS double) / 1e18 AS gas_cost_eth,
       avg(cast(price_sum AS double) / price_n) {W_MA} AS ma7_wei,
       (avg(cast(price_sum AS double) / price_n) {W_MA}) / 1e9 AS ma7_gwei,
       cast(sum(wei) {W_CUM} AS double) / 1e18 AS cum_eth
FROM daily""",
    }


REREAD = f"""
reread AS (
  SELECT * EXCLUDE (k) FROM transfers_k
  UNION ALL
  SELECT * EXCLUDE (k) REPLACE ("timestamp" + INTERVAL 1 HOUR AS updated_at) FROM transfers_k WHERE k = {K_REREAD}
)"""

ORDERS_LEDGER = f"""
month_ledger AS (
  SELECT o_orderkey + {BLOCK_BASE} AS block_number,
         '0x' || lpad(cast(o_orderkey AS varchar), 64, '0') AS transaction_hash,
         {_addr('o_custkey % 150')} AS from_address,
         {_addr('o_orderkey % 150')} AS to_address,
         o_orderdate AS "timestamp",
         21000 + o_orderkey % 100000 AS receipt_gas_used,
         cast(cast(round(o_totalprice / 1000 * 100) AS bigint) * 10000000 AS varchar) AS receipt_effective_gas_price,
         o_orderdate AS updated_at,
         cast(strftime(o_orderdate, '%Y%m') AS int) AS event_month
  FROM orders
)"""

STATE = f"""
state AS (
  SELECT {_addr('user_id')} AS wallet_address, event_id AS last_processed_block, ts AS updated_at FROM events
),
latest AS (
  SELECT wallet_address, last_processed_block, updated_at FROM (
    SELECT *, row_number() OVER (PARTITION BY wallet_address
                                 ORDER BY updated_at DESC, last_processed_block DESC) AS rn
    FROM state) WHERE rn = 1
)"""


def _storage_sql() -> dict[str, str]:
    step = 100
    return {
        "transfers_final": _with(TRANSFERS_K, REREAD) + """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_hash, block_number ORDER BY updated_at DESC) AS rn
  FROM reread) WHERE rn = 1""",
        "duplicate_keys": _with(TRANSFERS_K, REREAD) + """
SELECT transaction_hash, block_number, count(*) AS copies FROM reread
GROUP BY transaction_hash, block_number HAVING count(*) > 1""",
        "month_partitions": _with(ORDERS_LEDGER) + "SELECT * FROM month_ledger",
        "ledger_month_scan": _with(ORDERS_LEDGER) + """
SELECT * FROM month_ledger
WHERE "timestamp" >= TIMESTAMP '1995-01-01' AND "timestamp" < TIMESTAMP '1995-07-01'""",
        "stored_wallet_daily_gas_cost": _with(
            ORDERS_LEDGER, _priced("month_ledger", f"WHERE from_address = '{WALLET}'"), DAILY) + """
SELECT date, address, cast(wei AS double) / 1e18 AS gas_cost_eth, cast(wei AS varchar) AS gas_cost_wei FROM daily""",
        "chain_head": _with(BLOCKS) + "SELECT max(block_number) AS head FROM blocks",
        "block_chunks": _with(TRANSFERS) + """
SELECT cast((s - lo) / 1000 AS bigint) AS chunk_no, s AS chunk_from, least(s + 999, hi) AS chunk_to
FROM (SELECT lo, hi, unnest(generate_series(lo, hi - 1, 1000)) AS s
      FROM (SELECT min(block_number) AS lo, max(block_number) AS hi FROM transfers))""",
        "events_per_chunk": _with(LOGS, DECODED) + f""",
span AS (SELECT min(block_number) AS lo, max(block_number) AS hi FROM decoded),
chunks AS (
  SELECT cast((s - lo) / {step} AS bigint) AS chunk_no, s AS chunk_from, least(s + {step - 1}, hi) AS chunk_to
  FROM (SELECT lo, hi, unnest(generate_series(lo, hi - 1, {step})) AS s FROM span)
),
counted AS (
  SELECT cast(floor((d.block_number - span.lo) / {step}) AS bigint) AS chunk_no, count(*) AS events
  FROM decoded d JOIN span ON d.block_number BETWEEN span.lo AND span.hi GROUP BY 1
)
SELECT c.chunk_no, c.chunk_from, c.chunk_to, coalesce(n.events, 0) AS events
FROM chunks c LEFT JOIN counted n ON n.chunk_no = c.chunk_no""",
        "coverage_gaps": f"""
WITH chunks AS (
  SELECT chunk, count(*) FILTER (k = {K_FAILED_FETCH}) AS failed, count(*) FILTER (k = {K_WIDE_FETCH}) AS wide,
         count(*) FILTER (k = {K_BLOCK_FETCH}) AS single
  FROM (SELECT event_id // 24 AS chunk, {K} AS k FROM events) GROUP BY chunk
),
span AS (SELECT min(event_id) // 12 + {BLOCK_BASE} AS lo, max(event_id) // 12 + {BLOCK_BASE} AS hi FROM events),
runs AS (
  SELECT {BLOCK_BASE} + 2 * chunk AS a, {BLOCK_BASE} + 2 * chunk + 1 + CASE WHEN wide > 0 THEN 3 ELSE 0 END AS b
  FROM chunks WHERE failed = 0
  UNION ALL SELECT {BLOCK_BASE} + 2 * chunk, {BLOCK_BASE} + 2 * chunk FROM chunks WHERE single > 0
  UNION ALL SELECT hi + 1, hi + 1 FROM span
),
followed AS (
  SELECT a, coalesce(max(b) OVER (ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, lo) AS free, hi
  FROM runs, span
)
SELECT free AS gap_from, least(a - 1, hi) AS gap_to, least(a - 1, hi) - free + 1 AS blocks FROM followed WHERE free < a AND free <= hi""",
        "latest_progress": _with(STATE) + "SELECT * FROM latest",
        "progress_lookup": _with(STATE) + f"""
SELECT last_processed_block FROM latest WHERE wallet_address = '{WALLET}' ORDER BY updated_at DESC LIMIT 1""",
    }


def oracle_sql() -> dict[str, str]:
    sql = {}
    sql.update(_metric_sql())
    sql.update(_ingest_sql())
    sql.update(_storage_sql())
    sql["metrics_for_wallet_set"] = _with(
        STATE, TRANSFERS,
        _priced(where="WHERE from_address IN (SELECT wallet_address FROM latest)"), DAILY,
    ) + """
SELECT date, address, cast(wei AS double) / 1e18 AS gas_cost_eth, cast(wei AS varchar) AS gas_cost_wei FROM daily"""
    # the streams must land exactly the batch answers
    sql["rpc_json_logs"] = sql["decode_transfer_logs"]
    sql["landed_logs_by_sender"] = sql["logs_by_sender"]
    sql["landed_wallet_transfers_dedup"] = sql["wallet_transfers_dedup"]
    sql["landed_logs_by_receiver"] = sql["logs_by_receiver"]
    sql["metrics_report_flat"] = _with(TRANSFERS, _priced(), DAILY) + f""",
summary AS (
  SELECT address, cast(sum(events_collected) AS bigint) AS events_collected,
         min(block_min) AS blocks_scanned_start, max(block_max) AS blocks_scanned_end,
         strftime(min(date), '%Y-%m-%d') AS period_start, strftime(max(date), '%Y-%m-%d') AS period_end
  FROM daily GROUP BY address
),
ma AS (
  SELECT address, date, wei, avg(cast(price_sum AS double) / price_n) {W_MA} AS ma7_wei FROM daily
)
SELECT s.address, s.events_collected, s.blocks_scanned_start, s.blocks_scanned_end, s.period_start, s.period_end,
       strftime(m.date, '%Y-%m-%d') AS date, cast(m.wei AS varchar) AS gas_cost_wei,
       cast(m.wei AS double) / 1e18 AS gas_cost_eth, m.ma7_wei, m.ma7_wei / 1e9 AS ma7_gwei
FROM ma m JOIN summary s ON s.address = m.address"""
    sql["ledger_final_from_logs"] = sql["ledger_metrics_from_logs"]
    # the statements as Spark SQL text, for one wallet
    sql["sql_daily_gas_cost"] = sql["wallet_daily_gas_cost"]
    sql["sql_ma7_gas_price"] = sql["wallet_ma7_gas_price"]
    sql["sql_cumulative_gas_cost"] = sql["wallet_cumulative_gas_cost"]
    sql["sql_address_summary"] = sql["wallet_address_summary"]
    sql["sql_combined_daily_metrics"] = sql["combined_daily_metrics"]
    sql["stream_ingest"] = sql["transfers_flat"]
    sql["stream_daily_gas"] = sql["daily_gas_cost"]
    sql["stream_combined_metrics"] = sql["combined_all_wallets"]
    sql["stream_window_metrics"] = sql["combined_all_wallets"]
    return sql
