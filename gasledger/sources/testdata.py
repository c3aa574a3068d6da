"""Ledger-shaped views over the driver's generated tables.

The driver ships TPC-H-like tables plus an ``events`` table
(``event_id, ts, user_id, event_type, value, props``).  These adapters derive
every input of the ledger from it -- raw logs, block headers, receipts, the
stored transfers table, progress rows -- with projections and aggregations
that Spark runs over the whole table, so every query's work grows with the
data.  The same derivations are spelled in SQL in ``plans.oracle``.

Derivation rules (fixed values of the test fixture):
- address of integer n: ``'0x' || lpad(n, 40, '0')``
- transfers: one row per event; block ``event_id + 23534907``; hash
  ``'0x' || lpad(event_id, 64, '0')``; from ``addr(user_id)``; to
  ``addr((user_id*7 + event_id) % 150)``; gas ``21000 + event_id % 100000``;
  price ``round(value*100) * 10000000`` wei as text.
- raw logs: three logs per transaction (``event_id / 3``), four transactions
  per block (``event_id / 12``); from ``addr(user_id % 10)``, to
  ``addr((user_id*7 + event_id) % 10)``; amount ``round(value*100)``.  Logs
  of ``error`` events come from another contract, ``signup`` events carry the
  Approval signature: both must be filtered out by the decoder.
- receipts: one per transaction, gas = sum of its events' gas, price = max of
  their prices.  Conditions come from each event's own attribute ``k`` (the
  ``props`` JSON): a transaction with an event of ``k = 0`` has no receipt
  (the node lost it), one with ``k = 1`` has no price (defaults to '0').
- re-read rows: ledger rows of ``k = 99`` are written a second time, one hour
  newer; dirty prices: ``k`` 2, 3, 4 give '', 'abc', '-1'.
- fetch runs: requests of two blocks (run = request / 50); one with an event of ``k = 5``
  failed, ``k = 6`` makes it reach three blocks further, ``k = 7`` adds a run over its
  first block alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gasledger.constants import TRANSFER_TOPIC, USDC_CONTRACT

# --- fixed values of the fixture --------------------------------------------
BLOCK_BASE = 23534907
ADDRESS_SPACE = 150
LOG_ADDRESS_SPACE = 10
OTHER_CONTRACT = "0x" + "0" * 36 + "beef"
APPROVAL_TOPIC = "0x8c5be1e5ebec7d5bd14f71427d1e84f3dd0314c0f7b2291e5b200ac8c7c3b925"
# conditions keyed on the events' own attribute k (props = {"k": 0..99})
K_NO_RECEIPT = 0      # a transaction with such an event has no receipt
K_NO_PRICE = 1        # ... its receipt has no effective gas price
K_EMPTY_PRICE, K_TEXT_PRICE, K_NEGATIVE_PRICE = 2, 3, 4   # dirty ledger prices
K_FAILED_FETCH = 5    # a two-block request with such an event was never fetched
K_WIDE_FETCH = 6      # ... reached three blocks further than asked
K_BLOCK_FETCH = 7     # ... whose first block another run fetched on its own
K_REREAD = 99         # ledger rows written twice (boundary block re-read)
# --- end of fixed values ----------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def addr(n: Column) -> Column:
    return F.concat(F.lit("0x"), F.lpad(n.cast("string"), 40, "0"))


def word(n: Column) -> Column:
    """32-byte topic holding an address-like integer."""
    return F.concat(F.lit("0x"), F.lpad(n.cast("string"), 64, "0"))


def _price_wei(value: Column) -> Column:
    return F.round(value * 100).cast("long") * F.lit(10_000_000)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored ledger, one row per event (8 columns)."""
    return transfers_of(events(spark, sf_dir))


def transfers_of(e: DataFrame, extra: tuple[Column, ...] = ()) -> DataFrame:
    """Ledger rows of an events DataFrame (batch or streaming), plus ``extra`` columns."""
    eid = F.col("event_id")
    return e.select(
        (eid + F.lit(BLOCK_BASE)).alias("block_number"),
        F.concat(F.lit("0x"), F.lpad(eid.cast("string"), 64, "0")).alias("transaction_hash"),
        addr(F.col("user_id")).alias("from_address"),
        addr((F.col("user_id") * 7 + eid) % ADDRESS_SPACE).alias("to_address"),
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        (F.lit(21000) + eid % 100000).cast("long").alias("receipt_gas_used"),
        _price_wei(F.col("value")).cast("string").alias("receipt_effective_gas_price"),
        F.col("ts").cast("timestamp_ntz").alias("updated_at"),
        *extra,
    )


def test_wallet(n: int = 13) -> str:
    return "0x" + str(n).rjust(40, "0")


def event_k(props: Column) -> Column:
    """The ``k`` attribute of an event's ``props`` JSON (``{"k": n}``).

    A pattern match rather than a JSON parse: the optimizer may copy this
    expression into several predicates, and the match is the cheaper of the two.
    """
    return F.regexp_extract(props, r'"k"\s*:\s*(-?\d+)', 1).cast("int")


def _log_columns(e: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    tx = F.floor(eid / 3).cast("long")
    block = (F.lit(BLOCK_BASE) + F.floor(eid / 12)).cast("long")
    amount = F.round(F.col("value") * 100).cast("long")
    return e.select(
        eid.alias("event_id"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("user_id"),
        F.col("event_type"),
        F.col("value"),
        tx.alias("tx"),
        block.alias("block_number"),
        (eid % 3).cast("int").alias("log_index"),
        amount.alias("amount"),
        (F.col("user_id") % LOG_ADDRESS_SPACE).alias("from_n"),
        ((F.col("user_id") * 7 + eid) % LOG_ADDRESS_SPACE).alias("to_n"),
        event_k(F.col("props")).alias("k"),
    )


def tx_hash(tx: Column) -> Column:
    return F.concat(F.lit("0x"), F.lpad(tx.cast("string"), 64, "0"))


def block_hash(block: Column) -> Column:
    return F.concat(F.lit("0x"), F.lpad(block.cast("string"), 64, "b"))


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw node logs (``schemas.RAW_LOGS``)."""
    return raw_logs_of(events(spark, sf_dir))


def raw_logs_of(events_df: DataFrame) -> DataFrame:
    """Raw logs of an events DataFrame (batch or streaming)."""
    e = _log_columns(events_df)
    topic0 = F.when(F.col("event_type") == "signup", F.lit(APPROVAL_TOPIC)).otherwise(F.lit(TRANSFER_TOPIC))
    contract = F.when(F.col("event_type") == "error", F.lit(OTHER_CONTRACT)).otherwise(F.lit(USDC_CONTRACT))
    return e.select(
        contract.alias("address"),
        F.array(topic0, word(F.col("from_n")), word(F.col("to_n"))).alias("topics"),
        F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(F.col("amount"))), 64, "0")).alias("data"),
        F.col("log_index"),
        F.col("block_number"),
        block_hash(F.col("block_number")).alias("block_hash"),
        tx_hash(F.col("tx")).alias("transaction_hash"),
        (F.col("tx") % 4).cast("int").alias("transaction_index"),
    )


def raw_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block headers: the earliest event time of each block."""
    e = _log_columns(events(spark, sf_dir))
    return e.groupBy("block_number").agg(F.min("ts").alias("timestamp")).select(
        "block_number", block_hash(F.col("block_number")).alias("block_hash"), "timestamp"
    )


def raw_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receipts (``schemas.RAW_RECEIPTS``), one per transaction that has one.

    The ``logs`` array holds the transaction's own logs (three here; on chain a
    transaction's logs are bounded by its gas limit).
    """
    e = _log_columns(events(spark, sf_dir))
    log = F.struct(
        F.when(F.col("event_type") == "error", F.lit(OTHER_CONTRACT)).otherwise(F.lit(USDC_CONTRACT)).alias("address"),
        F.array(
            F.when(F.col("event_type") == "signup", F.lit(APPROVAL_TOPIC)).otherwise(F.lit(TRANSFER_TOPIC)),
            word(F.col("from_n")),
            word(F.col("to_n")),
        ).alias("topics"),
        F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(F.col("amount"))), 64, "0")).alias("data"),
        F.col("log_index"),
        F.col("block_number"),
        block_hash(F.col("block_number")).alias("block_hash"),
        tx_hash(F.col("tx")).alias("transaction_hash"),
        (F.col("tx") % 4).cast("int").alias("transaction_index"),
    )
    per_tx = (
        e.groupBy("tx", "block_number")
        .agg(
            F.sum(F.lit(21000) + F.col("event_id") % 100000).alias("gas"),
            F.max(_price_wei(F.col("value"))).alias("price"),
            F.min("user_id").alias("sender_n"),
            F.max((F.col("k") == K_NO_RECEIPT).cast("int")).alias("lost"),
            F.max((F.col("k") == K_NO_PRICE).cast("int")).alias("no_price"),
            # ordered by log index: sort (index, log) pairs, keep the log
            F.transform(
                F.array_sort(F.collect_list(F.struct(F.col("log_index").alias("idx"), log.alias("v")))),
                lambda p: p["v"],
            ).alias("logs"),
        )
        .where(F.col("lost") == 0)
    )
    return per_tx.select(
        tx_hash(F.col("tx")).alias("transaction_hash"),
        F.col("block_number"),
        block_hash(F.col("block_number")).alias("block_hash"),
        (F.col("tx") % 4).cast("int").alias("transaction_index"),
        F.lit(None).cast("string").alias("contract_address"),
        F.col("gas").cast("string").alias("cumulative_gas_used"),
        F.when(F.col("no_price") == 0, F.col("price").cast("string")).alias("effective_gas_price"),
        addr(F.col("sender_n")).alias("from"),
        F.lit(USDC_CONTRACT).alias("to"),
        F.col("gas").cast("string").alias("gas_used"),
        F.col("logs"),
        F.lit("0x").alias("logs_bloom"),
        F.lit("success").alias("status"),
        F.lit("eip1559").alias("type"),
    )


def processing_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress rows: many versions per wallet."""
    e = events(spark, sf_dir)
    return e.select(
        addr(F.col("user_id")).alias("wallet_address"),
        F.col("event_id").alias("last_processed_block"),
        F.col("ts").cast("timestamp_ntz").alias("updated_at"),
    )


def reread_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows where some rows (events with ``k = 99``) were written twice.

    The second copy is one hour newer; key dedup must keep it.
    """
    t = transfers_of(events(spark, sf_dir), (event_k(F.col("props")).alias("k"),))
    t = t.withColumn("updated_at", F.col("timestamp"))
    again = t.where(F.col("k") == K_REREAD).withColumn(
        "updated_at", F.col("updated_at") + F.expr("INTERVAL 1 HOUR")
    )
    return t.unionByName(again).drop("k")


def fetch_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block ranges that export runs fetched: requests of two blocks, some failed, overlapping or nested."""
    e = _log_columns(events(spark, sf_dir)).withColumn("chunk", F.floor((F.col("block_number") - BLOCK_BASE) / 2).cast("long"))
    has = lambda k: F.max((F.col("k") == k).cast("int")).alias(f"k{k}")
    chunks = e.groupBy("chunk").agg(has(K_FAILED_FETCH), has(K_WIDE_FETCH), has(K_BLOCK_FETCH))
    start = F.lit(BLOCK_BASE) + F.col("chunk") * 2
    run = F.floor(F.col("chunk") / 50).cast("long")
    asked = chunks.where(F.col(f"k{K_FAILED_FETCH}") == 0).select(
        run.alias("run_id"), start.alias("block_from"), (start + 1 + 3 * F.col(f"k{K_WIDE_FETCH}")).alias("block_to"))
    single = chunks.where(F.col(f"k{K_BLOCK_FETCH}") == 1).select(
        (run + 1000).alias("run_id"), start.alias("block_from"), start.alias("block_to"))
    return asked.unionByName(single)


def dirty_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows where some prices are unusable ('', 'abc', '-1'; by ``k``)."""
    t = transfers_of(events(spark, sf_dir), (event_k(F.col("props")).alias("k"),))
    k = F.col("k")
    price = (
        F.when(k == K_EMPTY_PRICE, F.lit(""))
        .when(k == K_TEXT_PRICE, F.lit("abc"))
        .when(k == K_NEGATIVE_PRICE, F.lit("-1"))
        .otherwise(F.col("receipt_effective_gas_price"))
    )
    return t.withColumn("receipt_effective_gas_price", price).drop("k")


def orders_transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows spread over many months, from ``orders`` (one row per order)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        (k + F.lit(BLOCK_BASE)).alias("block_number"),
        F.concat(F.lit("0x"), F.lpad(k.cast("string"), 64, "0")).alias("transaction_hash"),
        addr(F.col("o_custkey") % ADDRESS_SPACE).alias("from_address"),
        addr(k % ADDRESS_SPACE).alias("to_address"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("timestamp"),
        (F.lit(21000) + k % 100000).cast("long").alias("receipt_gas_used"),
        _price_wei(F.col("o_totalprice") / 1000).cast("string").alias("receipt_effective_gas_price"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("updated_at"),
    )
