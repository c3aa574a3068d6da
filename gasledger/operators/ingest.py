"""From decoded Transfer logs to ledger rows.

Steps (each a DataFrame -> DataFrame function):

1. :func:`transfers_union`   -- every log once per tracked wallet it touches, tagged
   ``src = 0`` when the wallet sent it and ``src = 1`` when it received it.
2. :func:`dedup_last`        -- one row per (wallet, transaction): the winner is the
   largest ``(src, log_index)``.  This is the "last value wins" of concatenating
   the wallet's sent logs and then its received logs, keyed by transaction
   hash: a transaction with several transfers keeps one, and a wallet that both
   sends and receives in a transaction keeps the *received* log.
3. :func:`enrich`            -- inner joins with receipts (gas) and block headers
   (time); events whose receipt is missing are dropped (see
   :func:`missing_receipts`).
4. :func:`nest` / :func:`flatten` -- the nested event record and the 8-column ledger row.

Scale notes.  The union is one ``Generate`` over a single scan (not two scans).
The dedup is keyed by (wallet, hash); hashes are uniform, and the top-1 per key
runs partially on the map side before the shuffle (``operators.keyed``).  The two joins
are the large-large joins of the job: AQE chooses at run time from the real
sizes and splits skewed partitions.  Receipts join on (block, hash), so a block
range prunes both sides of the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gasledger.constants import BUCKET_BLOCKS, USDC_CONTRACT
from gasledger.functions.units import js_default, try_to_uint, utc_now
from gasledger.operators import decode
from gasledger.operators.decode import in_block_range
from gasledger.operators.keyed import first_per_key
from gasledger.operators.wallets import Wallets, select_wallets

LOG_COLUMNS = [
    "address", "block_number", "block_hash", "transaction_hash", "transaction_index",
    "log_index", "from_address", "to_address", "value", "data",
]


def transfers_union(decoded: DataFrame, wallets: Wallets = None) -> DataFrame:
    """Sent and received logs per tracked wallet (``UNION ALL`` with a ``src`` tag).

    Decoded addresses are lower-case hex, so wallets given in checksum
    (mixed) case are lower-cased before matching.
    """
    logs = decoded
    normalize = isinstance(wallets, DataFrame)
    if isinstance(wallets, str):
        wallets = wallets.lower()
    elif wallets is not None and not normalize:
        wallets = [w.lower() for w in wallets]
    if isinstance(wallets, str):
        # prune to the wallet's logs before doubling them
        logs = logs.where((F.col("from_address") == wallets) | (F.col("to_address") == wallets))
    roles = F.array(
        F.struct(F.col("from_address").alias("wallet_address"), F.lit(0).alias("src")),
        F.struct(F.col("to_address").alias("wallet_address"), F.lit(1).alias("src")),
    )
    tagged = logs.select(*LOG_COLUMNS, F.inline(roles))
    return select_wallets(tagged, wallets, "wallet_address", normalize=normalize)


def wallet_transfers(raw_logs: DataFrame, wallet: str, lo: int | None = None, hi: int | None = None,
                     contract: str | None = USDC_CONTRACT) -> DataFrame:
    """One wallet's sent ∪ received Transfers, tagged, straight from raw logs.

    The two scans filter on the raw topics, so on landed logs
    (``sinks.raw_logs``) both wallet predicates reach the Parquet reader.
    Same rows as ``transfers_union(decode_transfer_logs(raw), wallet)``.
    """
    w = wallet.lower()
    sent = decode.scan_sender(raw_logs, w, lo, hi, contract).select(
        *LOG_COLUMNS, F.lit(w).alias("wallet_address"), F.lit(0).alias("src"))
    received = decode.scan_receiver(raw_logs, w, lo, hi, contract).select(
        *LOG_COLUMNS, F.lit(w).alias("wallet_address"), F.lit(1).alias("src"))
    return sent.unionByName(received)


def dedup_last(union: DataFrame) -> DataFrame:
    """One row per (wallet, transaction hash); the largest (src, log_index) wins."""
    # (src, log_index) identifies one log of a transaction for one wallet; equal
    # keys are the same log read twice, so no tie-break (and no extra shuffle
    # columns) is needed
    kept = first_per_key(
        union, ["wallet_address", "transaction_hash"], [F.col("src").desc(), F.col("log_index").desc()],
        tie_break=False,
    )
    return kept.select("wallet_address", "src", *LOG_COLUMNS)


def _range_blocks(blocks: DataFrame, lo: int | None, hi: int | None) -> DataFrame:
    bucket = [c for c in ("block_bucket",) if c in blocks.columns]
    return in_block_range(blocks.select("block_number", "timestamp", *bucket), lo, hi).select("block_number", "timestamp")


def enrich(
    deduped: DataFrame,
    blocks: DataFrame,
    receipts: DataFrame,
    lo: int | None = None,
    hi: int | None = None,
    receipt_columns: tuple[str, ...] = ("gas_used", "effective_gas_price"),
    prune: bool = False,
) -> DataFrame:
    """Join each event with its receipt (inner) and its block time (inner).

    ``prune`` first limits landed receipts and headers to the events' block buckets
    (:func:`event_buckets`): for few wallets, whose events lie in few buckets.
    """
    if prune:
        buckets = event_buckets(deduped)
        blocks, receipts = (in_buckets(d, buckets) for d in (blocks, receipts))
    bucket = [c for c in ("block_bucket",) if c in receipts.columns]
    r = in_block_range(receipts.select("transaction_hash", "block_number", *receipt_columns, *bucket), lo, hi)
    r = r.drop(*bucket)
    return deduped.join(r, ["block_number", "transaction_hash"], "inner").join(
        _range_blocks(blocks, lo, hi), "block_number", "inner")


def in_buckets(landed: DataFrame, buckets: list[int]) -> DataFrame:
    """Rows of a landed table in the given block buckets; other folders are not read."""
    return landed.where(F.col("block_bucket").isin(buckets)) if "block_bucket" in landed.columns else landed


def event_buckets(events: DataFrame) -> list[int]:
    """The block buckets that hold an event: one number per ``BUCKET_BLOCKS`` blocks of the chain at most, a few hundred in all.

    Found by a pass of its own over the events' block numbers.  A broadcast semi join would not do: above
    the dedup's window Spark does not find its broadcast again for dynamic pruning and reads every folder.
    """
    bucket = F.call_function("div", F.col("block_number"), F.lit(BUCKET_BLOCKS))
    return sorted(r[0] for r in events.where(F.col("block_number").isNotNull()).select(bucket).distinct().collect())


def matched(deduped: DataFrame, blocks: DataFrame, receipts: DataFrame) -> DataFrame:
    """Each event once with its receipt and block time, or nulls where one is missing.

    ``complete`` tells whether both are there: one pair of joins serves the rows to
    store and the events that wait.
    """
    r = receipts.select("transaction_hash", "block_number", "gas_used", "effective_gas_price", F.lit(True).alias("has_receipt"))
    h = blocks.select("block_number", "timestamp", F.lit(True).alias("has_header"))
    both = F.coalesce(F.col("has_receipt") & F.col("has_header"), F.lit(False))
    return (deduped.join(r, ["block_number", "transaction_hash"], "left").join(h, "block_number", "left")
            .withColumn("complete", both).drop("has_receipt", "has_header"))


def missing_receipts(deduped: DataFrame, receipts: DataFrame, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Events whose transaction has no receipt (``NOT EXISTS``); ``lo``/``hi`` prune both sides."""
    bucket = [c for c in ("block_bucket",) if c in receipts.columns]
    r = in_block_range(receipts.select("transaction_hash", "block_number", *bucket), lo, hi).drop(*bucket)
    return in_block_range(deduped, lo, hi).join(r, ["block_number", "transaction_hash"], "left_anti")


def unmatched(deduped: DataFrame, blocks: DataFrame, receipts: DataFrame,
              lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Events without a receipt or without a block header (yet)."""
    headers = _range_blocks(blocks, lo, hi).select("block_number")
    return (missing_receipts(deduped, receipts, lo, hi)
            .unionByName(in_block_range(deduped, lo, hi).join(headers, "block_number", "left_anti")).distinct())


def nest(deduped: DataFrame, blocks: DataFrame, receipts: DataFrame,
         lo: int | None = None, hi: int | None = None) -> DataFrame:
    """The nested event record: top-level transfer fields plus a ``receipt`` struct.

    Quantities are text, as in the original record; the receipt's ``logs``
    array is re-shaped element by element with ``transform`` (no explode).
    """
    r = in_block_range(receipts, lo, hi).select(
        "block_number",
        "transaction_hash",
        F.struct(
            F.col("block_hash").alias("blockHash"),
            F.col("block_number").cast("string").alias("blockNumber"),
            F.when(F.col("contract_address") != "", F.col("contract_address")).alias("contractAddress"),
            F.col("cumulative_gas_used").alias("cumulativeGasUsed"),
            js_default("effective_gas_price", "0").alias("effectiveGasPrice"),
            F.col("from").alias("from"),
            F.col("gas_used").alias("gasUsed"),
            receipt_logs(F.col("logs")).alias("logs"),
            F.col("logs_bloom").alias("logsBloom"),
            F.col("status"),
            F.when(F.col("to") != "", F.col("to")).alias("to"),
            F.col("transaction_hash").alias("transactionHash"),
            F.col("transaction_index").cast("string").alias("transactionIndex"),
            F.col("type"),
        ).alias("receipt"),
    )
    joined = deduped.join(r, ["block_number", "transaction_hash"], "inner").join(
        _range_blocks(blocks, lo, hi), "block_number", "inner")
    return joined.select(
        "wallet_address",
        "src",
        F.col("log_index").alias("logIndex"),
        F.col("block_number").cast("string").alias("blockNumber"),
        F.col("transaction_hash").alias("transactionHash"),
        js_default("from_address", "").alias("from"),
        js_default("to_address", "").alias("to"),
        js_default("value", "0").alias("value"),
        F.col("timestamp"),
        F.col("receipt"),
    )


def receipt_logs(logs):
    """Map over a receipt's logs: camel-case fields, quantities as text."""
    return F.transform(
        logs,
        lambda l: F.struct(
            l["address"].alias("address"),
            l["topics"].alias("topics"),
            l["data"].alias("data"),
            l["log_index"].cast("string").alias("logIndex"),
            l["block_number"].cast("string").alias("blockNumber"),
            l["block_hash"].alias("blockHash"),
            l["transaction_hash"].alias("transactionHash"),
            l["transaction_index"].cast("string").alias("transactionIndex"),
        ),
    )


def flatten(events: DataFrame, updated_at: bool = True) -> DataFrame:
    """Nested event -> the ledger row (``schemas.LEDGER``).

    ``from_address`` is the token sender from the event, not the receipt's
    ``from`` (the account that paid the gas).  A missing price becomes ``'0'``.
    """
    cols = [
        F.col("blockNumber").cast("long").alias("block_number"),
        F.col("transactionHash").alias("transaction_hash"),
        F.col("from").alias("from_address"),
        F.col("to").alias("to_address"),
        F.col("timestamp"),
        F.col("receipt.gasUsed").cast("long").alias("receipt_gas_used"),
        F.col("receipt.effectiveGasPrice").alias("receipt_effective_gas_price"),
    ]
    if updated_at:
        cols.append(utc_now().alias("updated_at"))
    return events.select(*cols, "wallet_address", "src", F.col("logIndex").alias("log_index"))


def ledger_rows(deduped: DataFrame, blocks: DataFrame, receipts: DataFrame,
                lo: int | None = None, hi: int | None = None, updated_at: bool = True) -> DataFrame:
    """Ledger rows straight from the joins, without building the nested record."""
    return as_ledger(enrich(deduped, blocks, receipts, lo, hi), updated_at)


def as_ledger(enriched: DataFrame, updated_at: bool = True) -> DataFrame:
    """Events with receipt and block time -> ledger rows."""
    cols = [
        F.col("block_number"),
        F.col("transaction_hash"),
        js_default("from_address", "").alias("from_address"),
        js_default("to_address", "").alias("to_address"),
        F.col("timestamp"),
        F.col("gas_used").try_cast("long").alias("receipt_gas_used"),
        js_default("effective_gas_price", "0").alias("receipt_effective_gas_price"),
    ]
    if updated_at:
        cols.append(utc_now().alias("updated_at"))
    return enriched.select(*cols, "wallet_address", "src", "log_index")


def split_quarantine(ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with a ``reason``) by whether gas and price are uint64.

    Bad rows are set aside instead of failing the whole job; nothing is lost.
    """
    price_ok = try_to_uint("receipt_effective_gas_price").isNotNull()
    gas_ok = F.col("receipt_gas_used").isNotNull() & (F.col("receipt_gas_used") >= 0)
    ok = price_ok & gas_ok
    reason = F.when(~gas_ok, F.lit("bad gas_used")).otherwise(F.lit("bad effective_gas_price"))
    return ledger.where(ok), ledger.where(~ok).withColumn("reason", reason)
