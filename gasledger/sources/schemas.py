"""Explicit schemas.  Nothing in this package infers or evolves a schema.

Timestamps are ``timestamp_ntz`` holding UTC wall-clock time: the ledger stores
zone-less ISO text of UTC instants, so the UTC date of a row never depends on the
session or host time zone.
"""

from pyspark.sql import types as T

LOG_FIELDS = [
    T.StructField("address", T.StringType()),
    T.StructField("topics", T.ArrayType(T.StringType())),
    T.StructField("data", T.StringType()),
    T.StructField("log_index", T.IntegerType()),
    T.StructField("block_number", T.LongType()),
    T.StructField("block_hash", T.StringType()),
    T.StructField("transaction_hash", T.StringType()),
    T.StructField("transaction_index", T.IntegerType()),
]

# One row per emitted log, as landed from a node.
RAW_LOGS = T.StructType(LOG_FIELDS)

# Block headers: number and UTC time.
RAW_BLOCKS = T.StructType([
    T.StructField("block_number", T.LongType()),
    T.StructField("block_hash", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])

# Transaction receipts; numeric quantities are decimal text, as a node returns them.
RAW_RECEIPTS = T.StructType([
    T.StructField("transaction_hash", T.StringType()),
    T.StructField("block_number", T.LongType()),
    T.StructField("block_hash", T.StringType()),
    T.StructField("transaction_index", T.IntegerType()),
    T.StructField("contract_address", T.StringType(), True),
    T.StructField("cumulative_gas_used", T.StringType()),
    T.StructField("effective_gas_price", T.StringType(), True),
    T.StructField("from", T.StringType()),
    T.StructField("to", T.StringType(), True),
    T.StructField("gas_used", T.StringType()),
    T.StructField("logs", T.ArrayType(T.StructType(LOG_FIELDS))),
    T.StructField("logs_bloom", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("type", T.StringType()),
])

# A ledger row: eight columns, one row per (transaction, tracked wallet).
TRANSFERS = T.StructType([
    T.StructField("block_number", T.LongType()),
    T.StructField("transaction_hash", T.StringType()),
    T.StructField("from_address", T.StringType()),
    T.StructField("to_address", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("receipt_gas_used", T.LongType()),
    T.StructField("receipt_effective_gas_price", T.StringType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])
TRANSFER_COLUMNS = [f.name for f in TRANSFERS.fields]

# What the stored table adds: the wallet a row was exported for, and which of the
# transaction's logs the row is (src 0 sent, 1 received), so that the last log still
# wins when a transaction arrives in several batches.
LEDGER = T.StructType([
    *TRANSFERS.fields,
    T.StructField("wallet_address", T.StringType()),
    T.StructField("src", T.IntegerType()),
    T.StructField("log_index", T.IntegerType()),
])
LEDGER_COLUMNS = [f.name for f in LEDGER.fields]
# Decoded events of tracked wallets that wait for their receipt or block header.
PENDING = T.StructType([
    T.StructField("wallet_address", T.StringType()),
    T.StructField("src", T.IntegerType()),
    *[f for f in LOG_FIELDS if f.name not in ("topics", "data")],
    T.StructField("from_address", T.StringType()),
    T.StructField("to_address", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("data", T.StringType()),
])
# Who wrote a batch: a named source and its batch number.
OWNER_COLUMNS = ("source", "batch_id")
# Partition column of the stored ledger (yyyyMM of `timestamp`).
MONTH_COLUMN = "event_month"

# Export progress, newest row per wallet wins.
PROCESSING_STATE = T.StructType([
    T.StructField("wallet_address", T.StringType()),
    T.StructField("last_processed_block", T.LongType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])
