"""Readers for node JSON-RPC objects landed as JSON Lines.

A node answers ``eth_getLogs``, ``eth_getBlockByNumber`` and
``eth_getTransactionReceipt`` with camel-case objects whose quantities are
``0x`` hex strings.  These readers take such files (one object per line, any
number of files) with an explicit schema and normalise them into the raw
schemas of ``sources.schemas`` using built-in functions only:

* hex quantities -> ``long`` (block numbers, indexes) or decimal text (gas,
  prices: unsigned 64-bit, exact);
* block ``timestamp`` (epoch seconds, hex) -> UTC wall-clock ``timestamp_ntz``;
* logs flagged ``removed: true`` (dropped by a chain re-organisation) are
  discarded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gasledger.functions.units import epoch_seconds_to_ts, hex_quantity

RPC_LOG_FIELDS = [
    T.StructField("address", T.StringType()),
    T.StructField("topics", T.ArrayType(T.StringType())),
    T.StructField("data", T.StringType()),
    T.StructField("blockNumber", T.StringType()),
    T.StructField("blockHash", T.StringType()),
    T.StructField("transactionHash", T.StringType()),
    T.StructField("transactionIndex", T.StringType()),
    T.StructField("logIndex", T.StringType()),
    T.StructField("removed", T.BooleanType()),
]
RPC_LOG = T.StructType(RPC_LOG_FIELDS)
RPC_BLOCK = T.StructType([
    T.StructField("number", T.StringType()),
    T.StructField("hash", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])
RPC_RECEIPT = T.StructType([
    T.StructField("transactionHash", T.StringType()),
    T.StructField("blockNumber", T.StringType()),
    T.StructField("blockHash", T.StringType()),
    T.StructField("transactionIndex", T.StringType()),
    T.StructField("contractAddress", T.StringType()),
    T.StructField("cumulativeGasUsed", T.StringType()),
    T.StructField("effectiveGasPrice", T.StringType()),
    T.StructField("from", T.StringType()),
    T.StructField("to", T.StringType()),
    T.StructField("gasUsed", T.StringType()),
    T.StructField("logs", T.ArrayType(RPC_LOG)),
    T.StructField("logsBloom", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("type", T.StringType()),
])


def hex_text(col: Column | str) -> Column:
    """Hex quantity -> unsigned decimal text (exact up to 2^64 - 1)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.conv(F.substring(c, 3, 64), 16, 10)


def _log_struct(l) -> Column:
    return F.struct(
        F.lower(l["address"]).alias("address"),
        l["topics"].alias("topics"),
        l["data"].alias("data"),
        hex_quantity(l["logIndex"]).cast("int").alias("log_index"),
        hex_quantity(l["blockNumber"]).alias("block_number"),
        l["blockHash"].alias("block_hash"),
        l["transactionHash"].alias("transaction_hash"),
        hex_quantity(l["transactionIndex"]).cast("int").alias("transaction_index"),
    )


def normalize_logs(rpc_logs: DataFrame) -> DataFrame:
    """``eth_getLogs`` objects -> ``schemas.RAW_LOGS``; removed logs dropped.

    A node reports a reorganised log again with ``removed`` set; within a batch
    read that notice also cancels the log it names (same block hash and index).
    """
    kept = rpc_logs.where(F.coalesce(F.col("removed"), F.lit(False)) == F.lit(False))
    if not rpc_logs.isStreaming:
        gone = rpc_logs.where("removed").select("blockHash", "logIndex").distinct()
        kept = kept.join(gone, ["blockHash", "logIndex"], "left_anti")
    return kept.select(_log_struct(F.struct(*[F.col(f.name) for f in RPC_LOG_FIELDS])).alias("l")).select("l.*")


def normalize_blocks(rpc_blocks: DataFrame) -> DataFrame:
    """Block objects -> ``schemas.RAW_BLOCKS``."""
    return rpc_blocks.select(
        hex_quantity("number").alias("block_number"),
        F.col("hash").alias("block_hash"),
        epoch_seconds_to_ts(hex_quantity("timestamp")).alias("timestamp"),
    )


def normalize_receipts(rpc_receipts: DataFrame) -> DataFrame:
    """Receipt objects -> ``schemas.RAW_RECEIPTS`` (quantities as decimal text)."""
    return rpc_receipts.select(
        F.col("transactionHash").alias("transaction_hash"),
        hex_quantity("blockNumber").alias("block_number"),
        F.col("blockHash").alias("block_hash"),
        hex_quantity("transactionIndex").cast("int").alias("transaction_index"),
        F.col("contractAddress").alias("contract_address"),
        hex_text("cumulativeGasUsed").alias("cumulative_gas_used"),
        hex_text("effectiveGasPrice").alias("effective_gas_price"),
        F.col("from"),
        F.col("to"),
        hex_text("gasUsed").alias("gas_used"),
        F.transform(F.filter("logs", lambda l: ~F.coalesce(l["removed"], F.lit(False))), _log_struct).alias("logs"),
        F.col("logsBloom").alias("logs_bloom"),
        F.col("status"),
        F.col("type"),
    )


def _read(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """JSON Lines; a line that is not a JSON object of this schema fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    return normalize_logs(_read(spark, RPC_LOG, path))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return normalize_blocks(_read(spark, RPC_BLOCK, path))


def read_receipts(spark: SparkSession, path: str) -> DataFrame:
    return normalize_receipts(_read(spark, RPC_RECEIPT, path))


def to_rpc_logs(raw_logs: DataFrame) -> DataFrame:
    """``schemas.RAW_LOGS`` -> ``eth_getLogs`` objects (hex quantities)."""
    hx = lambda c: F.concat(F.lit("0x"), F.lower(F.hex(F.col(c).cast("long"))))
    return raw_logs.select(
        "address",
        "topics",
        "data",
        hx("block_number").alias("blockNumber"),
        F.col("block_hash").alias("blockHash"),
        F.col("transaction_hash").alias("transactionHash"),
        hx("transaction_index").alias("transactionIndex"),
        hx("log_index").alias("logIndex"),
        F.lit(False).alias("removed"),
    )
