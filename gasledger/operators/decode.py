"""Decoding ERC-20 ``Transfer`` events from raw logs, and the log scans.

``Transfer(address indexed from, address indexed to, uint256 value)``: topic 0
is the event signature, topics 1 and 2 hold the two addresses (right-aligned in
32 bytes), ``data`` holds the amount.  Decoding is pure column arithmetic -- no
ABI library and no UDF.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gasledger.constants import BUCKET_BLOCKS, TRANSFER_TOPIC, USDC_CONTRACT
from gasledger.functions.units import address_from_topic, uint256_text


def _topic(raw_logs: DataFrame, i: int):
    """Topic ``i``: the landed top-level column when present (pushable), else the array element."""
    name = f"topic{i}"
    return F.col(name) if name in raw_logs.columns else F.get(F.col("topics"), i)


def address_topic(wallet: str) -> str:
    """The 32-byte topic word of an indexed address argument."""
    return "0x" + "0" * 24 + wallet.lower()[2:]


def in_block_range(df: DataFrame, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Inclusive ``[lo, hi]`` on ``block_number``; a pushed-down Parquet filter.

    On landed tables (a ``block_bucket`` partition column) the same range also
    prunes bucket folders.
    """
    bucketed = "block_bucket" in df.columns
    if lo is not None:
        df = df.where(F.col("block_number") >= F.lit(lo))
        if bucketed:
            df = df.where(F.col("block_bucket") >= F.lit(lo // BUCKET_BLOCKS))
    if hi is not None:
        df = df.where(F.col("block_number") <= F.lit(hi))
        if bucketed:
            df = df.where(F.col("block_bucket") <= F.lit(hi // BUCKET_BLOCKS))
    return df


def block_spans(df: DataFrame) -> list[tuple[int, int, int]]:
    """(bucket, lowest block, highest block) of each block bucket that ``df`` touches."""
    bucket = F.floor(F.col("block_number") / BUCKET_BLOCKS).cast("long").alias("bucket")
    found = df.groupBy(bucket).agg(F.min("block_number").alias("lo"), F.max("block_number").alias("hi"))
    return sorted((r["bucket"], r["lo"], r["hi"]) for r in found.collect())


def in_block_spans(df: DataFrame, spans: list[tuple[int, int, int]]) -> DataFrame:
    """Rows whose block lies in one of ``spans``: far-apart blocks do not read what is between them.

    Row groups are skipped by block statistics and, on landed tables, whole bucket folders.
    """
    wanted = F.lit(False)
    for _, lo, hi in spans:
        wanted = wanted | F.col("block_number").between(lo, hi)
    if "block_bucket" in df.columns:
        df = df.where(F.col("block_bucket").isin([b for b, _, _ in spans]))
    return df.where(wanted)


def decode_transfer_logs(
    raw_logs: DataFrame,
    contract: str | None = USDC_CONTRACT,
    lo: int | None = None,
    hi: int | None = None,
) -> DataFrame:
    """Transfer logs of one token contract (``None``: every contract).

    The contract and block-range predicates are plain column comparisons, so
    they reach the scan; the signature test reads ``topics[0]``.  Logs with a
    different signature or a wrong topic count are dropped (they are not
    Transfers).
    """
    logs = in_block_range(raw_logs, lo, hi)
    if contract is not None:
        logs = logs.where(F.col("address") == F.lit(contract.lower()))
    topics = F.col("topics")
    logs = logs.where((_topic(logs, 0) == F.lit(TRANSFER_TOPIC)) & (F.size(topics) == 3))
    return logs.select(
        "address",
        "block_number",
        "block_hash",
        "transaction_hash",
        "transaction_index",
        "log_index",
        address_from_topic(F.get(topics, 1)).alias("from_address"),
        address_from_topic(F.get(topics, 2)).alias("to_address"),
        uint256_text("data").alias("value"),
        "data",
    )


def logs_by_sender(decoded: DataFrame, wallet: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Transfers sent by ``wallet`` in ``[lo, hi]``."""
    return in_block_range(decoded, lo, hi).where(F.col("from_address") == F.lit(wallet.lower()))


def logs_by_receiver(decoded: DataFrame, wallet: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Transfers received by ``wallet`` in ``[lo, hi]``."""
    return in_block_range(decoded, lo, hi).where(F.col("to_address") == F.lit(wallet.lower()))


def scan_sender(raw_logs: DataFrame, wallet: str, lo: int | None = None, hi: int | None = None,
                contract: str | None = USDC_CONTRACT) -> DataFrame:
    """Transfers sent by ``wallet``, filtered on the raw topic before decoding.

    On landed logs (``sinks.raw_logs``) the predicate is a Parquet equality on
    ``topic1``: row groups without the wallet are skipped by bloom filter.
    """
    raw = raw_logs.where(_topic(raw_logs, 1) == F.lit(address_topic(wallet)))
    return decode_transfer_logs(raw, contract, lo, hi)


def scan_receiver(raw_logs: DataFrame, wallet: str, lo: int | None = None, hi: int | None = None,
                  contract: str | None = USDC_CONTRACT) -> DataFrame:
    """Transfers received by ``wallet`` (predicate on ``topic2``)."""
    raw = raw_logs.where(_topic(raw_logs, 2) == F.lit(address_topic(wallet)))
    return decode_transfer_logs(raw, contract, lo, hi)
