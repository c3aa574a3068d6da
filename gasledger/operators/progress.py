"""Export progress: the last processed block per wallet.

Progress is an append-only table of ``(wallet_address, last_processed_block,
updated_at)`` versions; the newest version of each wallet is the state (the
replace-by-version table of the original).  The live streaming path keeps its
offset in the streaming checkpoint instead; this table serves batch re-runs
and audits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gasledger.functions.units import utc_now
from gasledger.operators.keyed import first_per_key
from gasledger.sources.schemas import PROCESSING_STATE


def latest_progress(state: DataFrame) -> DataFrame:
    """Newest version per wallet (ties on ``updated_at``: the higher block)."""
    rows = state.select("wallet_address", "last_processed_block", "updated_at")
    return first_per_key(
        rows, ["wallet_address"], [F.col("updated_at").desc_nulls_last(), F.col("last_processed_block").desc()]
    )


def progress_lookup(spark: SparkSession, state: DataFrame, wallet: str) -> DataFrame:
    """``last_processed_block`` of one wallet, or no row when it has none.

    The wallet is a bound parameter of the SQL text, never spliced into it.
    """
    return spark.sql(
        "SELECT last_processed_block FROM {latest} WHERE wallet_address = :wallet "
        "ORDER BY updated_at DESC LIMIT 1",
        args={"wallet": wallet},
        latest=latest_progress(state),
    )


def save_progress(spark: SparkSession, path: str, wallet: str, block: int) -> None:
    """Append one progress version (never rewrites older ones)."""
    row = spark.createDataFrame([(wallet, int(block))], "wallet_address string, last_processed_block long")
    row.select("wallet_address", "last_processed_block", utc_now().alias("updated_at")).write.mode(
        "append"
    ).parquet(path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROCESSING_STATE).parquet(path)
