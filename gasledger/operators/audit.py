"""Coverage audits: chain head, request chunks, events per chunk.

The export job reads a block range in chunks of at most ``step`` blocks and
silently skips a chunk whose request fails.  These operators make coverage
visible: every chunk of a range is listed with the number of events found in
it, so empty or missing chunks show up as zero rows instead of disappearing.

The per-chunk count never runs a range join: an event's chunk number is
``floor((block - lo) / step)``, so events are pre-aggregated by that integer
(partial aggregate before the shuffle) and equi-joined with the chunk list.
The chunk list is generated by ``spark.range`` (distributed), from the two
range bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gasledger.constants import MAX_BLOCKS_PER_REQUEST
from gasledger.functions.blocks import chunk_id
from gasledger.operators.decode import in_block_range


def chain_head(blocks: DataFrame, confirmations: int = 0) -> DataFrame:
    """The newest block number (``head``), less ``confirmations`` blocks."""
    return blocks.agg((F.max("block_number") - F.lit(confirmations)).alias("head"))


def block_span(df: DataFrame) -> tuple[int | None, int | None]:
    """``(lo, hi)`` block bounds of ``df``: two scalars from one aggregate row."""
    row = df.agg(F.min("block_number").alias("lo"), F.max("block_number").alias("hi")).first()
    return row["lo"], row["hi"]


def chunk_count(lo: int, hi: int, step: int) -> int:
    """Chunks a walk from ``lo`` while ``current < hi`` produces."""
    return 0 if lo >= hi else -(-(hi - lo) // step)


def block_chunks(
    spark: SparkSession, lo: int, hi: int, step: int = MAX_BLOCKS_PER_REQUEST, mode: str = "compat"
) -> DataFrame:
    """``chunk_no, chunk_from, chunk_to`` of the range (see ``functions.blocks``)."""
    if mode not in ("compat", "half_open"):
        raise ValueError(f"unknown mode {mode!r}")
    last = hi if mode == "compat" else hi - 1
    start = F.lit(lo) + F.col("id") * F.lit(step)
    return spark.range(chunk_count(lo, hi, step)).select(
        F.col("id").alias("chunk_no"),
        start.alias("chunk_from"),
        F.least(start + F.lit(step - 1), F.lit(last)).alias("chunk_to"),
    )


def events_per_chunk(
    spark: SparkSession,
    events: DataFrame,
    lo: int,
    hi: int,
    step: int = MAX_BLOCKS_PER_REQUEST,
    mode: str = "compat",
) -> DataFrame:
    """Events found in each chunk of ``[lo, hi]``; chunks with none show 0."""
    chunks = block_chunks(spark, lo, hi, step, mode)
    last = hi if mode == "compat" else hi - 1
    counted = (
        in_block_range(events.select("block_number"), lo, last)
        .groupBy(chunk_id(F.col("block_number"), lo, step).alias("chunk_no"))
        .agg(F.count(F.lit(1)).alias("events"))
    )
    return chunks.join(counted, "chunk_no", "left").select(
        "chunk_no", "chunk_from", "chunk_to", F.coalesce(F.col("events"), F.lit(0)).alias("events")
    )
