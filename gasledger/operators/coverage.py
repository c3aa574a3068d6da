"""Which blocks were never fetched: gaps between the ranges that runs covered.

A range that was fetched and holds no event differs from one that was never fetched.
Runs record what they covered as ``(run_id, block_from, block_to)`` (inclusive); runs
may overlap, nest, repeat and leave gaps.  :func:`coverage_gaps` finds every maximal
run of uncovered blocks.

A running maximum over all ranges would need one sorted task.  Instead ranges are cut at
the borders of block buckets and reduced to one row per (bucket, first block); gaps are
found within each bucket; and only gaps that touch a border, at most two a bucket, are
joined across buckets.  A bucket no run touched is one gap from border to border.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gasledger.constants import BUCKET_BLOCKS


def covered_pieces(runs: DataFrame, lo: int, hi: int, width: int = BUCKET_BLOCKS) -> DataFrame:
    """The covered ranges within ``[lo, hi]``, cut at bucket borders: bucket, first, last.

    Ranges with a null bound or whose end lies before their start cover nothing.
    """
    bucket = lambda c: F.floor((c - lo) / width).cast("long")
    cut = (runs.where(F.col("block_from") <= F.col("block_to"))
           .select(F.greatest(F.col("block_from"), F.lit(lo)).alias("a"), F.least(F.col("block_to"), F.lit(hi)).alias("b"))
           .where(F.col("a") <= F.col("b"))
           .select("a", "b", F.explode(F.sequence(bucket(F.col("a")), bucket(F.col("b")))).alias("bucket")))
    start = F.lit(lo) + F.col("bucket") * width
    return (cut.select("bucket", F.greatest("a", start).alias("first"), F.least("b", start + (width - 1)).alias("last"))
            .groupBy("bucket", "first").agg(F.max("last").alias("last")))


def coverage_gaps(runs: DataFrame, lo: int, hi: int, width: int = BUCKET_BLOCKS) -> DataFrame:
    """One row per maximal run of blocks in ``[lo, hi]`` that no run covers: gap_from, gap_to, blocks."""
    spark = runs.sparkSession
    if lo > hi:
        return spark.createDataFrame([], "gap_from long, gap_to long, blocks long")
    buckets = spark.range((hi - lo) // width + 1).withColumnRenamed("id", "bucket")
    start = F.lit(lo) + F.col("bucket") * width
    end = F.least(start + (width - 1), F.lit(hi))
    # one empty piece behind each bucket closes its last gap
    closing = buckets.select("bucket", (end + 1).alias("first"), (end + 1).alias("last"))
    pieces = covered_pieces(runs, lo, hi, width).unionByName(closing)
    before = Window.partitionBy("bucket").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    free = F.coalesce(F.max("last").over(before) + 1, start)
    gaps = (pieces.select("bucket", free.alias("gap_from"), (F.col("first") - 1).alias("gap_to"))
            .where(F.col("gap_from") <= F.col("gap_to")))
    at_border = (F.col("gap_from") == start) | (F.col("gap_to") == end)
    # at most two gaps a bucket reach a border: joined in one small task
    line = Window.orderBy("gap_from")
    joined = (gaps.where(at_border)
              .withColumn("opens", (F.lag("gap_to").over(line).isNull() | (F.lag("gap_to").over(line) + 1 < F.col("gap_from"))).cast("int"))
              .withColumn("island", F.sum("opens").over(line)).groupBy("island")
              .agg(F.min("gap_from").alias("gap_from"), F.max("gap_to").alias("gap_to")))
    out = gaps.where(~at_border).select("gap_from", "gap_to").unionByName(joined.select("gap_from", "gap_to"))
    return out.withColumn("blocks", F.col("gap_to") - F.col("gap_from") + 1)
