"""Landing layout for raw chain data that lets scans skip data.

Logs, block headers and receipts are landed partitioned by ``block_bucket`` =
``block_number div 100000``.  Every block-range read of this package
(``operators.decode.in_block_range``) also puts a predicate on
``block_bucket`` when the column is present, so a range -- e.g. the blocks of
one streaming micro-batch -- prunes whole folders of all three tables.

Logs additionally keep ``topic0`` .. ``topic2`` as top-level columns
(predicates on ``topics[i]``, an array element, cannot be pushed into
Parquet), are sorted inside each file by (``address``, ``topic0``,
``block_number``) so contract / signature / block predicates skip row groups
by min/max, and carry bloom filters on ``topic1`` and ``topic2`` (the indexed
``from`` / ``to`` of a Transfer) so a one-wallet scan skips row groups that
cannot hold the wallet.  Receipts carry a bloom filter on the transaction hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gasledger.constants import BUCKET_BLOCKS
from gasledger.sources.schemas import RAW_BLOCKS, RAW_LOGS, RAW_RECEIPTS

BUCKET = "block_bucket"
TOPIC_COLUMNS = ("topic0", "topic1", "topic2")


def _with_bucket(schema: T.StructType, extra: Sequence[str] = ()) -> T.StructType:
    fields = list(schema.fields) + [T.StructField(c, T.StringType()) for c in extra]
    return T.StructType(fields + [T.StructField(BUCKET, T.LongType())])


LANDED_LOGS = _with_bucket(RAW_LOGS, TOPIC_COLUMNS)
LANDED_BLOCKS = _with_bucket(RAW_BLOCKS)
LANDED_RECEIPTS = _with_bucket(RAW_RECEIPTS)


def bucket_of(block_number) -> int:
    return block_number // BUCKET_BLOCKS


def land_by_block(
    df: DataFrame,
    path: str,
    sort_keys: Sequence[str],
    bloom: Sequence[str] = (),
    mode: str = "append",
    partitions: int | None = None,
) -> None:
    """Write ``df`` partitioned by block bucket, range-clustered on ``sort_keys``."""
    d = df.withColumn(BUCKET, F.floor(F.col("block_number") / BUCKET_BLOCKS).cast("long"))
    keys = [BUCKET, *sort_keys]
    d = d.repartitionByRange(partitions, *keys) if partitions else d.repartitionByRange(*keys)
    w = d.sortWithinPartitions(*keys).write.partitionBy(BUCKET)
    if bloom:
        w = w.option("parquet.bloom.filter.adaptive.enabled", "true")
        for c in bloom:
            w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    # an overwrite replaces the whole folder and marks its end with _SUCCESS
    w.mode(mode).option("partitionOverwriteMode", "static").parquet(path)


def with_topic_columns(raw_logs: DataFrame) -> DataFrame:
    return raw_logs.select(
        *RAW_LOGS.fieldNames(), *[F.get("topics", i).alias(c) for i, c in enumerate(TOPIC_COLUMNS)]
    )


def write_raw_logs(raw_logs: DataFrame, path: str, mode: str = "append", partitions: int | None = None) -> None:
    land_by_block(
        with_topic_columns(raw_logs), path, ["address", "topic0", "block_number"], ("topic1", "topic2"),
        mode, partitions,
    )


def write_raw_blocks(blocks: DataFrame, path: str, mode: str = "append", partitions: int | None = None) -> None:
    land_by_block(blocks.select(*RAW_BLOCKS.fieldNames()), path, ["block_number"], (), mode, partitions)


def write_raw_receipts(receipts: DataFrame, path: str, mode: str = "append", partitions: int | None = None) -> None:
    land_by_block(
        receipts.select(*RAW_RECEIPTS.fieldNames()), path, ["block_number", "transaction_index"],
        ("transaction_hash",), mode, partitions,
    )


def _read(spark: SparkSession, schema: T.StructType, path: str, lo: int | None, hi: int | None) -> DataFrame:
    df = spark.read.schema(schema).parquet(path)
    if lo is not None:
        df = df.where(F.col(BUCKET) >= bucket_of(lo))
    if hi is not None:
        df = df.where(F.col(BUCKET) <= bucket_of(hi))
    return df


def read_raw_logs(spark: SparkSession, path: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Landed raw logs; a block range also prunes ``block_bucket`` folders."""
    return _read(spark, LANDED_LOGS, path, lo, hi)


def read_raw_blocks(spark: SparkSession, path: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Landed headers, one per block: runs that overlap may hold the same one twice."""
    return _read(spark, LANDED_BLOCKS, path, lo, hi).dropDuplicates(["block_number", BUCKET])


def read_raw_receipts(spark: SparkSession, path: str, lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Landed receipts, one per transaction and block."""
    return _read(spark, LANDED_RECEIPTS, path, lo, hi).dropDuplicates(["block_number", "transaction_hash", BUCKET])


COVERAGE = T.StructType([T.StructField(c, T.LongType()) for c in ("run_id", "block_from", "block_to")])


def write_coverage(spark: SparkSession, path: str, run_id: int, block_from: int, block_to: int) -> None:
    """Record the inclusive block range that a landing run asked for."""
    row = spark.createDataFrame([(run_id, block_from, block_to)], COVERAGE)
    row.drop("run_id").write.mode("overwrite").parquet(path)


def read_coverage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COVERAGE).parquet(path)
