"""Reading an existing ledger exported as JSON Lines or CSV.

The original store received rows as one JSON object per line, with the 8
ledger columns and timestamps as zone-less ISO text of UTC time
(``2025-10-08T12:00:00.000``); an export of that table has the same shape (or
CSV with a header).  :func:`read_export` reads it with an explicit schema --
timestamps parsed as UTC wall-clock ``timestamp_ntz``, with or without the
``T`` and milliseconds -- so it can be written into the partitioned ledger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gasledger.sources.schemas import TRANSFER_COLUMNS

# all text first: numbers and times are parsed explicitly below
EXPORT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in TRANSFER_COLUMNS])


def _ts(col: str):
    text = F.regexp_replace(F.col(col), "T", " ")
    good = text.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,6})?$")
    return F.when(text.isNull() | good, text.cast("timestamp_ntz")).otherwise(
        F.raise_error(F.concat(F.lit("not a ledger time: "), F.col(col))))


def read_export(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Ledger rows (``schemas.TRANSFERS``) from a JSON Lines or CSV export."""
    reader = spark.read.schema(EXPORT_SCHEMA).option("mode", "FAILFAST")
    if fmt == "json":
        raw = reader.json(path)
    elif fmt == "csv":
        raw = reader.option("header", "true").csv(path)
    else:
        raise ValueError("fmt must be 'json' or 'csv'")
    return raw.select(
        F.col("block_number").cast("long").alias("block_number"),
        "transaction_hash",
        "from_address",
        "to_address",
        _ts("timestamp").alias("timestamp"),
        F.col("receipt_gas_used").cast("long").alias("receipt_gas_used"),
        "receipt_effective_gas_price",
        _ts("updated_at").alias("updated_at"),
    )
