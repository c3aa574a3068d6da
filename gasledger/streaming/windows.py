"""Moving averages and running sums kept up to date over a growing ledger.

Streams have no ROWS windows, and computing them again from all daily totals reads every
address for each batch.  :func:`start_window_metrics` keeps three tables below one path:

* ``totals`` and ``rows`` of ``streaming.daily``: what a batch changed, as daily totals;
* ``frames``: for each address its newest ``TAIL`` days with their totals and running wei --
  the frame state, at most ``TAIL`` entries an address;
* ``metrics``: one row per (address, day) with the window values, newest batch first.

A batch takes the addresses it touches and the first day it changes for each.  Days before
that keep their values; from it on the window values are computed again, seeded by the six
days before and the running wei up to there.  Both come from the address's frame.  Only an
address changed so far back that its frame does not reach (a late day) reads its days from
``metrics``.  Both tables are partitioned by a hash bucket of the address, so buckets
without a touched address are never listed or read.  A day that loses its last event gets a
row of no events, which readers leave out.

All writes are commits of (source, batch): a batch that is replayed, also with other rows,
builds on the batches before it and takes the place of what it wrote earlier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gasledger.constants import MA_ROWS_PRECEDING
from gasledger.functions.units import exact_mean, wei_to_eth, wei_to_gwei
from gasledger.operators import metrics
from gasledger.sinks import commits
from gasledger.streaming import daily
from gasledger.streaming.ingest import source_name

TAIL = 32          # days a frame holds: changes up to TAIL - 6 days back need no history
BUCKETS = 16       # address buckets of a table; fixed once the table has rows
BUCKET = "address_bucket"

_WEI = T.DecimalType(38, 0)
#: what a day needs to be computed again, and its running sum
DAY = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("events_collected", T.LongType()),
    T.StructField("wei", _WEI),
    T.StructField("price_sum", _WEI),
    T.StructField("price_n", T.LongType()),
    T.StructField("cum_wei", _WEI),
])
_ADDRESS = T.StructField("address", T.StringType())
_BUCKET = T.StructField(BUCKET, T.IntegerType())
METRICS = T.StructType([_ADDRESS, *DAY.fields, T.StructField("ma7_wei", T.DoubleType()), _BUCKET])
FRAMES = T.StructType([_ADDRESS, T.StructField("tail", T.ArrayType(DAY)), T.StructField("whole", T.BooleanType()), _BUCKET])


def _place(table_path: str, name: str) -> str:
    return f"{table_path.rstrip('/')}/{name}"


def _with_bucket(df: DataFrame) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64("address"), F.lit(BUCKETS)).cast("int"))


def _before(spark: SparkSession, path: str, schema: T.StructType, batch_id: int, buckets: set[str]) -> DataFrame:
    """Rows that batches before ``batch_id`` wrote to the given buckets."""
    rows = commits.read(spark, path, schema, partition=BUCKET, keep=lambda value: value in buckets)
    return rows.where(F.col("batch_id") < batch_id)


def _newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The row that the newest batch wrote for each key."""
    rest = [c for c in rows.columns if c not in (*keys, *commits.OWNER)]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("v"))
    return best.select(*keys, "v.*")


def _buckets(df: DataFrame) -> set[str]:
    """The address buckets of ``df``: at most ``BUCKETS`` values come to the driver."""
    return {str(r[0]) for r in _with_bucket(df.select("address")).select(BUCKET).distinct().collect()}


def _write(df: DataFrame, path: str, schema: T.StructType, source: str, batch_id: int, order: list[str]) -> None:
    out = _with_bucket(df).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    out = out.repartitionByRange(BUCKET, *order).sortWithinPartitions(BUCKET, *order)
    commits.write(out, path, source, batch_id, partition=BUCKET)


def known_days(touched: DataFrame, batch_id: int, table_path: str) -> DataFrame:
    """The stored days of the touched addresses (address, first) that the batch builds on.

    Columns: address, first, the day's, and ``whole`` (whether these are all days the address has).
    Addresses without a stored day have one row without a day.
    """
    spark = touched.sparkSession
    frames = _newest(_before(spark, _place(table_path, "frames"), FRAMES, batch_id, _buckets(touched)), ["address"])
    framed = touched.join(frames.select("address", "tail", "whole"), "address", "left").persist()
    reach = F.size(F.filter("tail", lambda d: d["date"] < F.col("first"))) >= MA_ROWS_PRECEDING
    served = F.col("tail").isNull() | F.col("whole") | reach
    near = framed.where(served).select("address", "first", F.coalesce("whole", F.lit(True)).alias("whole"), F.inline_outer("tail"))
    late = framed.where(~served).select("address", "first")
    far = _buckets(late)
    framed.unpersist()
    if not far:
        return near
    days = _before(spark, _place(table_path, "metrics"), METRICS, batch_id, far).join(late.select("address"), "address", "left_semi")
    days = _newest(days, ["address", "date"]).where("events_collected > 0")
    history = late.join(days, "address", "left").withColumn("whole", F.lit(True))
    return near.unionByName(history.select(*near.columns))


def renewed(known: DataFrame, changed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ``METRICS`` from each address's first changed day on, frames of all touched addresses).

    ``changed`` are the batch's totals; those of no events take their day away.
    """
    day = ["events_collected", "wei", "price_sum", "price_n"]
    new = changed.groupBy("address").agg(F.min("date").alias("first")).join(
        changed.select("address", "date", *day), "address")
    whole = known.groupBy("address").agg(F.min("whole").alias("whole"))
    stored = known.where(F.col("date").isNotNull()).join(changed.select("address", "date"), ["address", "date"], "left_anti")
    is_new = F.col("date") >= F.col("first")
    # six rows before the first changed day carry their means; the last one also the running wei
    back = Window.partitionBy("address").orderBy(F.col("date").desc())
    seeds = stored.where(~is_new).withColumn("back", F.row_number().over(back))
    live = (seeds.select("address", "first", "date", *day, "cum_wei", "back")
            .unionByName(stored.where(is_new).select("address", "first", "date", *day, "cum_wei", F.lit(0).alias("back")))
            .unionByName(new.where("events_collected > 0").select(
                "address", "first", "date", *day, F.lit(None).cast(_WEI).alias("cum_wei"), F.lit(0).alias("back"))))
    added = F.when(F.col("back") == 0, F.col("wei")).when(F.col("back") == 1, F.col("cum_wei")).otherwise(F.lit(0).cast(_WEI))
    order = Window.partitionBy("address").orderBy("date")
    valued = (live.withColumn("added", added.cast(_WEI))
              .withColumn("ma7_wei", metrics.moving_average(exact_mean(F.col("price_sum"), F.col("price_n"))))
              .withColumn("cum_wei", F.when(F.col("back") > 0, F.col("cum_wei")).otherwise(
                  F.sum("added").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast(_WEI))))
    gone = new.where("events_collected = 0").select(
        "address", "date", *day, F.lit(None).cast(_WEI).alias("cum_wei"), F.lit(None).cast("double").alias("ma7_wei"))
    rows = valued.where("back = 0").select("address", "date", *day, "cum_wei", "ma7_wei").unionByName(gone)
    kept = (valued.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("address")))
            .withColumn("rank", F.row_number().over(back)).where(F.col("rank") <= TAIL)
            .groupBy("address").agg(F.array_sort(F.collect_list(F.struct(*DAY.fieldNames()))).alias("tail"), F.max("n").alias("n")))
    frames = (whole.join(kept, "address", "left")
              .select("address", F.coalesce("tail", F.array().cast(T.ArrayType(DAY))).alias("tail"),
                      (F.col("whole") & (F.coalesce("n", F.lit(0)) <= TAIL)).alias("whole")))
    return rows, frames


def apply_batch(batch: DataFrame, batch_id: int, table_path: str, source: str) -> None:
    """Store one batch of ledger rows and renew the window values from its first changed days on."""
    spark = batch.sparkSession
    daily.apply_batch(batch, batch_id, table_path, source)
    changed = (commits.read(spark, _place(table_path, "totals"), daily.TOTALS)
               .where((F.col("source") == source) & (F.col("batch_id") == batch_id)).where(F.col("address").isNotNull()))
    apply_changes(changed, batch_id, table_path, source)


def apply_changes(changed: DataFrame, batch_id: int, table_path: str, source: str) -> None:
    """Renew the window values for changed daily totals (``daily.TOTALS``; no events: the day is gone)."""
    touched = changed.groupBy("address").agg(F.min("date").alias("first"))
    known = known_days(touched, batch_id, table_path).persist()
    try:
        rows, frames = renewed(known, changed)
        _write(rows, _place(table_path, "metrics"), METRICS, source, batch_id, ["address", "date"])
        _write(frames, _place(table_path, "frames"), FRAMES, source, batch_id, ["address"])
    finally:
        known.unpersist()


def start_window_metrics(ledger_stream: DataFrame, table_path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Stream ledger rows, repeated, replaced and late ones included, into the combined daily metrics."""
    source = source_name(checkpoint)

    def run(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch, batch_id, table_path, source)

    return (
        ledger_stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )


def read_metrics(spark: SparkSession, table_path: str) -> DataFrame:
    """The columns of ``metrics.combined_daily_metrics`` as of the newest commit."""
    rows = commits.read(spark, _place(table_path, "metrics"), METRICS, partition=BUCKET)
    return _newest(rows.drop(BUCKET), ["address", "date"]).where("events_collected > 0").select(
        "date",
        "address",
        F.col("wei").cast("string").alias("gas_cost_wei"),
        wei_to_eth("wei").alias("gas_cost_eth"),
        "ma7_wei",
        wei_to_gwei("ma7_wei").alias("ma7_gwei"),
        wei_to_eth("cum_wei").alias("cum_eth"),
    )


def compact_metrics(spark: SparkSession, table_path: str) -> None:
    """Fold what all batches but the newest wrote, which may still be replayed, into one batch; one commit a table."""
    daily.compact_totals(spark, table_path)
    for name, schema, keys in (("metrics", METRICS, ["address", "date"]), ("frames", FRAMES, ["address"])):
        path = _place(table_path, name)
        now = commits.state(spark, path)
        last = max((b for _, b, _ in now.live), default=0)
        old = {k: v for k, v in now.live.items() if k[1] < last}
        if len({k[:2] for k in old}) > 1:
            owner = max(old)
            rows = commits.read(spark, path, schema, partition=BUCKET, version=now.version).where(F.col("batch_id") < last)
            out = _newest(rows, keys).select(*schema.fieldNames())
            out = out.repartitionByRange(BUCKET, *keys).sortWithinPartitions(BUCKET, *keys)
            commits.write(out, path, owner[0], owner[1], partition=BUCKET, drops=old)
