"""Live daily gas metrics over a growing ledger.

:func:`start_daily_partials` reduces every micro-batch to one row per
(date, address) -- event count, exact wei, price sum and count -- and writes it
under its ``batch_id`` with dynamic overwrite (replay-safe).  Reading sums the
partials per key, so rows arriving days late still count; nothing is kept in
state and nothing is dropped.  The partial table is small (one row per touched
key per batch) and can be compacted by rewriting :func:`read_daily_totals` to a
new folder.  The input must hold each ledger row once: rows that a re-read
block or a replayed batch repeats are summed again.

:func:`start_daily_totals` takes any ledger rows.  It keeps the rows, finds the
(address, day) pairs that a batch touches -- also those that a row it replaces counted
for -- and puts those pairs' totals over the final rows (``sinks.ledger.final_rows``) in
the place of the earlier ones.  A pair that loses its last row gets a total of no events,
which readers leave out.  Untouched pairs are neither read nor written.

The moving average and the running sum are ROWS windows, which streams do not
support; ``metrics.combined_from_totals`` computes them in batch from the daily
totals, where their input is one row per (address, day).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gasledger.functions.units import wei_to_eth, year_month
from gasledger.operators import decode, metrics
from gasledger.operators.wallets import Wallets
from gasledger.sinks import commits
from gasledger.sinks import ledger as ledger_sink
from gasledger.sources.schemas import MONTH_COLUMN, OWNER_COLUMNS
from gasledger.streaming.ingest import source_name

PARTIALS_SCHEMA = (
    "address string, date date, events_collected long, wei decimal(38,0), "
    "price_sum decimal(38,0), price_n long, block_min long, block_max long, batch_id long"
)


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def start_daily_partials(
    ledger_stream: DataFrame,
    table_path: str,
    checkpoint: str,
    wallets: Wallets = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Stream ledger rows into per-batch daily partial totals (exact, no watermark)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        totals = metrics.daily_totals(batch, wallets)
        _write_batch(totals, table_path, batch_id)

    return (
        ledger_stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )


def read_daily_totals(spark: SparkSession, table_path: str) -> DataFrame:
    """Daily totals (the shape of ``metrics.daily_totals``) from the partials."""
    p = spark.read.schema(PARTIALS_SCHEMA).parquet(table_path)
    return p.groupBy("address", "date").agg(
        F.sum("events_collected").alias("events_collected"),
        F.sum("wei").cast("decimal(38,0)").alias("wei"),
        F.sum("price_sum").cast("decimal(38,0)").alias("price_sum"),
        F.sum("price_n").alias("price_n"),
        F.min("block_min").alias("block_min"),
        F.max("block_max").alias("block_max"),
    )


def compact_daily_partials(spark: SparkSession, src: str, dst: str) -> None:
    """Fold all partials into one row per (address, date), written to a new folder.

    The result is itself a valid partials table (one batch, ``batch_id`` 0), so
    :func:`read_daily_totals` reads either; never writes where it reads.
    """
    if src.rstrip("/") == dst.rstrip("/"):
        raise ValueError("compaction must write to a new folder")
    _write_batch(read_daily_totals(spark, src), dst, 0)


# --- totals that follow re-read rows ------------------------------------------------

TOTALS = T.StructType([
    T.StructField("address", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("events_collected", T.LongType()),
    T.StructField("wei", T.DecimalType(38, 0)),
    T.StructField("price_sum", T.DecimalType(38, 0)),
    T.StructField("price_n", T.LongType()),
    T.StructField("block_min", T.LongType()),
    T.StructField("block_max", T.LongType()),
])
KEYS = ["wallet_address", "transaction_hash", "block_number"]


def _places(table_path: str) -> tuple[str, str]:
    return f"{table_path.rstrip('/')}/rows", f"{table_path.rstrip('/')}/totals"


def _day(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"address": F.col("from_address"), "date": F.to_date("timestamp")})


def apply_batch(batch: DataFrame, batch_id: int, table_path: str, source: str) -> None:
    """Store one batch of ledger rows and renew the totals of the (address, day) pairs it touches.

    Every step reads the stored rows of the touched block spans or months only.  Both
    writes are commits of (``source``, ``batch_id``): a replay renews the same totals.
    """
    spark = batch.sparkSession
    rows_path, totals_path = _places(table_path)
    others = {s for s, _, _ in commits.state(spark, totals_path).live} - {source}
    if others:
        raise ValueError(f"totals at {table_path} belong to {sorted(others)}: one query a table")
    # a replayed batch may hold other rows than before: those it stored then are touched too
    earlier = ledger_sink.read_ledger(spark, rows_path, with_batch=True) if commits.is_committed(spark, rows_path) else None
    replaced = None
    if earlier is not None:
        replaced = _owned(earlier, source, batch_id).select("from_address", "timestamp", *KEYS)
    ledger_sink.write_batch(batch, rows_path, batch_id, source)
    stored = ledger_sink.read_ledger(spark, rows_path, with_batch=True)
    mine = _owned(stored, source, batch_id).select("from_address", "timestamp", *KEYS)
    if replaced is not None:
        mine = mine.unionByName(replaced)
    mine = mine.persist()
    spans = decode.block_spans(mine)
    # every stored version of the batch's keys tells a pair whose total it is part of
    versions = decode.in_block_spans(stored, spans).join(mine.select(*KEYS).distinct(), KEYS, "left_semi")
    pairs = ["address", "date"]
    touched = (_day(versions.select("from_address", "timestamp").unionByName(mine.select("from_address", "timestamp")))
               .select(*pairs).distinct().persist())
    try:
        months = [r[0] for r in touched.select(year_month(F.col("date").cast("timestamp_ntz"))).distinct().collect()]
        inside = _day(stored.where(F.col(MONTH_COLUMN).isin(months))).join(touched, pairs, "left_semi").select(*KEYS).distinct()
        # a row of a touched pair counts only if no newer version of its key lies elsewhere
        whole = decode.in_block_spans(stored, decode.block_spans(inside)).join(inside, KEYS, "left_semi")
        final = _day(ledger_sink.final_rows(whole.drop(MONTH_COLUMN, *OWNER_COLUMNS))).join(touched, pairs, "left_semi")
        totals = metrics.daily_totals(final.drop(*pairs))
        out = (touched.join(totals, pairs, "left")
               .withColumn("events_collected", F.coalesce("events_collected", F.lit(0)))
               .select(*[F.col(f.name).cast(f.dataType) for f in TOTALS.fields]))
        commits.write(out, totals_path, source, batch_id)
    finally:
        touched.unpersist()
        mine.unpersist()


def _owned(rows: DataFrame, source: str, batch_id: int) -> DataFrame:
    return rows.where((F.col("source") == source) & (F.col("batch_id") == batch_id))


def start_daily_totals(ledger_stream: DataFrame, table_path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Stream ledger rows, repeated and replaced ones included, into daily totals."""
    source = source_name(checkpoint)

    def run(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch, batch_id, table_path, source)

    return (
        ledger_stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )


def _newest(rows: DataFrame) -> DataFrame:
    """The total that the newest batch gave each pair."""
    value = F.struct("batch_id", *[f.name for f in TOTALS.fields if f.name not in ("address", "date")])
    best = rows.groupBy("address", "date").agg(F.max_by(value, "batch_id").alias("v"))
    return best.select("address", "date", "v.*").drop("batch_id").select(*TOTALS.fieldNames())


def read_totals(spark: SparkSession, table_path: str) -> DataFrame:
    """Daily totals (the shape of ``metrics.daily_totals``) as of the newest commit."""
    return _newest(commits.read(spark, _places(table_path)[1], TOTALS)).where("events_collected > 0")


def compact_totals(spark: SparkSession, table_path: str) -> None:
    """Fold the totals of all batches but the newest, which may still be replayed, into one; by one commit."""
    path = _places(table_path)[1]
    before = commits.state(spark, path)
    last = max((b for _, b, _ in before.live), default=0)
    old = {k: v for k, v in before.live.items() if k[1] < last}
    if len(old) > 1:
        owner = max(old)
        rows = commits.read(spark, path, TOTALS, version=before.version).where(F.col("batch_id") < last)
        commits.write(_newest(rows), path, owner[0], owner[1], drops=old)


def daily_cost_from_totals(totals: DataFrame) -> DataFrame:
    return totals.select(
        "date", "address", wei_to_eth("wei").alias("gas_cost_eth"), F.col("wei").cast("string").alias("gas_cost_wei")
    )
