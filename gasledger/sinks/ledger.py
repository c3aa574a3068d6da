"""The stored ledger: month-partitioned, clustered, bloom-filtered Parquet.

Physical layout (what the table DDL of the original asks of its engine):

* partitioned by ``event_month`` = yyyyMM of ``timestamp``, below the owner of a
  batch (``source``, ``batch_id``);
* clustered inside each file -- by ``(from_address, timestamp)`` (default:
  serves the per-wallet analytics) or by ``(transaction_hash, block_number)``;
* min/max statistics per row group and page on every column (Parquet writes
  them), so ``timestamp`` and ``block_number`` ranges skip row groups;
* bloom filters on ``from_address`` and ``to_address`` so an equality lookup
  of one wallet skips row groups that cannot hold it.

Before the write, rows are range-partitioned on (month, full cluster key):
Spark samples the keys, so a hot month -- or one wallet holding a third of all
rows, which differs in its timestamps -- is split across many tasks instead of
landing in one, and each task writes few, large, sorted files.  The price is
one sampling pass over the final stage before the shuffle; hash partitioning
would avoid it but scatter every task over every month folder (many small
files), which costs more on every later scan.

Batches are idempotent and atomic: :func:`write_batch` writes to a folder of its own and
commits it as the live one of its (source, batch) (``sinks.commits``), so a replay
replaces exactly what it wrote before, also when it now has fewer months or none, a
reader never meets half a batch, and sources never share batch numbers.
Key-level duplicates (re-read boundary blocks, retried exports, a transaction
whose logs arrived in several batches) are resolved on read by :func:`final_rows`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gasledger.functions.units import year_month
from gasledger.operators.keyed import first_per_key
from gasledger.sinks import commits
from gasledger.sources.schemas import LEDGER, LEDGER_COLUMNS, MONTH_COLUMN, OWNER_COLUMNS

LAYOUTS = {
    "address": ("from_address", "timestamp"),
    "key": ("transaction_hash", "block_number"),
}
BLOOM_COLUMNS = ("wallet_address", "from_address", "to_address")


def with_month(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH_COLUMN, year_month("timestamp"))


def with_identity(df: DataFrame) -> DataFrame:
    """``schemas.LEDGER`` columns of ``df``.

    Plain 8-column rows (an export without identity) count as their sender's
    own, as the first and only log of their transaction.
    """
    identity = {"wallet_address": F.col("from_address"), "src": F.lit(0), "log_index": F.lit(0)}
    return df.withColumns({c: v for c, v in identity.items() if c not in df.columns}).select(*LEDGER_COLUMNS)


def _dealt(df: DataFrame, layout: str, partitions: int | None) -> DataFrame:
    """Rows dealt to tasks and sorted as they are to lie in the files."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {sorted(LAYOUTS)}")
    cluster = LAYOUTS[layout]
    d = with_month(df) if MONTH_COLUMN not in df.columns else df
    # the full cluster key, not just the address: a wallet holding a third of a
    # month is one address value but many timestamps, so its rows still split
    keys = [MONTH_COLUMN, *cluster]
    d = d.repartitionByRange(partitions, *keys) if partitions else d.repartitionByRange(*keys)
    return d.sortWithinPartitions(MONTH_COLUMN, *cluster)


def _bloom_options(bloom: bool) -> dict[str, str]:
    """Bloom filters for chunks that outgrow the dictionary (real address cardinality);
    adaptive sizing keeps each filter near its true NDV."""
    if not bloom:
        return {}
    return {"parquet.bloom.filter.adaptive.enabled": "true",
            **{f"parquet.bloom.filter.enabled#{c}": "true" for c in BLOOM_COLUMNS}}


def create_ledger_table(spark: SparkSession, name: str, path: str) -> None:
    """Register the ledger at ``path`` as a catalog table, or bring the registered one up to date.

    A plain ledger (:func:`write_ledger`) is partitioned by month.  A committed one has one
    partition per source, batch and month whose location is the live folder: calling this
    again after a commit adds, moves and drops partitions, so that SQL users read exactly
    the committed rows and their predicates prune partitions.
    """
    committed = commits.is_committed(spark, path)
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in LEDGER.fields)
    owner = "`source` string, `batch_id` bigint, " if committed else ""
    keys = ("`source`, `batch_id`, " if committed else "") + f"`{MONTH_COLUMN}`"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({cols}, {owner}`{MONTH_COLUMN}` int) "
        f"USING parquet PARTITIONED BY ({keys}) LOCATION '{path}'"
    )
    if not committed:
        spark.sql(f"MSCK REPAIR TABLE {name}")
        return
    spec = lambda s, b, m: f"PARTITION (source='{s}', batch_id={b}, {MONTH_COLUMN}={m})"
    live = commits.state(spark, path).live
    known = set()
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
        values = dict(v.split("=", 1) for v in row[0].split("/"))
        known.add((values["source"], int(values["batch_id"]), values[MONTH_COLUMN]))
    for key in known - set(live):
        spark.sql(f"ALTER TABLE {name} DROP {spec(*key)}")
    for key, folder in live.items():
        place = f"'{path.rstrip('/')}/{folder}/{MONTH_COLUMN}={key[2]}'"
        if key in known:
            spark.sql(f"ALTER TABLE {name} {spec(*key)} SET LOCATION {place}")
        else:
            spark.sql(f"ALTER TABLE {name} ADD {spec(*key)} LOCATION {place}")
    spark.sql(f"REFRESH TABLE {name}")


def write_ledger(
    df: DataFrame,
    path: str,
    mode: str = "append",
    layout: str = "address",
    partitions: int | None = None,
    bloom: bool = True,
) -> None:
    """Write ledger rows (``schemas.TRANSFERS`` or ``LEDGER`` columns) to ``path``."""
    rows = _dealt(with_identity(df), layout, partitions)
    rows.write.partitionBy(MONTH_COLUMN).options(**_bloom_options(bloom)).mode(mode).parquet(path)


def write_batch(
    df: DataFrame,
    path: str,
    batch_id: int,
    source: str,
    layout: str = "address",
    partitions: int | None = None,
    bloom: bool = True,
    wallets: tuple[str, ...] = (),
    block: int | None = None,
) -> commits.State:
    """Atomic, idempotent write of one batch: takes the place of what (``source``, ``batch_id``) stored before.

    ``wallets``: whose progress moves to the highest block of the batch (or to ``block``) in the same commit.
    """
    def progress(highest: int | None) -> dict[str, int]:
        reached = block if block is not None else highest
        return {} if reached is None else {w: reached for w in wallets}

    return commits.write(_dealt(with_identity(df), layout, partitions), path, source, batch_id, MONTH_COLUMN,
                         "block_number", progress, _bloom_options(bloom))


def read_ledger(
    spark: SparkSession,
    path: str,
    start: str | None = None,
    end: str | None = None,
    with_batch: bool = False,
) -> DataFrame:
    """Read the ledger with its explicit schema.

    ``start`` / ``end`` (inclusive ``yyyy-MM-dd``) become both a partition
    predicate on ``event_month`` (whole months skipped) and a row predicate on
    ``timestamp`` (row groups skipped by statistics).  Of a committed ledger the live
    folders of the newest commit are read, months outside the range not even listed.
    """
    schema = T.StructType([*LEDGER.fields, T.StructField(MONTH_COLUMN, T.IntegerType())])
    if commits.is_committed(spark, path):
        first, last = (int(d[:4] + d[5:7]) if d else None for d in (start, end))
        df = commits.read(spark, path, schema, MONTH_COLUMN, lambda m: (
            not m.isdigit() or (first is None or int(m) >= first) and (last is None or int(m) <= last)))
    else:
        owner = [T.StructField(c, t) for c, t in zip(OWNER_COLUMNS, (T.StringType(), T.LongType()))]
        df = spark.read.schema(T.StructType([*schema.fields, *owner])).parquet(path)
    if not with_batch:
        df = df.drop(*OWNER_COLUMNS)
    if start is not None:
        df = df.where(F.col(MONTH_COLUMN) >= int(start[:4] + start[5:7]))
        df = df.where(F.col("timestamp") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        df = df.where(F.col(MONTH_COLUMN) <= int(end[:4] + end[5:7]))
        df = df.where(F.col("timestamp") < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz"))
    return df


def final_rows(ledger: DataFrame) -> DataFrame:
    """One row per table key (wallet, ``transaction_hash``, ``block_number``): the last log's newest row.

    The largest (``src``, ``log_index``) wins, as within one batch, then the
    newest ``updated_at``; equal versions fall back to the other columns so the
    answer never depends on row order.  Tables without identity columns are
    keyed by transaction and block alone.
    """
    has = lambda *names: [c for c in names if c in ledger.columns]
    keys = [*has("wallet_address"), "transaction_hash", "block_number"]
    return first_per_key(ledger, keys, [F.col(c).desc_nulls_last() for c in (*has("src", "log_index"), "updated_at")])


def compact(spark: SparkSession, src: str, dst: str, layout: str = "address", partitions: int | None = None) -> None:
    """Rewrite a batch-partitioned ledger as one row per key into a new folder.

    Streams leave one owner folder per micro-batch; this
    resolves duplicate keys and writes large, clustered month files.  It never
    writes where it reads: point readers at ``dst`` once it is complete.
    """
    if src.rstrip("/") == dst.rstrip("/"):
        raise ValueError("compaction must write to a new folder")
    rows = final_rows(read_ledger(spark, src).drop(MONTH_COLUMN))
    write_ledger(rows, dst, mode="errorifexists", layout=layout, partitions=partitions)


def compact_months(spark: SparkSession, path: str, months: list[int], layout: str = "address",
                   partitions: int | None = None) -> commits.State:
    """Fold the live batches of ``months`` into one row per key, published by one commit.

    Readers see the months' batches until the commit and the folded rows from then on; a
    batch that was replayed meanwhile makes the commit fail with ``commits.Conflict``.
    Keys are folded within their months: a key's rows share block and thus time.
    """
    before = commits.state(spark, path)
    wanted = {str(m) for m in months}
    folded = {k: v for k, v in before.live.items() if k[2] in wanted}
    if not folded:
        return before
    schema = T.StructType([*LEDGER.fields, T.StructField(MONTH_COLUMN, T.IntegerType())])
    rows = commits.read(spark, path, schema, MONTH_COLUMN, wanted.__contains__, before.version).drop(*OWNER_COLUMNS)
    return commits.write(_dealt(final_rows(rows.drop(MONTH_COLUMN)), layout, partitions), path, "compacted",
                         before.version, MONTH_COLUMN, "block_number", None, _bloom_options(True), folded)


def duplicate_keys(ledger: DataFrame) -> DataFrame:
    """Table keys (those of :func:`final_rows`) stored more than once, with the number of copies."""
    keys = [c for c in ("wallet_address", "transaction_hash", "block_number") if c in ledger.columns]
    return ledger.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
