"""Continuous ingest: raw log files -> ledger table, exactly once.

A Structured Streaming query reads raw logs as they land (any file source;
``maxFilesPerTrigger`` bounds a micro-batch the way a block batch size bounds
one export iteration).  Each micro-batch runs the batch operators of
``operators.decode`` / ``operators.ingest`` and is written with
:func:`gasledger.sinks.ledger.write_batch`:

* the stream offset lives in the checkpoint (restart resumes, nothing to code);
* a batch is committed as the live one of its (source, batch), so a batch replayed after
  a failure takes the place of its earlier output instead of adding to it;
* a failing batch fails the query -- it is never skipped -- and the restart
  retries the same batch;
* an empty batch writes nothing.

Receipts and block headers are opened anew for every micro-batch, so files that
land while the query runs are seen, and read with the block spans of the batch,
one per block bucket, as pushed-down predicates.  Events whose receipt or header has
not landed yet go to ``<table>_pending`` under their batch and source, and the next
batch of that source takes them up again: nothing is lost when logs arrive first, and
streams that write into one table keep their waiting events apart.  Events that are
still incomplete ``patience`` blocks behind the batch's highest block are set aside
under ``<table>_aside/unmatched``, and rows whose gas or price is no uint64 under
``<table>_aside/malformed``, by source and batch; one receipt that never comes thus
costs a bounded time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gasledger.constants import USDC_CONTRACT
from gasledger.operators import decode, ingest
from gasledger.operators.wallets import Wallets
from gasledger.sinks import ledger as sink
from gasledger.sources.schemas import PENDING


#: blocks behind a batch's highest one after which an event without receipt or header is set aside
PATIENCE = 50_000

Table = DataFrame | Callable[[], DataFrame]


def _opened(table: Table) -> DataFrame:
    return table() if callable(table) else table


def _pending_path(table_path: str, batch_id: int, source: str) -> str:
    return f"{table_path.rstrip('/')}_pending/batch_id={batch_id}/source={source}"


def _pending(spark: SparkSession, table_path: str, batch_id: int, source: str) -> DataFrame | None:
    """Events that the batches of ``source`` before ``batch_id`` left without receipt or header."""
    if batch_id == 0:
        return None
    path = _pending_path(table_path, batch_id - 1, source)
    fs = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs):
        return None
    return spark.read.schema(PENDING).parquet(path)


def _set_aside(rows: DataFrame, table_path: str, kind: str, batch_id: int, source: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
        f"{table_path.rstrip('/')}_aside/{kind}/source={source}/batch_id={batch_id}")


def tracked(wallets: Wallets) -> tuple[str, ...]:
    """The names under which progress is kept: each wallet of a list, else '*'."""
    if isinstance(wallets, str):
        return (wallets.lower(),)
    return ("*",) if wallets is None or isinstance(wallets, DataFrame) else tuple(w.lower() for w in wallets)


def ingest_batch(
    logs: DataFrame,
    batch_id: int,
    blocks: Table,
    receipts: Table,
    table_path: str,
    contract: str | None = USDC_CONTRACT,
    wallets: Wallets = None,
    source: str = "stream",
    patience: int = PATIENCE,
) -> None:
    """Decode, dedup, enrich and write one micro-batch of raw logs."""
    spark = logs.sparkSession
    decoded = decode.decode_transfer_logs(logs, contract)
    union = ingest.transfers_union(decoded, wallets).select(*PENDING.fieldNames())
    waiting = _pending(spark, table_path, batch_id, source)
    if waiting is not None:
        union = union.unionByName(waiting)
    union = union.persist()
    try:
        spans = decode.block_spans(union)
        if not spans:
            return
        tables = [decode.in_block_spans(_opened(t), spans) for t in (blocks, receipts)]
        found = ingest.matched(ingest.dedup_last(union), *tables).persist()
        try:
            # in the order of what a later reader needs: a replay overwrites all of them
            late = F.col("block_number") < F.lit(spans[-1][2] - patience)
            missing = found.where("not complete").select(*PENDING.fieldNames())
            missing.where(~late).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(
                _pending_path(table_path, batch_id, source))
            good, bad = ingest.split_quarantine(ingest.as_ledger(found.where("complete")))
            _set_aside(missing.where(late), table_path, "unmatched", batch_id, source)
            _set_aside(bad, table_path, "malformed", batch_id, source)
            sink.write_batch(good, table_path, batch_id, source, wallets=tracked(wallets), block=spans[-1][2])
        finally:
            found.unpersist()
    finally:
        union.unpersist()


def source_name(checkpoint: str) -> str:
    """The owner of a stream's batches: its checkpoint numbers them."""
    return f"stream-{hashlib.sha256(checkpoint.rstrip('/').encode()).hexdigest()[:16]}"


def start_ingest(
    raw_logs: DataFrame,
    blocks: Table,
    receipts: Table,
    table_path: str,
    checkpoint: str,
    first_block: int | None = None,
    contract: str | None = USDC_CONTRACT,
    wallets: Wallets = None,
    trigger: dict | None = None,
    patience: int = PATIENCE,
) -> StreamingQuery:
    """Start the ingest query over a streaming DataFrame of raw logs.

    ``first_block`` applies to the first run only in effect: later runs resume
    from the checkpoint's offsets.  ``blocks`` and ``receipts`` are best given as
    functions that open the tables: a DataFrame of files keeps the list of files
    it was made with.  ``trigger`` defaults to
    ``{"processingTime": "30 seconds"}``; tests use ``{"availableNow": True}``.
    """
    stream = raw_logs
    if first_block is not None:
        stream = stream.where(F.col("block_number") >= F.lit(first_block))

    def run(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, batch_id, blocks, receipts, table_path, contract, wallets, source_name(checkpoint), patience)

    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )


def file_stream(
    spark: SparkSession,
    directory: str,
    schema,
    files_per_trigger: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """A Parquet file source over ``directory`` with an explicit schema.

    ``glob`` keeps only matching file names (e.g. one table of a folder).
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(directory)


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query, however long it takes, and surface its failure, if any."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
