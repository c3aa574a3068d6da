"""The block-offset stream: batches cut by blocks, restarts, confirmations, and the ingest over it."""

import pytest
from pyspark.sql import functions as F

from gasledger import jobs
from gasledger.sinks import commits, raw_logs as landing
from gasledger.sinks import ledger as sink
from gasledger.sources import block_stream
from gasledger.streaming import ingest as stream
from tests.test_streaming import W, _logs, _static

FIRST = 99_990      # the blocks cross a bucket border


def land(spark, path, blocks, run=1, change=lambda receipts: receipts):
    b, r = _static(spark, blocks)
    r = r.select(*[F.col(f.name) if f.name in r.columns else F.lit(None).cast(f.dataType).alias(f.name)
                   for f in landing.RAW_RECEIPTS.fields])
    landing.write_raw_logs(_logs(spark, blocks), f"{path}/logs/run_id={run}", "overwrite")
    landing.write_raw_blocks(b, f"{path}/blocks/run_id={run}", "overwrite")
    landing.write_raw_receipts(change(r), f"{path}/receipts/run_id={run}", "overwrite")


def ingest(spark, path, **options):
    options = {"blocks_per_batch": 10, "step": 4} | options
    q = stream.start_ingest(
        block_stream.block_log_stream(spark, f"{path}/logs", f"{path}/blocks", **options),
        lambda: landing.read_raw_blocks(spark, f"{path}/blocks"), lambda: landing.read_raw_receipts(spark, f"{path}/receipts"),
        f"{path}/table", f"{path}/ckpt", wallets=W, trigger={"processingTime": "0 seconds"}, patience=15)
    block_stream.run_to_head(q)


def stored(spark, path):
    rows = sink.read_ledger(spark, f"{path}/table", with_batch=True).select("block_number", "batch_id").collect()
    return sorted((r.block_number, r.batch_id) for r in rows)


def test_batches_are_cut_by_blocks_and_resume(spark, scratch):
    land(spark, scratch, range(FIRST, FIRST + 25))
    ingest(spark, scratch, confirmations=2)
    # 23 blocks below the head's confirmations: 10, 10 and 3, across the bucket border
    assert stored(spark, scratch) == [(FIRST + i, i // 10) for i in range(23)]
    progress = commits.state(spark, f"{scratch}/table").progress
    assert progress == {W: FIRST + 22}
    # a second run lands; a new query goes on where the checkpoint ends, with the blocks it held back
    land(spark, scratch, range(FIRST + 25, FIRST + 35), run=2)
    ingest(spark, scratch, confirmations=2)
    assert [b for b, _ in stored(spark, scratch)] == list(range(FIRST, FIRST + 33))
    assert [n for _, n in stored(spark, scratch)][23:] == [3] * 10
    ingest(spark, scratch, confirmations=0)
    assert stored(spark, scratch)[-2:] == [(FIRST + 33, 4), (FIRST + 34, 4)]


def test_a_receipt_that_never_comes_and_a_bad_row(spark, scratch):
    """One receipt is lost, one comes late, one has no usable price: three batches equal what can be stored."""
    price = F.when(F.col("block_number") == FIRST + 4, "-1").otherwise(F.col("effective_gas_price"))
    land(spark, scratch, range(FIRST, FIRST + 30), change=lambda r: r.where(
        f"block_number not in ({FIRST + 1}, {FIRST + 9})").withColumn("effective_gas_price", price))
    ingest(spark, scratch, first_block=FIRST)
    want = [FIRST + i for i in range(30) if i not in (1, 4, 9)]
    assert [b for b, _ in stored(spark, scratch)] == want
    malformed = spark.read.parquet(f"{scratch}/table_aside/malformed").collect()
    assert [(r.block_number, r.reason) for r in malformed] == [(FIRST + 4, "bad effective_gas_price")]
    # block 1 lies more than 15 blocks behind the end and is set aside, block 9 too; nothing waits for ever
    gone = spark.read.parquet(f"{scratch}/table_aside/unmatched").collect()
    assert sorted(r.block_number for r in gone) == [FIRST + 1, FIRST + 9]
    assert spark.read.parquet(f"{scratch}/table_pending/batch_id=2").count() == 0


def test_folders_still_being_written_are_not_read(spark, scratch):
    land(spark, scratch, range(FIRST, FIRST + 5))
    fs, done = commits._path(spark, f"{scratch}/logs/run_id=1/_SUCCESS")
    fs.delete(done, False)
    ingest(spark, scratch)
    assert not commits.is_committed(spark, f"{scratch}/table") or stored(spark, scratch) == []


def test_options_are_checked():
    for wrong in ({"blocks_per_batch": "0"}, {"step": "1001"}, {"confirmations": "-1"}):
        with pytest.raises(ValueError):
            block_stream.BlockLogReader({"path": "/a", "headers": "/b", **wrong}, landing.RAW_LOGS)
    r = block_stream.BlockLogReader({"path": "/a", "headers": "/b", "step": "300"}, landing.RAW_LOGS)
    parts = r.partitions({"block": 100}, {"block": 1001})
    assert [(p.first, p.last) for p in parts] == [(100, 399), (400, 699), (700, 999), (1000, 1000)]
    assert r.partitions({"block": 7}, {"block": 7}) == [] and r.next == 7


def test_the_stream_job_reads_the_landing_layout(spark, scratch):
    land(spark, scratch, range(FIRST, FIRST + 12))
    jobs.main(["stream", "--format", "landed", "--landing", f"{scratch}/logs", "--blocks", f"{scratch}/blocks",
               "--receipts", f"{scratch}/receipts", "--table", f"{scratch}/table", "--checkpoint", f"{scratch}/c",
               "--blocks-per-batch", "6", "--confirmations", "1", "--available-now", "--wallet", W], spark)
    assert [b for b, _ in stored(spark, scratch)] == list(range(FIRST, FIRST + 11))
