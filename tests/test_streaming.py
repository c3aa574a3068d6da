"""Streaming ingest: restart from the checkpoint, replay, stream = batch."""

import datetime as dt

from pyspark.sql import functions as F

from gasledger.constants import TRANSFER_TOPIC, USDC_CONTRACT
from gasledger.sinks import ledger as sink
from gasledger.sources.schemas import RAW_LOGS
from gasledger.streaming import daily as live
from gasledger.streaming import ingest as stream

W = "0x" + "a" * 40
O = "0x" + "c" * 40


def _logs(spark, blocks):
    word = lambda a: "0x" + "0" * 24 + a[2:]
    rows = [
        (USDC_CONTRACT, [TRANSFER_TOPIC, word(W), word(O)], "0x" + "5".rjust(64, "0"), 0, b, "0x", f"0x{b:064x}", 0)
        for b in blocks
    ]
    return spark.createDataFrame(rows, RAW_LOGS)


def _static(spark, blocks):
    b = spark.createDataFrame(
        [(x, "0x", dt.datetime(2024, 1, 1) + dt.timedelta(hours=x)) for x in blocks],
        "block_number long, block_hash string, timestamp timestamp_ntz",
    )
    r = spark.createDataFrame(
        [(f"0x{x:064x}", x, "21000", str(x)) for x in blocks],
        "transaction_hash string, block_number long, gas_used string, effective_gas_price string",
    )
    return b, r


def test_restart_resumes_and_replay_changes_nothing(spark, scratch):
    landing, table, ckpt = f"{scratch}/landing", f"{scratch}/table", f"{scratch}/ckpt"
    blocks, receipts = _static(spark, range(1, 41))
    _logs(spark, range(1, 21)).coalesce(1).write.parquet(f"{landing}/part=1")

    def run():
        q = stream.start_ingest(
            stream.file_stream(spark, landing, RAW_LOGS, files_per_trigger=1).drop("part"),
            blocks, receipts, table, ckpt, wallets=W, trigger={"availableNow": True},
        )
        stream.run_to_end(q)

    run()
    assert sink.read_ledger(spark, table).count() == 20
    # new files land; the restarted query reads only them
    _logs(spark, range(21, 41)).coalesce(1).write.parquet(f"{landing}/part=2")
    run()
    t = sink.read_ledger(spark, table, with_batch=True)
    assert t.count() == 40
    assert t.select("batch_id").distinct().count() == 2
    # replaying batch 0 by hand replaces, never adds
    stream.ingest_batch(spark.read.schema(RAW_LOGS).parquet(f"{landing}/part=1"), 0, blocks, receipts, table, wallets=W,
                        source=stream.source_name(ckpt))
    assert sink.read_ledger(spark, table).count() == 40
    assert sink.duplicate_keys(sink.read_ledger(spark, table)).count() == 0


def test_first_block_filter(spark, scratch):
    landing = f"{scratch}/landing"
    blocks, receipts = _static(spark, range(1, 11))
    _logs(spark, range(1, 11)).coalesce(1).write.parquet(landing)
    q = stream.start_ingest(
        stream.file_stream(spark, landing, RAW_LOGS), blocks, receipts, f"{scratch}/t", f"{scratch}/c",
        first_block=6, wallets=W, trigger={"availableNow": True},
    )
    stream.run_to_end(q)
    got = sorted(r.block_number for r in sink.read_ledger(spark, f"{scratch}/t").collect())
    assert got == [6, 7, 8, 9, 10]


def _ledger(spark):
    rows = [(i, dt.datetime(2024, 1, 1 + i // 5, i % 24), "0xw", "0xo", str(i + 1)) for i in range(30)]
    df = spark.createDataFrame(rows, "i long, timestamp timestamp_ntz, from_address string, to_address string, p string")
    return df.select(
        F.col("i").alias("block_number"), F.format_string("0x%064d", "i").alias("transaction_hash"),
        "from_address", "to_address", "timestamp", F.lit(2).cast("long").alias("receipt_gas_used"),
        F.col("p").alias("receipt_effective_gas_price"), F.col("timestamp").alias("updated_at"),
    )


def _batch_answer(ledger):
    from gasledger.operators import metrics

    return {(r.date, r.gas_cost_wei) for r in metrics.daily_gas_cost(ledger).collect()}


def test_daily_partials_exact_for_out_of_order_input(spark, scratch):
    ledger = _ledger(spark)
    ledger.repartition(3).write.parquet(f"{scratch}/landing")  # days arrive out of order
    s = stream.file_stream(spark, f"{scratch}/landing", ledger.schema, files_per_trigger=1)
    q = live.start_daily_partials(s, f"{scratch}/d", f"{scratch}/c", trigger={"availableNow": True})
    stream.run_to_end(q)
    totals = live.read_daily_totals(spark, f"{scratch}/d")
    got = {(r.date, r.gas_cost_wei) for r in live.daily_cost_from_totals(totals).collect()}
    assert got == _batch_answer(ledger) and len(got) == 6


def test_daily_partials_compaction(spark, scratch):
    ledger = _ledger(spark)
    ledger.repartition(3).write.parquet(f"{scratch}/landing")
    s = stream.file_stream(spark, f"{scratch}/landing", ledger.schema, files_per_trigger=1)
    q = live.start_daily_partials(s, f"{scratch}/d", f"{scratch}/c", trigger={"availableNow": True})
    stream.run_to_end(q)
    live.compact_daily_partials(spark, f"{scratch}/d", f"{scratch}/d2")
    before = sorted(live.read_daily_totals(spark, f"{scratch}/d").collect())
    after = sorted(live.read_daily_totals(spark, f"{scratch}/d2").collect())
    assert before == after and len(after) == 6
    assert spark.read.parquet(f"{scratch}/d2").count() == 6


def test_failed_batch_is_retried_after_restart(spark, scratch):
    import pytest

    landing, table, ckpt = f"{scratch}/landing", f"{scratch}/table", f"{scratch}/ckpt"
    blocks, receipts = _static(spark, range(1, 21))
    _logs(spark, range(1, 21)).coalesce(1).write.parquet(landing)
    broken = blocks.withColumn("timestamp", F.raise_error(F.lit("header store unavailable")).cast("timestamp_ntz"))

    def run(b):
        q = stream.start_ingest(
            stream.file_stream(spark, landing, RAW_LOGS), b, receipts, table, ckpt,
            wallets=W, trigger={"availableNow": True},
        )
        stream.run_to_end(q)

    with pytest.raises(Exception):
        run(broken)  # the batch fails as a whole; nothing is skipped or committed
    run(blocks)      # restart: the same batch runs again
    t = sink.read_ledger(spark, table, with_batch=True)
    assert t.count() == 20
    assert {r.batch_id for r in t.select("batch_id").distinct().collect()} == {0}


def test_receipts_that_land_later_are_taken_up(spark, scratch):
    blocks, receipts = _static(spark, range(1, 41))
    landing, table, ckpt = f"{scratch}/landing", f"{scratch}/table", f"{scratch}/ckpt"

    def run():
        q = stream.start_ingest(
            stream.file_stream(spark, landing, RAW_LOGS, files_per_trigger=1).drop("part"),
            lambda: spark.read.schema(blocks.schema).parquet(f"{scratch}/b"),
            lambda: spark.read.schema(receipts.schema).parquet(f"{scratch}/r"),
            table, ckpt, wallets=W, trigger={"availableNow": True})
        stream.run_to_end(q)

    blocks.write.parquet(f"{scratch}/b/n=1")
    receipts.where("block_number <= 10").write.parquet(f"{scratch}/r/n=1")
    _logs(spark, range(1, 21)).coalesce(1).write.parquet(f"{landing}/part=1")
    run()
    assert sink.read_ledger(spark, table).count() == 10
    receipts.where("block_number > 10").write.parquet(f"{scratch}/r/n=2")
    _logs(spark, range(21, 41)).coalesce(1).write.parquet(f"{landing}/part=2")
    run()
    assert sink.read_ledger(spark, table).count() == 40
    assert spark.read.parquet(f"{table}_pending/batch_id=1").count() == 0
