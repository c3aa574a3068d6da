"""Command-line jobs end to end on landed Parquet inputs."""

from pyspark.sql import functions as F

from gasledger import jobs
from gasledger.operators import decode, ingest, metrics
from gasledger.sinks import ledger as sink
from gasledger.sources import testdata as td

from .conftest import SF_SMALL


def test_ingest_metrics_report_audit(spark, scratch):
    logs, blocks, receipts = td.raw_logs(spark, SF_SMALL), td.raw_blocks(spark, SF_SMALL), td.raw_receipts(spark, SF_SMALL)
    logs.write.parquet(f"{scratch}/logs")
    blocks.write.parquet(f"{scratch}/blocks")
    receipts.write.parquet(f"{scratch}/receipts")
    args = ["ingest", "--logs", f"{scratch}/logs", "--blocks", f"{scratch}/blocks",
            "--receipts", f"{scratch}/receipts", "--table", f"{scratch}/ledger", "--run-id", "7"]
    first = jobs.main(args, spark)
    again = jobs.main(args, spark)  # same run id: replaced, not doubled
    assert first == again > 0
    expected = ingest.ledger_rows(
        ingest.dedup_last(ingest.transfers_union(decode.decode_transfer_logs(logs))), blocks, receipts
    )
    assert sink.read_ledger(spark, f"{scratch}/ledger").count() == expected.count()

    jobs.main(["metrics", "--table", f"{scratch}/ledger", "--out", f"{scratch}/m",
               "--metric", "combined_daily_metrics"], spark)
    got = spark.read.parquet(f"{scratch}/m")
    want = metrics.combined_daily_metrics(sink.final_rows(sink.read_ledger(spark, f"{scratch}/ledger")))
    cols = ["date", "address", "gas_cost_wei", "cum_eth"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())

    jobs.main(["report", "--table", f"{scratch}/ledger", "--out", f"{scratch}/r", "--wallet", td.test_wallet(3)], spark)
    rep = spark.read.json(f"{scratch}/r").collect()
    assert len(rep) == 1 and rep[0].address == td.test_wallet(3)

    lo, hi = td.BLOCK_BASE, td.BLOCK_BASE + 80
    jobs.main(["audit", "--logs", f"{scratch}/logs", "--out", f"{scratch}/a", "--from-block", str(lo),
               "--to-block", str(hi), "--step", "20"], spark)
    chunks = spark.read.parquet(f"{scratch}/a").orderBy("chunk_no").collect()
    assert [(c.chunk_from, c.chunk_to) for c in chunks][0] == (lo, lo + 19) and len(chunks) == 4


def test_compact_resolves_duplicates(spark, scratch):
    t = td.reread_transfers(spark, SF_SMALL)
    sink.write_batch(t, f"{scratch}/batches", 0, "test")
    sink.write_batch(t.limit(50), f"{scratch}/batches", 1, "test")
    jobs.main(["compact", "--table", f"{scratch}/batches", "--out", f"{scratch}/compact"], spark)
    c = sink.read_ledger(spark, f"{scratch}/compact")
    assert c.count() == td.transfers(spark, SF_SMALL).count()
    assert sink.duplicate_keys(c).count() == 0
    # metrics on the compacted table without the dedup shuffle = metrics with it
    jobs.main(["metrics", "--table", f"{scratch}/compact", "--out", f"{scratch}/m1", "--metric", "daily_gas_cost",
               "--compacted"], spark)
    jobs.main(["metrics", "--table", f"{scratch}/batches", "--out", f"{scratch}/m2", "--metric", "daily_gas_cost"],
              spark)
    assert sorted(spark.read.parquet(f"{scratch}/m1").collect()) == sorted(spark.read.parquet(f"{scratch}/m2").collect())
    import pytest

    with pytest.raises(ValueError):
        sink.compact(spark, f"{scratch}/compact", f"{scratch}/compact/")


def test_stream_job_over_node_json(spark, scratch):
    from pyspark.sql import functions as F

    from gasledger.sources import rpc_json

    logs = td.raw_logs(spark, SF_SMALL)
    # land the logs as node JSON in two drops, blocks/receipts as parquet
    rpc = rpc_json.to_rpc_logs(logs)
    rpc.where(F.col("blockNumber") < F.lit(hex(td.BLOCK_BASE + 40))).coalesce(1).write.json(f"{scratch}/landing/a")
    rpc.where(F.col("blockNumber") >= F.lit(hex(td.BLOCK_BASE + 40))).coalesce(1).write.json(f"{scratch}/landing/b")
    td.raw_blocks(spark, SF_SMALL).write.parquet(f"{scratch}/blocks")
    td.raw_receipts(spark, SF_SMALL).write.parquet(f"{scratch}/receipts")
    jobs.main(["stream", "--format", "rpc-json", "--tables-format", "parquet", "--landing", f"{scratch}/landing/*", "--blocks", f"{scratch}/blocks",
               "--receipts", f"{scratch}/receipts", "--table", f"{scratch}/ledger", "--checkpoint", f"{scratch}/ckpt",
               "--files-per-trigger", "1", "--available-now"], spark)
    got = sink.read_ledger(spark, f"{scratch}/ledger").drop("updated_at", "event_month")
    want = ingest.ledger_rows(
        ingest.dedup_last(ingest.transfers_union(decode.decode_transfer_logs(logs))),
        td.raw_blocks(spark, SF_SMALL), td.raw_receipts(spark, SF_SMALL), updated_at=False,
    )
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())


def test_land_then_ingest_one_wallet(spark, scratch):
    logs, blocks, receipts = td.raw_logs(spark, SF_SMALL), td.raw_blocks(spark, SF_SMALL), td.raw_receipts(spark, SF_SMALL)
    logs.write.parquet(f"{scratch}/logs")
    blocks.write.parquet(f"{scratch}/blocks")
    receipts.write.parquet(f"{scratch}/receipts")
    jobs.main(["land", "--run-id", "1", "--logs", f"{scratch}/logs", "--blocks", f"{scratch}/blocks", "--receipts",
               f"{scratch}/receipts", "--out", f"{scratch}/landed"], spark)
    w = td.test_wallet(3)
    jobs.main(["ingest", "--format", "landed", "--logs", f"{scratch}/landed/logs", "--blocks", f"{scratch}/landed/blocks",
               "--receipts", f"{scratch}/landed/receipts", "--table", f"{scratch}/ledger", "--run-id", "1",
               "--wallet", w], spark)
    got = sink.read_ledger(spark, f"{scratch}/ledger").drop("updated_at", "event_month")
    want = ingest.ledger_rows(
        ingest.dedup_last(ingest.transfers_union(decode.decode_transfer_logs(logs), w)), blocks, receipts,
        updated_at=False,
    )
    assert got.count() > 0
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())


def test_ingest_leaves_unconfirmed_blocks(spark, scratch):
    td.raw_logs(spark, SF_SMALL).write.parquet(f"{scratch}/logs")
    blocks = td.raw_blocks(spark, SF_SMALL)
    blocks.write.parquet(f"{scratch}/blocks")
    td.raw_receipts(spark, SF_SMALL).write.parquet(f"{scratch}/receipts")
    head = blocks.agg({"block_number": "max"}).first()[0]
    jobs.main(["ingest", "--logs", f"{scratch}/logs", "--blocks", f"{scratch}/blocks", "--receipts",
               f"{scratch}/receipts", "--table", f"{scratch}/ledger", "--run-id", "1", "--confirmations", "12"], spark)
    top = sink.read_ledger(spark, f"{scratch}/ledger").agg({"block_number": "max"}).first()[0]
    assert top <= head - 12


def test_metrics_for_a_wallet_table(spark, scratch):
    t = td.transfers(spark, SF_SMALL)
    sink.write_batch(t, f"{scratch}/ledger", 0, "test")
    wallets = [td.test_wallet(n) for n in (3, 13, 42)]
    spark.createDataFrame([(w,) for w in wallets], "wallet string").write.parquet(f"{scratch}/wallets")
    jobs.main(["metrics", "--table", f"{scratch}/ledger", "--out", f"{scratch}/m", "--metric", "address_summary",
               "--wallets-from", f"{scratch}/wallets"], spark)
    got = sorted(r.address for r in spark.read.parquet(f"{scratch}/m").collect())
    present = {r.from_address for r in t.select("from_address").distinct().collect()}
    assert got == sorted(set(wallets) & present) and len(got) >= 2


def test_stream_job_over_landed_logs(spark, scratch):
    logs, blocks, receipts = td.raw_logs(spark, SF_SMALL), td.raw_blocks(spark, SF_SMALL), td.raw_receipts(spark, SF_SMALL)
    logs.write.parquet(f"{scratch}/logs")
    blocks.write.parquet(f"{scratch}/blocks")
    receipts.write.parquet(f"{scratch}/receipts")
    jobs.main(["land", "--run-id", "1", "--logs", f"{scratch}/logs", "--blocks", f"{scratch}/blocks", "--receipts",
               f"{scratch}/receipts", "--out", f"{scratch}/landed"], spark)
    jobs.main(["stream", "--format", "landed", "--landing", f"{scratch}/landed/logs", "--blocks",
               f"{scratch}/landed/blocks", "--receipts", f"{scratch}/landed/receipts", "--table", f"{scratch}/ledger",
               "--checkpoint", f"{scratch}/ckpt", "--available-now"], spark)
    got = sink.read_ledger(spark, f"{scratch}/ledger").drop("updated_at", "event_month")
    want = ingest.ledger_rows(
        ingest.dedup_last(ingest.transfers_union(decode.decode_transfer_logs(logs))), blocks, receipts,
        updated_at=False,
    )
    assert got.count() > 0
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())


def test_wallet_filter_reaches_the_scan_below_the_dedup(spark, scratch):
    from gasledger.operators.wallets import either_case, select_wallets
    from gasledger.streaming import ingest as stream

    logs = td.raw_logs(spark, SF_SMALL)
    for batch in (0, 1):    # every transaction is split over two batches
        stream.ingest_batch(logs.where(F.col("log_index") % 2 == 1 - batch), batch, td.raw_blocks(spark, SF_SMALL),
                            td.raw_receipts(spark, SF_SMALL), f"{scratch}/t")
    ledger = sink.read_ledger(spark, f"{scratch}/t")
    wallet = td.test_wallet(3)
    one = sink.final_rows(select_wallets(ledger, either_case("0X" + wallet[2:]), "wallet_address"))
    pushed = one._jdf.queryExecution().executedPlan().toString().split("PushedFilters:")[1].split("\n")[0]
    assert "wallet_address" in pushed
    # the all-wallet ledger holds each wallet's own single export
    decoded = decode.decode_transfer_logs(logs)
    for n in range(10):
        w = td.test_wallet(n)
        alone = ingest.ledger_rows(ingest.dedup_last(ingest.transfers_union(decoded, w)), td.raw_blocks(spark, SF_SMALL),
                                   td.raw_receipts(spark, SF_SMALL), updated_at=False)
        stored = sink.final_rows(ledger.where(F.col("wallet_address") == w)).select(alone.columns)
        assert sorted(alone.collect()) == sorted(stored.collect())
        cost = {r.date: r.gas_cost_wei for r in metrics.daily_gas_cost(alone, w).collect()}
        assert cost == {r.date: r.gas_cost_wei for r in metrics.daily_gas_cost(sink.final_rows(ledger), w).collect()}


def test_owners_do_not_touch_each_other(spark, scratch):
    t = td.transfers(spark, SF_SMALL)
    sink.write_batch(t, scratch, 0, "import")
    sink.write_batch(t.limit(10), scratch, 0, "stream-a")
    sink.write_batch(t.limit(20), scratch, 0, "stream-b")
    assert sink.read_ledger(spark, scratch).count() == 1030
    many = td.orders_transfers(spark, SF_SMALL)
    sink.write_batch(many, scratch, 1, "import")
    sink.write_batch(many.limit(1), scratch, 1, "import")       # fewer months than before
    assert sink.read_ledger(spark, scratch).count() == 1031
    sink.write_batch(many.limit(0), scratch, 1, "import")       # none
    sink.write_batch(t.limit(5), scratch, 0, "stream-a")
    assert sink.read_ledger(spark, scratch).count() == 1025


def test_landing_twice_changes_nothing(spark, scratch):
    for n, df in (("logs", td.raw_logs(spark, SF_SMALL)), ("blocks", td.raw_blocks(spark, SF_SMALL)),
                  ("receipts", td.raw_receipts(spark, SF_SMALL))):
        df.write.parquet(f"{scratch}/{n}")
    land = ["land", "--logs", f"{scratch}/logs", "--blocks", f"{scratch}/blocks", "--receipts", f"{scratch}/receipts",
            "--out", f"{scratch}/landed", "--run-id"]
    saved = []
    for run in ("1", "1", "2"):     # the same run again, then the same data as another run
        jobs.main([*land, run], spark)
        saved.append(jobs.main(["ingest", "--format", "landed", "--logs", f"{scratch}/landed/logs", "--blocks",
                                f"{scratch}/landed/blocks", "--receipts", f"{scratch}/landed/receipts",
                                "--table", f"{scratch}/t", "--run-id", "7"], spark))
    assert saved[0] == saved[1] == saved[2] > 0
