"""One test per semantic trap of the original ledger (see README, traps)."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gasledger.constants import TRANSFER_TOPIC, USDC_CONTRACT
from gasledger.functions.blocks import block_ranges
from gasledger.operators import audit, decode, ingest, metrics, progress
from gasledger.operators.wallets import select_wallets
from gasledger.sinks import ledger as sink

W = "0x" + "a" * 40
LEDGER = (
    "block_number long, transaction_hash string, from_address string, to_address string, "
    "timestamp timestamp_ntz, receipt_gas_used long, receipt_effective_gas_price string, updated_at timestamp_ntz"
)


def row(i, ts, price, gas=1, frm=W, block=None, updated=None):
    return (block if block is not None else 100 + i, f"0x{i:064x}", frm, "0x" + "b" * 40,
            dt.datetime.fromisoformat(ts), gas, price, updated or dt.datetime(2024, 2, 1))


def test_overflow_is_exact(spark):
    t = spark.createDataFrame([row(i, "2024-01-01T10:00:00", str(10**18)) for i in range(20)], LEDGER)
    r = metrics.daily_gas_cost(t).first()
    assert r.gas_cost_wei == "20000000000000000000"
    assert r.gas_cost_eth == 20.0


def test_moving_average_counts_rows_not_days(spark):
    t = spark.createDataFrame([row(0, "2024-01-01T00:00:00", "1"), row(1, "2024-01-20T00:00:00", "3")], LEDGER)
    got = metrics.ma7_gas_price(t).collect()
    assert [r.ma7_wei for r in got] == [1.0, 2.0]


def test_moving_average_is_unweighted_mean_of_daily_means(spark):
    rows = [row(i, "2024-01-01T01:00:00", "1") for i in range(3)] + [row(3, "2024-01-02T01:00:00", "3")]
    got = metrics.ma7_gas_price(spark.createDataFrame(rows, LEDGER)).collect()
    assert got[1].ma7_wei == 2.0


def test_global_window_form_matches_single_wallet(spark):
    rows = [row(0, "2024-01-01T00:00:00", "1"), row(1, "2024-01-03T00:00:00", "5")]
    t = spark.createDataFrame(rows, LEDGER)
    a = [r.ma7_wei for r in metrics.ma7_gas_price(t, W, per_address=False).collect()]
    b = [r.ma7_wei for r in metrics.ma7_gas_price(t, W).collect()]
    assert a == b == [1.0, 3.0]


def test_address_case(spark):
    mixed = "0xAbC" + "d" * 37
    t = spark.createDataFrame(
        [row(0, "2024-01-01T00:00:00", "1", frm=mixed), row(1, "2024-01-01T00:00:00", "1", frm=mixed.lower())],
        LEDGER,
    )
    assert metrics.address_summary(t, mixed).first().events_collected == 1
    assert metrics.address_summary(t, mixed, normalize=True).first().events_collected == 2


def test_wallet_set_as_dataframe_and_list(spark):
    t = spark.createDataFrame([row(i, "2024-01-01T00:00:00", "1", frm=f"0x{i:040x}") for i in range(5)], LEDGER)
    ws = spark.createDataFrame([("0x" + "0" * 39 + "1",), ("0x" + "0" * 39 + "3",)], "w string")
    a = sorted(r.address for r in metrics.daily_gas_cost(t, ws).collect())
    b = sorted(r.address for r in metrics.daily_gas_cost(t, [r.w for r in ws.collect()]).collect())
    assert a == b and len(a) == 2
    assert select_wallets(t, ws.repartition(3)).count() == 2


def test_day_boundary_is_utc(spark):
    t = spark.createDataFrame([row(0, "2024-01-01T23:59:59", "1"), row(1, "2024-01-02T00:00:00", "1")], LEDGER)
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        dates = [r.date for r in metrics.daily_gas_cost(t).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert dates == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]


def test_bad_price_fails_the_metric_but_is_quarantined(spark):
    t = spark.createDataFrame(
        [row(0, "2024-01-01T00:00:00", ""), row(1, "2024-01-01T00:00:00", "abc"),
         row(2, "2024-01-01T00:00:00", "-1"), row(3, "2024-01-01T00:00:00", "7")],
        LEDGER,
    )
    with pytest.raises(Exception):
        metrics.daily_gas_cost(t).collect()
    good, bad = ingest.split_quarantine(t)
    assert sorted(r.receipt_effective_gas_price for r in bad.collect()) == ["", "-1", "abc"]
    assert metrics.daily_gas_cost(good).first().gas_cost_wei == "7"


LOGS = (
    "address string, topics array<string>, data string, log_index int, block_number long, "
    "block_hash string, transaction_hash string, transaction_index int"
)


def log(frm, to, idx, tx="0x" + "1" * 64, block=10, amount=5, topic=TRANSFER_TOPIC, contract=USDC_CONTRACT):
    word = lambda a: "0x" + "0" * 24 + a[2:]
    return (contract, [topic, word(frm), word(to)], "0x" + f"{amount:x}".rjust(64, "0"), idx, block,
            "0x" + "b" * 64, tx, 0)


def test_last_wins_keeps_received_log(spark):
    other = "0x" + "c" * 40
    logs = spark.createDataFrame([log(W, other, 0), log(other, W, 1), log(W, other, 2)], LOGS)
    d = ingest.dedup_last(ingest.transfers_union(decode.decode_transfer_logs(logs), W)).collect()
    assert len(d) == 1 and d[0].log_index == 1 and d[0].to_address == W


def test_self_transfer_is_one_row(spark):
    logs = spark.createDataFrame([log(W, W, 0)], LOGS)
    d = ingest.dedup_last(ingest.transfers_union(decode.decode_transfer_logs(logs), W)).collect()
    assert len(d) == 1


def test_decoder_filters_contract_and_signature_and_reads_amount(spark):
    other = "0x" + "c" * 40
    logs = spark.createDataFrame(
        [log(W, other, 0, amount=123456789), log(W, other, 1, topic="0x" + "9" * 64),
         log(W, other, 2, contract="0x" + "e" * 40)],
        LOGS,
    )
    d = decode.decode_transfer_logs(logs).collect()
    assert len(d) == 1 and d[0].value == "123456789" and d[0].from_address == W


def test_missing_receipt_and_absent_price(spark):
    other = "0x" + "c" * 40
    logs = spark.createDataFrame([log(W, other, 0, tx="0x" + "1" * 64), log(W, other, 0, tx="0x" + "2" * 64)], LOGS)
    blocks = spark.createDataFrame([(10, "0x", dt.datetime(2024, 1, 1))], "block_number long, block_hash string, timestamp timestamp_ntz")
    receipts = spark.createDataFrame(
        [("0x" + "1" * 64, 10, "21000", None)],
        "transaction_hash string, block_number long, gas_used string, effective_gas_price string",
    )
    d = ingest.dedup_last(ingest.transfers_union(decode.decode_transfer_logs(logs), W))
    rows = ingest.ledger_rows(d, blocks, receipts, updated_at=False).collect()
    assert len(rows) == 1 and rows[0].receipt_effective_gas_price == "0"
    assert [r.transaction_hash for r in ingest.missing_receipts(d, receipts).collect()] == ["0x" + "2" * 64]


@pytest.mark.parametrize(
    "lo,hi,want",
    [
        (100, 1100, [(100, 1099)]),
        (100, 600, [(100, 600)]),
        (100, 1101, [(100, 1099), (1100, 1101)]),
        (100, 100, []),
        (100, 101, [(100, 101)]),
    ],
)
def test_chunk_edges(spark, lo, hi, want):
    col = spark.range(1).select(F.inline(block_ranges(lo, hi, 1000))).collect()
    assert [(r.chunk_from, r.chunk_to) for r in col] == want
    rows = audit.block_chunks(spark, lo, hi, 1000).orderBy("chunk_no").collect()
    assert [(r.chunk_from, r.chunk_to) for r in rows] == want


def test_half_open_chunks_tile_the_range(spark):
    rows = audit.block_chunks(spark, 100, 2600, 1000, mode="half_open").collect()
    assert [(r.chunk_from, r.chunk_to) for r in rows] == [(100, 1099), (1100, 2099), (2100, 2599)]


def test_rechunking_does_not_change_totals(spark):
    ev = spark.range(1000, 5000).select(F.col("id").alias("block_number"))
    for step in (7, 100, 1000, 5000):
        got = audit.events_per_chunk(spark, ev, 1000, 4999, step, mode="half_open")
        assert got.agg(F.sum("events")).first()[0] == 3999


def test_boundary_reread_collapses(spark):
    a = row(0, "2024-01-01T00:00:00", "5", block=1000, updated=dt.datetime(2024, 1, 1))
    b = a[:-1] + (dt.datetime(2024, 1, 1, 1),)
    b = b[:6] + ("6",) + b[7:]
    t = spark.createDataFrame([a, b], LEDGER)
    got = sink.final_rows(t).collect()
    assert len(got) == 1 and got[0].receipt_effective_gas_price == "6"
    assert sink.duplicate_keys(t).first().copies == 2
    once = sink.final_rows(t)
    assert sorted(once.collect()) == sorted(sink.final_rows(once.select(*t.columns)).collect())


def test_batch_replay_is_idempotent(spark, scratch):
    t = spark.createDataFrame([row(i, "2024-01-01T00:00:00", "1") for i in range(10)], LEDGER)
    sink.write_batch(t, scratch, 0, "test")
    sink.write_batch(t, scratch, 0, "test")
    sink.write_batch(t.limit(3), scratch, 1, "test")
    assert sink.read_ledger(spark, scratch).count() == 13


def test_uint_parse_rejects_negative(spark):
    from gasledger.functions.units import to_uint

    with pytest.raises(PySparkException):
        spark.createDataFrame([("-1",)], "p string").select(to_uint("p")).collect()


def test_progress_roundtrip(spark, scratch):
    progress.save_progress(spark, scratch, W, 100)
    progress.save_progress(spark, scratch, W, 250)
    state = progress.read_progress(spark, scratch)
    got = progress.progress_lookup(spark, state, W).collect()
    assert [r.last_processed_block for r in got] == [250]
    assert progress.progress_lookup(spark, state, "0xnone").count() == 0


def test_scalar_conversions(spark):
    from gasledger.functions.units import epoch_seconds_to_ts, hex_quantity, iso_text, uint256_text, utc_instant

    df = spark.createDataFrame([(1759881600, "0x1671e5b", "0x" + "f" * 16)], "s long, h string, big string")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        r = df.select(
            epoch_seconds_to_ts("s").alias("ts"),
            iso_text(epoch_seconds_to_ts("s")).alias("iso"),
            hex_quantity("h").alias("n"),
            uint256_text(F.concat(F.lit("0x"), F.lpad(F.substring("big", 3, 16), 64, "0"))).alias("u"),
            F.unix_seconds(utc_instant(epoch_seconds_to_ts("s"))).alias("back"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert r.ts == dt.datetime(2025, 10, 8, 0, 0, 0)
    assert r.iso == "2025-10-08T00:00:00.000"
    assert r.n == 0x1671E5B == 23535195
    assert r.u == str(2**64 - 1)
    assert r.back == 1759881600


def test_create_table_if_absent(spark, scratch):
    name = "ledger_" + scratch.rsplit("/", 1)[1][:8]
    t = spark.createDataFrame([row(0, "2024-03-05T00:00:00", "2")], LEDGER)
    sink.write_ledger(t, scratch)
    sink.create_ledger_table(spark, name, scratch)
    sink.create_ledger_table(spark, name, scratch)  # second call is a no-op
    spark.sql(f"MSCK REPAIR TABLE {name}")
    assert spark.sql(f"SELECT event_month FROM {name}").first().event_month == 202403
    spark.sql(f"DROP TABLE {name}")


def test_global_running_sum_pools_selected_wallets(spark):
    other = "0x" + "e" * 40
    rows = [row(0, "2024-01-01T00:00:00", "10"), row(1, "2024-01-02T00:00:00", "20", frm=other),
            row(2, "2024-01-03T00:00:00", "30")]
    t = spark.createDataFrame(rows, LEDGER)
    pooled = metrics.cumulative_gas_cost(t, [W, other], per_address=False).collect()
    assert [round(r.cum_eth * 1e18) for r in pooled] == [10, 30, 60]
    per = metrics.cumulative_gas_cost(t, [W, other]).where(F.col("address") == W).collect()
    assert [round(r.cum_eth * 1e18) for r in per] == [10, 40]


def test_checksum_case_wallet_finds_its_logs(spark):
    mixed = "0xAaAa" + "a" * 36
    other = "0x" + "c" * 40
    logs = spark.createDataFrame([log(mixed.lower(), other, 0)], LOGS)
    decoded = decode.decode_transfer_logs(logs)
    for wallets in (mixed, [mixed], spark.createDataFrame([(mixed,)], "w string")):
        assert ingest.dedup_last(ingest.transfers_union(decoded, wallets)).count() == 1


def test_wallet_transfers_equal_union_path(spark):
    from gasledger.sources import testdata as td

    raw = td.raw_logs(spark, "/root/testdata/sf0.001")
    w = td.test_wallet(3).upper().replace("0X", "0x")
    a = ingest.dedup_last(ingest.wallet_transfers(raw, w))
    b = ingest.dedup_last(ingest.transfers_union(decode.decode_transfer_logs(raw), w))
    assert a.count() > 0
    assert sorted(a.collect()) == sorted(b.collect())


def test_day_without_prices_has_null_mean(spark):
    rows = [row(0, "2024-01-01T00:00:00", None), row(1, "2024-01-02T00:00:00", "4")]
    got = metrics.ma7_gas_price(spark.createDataFrame(rows, LEDGER)).collect()
    # day 1 has no price: its mean is NULL and the moving average skips it
    assert [r.ma7_wei for r in got] == [None, 4.0]


def test_small_scalar_helpers(spark):
    from gasledger.functions.units import exact_mean, js_default, utc_date, wei, wei_to_eth, year_month

    df = spark.createDataFrame(
        [("", None, dt.datetime(2024, 2, 29, 23, 59, 59), "21000", "1000000000")],
        "a string, b string, ts timestamp_ntz, gas string, price string",
    )
    r = df.select(
        js_default("a", "0").alias("a"), js_default("b", "").alias("b"),
        utc_date("ts").alias("d"), year_month("ts").alias("m"),
        wei("gas", "price").cast("string").alias("w"), wei_to_eth(wei("gas", "price")).alias("eth"),
        exact_mean(F.lit(0), F.lit(0)).alias("empty"),
    ).first()
    assert (r.a, r.b, r.d, r.m) == ("0", "", dt.date(2024, 2, 29), 202402)
    assert r.w == "21000000000000" and r.eth == 21000000000000 / 1e18 and r.empty is None
