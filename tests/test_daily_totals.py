"""Live totals over re-read, replaced and moved rows equal the batch over the final rows."""

import datetime as dt

from pyspark.sql import functions as F

from gasledger.operators import metrics
from gasledger.sinks import commits
from gasledger.sinks import ledger as sink
from gasledger.sources.schemas import LEDGER
from gasledger.streaming import daily as live

A, B = "0x" + "a" * 40, "0x" + "b" * 40


def row(tx, day, price=5, who=A, version=1, block=None):
    when = dt.datetime(2024, 1, day, 12)
    return (block or tx, f"0x{tx:064x}", who, B, when, 21000, str(price), when + dt.timedelta(days=version), who, 0, 0)


def frame(spark, rows):
    names = ["block_number", "transaction_hash", "from_address", "to_address", "timestamp", "receipt_gas_used",
             "receipt_effective_gas_price", "updated_at", "wallet_address", "src", "log_index"]
    return spark.createDataFrame([dict(zip(names, r)) for r in rows], LEDGER)


def totals(df):
    return sorted(tuple(r) for r in df.select(*live.TOTALS.fieldNames()).collect())


def check(spark, path):
    rows = sink.read_ledger(spark, f"{path}/rows").drop("event_month")
    want = metrics.daily_totals(sink.final_rows(rows))
    assert totals(live.read_totals(spark, path)) == totals(want)


BATCHES = [
    [row(1, 1), row(2, 1), row(3, 2), row(4, 3, who=B)],
    [row(2, 1, version=2), row(5, 1)],                                   # re-read as it was, and a new row of that day
    [row(3, 4, price=9, version=2)],                                     # moved to another day: day 2 loses its only row
    [row(1, 1, price=7, version=3), row(4, 3, who=B, version=0)],        # a new price; an older version changes nothing
    [row(6, 1)],                                                         # touches day 1 again, not the day its rows moved to
    [row(7, 2)],                                                         # day 2 again: the moved row must not come back
]


def test_totals_follow_every_batch(spark, scratch):
    for i, rows in enumerate(BATCHES):
        live.apply_batch(frame(spark, rows), i, scratch, "s")
        check(spark, scratch)
    days = {(r.address, r.date.day): r.events_collected for r in live.read_totals(spark, scratch).collect()}
    assert days == {(A, 1): 4, (A, 2): 1, (A, 4): 1, (B, 3): 1}


def test_replays_and_compaction(spark, scratch):
    for i, rows in enumerate(BATCHES[:3]):
        live.apply_batch(frame(spark, rows), i, scratch, "s")
    before = totals(live.read_totals(spark, scratch))
    live.apply_batch(frame(spark, BATCHES[2]), 2, scratch, "s")          # a replay
    assert totals(live.read_totals(spark, scratch)) == before
    live.apply_batch(frame(spark, [row(8, 5)]), 2, scratch, "s")         # a replay that stores other rows
    check(spark, scratch)
    live.compact_totals(spark, scratch)
    check(spark, scratch)
    state = commits.state(spark, f"{scratch}/totals")
    assert sorted(b for _, b, _ in state.live) == [1, 2]
    live.apply_batch(frame(spark, [row(8, 5)]), 2, scratch, "s")         # the newest batch replayed after it
    live.apply_batch(frame(spark, BATCHES[3]), 3, scratch, "s")
    check(spark, scratch)


def test_only_touched_pairs_are_written(spark, scratch):
    live.apply_batch(frame(spark, [row(i, 1 + i % 20, who=A if i % 2 else B) for i in range(1, 200)]), 0, scratch, "s")
    live.apply_batch(frame(spark, [row(500, 3)]), 1, scratch, "s")
    assert commits.state(spark, f"{scratch}/totals").rows == {("s", 0): 20, ("s", 1): 1}
    check(spark, scratch)
    try:
        live.apply_batch(frame(spark, [row(501, 3)]), 0, scratch, "other")
    except ValueError as e:
        assert "one query a table" in str(e)
    else:
        raise AssertionError("two queries shared a table of totals")


def test_empty_batch(spark, scratch):
    live.apply_batch(frame(spark, []).where(F.lit(False)), 0, scratch, "s")
    assert live.read_totals(spark, scratch).count() == 0
