"""Window values renewed from the first changed day on equal the batch over all days."""

import datetime as dt
from decimal import Decimal

from gasledger.operators import metrics
from gasledger.sinks import commits
from gasledger.sinks import ledger as sink
from gasledger.streaming import daily, windows

from .test_daily_totals import A, B, BATCHES, frame


def values(df):
    cols = ["address", "date", "gas_cost_wei", "gas_cost_eth", "ma7_wei", "ma7_gwei", "cum_eth"]
    return sorted(tuple(r) for r in df.select(*cols).collect())


def total(who, day, wei, price, n=2):
    """A day's totals; ``n = 0`` takes the day away."""
    amounts = (Decimal(wei), Decimal(price), n) if n else (None, None, None)
    return (who, dt.date(2024, 1, 1) + dt.timedelta(days=day), n, *amounts, 1, 2)


class Days:
    """The days as a plain dictionary beside the maintained table."""

    def __init__(self, spark, path):
        self.spark, self.path, self.now = spark, path, {}

    def apply(self, batch_id, rows, replay_of=None):
        if replay_of is not None:
            self.now = dict(replay_of)
        for r in rows:
            if r[2]:
                self.now[r[:2]] = r
            else:
                self.now.pop(r[:2], None)
        windows.apply_changes(self.spark.createDataFrame(rows, daily.TOTALS), batch_id, self.path, "s")
        want = metrics.combined_from_totals(self.spark.createDataFrame(list(self.now.values()), daily.TOTALS), ordered=False)
        assert values(windows.read_metrics(self.spark, self.path)) == values(want)


def test_rows_replaced_and_moved(spark, scratch):
    """Through the ledger rows: a re-read row, and one moved to another day that leaves its day empty."""
    for i, rows in enumerate(BATCHES[:3]):
        windows.apply_batch(frame(spark, rows), i, scratch, "s")
    rows = sink.read_ledger(spark, f"{scratch}/rows").drop("event_month")
    want = metrics.combined_daily_metrics(sink.final_rows(rows), ordered=False)
    assert values(windows.read_metrics(spark, scratch)) == values(want)


def test_late_days_beyond_the_frame(spark, scratch, monkeypatch):
    """Frames of eight days: some batches reach back beyond them, some change the last days only."""
    monkeypatch.setattr(windows, "TAIL", 8)
    reads = []
    plain = windows._before
    monkeypatch.setattr(windows, "_before", lambda s, p, *rest: (reads.append(p.rsplit("/", 1)[1]), plain(s, p, *rest))[1])
    days = Days(spark, scratch)
    days.apply(0, [total(who, d, 10**17 + d, d * 7 + 1) for who in (A, B) for d in range(17)])
    days.apply(1, [total(A, 16, 3, 5), total(A, 17, 10**18, 9)])      # the last days
    days.apply(2, [total(A, 3, 0, 0, n=0), total(A, 20, 8, 8)])       # a late day that loses its rows
    days.apply(3, [total(A, 12, 0, 0, n=0), total(B, 2, 1, 1)])       # within A's frame, far back for B
    assert reads == ["frames", "frames", "frames", "metrics", "frames", "metrics"]


def test_replays_and_compaction(spark, scratch):
    days = Days(spark, scratch)
    days.apply(0, [total(A, d, d, d) for d in (1, 2, 5)])
    days.apply(1, [total(A, 4, 9, 9), total(B, 1, 1, 1)])
    before = dict(days.now)
    days.apply(2, [total(A, 2, 0, 0, n=0)])
    days.apply(2, [total(A, 5, 77, 7)], replay_of=before)             # a replay with other rows
    windows.compact_metrics(spark, scratch)
    assert {b for _, b, _ in commits.state(spark, f"{scratch}/metrics").live} == {1, 2}
    days.apply(3, [total(A, 1, 0, 0, n=0), total(A, 2, 0, 0, n=0), total(A, 4, 0, 0, n=0), total(A, 5, 0, 0, n=0)])


def test_untouched_addresses_are_not_read(spark, scratch):
    days = Days(spark, scratch)
    who = [f"0x{i:040x}" for i in range(40)]
    days.apply(0, [total(w, d, d + 1, d + 2) for w in who for d in range(5)])
    days.apply(1, [total(who[7], 4, 1, 1)])
    state = commits.state(spark, f"{scratch}/metrics")
    assert state.rows["s", 1] == 1                                     # one day of one address
    touched = {v for _, b, v in state.live if b == 1}
    assert len(touched) == 1
    read = windows._before(spark, f"{scratch}/metrics", windows.METRICS, 1, touched).inputFiles()
    assert read and all(f"{windows.BUCKET}={min(touched)}/" in f for f in read)
