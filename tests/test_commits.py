"""Atomic batches: replays, readers beside writers, lost writers, progress, compaction, the catalog table."""

import threading
import uuid

import pytest
from pyspark.sql import functions as F

from gasledger.sinks import commits
from gasledger.sinks import ledger as sink
from gasledger.sources import testdata as td
from tests.conftest import SF_SMALL


def rows(spark):
    """The stored rows of four months."""
    months = td.orders_transfers(spark, SF_SMALL).where("timestamp >= '1995-01-01' and timestamp < '1995-05-01'")
    return sink.with_identity(months).cache()


def test_a_replay_takes_the_place_of_its_batch(spark, scratch):
    all_rows = rows(spark)
    n = all_rows.count()
    sink.write_batch(all_rows, scratch, 0, "a")
    sink.write_batch(all_rows.where("block_number % 2 = 0"), scratch, 1, "a")
    state = sink.write_batch(all_rows.where("block_number % 3 = 0"), scratch, 0, "a")
    third, half = (all_rows.where(f"block_number % {k} = 0").count() for k in (3, 2))
    assert sink.read_ledger(spark, scratch).count() == third + half < n + half
    assert state.rows == {("a", 0): third, ("a", 1): half}      # counted by the write, equal to what is stored
    sink.write_batch(all_rows.limit(0), scratch, 1, "a")
    assert sink.read_ledger(spark, scratch).count() == third


def test_sources_do_not_share_batches(spark, scratch):
    all_rows = rows(spark)
    sink.write_batch(all_rows, scratch, 0, "a")
    sink.write_batch(all_rows, scratch, 0, "b")
    found = sink.read_ledger(spark, scratch, with_batch=True).groupBy("source", "batch_id").count().collect()
    assert {(r.source, r.batch_id, r["count"]) for r in found} == {("a", 0, all_rows.count()), ("b", 0, all_rows.count())}


def test_a_writer_that_dies_leaves_nothing_to_readers(spark, scratch):
    all_rows = rows(spark)
    sink.write_batch(all_rows, scratch, 0, "a")
    broken = all_rows.withColumn("from_address", F.when(F.col("block_number") % 7 == 0, F.raise_error(F.lit("lost")))
                                 .otherwise(F.col("from_address")))
    with pytest.raises(Exception, match="lost"):
        sink.write_batch(broken, scratch, 0, "a")
    # files of a complete write whose commit never came
    state = commits.state(spark, scratch)
    folder = next(iter(state.live.values()))
    spark.read.parquet(f"{scratch}/{folder}").write.partitionBy("event_month").parquet(
        f"{scratch}/source=a/batch_id=0/attempt={uuid.uuid4().hex}")
    assert sink.read_ledger(spark, scratch).count() == all_rows.count()
    assert commits.state(spark, scratch).version == 0
    assert commits.vacuum(spark, scratch, older_than_hours=-1) >= 1
    assert sink.read_ledger(spark, scratch).count() == all_rows.count()


def test_readers_beside_replays_see_the_old_or_the_new_batch(spark, scratch):
    """Each write stores one of two sizes; every read in between finds exactly one of them."""
    all_rows = rows(spark)
    small = all_rows.where("block_number % 2 = 0").cache()
    sizes = {all_rows.count(), small.count()}
    sink.write_batch(all_rows, scratch, 0, "a")
    done, seen, failed = threading.Event(), [], []

    def look():
        while not done.is_set():
            try:
                seen.append(sink.read_ledger(spark, scratch).count())
            except Exception as e:  # noqa: BLE001
                failed.append(e)

    reader = threading.Thread(target=look)
    reader.start()
    for i in range(4):
        sink.write_batch(small if i % 2 == 0 else all_rows, scratch, 0, "a")
    done.set()
    reader.join()
    assert not failed and len(seen) > 3 and set(seen) <= sizes


def test_two_writers_never_share_a_version(spark, scratch):
    writers = [threading.Thread(target=commits.commit, args=(spark, scratch, f"w{i}", j, f"f{i}-{j}", [""], 1))
               for i in range(3) for j in range(2)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    state = commits.state(spark, scratch)
    assert state.version == 5 and len(state.live) == 6 and sum(state.rows.values()) == 6


def test_snapshots_and_versions(spark, scratch):
    for i in range(25):
        commits.commit(spark, scratch, "a", i % 9, f"f{i}", [""], i, {"w": i})
    names = commits.listed(spark, f"{scratch}/_commits")
    assert sum(n.endswith(".snapshot.json") for n in names) == 1
    now = commits.state(spark, scratch)
    assert now.version == 24 and now.progress == {"w": 24} and set(now.live.values()) == {f"f{i}" for i in range(16, 25)}
    assert set(commits.state(spark, scratch, 21).live.values()) == {f"f{i}" for i in range(13, 22)}
    with pytest.raises(ValueError):
        commits.state(spark, scratch, 25)


def test_progress_moves_with_its_rows(spark, scratch):
    all_rows = rows(spark)
    top = all_rows.agg(F.max("block_number")).first()[0]
    state = sink.write_batch(all_rows, scratch, 0, "a", wallets=("0x1", "0x2"))
    assert state.progress == {"0x1": top, "0x2": top}
    state = sink.write_batch(all_rows.limit(0), scratch, 1, "a", wallets=("0x1",), block=top + 500)
    assert state.progress == {"0x1": top + 500, "0x2": top}
    state = sink.write_batch(all_rows, scratch, 0, "a", wallets=("0x1",))      # a replay moves nothing back
    assert state.progress["0x1"] == top + 500


def test_months_are_folded_in_one_commit(spark, scratch):
    all_rows = rows(spark)
    later = all_rows.withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 1 DAY"))
    sink.write_batch(all_rows, scratch, 0, "a")
    sink.write_batch(later, scratch, 1, "a")
    before = commits.state(spark, scratch)
    month = int(sorted(k[2] for k in before.live)[0])
    want = sorted(tuple(r) for r in sink.final_rows(sink.read_ledger(spark, scratch)).drop("event_month").collect())
    after = sink.compact_months(spark, scratch, [month])
    assert [k for k in after.live if k[2] == str(month)] == [("compacted", 1, str(month))]
    ledger = sink.read_ledger(spark, scratch)
    in_month = ledger.where(F.col("event_month") == month)
    assert in_month.count() == in_month.select("transaction_hash").distinct().count()
    assert ledger.count() < 2 * all_rows.count()
    assert sorted(tuple(r) for r in sink.final_rows(ledger).drop("event_month").collect()) == want
    # what a reader opened before still stands
    assert commits.read(spark, scratch, ledger.schema, "event_month", version=before.version).count() == 2 * all_rows.count()


def test_folding_what_was_replayed_fails(spark, scratch):
    all_rows = rows(spark)
    before = sink.write_batch(all_rows, scratch, 0, "a")
    sink.write_batch(all_rows, scratch, 0, "a")
    with pytest.raises(commits.Conflict):
        commits.commit(spark, scratch, "compacted", 0, "f", [], 0, drops=before.live)
    assert sink.read_ledger(spark, scratch).count() == all_rows.count()


def test_months_outside_the_range_are_not_listed(spark, scratch):
    all_rows = rows(spark)
    sink.write_batch(all_rows, scratch, 0, "a")
    some = sink.read_ledger(spark, scratch, "1995-02-01", "1995-03-31")
    assert {f.split("event_month=")[1][:6] for f in some.inputFiles()} <= {"199502", "199503"}
    assert some.count() == all_rows.where("timestamp >= '1995-02-01' and timestamp < '1995-04-01'").count() > 0


def test_the_catalog_table_follows_the_commits(spark, scratch):
    name = f"ledger_{uuid.uuid4().hex[:8]}"
    all_rows = rows(spark)
    sink.write_batch(all_rows, scratch, 0, "a")
    sink.write_batch(all_rows.limit(5), scratch, 0, "b")
    sink.create_ledger_table(spark, name, scratch)
    try:
        assert spark.table(name).count() == all_rows.count() + 5
        assert spark.sql(f"SELECT count(*) FROM {name} WHERE source = 'b'").first()[0] == 5
        sink.write_batch(all_rows.where("month(timestamp) = 3"),
                         scratch, 0, "a")
        sink.create_ledger_table(spark, name, scratch)
        assert spark.table(name).count() == sink.read_ledger(spark, scratch).count() < all_rows.count()
        months = [r[0] for r in spark.sql(f"SELECT DISTINCT event_month FROM {name} WHERE source = 'a'").collect()]
        assert months == [199503]
    finally:
        spark.sql(f"DROP TABLE {name}")
