"""Two streams into one table keep their waiting events apart."""

from gasledger.sinks import ledger as sink
from gasledger.sources.schemas import RAW_LOGS
from gasledger.streaming import ingest as stream
from tests.test_streaming import W, _logs, _static


def test_two_streams_with_late_receipts(spark, scratch):
    blocks, receipts = _static(spark, range(1, 61))
    table = f"{scratch}/table"

    def run(name):
        q = stream.start_ingest(
            stream.file_stream(spark, f"{scratch}/{name}", RAW_LOGS, files_per_trigger=1).drop("part"), blocks,
            lambda: spark.read.schema(receipts.schema).parquet(f"{scratch}/r"),
            table, f"{scratch}/ckpt-{name}", wallets=W, trigger={"availableNow": True})
        stream.run_to_end(q)

    def numbers(source=None):
        t = sink.read_ledger(spark, table, with_batch=True)
        return sorted(r.block_number for r in (t if source is None else t.where(t.source == source)).collect())

    receipts.where("block_number <= 5 or block_number between 21 and 25").write.parquet(f"{scratch}/r/n=1")
    for name, first in (("a", 1), ("b", 21)):       # both streams leave events in their batch 0
        _logs(spark, range(first, first + 20)).coalesce(1).write.parquet(f"{scratch}/{name}/part=1")
        run(name)
    assert numbers() == [*range(1, 6), *range(21, 26)]
    receipts.where("block_number between 6 and 20 or block_number > 25").write.parquet(f"{scratch}/r/n=2")
    for name, first in (("a", 41), ("b", 51)):
        _logs(spark, range(first, first + 10)).coalesce(1).write.parquet(f"{scratch}/{name}/part=2")
        run(name)
    assert numbers() == list(range(1, 61))
    assert numbers(stream.source_name(f"{scratch}/ckpt-a")) == [*range(1, 21), *range(41, 51)]
    assert numbers(stream.source_name(f"{scratch}/ckpt-b")) == [*range(21, 41), *range(51, 61)]
