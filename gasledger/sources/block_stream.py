"""A stream of landed logs whose offset is a block number.

``spark.readStream.format("block_logs")`` reads the landing layout of ``sinks.raw_logs``
in batches cut by blocks, as an export walks the chain:

* the offset is the next block to read; a new query begins at ``first_block`` (default:
  the first landed block) and a restarted one where its checkpoint ends;
* a batch goes up to ``blocks_per_batch`` blocks further, and never beyond the head, the
  highest landed block header less ``confirmations``;
* a batch is dealt as ranges of at most ``step`` blocks, one task each, which opens only
  the bucket folders of its range, skips row groups by block statistics and decodes the
  others a few thousand rows at a time.

A transaction lies in one block, so no batch splits one.  Only folders whose write has
ended (``_SUCCESS``) are read: land corrections as a new run instead of rewriting one
below the head.  Paths are opened with ``pyarrow.fs`` in the tasks.

Spark asks for one latest offset per trigger, so ``availableNow`` does one batch; a query
with a zero ``processingTime`` trigger and ``run_to_head`` goes on to the head.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gasledger.constants import BUCKET_BLOCKS, MAX_BLOCKS_PER_REQUEST
from gasledger.sources.schemas import RAW_LOGS

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # executors need not have this package

NAME = "block_logs"
DEFAULT_BATCH = 5_000
BUCKET = "block_bucket"
BATCH_ROWS = 4_096
BUFFER_BYTES = 256 << 10    # read at once of each column


class BlockRange(InputPartition):
    """Blocks ``first`` to ``last``, both included."""

    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


def _files(path: str):
    """File system and path of a full URI."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def _qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the session's file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def _names(files, folder: str) -> list[str]:
    from pyarrow import fs

    found = files.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == fs.FileType.Directory)


def _roots(files, folder: str) -> list[str]:
    """Folders that hold buckets: ``folder`` itself or its runs, as far as their write has ended."""
    from pyarrow import fs

    runs = [f"{folder}/{n}" for n in _names(files, folder) if n.startswith("run_id=")] or [folder]
    ended = files.get_file_info([f"{r}/_SUCCESS" for r in runs])
    return [r for r, f in zip(runs, ended) if f.type == fs.FileType.File]


def _bucket_blocks(path: str, newest: bool) -> int | None:
    """The highest (or lowest) block of a landed table, out of its last (first) bucket alone."""
    import pyarrow.compute as pc
    import pyarrow.dataset as ds

    files, folder = _files(path)
    found: dict[int, list[str]] = {}
    for root in _roots(files, folder):
        for name in _names(files, root):
            if name.startswith(f"{BUCKET}="):
                found.setdefault(int(name.split("=")[1]), []).append(f"{root}/{name}")
    for bucket in sorted(found, reverse=newest):
        edge = [pc.min_max(t.column(0)) for place in found[bucket]
                for t in [ds.dataset(place, filesystem=files, format="parquet").to_table(columns=["block_number"])] if len(t)]
        if edge:
            return max(e["max"].as_py() for e in edge) if newest else min(e["min"].as_py() for e in edge)
    return None


def _parts(files, folder: str) -> list[str]:
    """The data files in a folder."""
    from pyarrow import fs

    found = files.get_file_info(fs.FileSelector(folder))
    return sorted(f.path for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", ".")))


def _rows(files, path: str, first: int, last: int, columns: list[str]) -> Iterator:
    """The rows of blocks ``first`` to ``last`` of a file, decoded ``BATCH_ROWS`` at a time.

    A dataset scan decodes whole row groups, and several ahead; what this holds does not
    grow with the file, its row groups or the logs of a block.
    """
    import pyarrow.compute as pc
    import pyarrow.parquet as pq

    with files.open_input_file(path) as opened:
        file = pq.ParquetFile(opened, pre_buffer=False, buffer_size=BUFFER_BYTES)
        place = next(i for i in range(file.metadata.num_columns) if file.metadata.schema.column(i).path == "block_number")
        for group in range(file.metadata.num_row_groups):
            seen = file.metadata.row_group(group).column(place).statistics
            if seen is not None and seen.has_min_max and (seen.max < first or seen.min > last):
                continue
            for batch in file.iter_batches(BATCH_ROWS, [group], columns, use_threads=False):
                block = batch.column("block_number")
                kept = batch.select(columns).filter(pc.and_(pc.greater_equal(block, first), pc.less_equal(block, last)))
                if kept.num_rows:
                    yield kept


class BlockLogReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.logs, self.headers = options["path"].rstrip("/"), options["headers"].rstrip("/")
        self.batch = int(options.get("blocks_per_batch", DEFAULT_BATCH))
        self.step = int(options.get("step", MAX_BLOCKS_PER_REQUEST))
        self.confirmations = int(options.get("confirmations", 0))
        self.first = int(options["first_block"]) if "first_block" in options else None
        if self.batch < 1 or not 1 <= self.step <= MAX_BLOCKS_PER_REQUEST or self.confirmations < 0:
            raise ValueError(f"blocks_per_batch >= 1, step in 1..{MAX_BLOCKS_PER_REQUEST}, confirmations >= 0")
        self.columns = schema.names
        self.next: int | None = None

    def initialOffset(self) -> dict:
        if self.first is None:
            self.first = _bucket_blocks(self.headers, newest=False)
        self.next = self.first or 0
        return {"block": self.next}

    def latestOffset(self) -> dict:
        if self.next is None:
            self.initialOffset()
        head = _bucket_blocks(self.headers, newest=True)
        end = self.next if head is None else head - self.confirmations + 1
        return {"block": max(self.next, min(end, self.next + self.batch))}

    def partitions(self, start: dict, end: dict) -> list[BlockRange]:
        # a restarted query names the end of its last batch here before it asks for more
        self.next = end["block"]
        return [BlockRange(a, min(a + self.step, end["block"]) - 1) for a in range(start["block"], end["block"], self.step)]

    def read(self, partition: BlockRange) -> Iterator:
        files, folder = _files(self.logs)
        buckets = {f"{BUCKET}={b}" for b in range(partition.first // BUCKET_BLOCKS, partition.last // BUCKET_BLOCKS + 1)}
        for root in _roots(files, folder):
            for name in _names(files, root):
                if name in buckets:
                    for path in _parts(files, f"{root}/{name}"):
                        yield from _rows(files, path, partition.first, partition.last, self.columns)

    def commit(self, end: dict) -> None:
        pass


class BlockLogs(DataSource):
    """Options: path (landed logs), headers (landed blocks), blocks_per_batch, step, confirmations, first_block."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        return RAW_LOGS

    def streamReader(self, schema: StructType) -> BlockLogReader:
        return BlockLogReader(dict(self.options), schema)


def block_log_stream(
    spark: SparkSession, logs: str, headers: str, blocks_per_batch: int = DEFAULT_BATCH,
    confirmations: int = 0, first_block: int | None = None, step: int = MAX_BLOCKS_PER_REQUEST,
) -> DataFrame:
    """Landed raw logs (``schemas.RAW_LOGS``) as a stream in batches of blocks."""
    spark.dataSource.register(BlockLogs)
    reader = spark.readStream.format(NAME).option("headers", _qualified(spark, headers)).option("blocks_per_batch", blocks_per_batch)
    reader = reader.option("confirmations", confirmations).option("step", step)
    if first_block is not None:
        reader = reader.option("first_block", first_block)
    return reader.load(_qualified(spark, logs))


def run_to_head(query: StreamingQuery) -> None:
    """Wait until every block up to the head is stored, stop the query and surface its failure, if any."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
