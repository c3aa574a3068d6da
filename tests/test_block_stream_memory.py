"""A range of blocks is read a few rows at a time, however large the file's row groups are."""

import pyarrow as pa
import pyarrow.parquet as pq

from gasledger.sources import block_stream
from gasledger.sources.schemas import RAW_LOGS

FIRST, ROWS = 100_000, 200_000


def write_logs(folder, per_block):
    place = folder / f"{block_stream.BUCKET}=1"
    place.mkdir(parents=True)
    (folder / "_SUCCESS").touch()
    (place / "_hidden").write_text("no data")
    blocks = [FIRST + i // per_block for i in range(ROWS)]
    kinds = {"log_index": pa.int32(), "block_number": pa.int64(), "transaction_index": pa.int32()}
    columns = {"address": ["0xa"] * ROWS, "topics": [[f"0x{i:064x}", f"0x{i * 7:064x}"] for i in range(ROWS)],
               "data": [f"0x{i * 3:064x}" for i in range(ROWS)], "log_index": [i % per_block for i in range(ROWS)],
               "block_number": blocks, "block_hash": [f"0x{b:064x}" for b in blocks],
               "transaction_hash": [f"0x{i:064x}" for i in range(ROWS)], "transaction_index": [0] * ROWS}
    table = pa.table({f.name: pa.array(columns[f.name], kinds.get(f.name)) for f in RAW_LOGS.fields})
    pq.write_table(table, place / "part-0.parquet", row_group_size=ROWS)


def test_a_large_row_group_is_not_held_whole(tmp_path):
    write_logs(tmp_path / "logs", 100)
    reader = block_stream.BlockLogReader({"path": f"file:{tmp_path}/logs", "headers": "/none"}, RAW_LOGS)
    before, most, found = pa.total_allocated_bytes(), 0, []
    for batch in reader.read(block_stream.BlockRange(FIRST + 500, FIRST + 1499)):
        most = max(most, pa.total_allocated_bytes() - before)
        assert batch.schema.names == RAW_LOGS.names and batch.num_rows <= block_stream.BATCH_ROWS
        found += zip(batch.column("block_number").to_pylist(), batch.column("log_index").to_pylist())
    assert found == [(FIRST + b, i) for b in range(500, 1500) for i in range(100)]
    assert most < 12_000_000      # the row group takes more than 80 MB


def test_a_range_outside_the_statistics_is_not_decoded(tmp_path, monkeypatch):
    write_logs(tmp_path / "logs", 100)
    reader = block_stream.BlockLogReader({"path": f"file:{tmp_path}/logs", "headers": "/none"}, RAW_LOGS)
    monkeypatch.setattr(pq.ParquetFile, "iter_batches", lambda *a, **k: 1 / 0)
    assert list(reader.read(block_stream.BlockRange(FIRST + 2_000, FIRST + 2_999))) == []
