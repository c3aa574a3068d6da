"""Node JSON-RPC objects landed as JSON Lines."""

import datetime as dt
import json

from gasledger.constants import TRANSFER_TOPIC, USDC_CONTRACT
from gasledger.operators import decode
from gasledger.session import local_path
from gasledger.sources import rpc_json

W = "0x" + "a" * 40
O = "0x" + "c" * 40


def _word(a):
    return "0x" + "0" * 24 + a[2:]


def _log(i, removed=False):
    return {
        "address": USDC_CONTRACT.upper().replace("0X", "0x"),
        "topics": [TRANSFER_TOPIC, _word(W), _word(O)],
        "data": "0x" + hex(1000 + i)[2:].rjust(64, "0"),
        "blockNumber": hex(23534907 + i), "blockHash": "0x" + "b" * 64,
        "transactionHash": f"0x{i:064x}", "transactionIndex": hex(i % 4), "logIndex": hex(i),
        "removed": removed,
    }


def _write(spark, path, objs):
    import os

    os.makedirs(local_path(path), exist_ok=True)
    with open(local_path(path) + "/part-0.json", "w") as f:
        for o in objs:
            f.write(json.dumps(o) + "\n")


def test_logs_blocks_receipts(spark, scratch):
    _write(spark, f"{scratch}/logs", [_log(0), _log(1), _log(2, removed=True)])
    logs = rpc_json.read_logs(spark, f"{scratch}/logs")
    d = decode.decode_transfer_logs(logs).orderBy("log_index").collect()
    assert [(r.block_number, r.log_index, r.value) for r in d] == [(23534907, 0, "1000"), (23534908, 1, "1001")]

    _write(spark, f"{scratch}/blocks", [{"number": "0x1671e5b", "hash": "0xh", "timestamp": hex(1759881600)}])
    b = rpc_json.read_blocks(spark, f"{scratch}/blocks").first()
    assert b.block_number == 23535195 and b.timestamp == dt.datetime(2025, 10, 8)

    receipt = {
        "transactionHash": "0x01", "blockNumber": "0x10", "blockHash": "0xh", "transactionIndex": "0x2",
        "contractAddress": None, "cumulativeGasUsed": "0x5208", "effectiveGasPrice": "0xffffffffffffffff",
        "from": W, "to": None, "gasUsed": "0x5208", "logs": [_log(0), _log(1, removed=True)],
        "logsBloom": "0x", "status": "0x1", "type": "0x2",
    }
    _write(spark, f"{scratch}/receipts", [receipt])
    r = rpc_json.read_receipts(spark, f"{scratch}/receipts").first()
    assert r.gas_used == "21000" and r.effective_gas_price == str(2**64 - 1)
    assert r.block_number == 16 and r.transaction_index == 2 and r.to is None
    assert len(r.logs) == 1 and r.logs[0].log_index == 0


def test_ledger_export_roundtrip(spark, scratch):
    from pyspark.sql import functions as F

    from gasledger import jobs
    from gasledger.functions.units import iso_text
    from gasledger.sinks import ledger as sink
    from gasledger.sources import ledger_export
    from gasledger.sources import testdata as td

    t = td.transfers(spark, "/root/testdata/sf0.001")
    # the original insert format: ISO text without zone, millisecond precision
    exported = t.select(*[iso_text(c).alias(c) if c in ("timestamp", "updated_at") else F.col(c)
                          for c in t.columns])
    exported.write.json(f"{scratch}/json")
    exported.write.option("header", "true").csv(f"{scratch}/csv")
    for fmt in ("json", "csv"):
        back = ledger_export.read_export(spark, f"{scratch}/{fmt}", fmt)
        want = t.select(*[F.date_trunc("millisecond", F.col(c)).cast("timestamp_ntz").alias(c)
                          if c in ("timestamp", "updated_at") else F.col(c) for c in t.columns])
        assert sorted(back.collect()) == sorted(want.collect())
    n = jobs.main(["import", "--source", f"{scratch}/json", "--table", f"{scratch}/ledger", "--run-id", "1"], spark)
    assert n == t.count() == sink.read_ledger(spark, f"{scratch}/ledger").count()
