"""Command-line jobs (``spark-submit`` or ``python -m gasledger.jobs``).

    import   exported ledger (JSON / CSV) -> ledger table
    land     raw logs + blocks + receipts  -> block-bucketed landing layout (scan-friendly)
    ingest   raw logs + blocks + receipts  -> ledger table (batch, idempotent per run id)
    stream   landed raw logs               -> ledger table (Structured Streaming; --format landed: batches of blocks)
    metrics  ledger table                  -> one metric table (Parquet)
    report   ledger table                  -> nested JSON report per address
    compact  batch-partitioned ledger      -> one row per key, month files, new folder
    audit    raw logs                      -> events per request chunk
    gaps     recorded landing runs         -> block ranges that no run covered

Raw inputs are Parquet in the raw schemas, node JSON objects with
``--format rpc-json``, or the landing layout with ``--format landed``.  Wallet options may repeat; none means every wallet.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from gasledger.constants import MAX_BLOCKS_PER_REQUEST, USDC_CONTRACT
from gasledger.operators import audit, coverage, decode, ingest, metrics, report
from gasledger.operators.wallets import either_case, select_wallets
from gasledger.session import get_session
from gasledger.sinks import commits
from gasledger.sinks import ledger as sink
from gasledger.sinks import raw_logs as raw_landing
from gasledger.sources import block_stream, ledger_export, rpc_json
from gasledger.sources.schemas import RAW_BLOCKS, RAW_LOGS, RAW_RECEIPTS
from gasledger.streaming import ingest as stream

METRICS = {
    "daily_gas_cost": metrics.daily_gas_cost,
    "daily_avg_gas_price": metrics.daily_avg_gas_price,
    "ma7_gas_price": metrics.ma7_gas_price,
    "cumulative_gas_cost": metrics.cumulative_gas_cost,
    "address_summary": metrics.address_summary,
    "combined_daily_metrics": metrics.combined_daily_metrics,
}


def _read(spark: SparkSession, path: str, kind: str, fmt: str) -> DataFrame:
    if fmt == "landed":
        return {"logs": raw_landing.read_raw_logs, "blocks": raw_landing.read_raw_blocks,
                "receipts": raw_landing.read_raw_receipts}[kind](spark, path)
    if fmt == "rpc-json":
        return {"logs": rpc_json.read_logs, "blocks": rpc_json.read_blocks, "receipts": rpc_json.read_receipts}[
            kind
        ](spark, path)
    schema = {"logs": RAW_LOGS, "blocks": RAW_BLOCKS, "receipts": RAW_RECEIPTS}[kind]  # parquet / landed
    return spark.read.schema(schema).parquet(path)


def _tables_format(args) -> str:
    """Format of the blocks and receipts inputs (defaults to the logs format)."""
    return args.tables_format or args.format


def _wallets(args, spark: SparkSession | None = None):
    """Wallet selection: ``--wallets-from`` (a Parquet table, any size), else ``--wallet``."""
    if getattr(args, "wallets_from", None):
        return spark.read.parquet(args.wallets_from)
    if not args.wallet:
        return None
    return args.wallet[0] if len(args.wallet) == 1 else args.wallet


def cmd_ingest(spark: SparkSession, args) -> None:
    if args.resume:
        # go on where the commits say every tracked wallet has come to, that block once more
        done = commits.state(spark, args.table).progress
        reached = [done.get(w) for w in stream.tracked(_wallets(args))]
        if None not in reached:
            args.from_block = min(reached)
    logs = _read(spark, args.logs, "logs", args.format)
    fmt = _tables_format(args)
    blocks = _read(spark, args.blocks, "blocks", fmt)
    if args.confirmations:
        # leave the newest blocks (possible re-organisation) for a later run
        head = audit.chain_head(blocks, args.confirmations).first()["head"]
        args.to_block = head if args.to_block is None else min(args.to_block, head)
    wallets = _wallets(args)
    if isinstance(wallets, str):
        # the two per-wallet scans push the wallet into the reader
        union = ingest.wallet_transfers(logs, wallets, args.from_block, args.to_block, args.contract or None)
    else:
        decoded = decode.decode_transfer_logs(logs, args.contract or None, args.from_block, args.to_block)
        union = ingest.transfers_union(decoded, wallets)
    deduped = ingest.dedup_last(union)
    receipts = _read(spark, args.receipts, "receipts", fmt)
    if isinstance(wallets, str) and fmt == "landed":
        # one wallet's events lie in few buckets: only theirs are read of headers and receipts
        buckets = ingest.event_buckets(deduped)
        blocks, receipts = ingest.in_buckets(blocks, buckets), ingest.in_buckets(receipts, buckets)
    rows = ingest.ledger_rows(deduped, blocks, receipts, args.from_block, args.to_block)
    good, bad = ingest.split_quarantine(rows)
    sink.write_batch(good, args.table, args.run_id, "ingest", layout=args.layout,
                     wallets=stream.tracked(_wallets(args)), block=args.to_block)
    # what cannot be stored is set aside beside the table, under the same run
    aside = f"{args.table.rstrip('/')}_aside"
    bad.write.mode("overwrite").parquet(f"{aside}/malformed/run_id={args.run_id}")
    ingest.unmatched(deduped, blocks, receipts, args.from_block, args.to_block).write.mode("overwrite").parquet(
        f"{aside}/unmatched/run_id={args.run_id}")
    written = _written(spark, args.table, "ingest", args.run_id)
    print(json.dumps({"run_id": args.run_id, "events_saved": written}))
    return written


def _written(spark: SparkSession, table: str, source: str, run_id: int) -> int:
    """Rows of one run, as its commit counted them."""
    return commits.state(spark, table).rows[source, run_id]


def cmd_stream(spark: SparkSession, args) -> None:
    by_blocks = args.format == "landed"
    if by_blocks:
        raw = block_stream.block_log_stream(spark, args.landing, args.blocks, args.blocks_per_batch, args.confirmations,
                                            args.first_block, MAX_BLOCKS_PER_REQUEST)
    elif args.format == "rpc-json":
        raw = rpc_json.normalize_logs(
            spark.readStream.schema(rpc_json.RPC_LOG).option("maxFilesPerTrigger", args.files_per_trigger)
            .option("mode", "FAILFAST").json(args.landing)
        )
    else:
        raw = stream.file_stream(spark, args.landing, RAW_LOGS, args.files_per_trigger)
    trigger = {"processingTime": f"{args.trigger_seconds} seconds"}
    if args.available_now:
        trigger = {"processingTime": "0 seconds"} if by_blocks else {"availableNow": True}
    fmt = _tables_format(args)
    q = stream.start_ingest(
        raw, lambda: _read(spark, args.blocks, "blocks", fmt), lambda: _read(spark, args.receipts, "receipts", fmt),
        args.table, args.checkpoint, None if by_blocks else args.first_block, args.contract or None, _wallets(args), trigger,
        args.patience,
    )
    if args.available_now:
        (block_stream.run_to_head if by_blocks else stream.run_to_end)(q)
    else:
        q.awaitTermination()


def _ledger(spark: SparkSession, args) -> DataFrame:
    ledger = sink.read_ledger(spark, args.table, args.start, args.end)
    # the wallet is part of the key, so its predicate goes below the dedup, into the scan
    ledger = select_wallets(ledger, _selected(args, spark), "wallet_address", normalize=args.normalize)
    # a compacted table already holds one row per key: skip the dedup shuffle
    return ledger if args.compacted else sink.final_rows(ledger)


def _selected(args, spark: SparkSession):
    return _wallets(args, spark) if args.normalize else either_case(_wallets(args, spark))


def cmd_metrics(spark: SparkSession, args) -> None:
    out = METRICS[args.metric](_ledger(spark, args), None, args.normalize)
    out.write.mode("overwrite").parquet(args.out)


def cmd_report(spark: SparkSession, args) -> None:
    rep = report.metrics_report(_ledger(spark, args), None, normalize=args.normalize)
    report.write_reports(rep, args.out)


def cmd_import(spark: SparkSession, args) -> int:
    """Load an exported ledger (JSON Lines / CSV) into the partitioned ledger table."""
    rows = ledger_export.read_export(spark, args.source, args.format)
    sink.write_batch(rows, args.table, args.run_id, "import", layout=args.layout)
    return _written(spark, args.table, "import", args.run_id)


def cmd_land(spark: SparkSession, args) -> None:
    """Re-land raw inputs in the block-bucketed, scan-friendly layout; a run replaces its own folder."""
    run = f"run_id={args.run_id}"
    raw_landing.write_raw_logs(_read(spark, args.logs, "logs", args.format), f"{args.out}/logs/{run}", "overwrite")
    raw_landing.write_raw_blocks(_read(spark, args.blocks, "blocks", args.format), f"{args.out}/blocks/{run}", "overwrite")
    raw_landing.write_raw_receipts(
        _read(spark, args.receipts, "receipts", args.format), f"{args.out}/receipts/{run}", "overwrite")
    if args.from_block is not None and args.to_block is not None:
        # what was asked for, whether or not it held an event
        raw_landing.write_coverage(spark, f"{args.out}/coverage/{run}", args.run_id, args.from_block, args.to_block)


def cmd_gaps(spark: SparkSession, args) -> None:
    """Blocks of a range that no landing run covered."""
    runs = raw_landing.read_coverage(spark, args.coverage)
    coverage.coverage_gaps(runs, args.from_block, args.to_block).write.mode("overwrite").parquet(args.out)


def cmd_compact(spark: SparkSession, args) -> None:
    sink.compact(spark, args.table, args.out, args.layout)


def cmd_audit(spark: SparkSession, args) -> None:
    logs = decode.decode_transfer_logs(_read(spark, args.logs, "logs", args.format), args.contract or None)
    audit.events_per_chunk(spark, logs, args.from_block, args.to_block, args.step, args.mode).write.mode(
        "overwrite"
    ).parquet(args.out)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="gasledger.jobs")
    sub = p.add_subparsers(dest="cmd", required=True)

    def common(sp, raw=True):
        sp.add_argument("--wallet", action="append", default=[])
        sp.add_argument("--contract", default=USDC_CONTRACT, help="'' for every contract")
        if raw:
            # landed: logs written by sinks.raw_logs (blocks/receipts as parquet)
            sp.add_argument("--format", choices=("parquet", "rpc-json", "landed"), default="parquet")
            sp.add_argument("--tables-format", choices=("parquet", "rpc-json", "landed"), default=None,
                            help="blocks and receipts; default: as --format")

    sp = sub.add_parser("ingest")
    common(sp)
    for a in ("--logs", "--blocks", "--receipts", "--table"):
        sp.add_argument(a, required=True)
    sp.add_argument("--from-block", type=int)
    sp.add_argument("--to-block", type=int)
    sp.add_argument("--run-id", type=int, required=True, help="re-running the same id replaces its output")
    sp.add_argument("--confirmations", type=int, default=0, help="skip the newest N blocks")
    sp.add_argument("--resume", action="store_true", help="from the progress committed with the table, else --from-block")
    sp.add_argument("--layout", choices=tuple(sink.LAYOUTS), default="address")

    sp = sub.add_parser("stream")
    common(sp)
    for a in ("--landing", "--blocks", "--receipts", "--table", "--checkpoint"):
        sp.add_argument(a, required=True)
    sp.add_argument("--first-block", type=int)
    sp.add_argument("--files-per-trigger", type=int, default=100)
    sp.add_argument("--blocks-per-batch", type=int, default=block_stream.DEFAULT_BATCH, help="with --format landed")
    sp.add_argument("--confirmations", type=int, default=0, help="with --format landed: stay N blocks behind the head")
    sp.add_argument("--patience", type=int, default=stream.PATIENCE, help="blocks an event waits for its receipt or header")
    sp.add_argument("--trigger-seconds", type=int, default=30)
    sp.add_argument("--available-now", action="store_true")

    for name in ("metrics", "report"):
        sp = sub.add_parser(name)
        sp.add_argument("--table", required=True)
        sp.add_argument("--out", required=True)
        sp.add_argument("--wallet", action="append", default=[])
        sp.add_argument("--wallets-from", help="Parquet table whose first column lists the wallets")
        sp.add_argument("--normalize", action="store_true")
        sp.add_argument("--compacted", action="store_true", help="table written by `compact`: keys are unique")
        sp.add_argument("--start")
        sp.add_argument("--end")
        if name == "metrics":
            sp.add_argument("--metric", choices=sorted(METRICS), required=True)

    sp = sub.add_parser("import")
    sp.add_argument("--source", required=True)
    sp.add_argument("--format", choices=("json", "csv"), default="json")
    sp.add_argument("--table", required=True)
    sp.add_argument("--run-id", type=int, required=True, help="re-running the same id replaces its output")
    sp.add_argument("--layout", choices=tuple(sink.LAYOUTS), default="address")

    sp = sub.add_parser("land")
    sp.add_argument("--format", choices=("parquet", "rpc-json"), default="parquet")
    for a in ("--logs", "--blocks", "--receipts", "--out"):
        sp.add_argument(a, required=True)
    sp.add_argument("--run-id", type=int, required=True, help="re-running the same id replaces its output")
    sp.add_argument("--from-block", type=int, help="with --to-block: the range that was asked for, recorded for `gaps`")
    sp.add_argument("--to-block", type=int)

    sp = sub.add_parser("gaps")
    for a in ("--coverage", "--out"):
        sp.add_argument(a, required=True)
    for a in ("--from-block", "--to-block"):
        sp.add_argument(a, type=int, required=True)

    sp = sub.add_parser("compact")
    sp.add_argument("--table", required=True)
    sp.add_argument("--out", required=True)
    sp.add_argument("--layout", choices=tuple(sink.LAYOUTS), default="address")

    sp = sub.add_parser("audit")
    common(sp)
    sp.add_argument("--logs", required=True)
    sp.add_argument("--out", required=True)
    sp.add_argument("--from-block", type=int, required=True)
    sp.add_argument("--to-block", type=int, required=True)
    sp.add_argument("--step", type=int, default=MAX_BLOCKS_PER_REQUEST)
    sp.add_argument("--mode", choices=("compat", "half_open"), default="compat")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None):
    args = parser().parse_args(argv)
    spark = spark or get_session()
    commands = {
        "ingest": cmd_ingest, "stream": cmd_stream, "metrics": cmd_metrics,
        "report": cmd_report, "compact": cmd_compact, "audit": cmd_audit, "land": cmd_land,
        "import": cmd_import, "gaps": cmd_gaps,
    }
    return commands[args.cmd](spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
