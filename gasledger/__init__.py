"""gasledger: token-transfer ledgers and gas-cost analytics on Spark.

Layout
------
- ``functions``  column expressions (units, dates, hex, block ranges)
- ``sources``    explicit schemas, table readers, adapters over the test tables
- ``operators``  decode, ingest (union / dedup / joins), metrics, progress, audits, report
- ``sinks``      month-partitioned, idempotent Parquet writes
- ``streaming``  Structured Streaming ingest and live daily aggregates
- ``plans``      the named query catalogue and its DuckDB oracle SQL
"""

from gasledger.session import checkpoint_root, get_session

__all__ = ["get_session", "checkpoint_root"]
