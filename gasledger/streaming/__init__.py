"""Structured Streaming: replay-safe ingest (``ingest``) and live daily totals (``daily``)."""
