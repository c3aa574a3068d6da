"""DataFrame -> DataFrame operators.

- ``decode``    Transfer decoding, sender / receiver scans, block ranges
- ``ingest``    sender ∪ receiver union, last-wins dedup, receipt / block joins, ledger rows, quarantine
- ``keyed``     one row per key (partial top-1 before the shuffle)
- ``wallets``   one / many / all wallets; size-checked broadcast semi join
- ``metrics``   daily cost, mean price, 7-row moving average, running sum, summary, combined
- ``report``    nested per-address report
- ``progress``  export progress versions and lookups
- ``audit``     chain head, request chunks, events per chunk
"""
