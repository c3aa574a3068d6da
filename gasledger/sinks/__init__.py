"""Writers: the month-partitioned ledger (``ledger``) and the block-bucketed raw landing (``raw_logs``)."""
