"""Selecting the wallets a metric is computed for.

``wallets`` everywhere in the package may be:

* ``None``       -- every address (the scalable form: one pass for all wallets);
* ``str``        -- one address, an equality predicate pushed to the Parquet scan
                    (row-group statistics and bloom filters skip the rest);
* list of str    -- an ``IN`` predicate, also pushed down;
* ``DataFrame``  -- a column of addresses of any size: a left-semi join with the
                    distinct set; AQE picks the strategy from its real size.

Addresses compare case-sensitively, as stored.  ``normalize=True`` lower-cases
both sides (the predicate then cannot be pushed to the scan).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gasledger.functions.units import normalize_address

Wallets = None | str | Sequence[str] | DataFrame


def select_wallets(
    df: DataFrame,
    wallets: Wallets,
    column: str = "from_address",
    normalize: bool = False,
) -> DataFrame:
    if wallets is None:
        return df
    target: Column = normalize_address(column) if normalize else F.col(column)
    if isinstance(wallets, str):
        value = wallets.lower() if normalize else wallets
        return df.where(target == F.lit(value))
    if isinstance(wallets, DataFrame):
        key = wallets.columns[0]
        w = wallets.select(F.col(key).alias("_wallet"))
        if normalize:
            w = w.select(normalize_address("_wallet").alias("_wallet"))
        return df.join(w.distinct(), target == F.col("_wallet"), "left_semi")
    values = [v.lower() if normalize else v for v in wallets]
    return df.where(target.isin(values))


def either_case(wallets: Wallets) -> Wallets:
    """Given addresses as they are and in lower case: ingested ledgers hold lower case, imported
    ones what the export held.  Stays a pushable predicate."""
    if wallets is None or isinstance(wallets, DataFrame):
        return wallets
    given = [wallets] if isinstance(wallets, str) else list(wallets)
    return sorted({v for w in given for v in (w, w.lower())})
