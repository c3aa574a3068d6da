"""Keep one row per key.

Used for last-wins log dedup, newest progress version and table-key dedup.
Written as ``row_number() = 1`` over a window: Spark plans it as a partial
top-1 per key on the map side (``WindowGroupLimit Partial``), the shuffle,
and a final top-1, so a key holding a third of all rows is reduced to one row
per map task before it moves -- like a partial aggregate, but without carrying
whole rows through an aggregation buffer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], tie_break: bool = True
) -> DataFrame:
    """The first row of every key in ``order``.

    With ``tie_break`` the order is made total by appending every other column,
    so ties never make the answer depend on row order or partitioning.  Pass
    ``tie_break=False`` when ``order`` is already unique within a key (or tied
    rows are identical): then columns the caller does not use are pruned
    before the shuffle instead of being carried as sort keys.
    """
    tie_break = [F.col(c).desc_nulls_last() for c in df.columns if c not in keys] if tie_break else []
    w = Window.partitionBy(*keys).orderBy(*order, *tie_break)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")
