"""Block-range arithmetic: splitting a range into request-sized chunks.

The export job asks a node for at most ``step`` blocks per log request.  Its
chunking walks ``current`` from ``lo`` while ``current < hi`` and emits the
inclusive pair ``[current, min(current + step - 1, hi)]``.  Two consequences
(kept on purpose in ``mode="compat"``):

* ``(100, 1100)`` -> ``[100, 1099]``: block 1100 is left for the next batch;
* ``(100, 600)``  -> ``[100, 600]``: block 600 is read again by the next batch,
  which starts at 600.

``mode="half_open"`` covers exactly ``[lo, hi)`` so consecutive batches
``[a, b)``, ``[b, c)`` neither skip nor repeat a block.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


CHUNK_ARRAY = "array<struct<chunk_from:bigint,chunk_to:bigint>>"


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x).cast("long")


def block_ranges(lo, hi, step=1000, mode: str = "compat") -> Column:
    """Array of ``struct(chunk_from, chunk_to)`` for one range; explode it.

    ``lo``, ``hi``: columns or ints; ``step``: int or column.  Empty when
    ``lo >= hi`` (no chunk is emitted, and ``sequence`` is never asked to count
    backwards).
    """
    if mode not in ("compat", "half_open"):
        raise ValueError(f"unknown mode {mode!r}")
    lo_c, hi_c, step_c = _c(lo), _c(hi), _c(step)
    starts = F.sequence(lo_c, hi_c - 1, step_c)
    last = hi_c if mode == "compat" else hi_c - 1
    chunks = F.transform(
        starts,
        lambda s: F.struct(s.alias("chunk_from"), F.least(s + step_c - 1, last).alias("chunk_to")),
    )
    return F.when(lo_c < hi_c, chunks).otherwise(F.array().cast(CHUNK_ARRAY))


def chunk_id(block: Column | str, lo, step=1000) -> Column:
    """Index of the chunk that holds ``block`` (same layout as block_ranges).

    Lets a per-chunk audit run as an equi-join / group-by on an integer key
    instead of a range join.
    """
    return F.floor((_c(block) - _c(lo)) / _c(step)).cast("long")
