"""Packing of instruction or text data into training sequences by vector bin packing.

Every example has a demand vector -- tokens, segments (1) and loss-bearing
tokens -- and a sequence has a capacity in each.  The open sequence takes, of
the examples that still fit, the one whose demand has the largest dot product
with what is left of the capacity; when none fits, the next one opens.

Examples longer than a sequence are cut before: whole sequences of
``max_tokens`` stand alone, the rest is packed.  Packing runs over windows of
``WINDOW`` examples of a stored table, so a task holds a bounded number and
nothing is shuffled; a window leaves at most its last sequences part-filled.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gasledger.llm.common import map_arrow, stored, two_columns
from gasledger.llm.tokens import encoder

WINDOW = 4096          # examples packed together
SLICE_BYTES = 8 << 20    # text cut into words at once: a slice's repeated words are looked up once
MAX_TOKENS = 2048
MAX_SEGMENTS = 256
END_ID = 1


def pack_vectors(demand: np.ndarray, capacity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and order in the bin of every row of ``demand``; a row that fits no empty bin is refused.

    Ties go to the earlier row.  Rows of zero demand are placed like any other.
    """
    if (demand > capacity).any():
        raise ValueError("an example exceeds a sequence's limits")
    n = len(demand)
    bins, order = np.zeros(n, np.int64), np.zeros(n, np.int64)
    alone = (demand == capacity).any(axis=1) & (demand[:, 0] == capacity[0])    # nothing fits beside these
    bins[alone] = np.arange(int(alone.sum()))
    rows = np.flatnonzero(~alone)
    kinds, kind = np.unique(demand[rows], axis=0, return_inverse=True)
    if (np.diff(kinds, axis=0) >= 0).all():
        bins[rows], order[rows] = _pack_chain(kinds, kind.ravel(), capacity)
        bins[rows] += int(alone.sum())
        return bins, order
    want, share = demand[rows], demand[rows] / np.maximum(capacity, 1)
    gone = np.zeros(len(rows), bool)
    left, current, inside, taken = capacity.astype(np.int64), int(alone.sum()), 0, 0
    for _ in range(len(rows)):
        while True:
            fits = ~gone & (want <= left).all(axis=1)
            dot = np.where(fits, share @ (left / np.maximum(capacity, 1)), -1.0)
            best = int(dot.argmax())
            if dot[best] >= 0:
                break
            left, current, inside = capacity.astype(np.int64), current + 1, 0
        bins[rows[best]], order[rows[best]] = current, inside
        left = left - want[best]
        gone[best] = True
        inside, taken = inside + 1, taken + 1
        if taken * 4 > len(rows):
            keep = ~gone
            rows, want, share, gone, taken = rows[keep], want[keep], share[keep], gone[keep], 0
            if not len(rows):
                break
    return bins, order


def _pack_chain(kinds: np.ndarray, kind: np.ndarray, capacity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``pack_vectors`` of rows whose different demands (``kinds``) grow in every dimension together.

    Of those the largest that fits has the largest dot product, so it is looked up.
    """
    columns, limits = kinds.T.tolist(), capacity.tolist()
    by = np.argsort(kind, kind="stable")
    rows, sizes = by.tolist(), kinds.tolist()
    after = np.cumsum(np.bincount(kind, minlength=len(kinds))).tolist()
    first = [0, *after[:-1]]
    # places count from 1: one with rows left points to itself, another to a smaller one, 0 is none
    below = list(range(len(kinds) + 1))
    bins, order = np.zeros(len(kind), np.int64), np.zeros(len(kind), np.int64)
    left, current, inside = limits, 0, 0
    for _ in rows:
        while True:
            at = min(map(bisect_right, columns, left))
            while below[at] != at:
                below[at] = at = below[below[at]]
            if at:
                break
            left, current, inside = limits, current + 1, 0
        row = rows[first[at - 1]]
        first[at - 1] += 1
        if first[at - 1] == after[at - 1]:
            below[at] = at - 1
        bins[row], order[row] = current, inside
        left = [x - y for x, y in zip(left, sizes[at - 1])]
        inside += 1
    return bins, order


def pack(examples: DataFrame, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS,
         max_loss_tokens: int | None = None, tokens_col: str = "length", loss_col: str | None = None) -> DataFrame:
    """``examples`` with ``sequence_id`` and ``offset`` (its place in the sequence, gapless from 0).

    The rows are stored first, so that windows are the same when a task runs
    again.  Null demands count as 0; examples beyond a limit raise.
    """
    taken = [c for c in ("sequence_id", "offset", "_tokens", "_loss") if c in examples.columns]
    if taken:
        raise ValueError(f"examples already have columns {taken}")
    loss = F.col(loss_col) if loss_col else F.col(tokens_col)
    table = stored(examples.withColumns({
        "_tokens": F.coalesce(F.col(tokens_col).cast("long"), F.lit(0)),
        "_loss": F.coalesce(loss.cast("long"), F.lit(0))}), "packing")
    names = table.columns
    capacity = np.array([max_tokens, max_segments, max_tokens if max_loss_tokens is None else max_loss_tokens])

    def windows(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            while rows >= WINDOW:
                whole = pa.Table.from_batches(held)
                yield whole.slice(0, WINDOW)
                held, rows = whole.slice(WINDOW).to_batches(), rows - WINDOW
        if rows:
            yield pa.Table.from_batches(held)

    def run(batches):
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 33
        for window in windows(batches):
            tokens, lost = (window.column(c).to_numpy() for c in ("_tokens", "_loss"))
            bins, order = pack_vectors(np.stack([tokens, np.ones_like(tokens), lost], axis=1), capacity)
            by = np.lexsort((order, bins))
            ends = np.cumsum(tokens[by])
            new = np.diff(bins[by], prepend=-1) > 0
            base = np.maximum.accumulate(np.where(new, ends - tokens[by], 0))
            offset = np.empty(len(by), np.int64)
            offset[by] = ends - tokens[by] - base
            out = window.select(names[:-2]).append_column("sequence_id", pa.array(first + bins))
            yield from out.append_column("offset", pa.array(offset)).combine_chunks().to_batches()
            first += int(bins.max()) + 1

    schema = table.drop("_tokens", "_loss").schema.add("sequence_id", "long").add("offset", "long")
    return table.mapInArrow(run, schema)


def token_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 max_tokens: int = MAX_TOKENS, end_id: int = END_ID) -> DataFrame:
    """Documents as ids plus ``end_id``, cut every ``max_tokens`` ids.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens.  Null or
    empty text is the end id alone; repeated rows give their pieces each.
    """
    def cut(ids, texts):
        flat, sizes = encoder(path).encode(texts)
        flat, at, out = flat.astype("<u4"), 0, []
        for doc_id, size in zip(ids, sizes.tolist()):
            data = np.append(flat[at: at + size], np.uint32(end_id)).astype("<u4").tobytes()
            at += size
            out += [(doc_id, s, min(max_tokens, size + 1 - s), zlib.crc32(data[4 * s: 4 * (s + max_tokens)]), size + 1)
                    for s in range(0, size + 1, max_tokens)]
        return dict(zip(("doc_id", "start", "length", "ids_crc32", "doc_tokens"), zip(*out)))

    return map_arrow(two_columns(docs, id_col, text_col),
                     "doc_id long, start long, length long, ids_crc32 long, doc_tokens long", cut, SLICE_BYTES)


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                   max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS) -> DataFrame:
    """Documents packed into sequences of at most ``max_tokens`` ids, every id once."""
    return pack(token_pieces(docs, path, id_col, text_col, max_tokens), max_tokens, max_segments)
