"""Removal of byte strings that occur more than once, by suffix arrays.

The text that can repeat (``repeats``) is dealt into shards by content, so that
equal strings share a shard.  A shard's suffix array is built by Larsson and
Sadakane's refinement: suffixes are sorted by their first eight bytes, and
groups that are still equal are sorted again by the rank of what follows, at
twice the depth each time, until all differ.  Kasai's scan then gives the
common prefixes of neighbours; it walks all contexts of the shard side by side.
A window is repeated if it shares ``BYTES`` bytes with either neighbour.

Strings of an anchor too common for one shard meet in a grouping by digest, in
place of pairwise binary searches between shards, whose number would grow with
the square of the shards.

Defined results: null or empty texts have no bytes; shorter texts keep all of
theirs; texts that occur twice as a whole go as a whole; a null id takes no
part; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from gasledger.llm import anchors
from gasledger.llm.repeats import Kind, repeated

BYTES = 200
ANCHOR_BYTES = 64


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eight bytes from every place, starts, ends): texts end to end with a zero after each."""
    flat = np.frombuffer(b"\x00".join(texts) + bytes(9), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    n = int(ends[-1]) + 1
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | flat[i: i + n]
    return key, ends - sizes, ends


def suffix_array(key: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks of texts, each of which ends in a symbol of its own."""
    n = len(key)
    left = np.repeat(ends, ends - starts + 1) - np.arange(n)       # bytes to the end of the text
    # what stands beyond an end does not count, and no end equals another
    short = left < 8
    beyond = (np.uint64(8) * (8 - left[short]).astype(np.uint64))
    key = key.copy()
    key[short] &= ~((np.uint64(1) << (beyond % np.uint64(64))) - np.uint64(1))
    key[left == 0] = 0
    order = np.lexsort((np.minimum(left, 8), key))
    new = np.ones(n, bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | short[order][1:] | short[order][:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = head
    depth = 8
    while True:
        last = np.append(new[1:], True)
        slots = np.flatnonzero(~(new & last))       # places in groups of two or more
        if not len(slots):
            return order, rank
        who = order[slots]
        by = np.argsort(rank[who] * np.int64(n + 1) + rank[np.minimum(who + depth, n - 1)], kind="stable")
        follow = rank[np.minimum(who + depth, n - 1)][by]
        group = rank[who][by]
        order[slots] = who[by]
        fresh = np.ones(len(slots), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])
        new[slots] = fresh
        rank[order[slots]] = np.maximum.accumulate(np.where(fresh, slots, 0))
        depth *= 2


def common_prefixes(key: np.ndarray, starts: np.ndarray, ends: np.ndarray, order: np.ndarray,
                    rank: np.ndarray, most: int, walk: np.ndarray) -> np.ndarray:
    """Bytes (at most ``most``) that the suffixes at the first ``walk`` places of each text share
    with the one sorted before, by place; Kasai's scan over all texts at once."""
    out = np.zeros(len(key), np.int64)
    ending = np.repeat(ends, ends - starts + 1)
    active = np.flatnonzero(walk > 0)
    h = np.zeros(len(starts), np.int64)
    step = 0
    while len(active):
        at = starts[active] + step
        before = order[np.maximum(rank[at] - 1, 0)]
        room = np.minimum(np.minimum(ending[at] - at, ending[before] - before), most)
        room[rank[at] == 0] = 0
        same = np.minimum(np.maximum(h[active] - 1, 0), room)
        for stride in (8, 1):
            go = np.arange(len(active))
            while len(go):
                go = go[same[go] + stride <= room[go]]
                x, y = key[at[go] + same[go]], key[before[go] + same[go]]
                go = go[(x == y) if stride == 8 else (x >> np.uint64(56)) == (y >> np.uint64(56))]
                same[go] += stride
        out[at] = same
        h[active] = same
        step += 1
        active = active[walk[active] > step]
    return out


def _repeated(contexts: list[bytes], hashes: np.ndarray, lengths: np.ndarray):
    """Repeated windows of a shard as ranges: (row, first, end)."""
    key, starts, ends = joined(contexts)
    order, rank = suffix_array(key, starts, ends)
    shared = common_prefixes(key, starts, ends, order, rank, BYTES, lengths)
    with_last = shared >= BYTES
    again = with_last.copy()
    again[order[np.maximum(rank[with_last] - 1, 0)]] = True
    row = np.repeat(np.arange(len(starts)), ends - starts + 1)
    place = np.arange(len(key)) - starts[row]
    again &= place < lengths[row]
    step = np.diff(np.concatenate([[0], again.astype(np.int8), [0]]))
    first, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    return row[first], place[first], place[end - 1] + 1


KIND = Kind(width=BYTES, gram=ANCHOR_BYTES, units=anchors.byte_units, cut=bytes, glue=bytes,
            merge=b"".join, first_stays=False, compare=_repeated)


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_units (bytes), n_removed, spans (of bytes) and kept_sha256."""
    return repeated(docs, KIND, id_col, text_col)
