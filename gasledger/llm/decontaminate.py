"""Benchmark decontamination by Wu-Manber multi-pattern search.

Text is lower-cased (A-Z) and reduced to its words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``
with one space between; a pattern is a window of ``n`` consecutive words of a
benchmark item (an item of fewer words is one pattern), with a space on either
side so that only whole words match.

The search looks at the last ``BLOCK`` bytes of a stretch as long as the
shortest pattern: a shift table says how far the stretch can move on without
missing an occurrence; where it cannot, the bucket of patterns that share those
bytes is compared byte by byte.  Patterns are searched in classes of similar
length, so that a very short one does not spoil the shifts of the rest.

Patterns reach the tasks in blocks of at most ``BLOCK_PATTERNS`` patterns or
``BLOCK_BYTES`` bytes, one broadcast each; every document is searched for every
block.  Only the benchmark (a stated query set) travels that way, never documents.

Defined results: null or empty texts and texts without words have no words and
no hits; items without words have no patterns; repeated items count once per
distinct id; a null item id is reported as ''; empty tables give no rows or no hits.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gasledger.llm.common import map_arrow, two_columns, worker_cache

WINDOW_WORDS = 10
BLOCK = 8                   # bytes looked up in the shift table
BLOCK_PATTERNS = 16_384
BLOCK_BYTES = 4 << 20

_WORDS = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
               for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


class WuManber:
    """Search tables for patterns of similar length."""

    def __init__(self, patterns: list[bytes]):
        self.stretch = min(map(len, patterns))
        self.block = min(BLOCK, self.stretch)
        self.step = self.stretch - self.block + 1
        self.shift: dict[bytes, int] = {}
        self.bucket: dict[bytes, list[bytes]] = {}
        for p in patterns:
            for end in range(self.block, self.stretch + 1):
                key, move = p[end - self.block: end], self.stretch - end
                if move < self.shift.get(key, self.step):
                    self.shift[key] = move
            self.bucket.setdefault(p[self.stretch - self.block: self.stretch], []).append(p)

    def find(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        """(position, pattern) of every occurrence."""
        shift, block, stretch, step, at = self.shift.get, self.block, self.stretch, self.step, self.stretch
        while at <= len(text):
            tail = text[at - block: at]
            move = shift(tail, step)
            if move:
                at += move
                continue
            for p in self.bucket[tail]:
                if text.startswith(p, at - stretch):
                    yield at - stretch, p
            at += 1


def classes(patterns: list[bytes]) -> list[WuManber]:
    by: dict[int, list[bytes]] = {}
    for p in patterns:
        by.setdefault(len(p).bit_length(), []).append(p)
    return [WuManber(x) for x in by.values()]


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = WINDOW_WORDS) -> DataFrame:
    """Distinct (pattern, item_id) of a benchmark table."""
    def cut(ids, texts):
        out = []
        for item, text in zip(ids, texts):
            words = words_of(text)
            if words:
                out += {(b" " + b" ".join(words[i: i + n]) + b" ", item or "") for i in range(max(1, len(words) - n + 1))}
        return {"pattern": [p for p, _ in out], "item_id": [i for _, i in out]} if out else None

    source = items.select(F.col(id_col).cast("string"), F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return map_arrow(source, "pattern binary, item_id string", cut).distinct()


def _blocks(windows: DataFrame) -> Iterator[bytes]:
    """Blocks of pattern -> item ids, one on the driver at a time."""
    block, size, rows = {}, 0, 0
    for pattern, item in windows.toLocalIterator():
        block.setdefault(bytes(pattern), []).append(item)
        size, rows = size + len(pattern) + len(item), rows + 1
        if rows >= BLOCK_PATTERNS or size >= BLOCK_BYTES:
            yield pickle.dumps(block)
            block, size, rows = {}, 0, 0
    if block:
        yield pickle.dumps(block)


def contamination(docs: DataFrame, items: DataFrame, n: int = WINDOW_WORDS, id_col: str = "doc_id",
                  text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit (words inside an occurrence), item_ids (distinct
    items that occur, as strings), spans (hit words as [first, end) of word numbers)."""
    spark = docs.sparkSession
    shared = [spark.sparkContext.broadcast(b) for b in _blocks(item_windows(items, item_id_col, item_text_col, n))]

    call = uuid.uuid4().hex

    def tables(i: int):
        cache = worker_cache()
        if cache.get("wu-manber", (None,))[0] != (call, i):
            found = pickle.loads(shared[i].value)
            cache["wu-manber"] = ((call, i), found, classes(list(found)))
        return cache["wu-manber"][1:]

    def search(ids, texts):
        words = [words_of(t) for t in texts]
        hits: dict[int, list[tuple[int, bytes]]] = {}
        names: dict[int, set[str]] = {}
        for i in range(len(shared)):
            named, searchers = tables(i)
            for d, w in enumerate(words):
                line = b" " + b" ".join(w) + b" "
                for s in searchers:
                    for at, p in s.find(line):
                        hits.setdefault(d, []).append((at, p.count(b" ") - 1))
                        names.setdefault(d, set()).update(named[p])
        spans = [[] for _ in words]
        for d, found in hits.items():
            line = np.frombuffer(b" " + b" ".join(words[d]) + b" ", np.uint8)
            first = np.searchsorted(np.flatnonzero(line == 32), [a for a, _ in found])
            change = np.zeros(len(words[d]) + 1, np.int64)
            np.add.at(change, first, 1)
            np.add.at(change, first + [c for _, c in found], -1)
            inside = np.concatenate([[0], np.cumsum(change)[:-1] > 0, [0]]).astype(np.int64)
            spans[d] = [{"first": int(a), "end": int(b)} for a, b in
                        zip(np.flatnonzero(np.diff(inside) == 1), np.flatnonzero(np.diff(inside) == -1))]
        return {"doc_id": ids, "n_words": [len(w) for w in words],
                "n_hit": [sum(s["end"] - s["first"] for s in x) for x in spans],
                "item_ids": [sorted(names.get(d, ())) for d in range(len(words))], "spans": spans}

    return map_arrow(two_columns(docs, id_col, text_col),
                     "doc_id long, n_words long, n_hit long, item_ids array<string>, "
                     "spans array<struct<first:long,end:long>>", search)


def drop_contaminated(docs: DataFrame, items: DataFrame, n: int = WINDOW_WORDS, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without any occurrence, all columns kept.

    The search runs beside each row's other columns, so nothing is shuffled.
    """
    spark = docs.sparkSession
    shared = [spark.sparkContext.broadcast(b) for b in _blocks(item_windows(items, n=n))]
    at = docs.columns.index(text_col)

    def keep(batches):
        searchers = [classes(list(pickle.loads(b.value))) for b in shared] if len(shared) == 1 else None
        for batch in batches:
            lines = [b" " + b" ".join(words_of(t or b"")) + b" " for t in batch.column(at).cast(pa.binary()).to_pylist()]
            clean = np.ones(len(lines), bool)
            for i, b in enumerate(shared):
                found = searchers[i] if searchers else classes(list(pickle.loads(b.value)))
                for d, line in enumerate(lines):
                    clean[d] &= not any(next(s.find(line), None) for s in found)
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(keep, docs.schema)
