"""Small helpers shared by the operators: scratch tables, text batches, word hashes."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gasledger.session import checkpoint_root

SLICE_BYTES = 1 << 20    # text handled at once inside a Python task
CACHE_WORDS = 1_000_000    # words whose ids a Python worker remembers
WHITE = "[\\x20\\x09-\\x0D]+"    # white space between words, as a pattern

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_BASE = np.uint64(0xD1342543DE82EF95)
_BYTE_VALUE = np.random.default_rng(7).integers(0, 2**64, 256, dtype=np.uint64)
_LOWER_VALUE = _BYTE_VALUE[[b + 32 if 65 <= b <= 90 else b for b in range(256)]]
_IS_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def two_columns(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id`` and ``text`` under fixed names, whatever else ``df`` carries; null text is ''."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs the tasks it ran, not the steps before.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_slices(batches: Iterable[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, UTF-8 texts) of bounded size out of Arrow batches of (doc_id, text)."""
    for batch in batches:
        ids = batch.column(0).to_pylist()
        texts = batch.column(1).cast(pa.binary())
        start, size = 0, 0
        lengths = np.diff(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset: texts.offset + len(texts) + 1]) \
            if len(texts) else np.zeros(0, np.int32)
        for i, n in enumerate(lengths):
            size += int(n) + 64
            if size >= most or i + 1 == len(lengths):
                yield ids[start: i + 1], texts.slice(start, i + 1 - start).to_pylist()
                start, size = i + 1, 0


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker process."""
    return sys.__dict__.setdefault("_llm_worker_cache", {})


def hash_words(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts end to end, and each text's first index (with the total last)."""
    hashes, _, starts = hash_words_and_heads(texts, lower, 0)
    return hashes, starts


def hash_words_and_heads(texts: list[bytes], lower: bool, head: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of all texts end to end, of their first ``head`` bytes, and each text's first index.

    Words are what is between ``[\\x20\\x09-\\x0D]``; ``lower`` hashes A-Z as a-z.  A word's
    hash is a polynomial over random values of its bytes, for all words at once.
    """
    flat = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    inside = np.concatenate([[False], ~_IS_WHITE[flat]])
    begin = np.flatnonzero(inside[1:] & ~inside[:-1])
    begins = np.zeros(len(texts) + 1, np.int64)     # of the texts, in bytes
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    starts = np.searchsorted(begin, begins)
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), starts
    length = np.flatnonzero(inside[:-1] & ~inside[1:]) - begin
    first = np.cumsum(length) - length
    place = np.arange(int(length.sum())) - np.repeat(first, length)
    terms = (_LOWER_VALUE if lower else _BYTE_VALUE)[flat[inside[1:]]] * _powers(int(length.max()))[place]
    heads = np.minimum(length, head).astype(np.uint64) * _MUL
    for i in range(head):
        long = np.flatnonzero(length > i)
        heads[long] += terms[first[long] + i]
    return mixed(np.add.reduceat(terms, first) + length.astype(np.uint64) * _MUL), mixed(heads), starts


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, _BASE, np.uint64), dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h *= _MIX
    return h ^ (h >> np.uint64(32))


def rolled(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive hashes (runs across documents included)."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    n = len(h) - k + 1
    out = mixed(h[:n])
    for i in range(1, k):
        out *= _MUL
        out += h[i: i + n]
    return mixed(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    have, out = 1, values
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def map_arrow(df: DataFrame, schema: str, fn: Callable[[list, list[bytes]], dict | None],
              most: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` over slices of (doc_id, text) of ``most`` bytes; ``fn`` returns columns or None."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for ids, texts in text_slices(batches, most):
            columns = fn(ids, texts)
            if columns is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name]
                     for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def lists(values: np.ndarray, starts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Arrow list column out of one flat array and list starts (total last)."""
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(values, type=kind))
