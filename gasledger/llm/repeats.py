"""Windows of a fixed width that occur more than once in a corpus, exactly, in bounded tasks.

The frame that substring dedup by Lempel-Ziv parsing (``substring_dedup``) and
by suffix arrays (``suffix_dedup``) share:

1. every distinct text is reduced to its runs of anchors (``anchors``), and the
   runs whose anchor occurs twice are found by a pre-aggregated count;
2. texts that hold such runs are kept, compressed, with their runs;
3. each run's context -- the units its windows cover -- is reduced to a digest;
   contexts that are equal are one, with a count and their first occurrence;
4. contexts that share an anchor but differ are compared exactly by the
   method's own ``compare``, in shards of bounded size dealt by anchor; anchors
   of more than ``HOT`` different contexts are compared window by window in a
   pre-aggregated grouping instead, so that no shard grows with a hot anchor;
5. the repeated windows go back to their texts.

Equal texts are one text from step 1 on, so copies are never expanded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gasledger.llm import anchors
from gasledger.llm.common import lists, stored, text_slices, two_columns

SHARD_BYTES = 2 << 20      # context bytes compared together
HOT = 4096                 # different contexts of an anchor beyond which windows are compared singly


@dataclass(frozen=True)
class Kind:
    """How a method sees texts and windows."""

    width: int                                   # units of a window
    gram: int                                    # units of an anchor
    units: Callable                              # texts -> unit hashes, starts
    cut: Callable[[bytes], object]               # text -> its units, sliceable
    glue: Callable[[object], bytes]              # units -> text
    merge: Callable[[list], bytes]               # stretches of units -> text
    first_stays: bool                            # whether the first occurrence is not a repeat
    compare: Callable                            # contexts of a shard -> repeated windows


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _digest(data: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(data)
    return _signed(d >> 64), _signed(d & (2**64 - 1))


def summaries(texts: DataFrame, kind: Kind) -> DataFrame:
    """Per document: doc_id, n_units, sha256, d1, d2 (digest of the units) and its runs as lists."""
    def run(batches):
        for ids, found in text_slices(batches):
            flat, starts = kind.units(found)
            text, first, length, value, weight = anchors.runs(flat, starts, kind.gram, kind.width)
            bounds = np.searchsorted(text, np.arange(len(found) + 1))
            digests = [_digest(flat[a:b].tobytes()) for a, b in zip(starts[:-1], starts[1:])]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(np.diff(starts)),
                pa.array([hashlib.sha256(kind.glue(kind.cut(t))).digest() for t in found], pa.binary()),
                pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()),
                lists(value.view(np.int64), bounds, pa.int64()), lists(first, bounds, pa.int32()),
                lists(length, bounds, pa.int32()), lists(weight, bounds, pa.int32())],
                names=["doc_id", "n_units", "sha256", "d1", "d2", "hash", "first", "length", "weight"])

    return texts.mapInArrow(run, "doc_id long, n_units long, sha256 binary, d1 long, d2 long, hash array<long>, "
                                 "first array<int>, length array<int>, weight array<int>")


def _compressed(texts: DataFrame) -> DataFrame:
    def run(batches):
        press = zstandard.ZstdCompressor(3).compress
        for ids, found in text_slices(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([press(t) for t in found], pa.binary())], names=["doc_id", "z"])

    return texts.mapInArrow(run, "doc_id long, z binary")


def _contexts(held: DataFrame, kind: Kind) -> DataFrame:
    """(hash, c1, c2, doc_id, first, length, weight, size) of every run of ``held``."""
    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                units = kind.cut(zstandard.decompress(row["z"]))
                for r in row["runs"]:
                    data = kind.glue(units[r["first"]: r["first"] + r["length"] + kind.width - 1])
                    out.append((r["hash"], *_digest(data), row["doc_id"], r["first"], r["length"], r["weight"], len(data)))
            if out:
                yield pa.RecordBatch.from_pydict(
                    dict(zip(("hash", "c1", "c2", "doc_id", "first", "length", "weight", "size"), zip(*out))))

    return held.mapInArrow(run, "hash long, c1 long, c2 long, doc_id long, first long, length long, "
                                "weight long, size long")


def _texts_of(wanted: DataFrame, held: DataFrame, kind: Kind, windows: bool) -> DataFrame:
    """The contexts of ``wanted`` (hash, doc_id, first, length, shard), or each of their windows by digest."""
    per = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("hash", "first", "length", "shard")).alias("wants"))

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                units = kind.cut(zstandard.decompress(row["z"]))
                for r in row["wants"]:
                    a, n = r["first"], r["length"]
                    if windows:
                        out += [(*_digest(kind.glue(units[i: i + kind.width])), row["doc_id"], i) for i in range(a, a + n)]
                    else:
                        out.append((r["shard"], r["hash"], row["doc_id"], a, n, kind.glue(units[a: a + n + kind.width - 1])))
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*out))))

    names = ("f1", "f2", "doc_id", "first") if windows else ("shard", "hash", "doc_id", "first", "length", "context")
    schema = "f1 long, f2 long, doc_id long, first long" if windows else \
        "shard long, hash long, doc_id long, first long, length long, context binary"
    return held.select("doc_id", "z").join(per, "doc_id").mapInArrow(run, schema)


def repeated(docs: DataFrame, kind: Kind, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_units, n_removed, spans (removed units as [first, end)) and
    kept_sha256 (of the units left, as bytes)."""
    texts = two_columns(docs, id_col, text_col)
    seen = stored(summaries(texts, kind), "runs")
    copies = stored(seen.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "copies")
    each = (seen.where("size(hash) > 0 and doc_id is not null")
            .join(copies.select("rep").where("rep is not null"), F.col("doc_id") == F.col("rep"), "left_semi")
            .select("doc_id", F.explode(F.arrays_zip("hash", "first", "length", "weight")).alias("r"))
            .select("doc_id", "r.*"))
    # aggregates are stored before they are joined: only a join whose two sides are plain
    # exchanges has its hot partitions split
    twice = stored(each.groupBy("hash").agg(F.sum("weight").alias("n")).where("n > 1").select("hash"), "anchors")
    found = (each.join(twice, "hash", "left_semi").groupBy("doc_id")
             .agg(F.collect_list(F.struct("hash", "first", "length", "weight")).alias("runs")))
    held = stored(_compressed(texts).join(found, "doc_id").dropDuplicates(["doc_id"]), "held")
    marked = _marked(held, kind)
    cut = held.join(marked, "doc_id", "left").mapInArrow(
        _cutter(kind), "doc_id long, n_removed long, spans array<struct<first:long,end:long>>, cut_sha256 string")
    whole = (F.col("doc_id") != F.col("rep")) if kind.first_stays else (F.col("copies") > 1)
    whole = F.coalesce(whole & (F.col("n_units") >= kind.width), F.lit(False))
    span = F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("n_units").alias("end")))
    none = F.array().cast("array<struct<first:bigint,end:bigint>>")
    return (seen.select("doc_id", "n_units", "sha256", "d1", "d2").join(copies, ["d1", "d2"])
            .join(cut, "doc_id", "left")
            .select("doc_id", "n_units",
                    F.when(whole, F.col("n_units")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
                    F.when(whole, span).otherwise(F.coalesce("spans", none)).alias("spans"),
                    F.when(whole, F.sha2(F.lit(""), 256))
                    .otherwise(F.coalesce("cut_sha256", F.lower(F.hex("sha256")))).alias("kept_sha256")))


def _marked(held: DataFrame, kind: Kind) -> DataFrame:
    """Per document: partial (first units of the runs that are not repeated as a whole) and
    ranges (of repeated windows in them)."""
    kinds = stored(
        _contexts(held, kind).groupBy("hash", "c1", "c2")
        .agg(F.min(F.struct("doc_id", "first")).alias("src"), F.count("*").alias("n"),
             F.max("weight").alias("weight"), F.max("length").alias("length"), F.max("size").alias("size"))
        .select("hash", "src.doc_id", "src.first", "n", "weight", "length", "size"), "contexts")
    several = stored(kinds.groupBy("hash").agg(F.count("*").alias("m"), F.max("weight").alias("w"))
                     .where("m > 1 or w > 1").select("hash", "m"), "several")
    wanted = stored(kinds.join(several, "hash").select("hash", "doc_id", "first", "length", "m", "size"), "wanted")
    shards = max(1, (wanted.where(F.col("m") <= HOT).agg(F.sum("size")).first()[0] or 0) // SHARD_BYTES)
    wanted = wanted.withColumn("shard", F.pmod("hash", F.lit(shards)))
    ranges = (_texts_of(wanted.where(F.col("m") <= HOT), held, kind, False)
              .groupBy("shard").applyInPandas(_shard(kind), "doc_id long, first long, end long"))
    hot = wanted.where(F.col("m") > HOT)
    if not hot.isEmpty():
        single = stored(_texts_of(hot, held, kind, True), "windows")
        same = stored(single.groupBy("f1", "f2").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "first")).alias("src"))
                      .where("n > 1"), "same")
        again = single.join(same, ["f1", "f2"])
        if kind.first_stays:
            again = again.where(F.struct("doc_id", "first") != F.col("src"))
        ranges = ranges.union(again.select("doc_id", "first", (F.col("first") + 1).alias("end")))
    partial = kinds if kind.first_stays else kinds.where("n = 1")
    empty = F.lit(None).cast("long")
    return (ranges.select("doc_id", F.struct("first", "end").alias("range"), empty.alias("partial"))
            .unionByName(partial.select("doc_id", F.col("first").alias("partial")), allowMissingColumns=True)
            .groupBy("doc_id").agg(F.collect_list("range").alias("ranges"), F.collect_list("partial").alias("partial")))


def _shard(kind: Kind):
    def run(frame):
        import pandas as pd

        frame = frame.sort_values(["hash", "doc_id", "first"], kind="stable", ignore_index=True)
        rows, firsts, ends = kind.compare(frame["context"].tolist(), frame["hash"].to_numpy(), frame["length"].to_numpy())
        base = frame["first"].to_numpy()[rows]
        return pd.DataFrame({"doc_id": frame["doc_id"].to_numpy()[rows], "first": base + firsts, "end": base + ends})

    return run


def _cutter(kind: Kind):
    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                units = kind.cut(zstandard.decompress(row["z"]))
                partial = set(row["partial"] or ())
                ranges = [(r["first"], r["end"]) for r in row["ranges"] or ()]
                ranges += [(r["first"], r["first"] + r["length"]) for r in row["runs"] if r["first"] not in partial]
                change = np.zeros(len(units) + 1, np.int64)
                if ranges:
                    a, b = np.array(ranges, np.int64).T
                    np.add.at(change, a, 1)
                    np.add.at(change, b - 1 + kind.width, -1)
                gone = np.concatenate([[0], np.cumsum(change[:-1]) > 0, [0]]).astype(np.int64)
                step = np.diff(gone)
                spans = list(zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()))
                edges = [0, *(x for span in spans for x in span), len(units)]
                kept = kind.merge([units[a:b] for a, b in zip(edges[::2], edges[1::2])])
                out.append({"doc_id": row["doc_id"], "n_removed": int(gone.sum()),
                            "spans": [{"first": a, "end": b} for a, b in spans],
                            "cut_sha256": hashlib.sha256(kept).hexdigest()})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                    ("doc_id", pa.int64()), ("n_removed", pa.int64()),
                    ("spans", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), ("cut_sha256", pa.string())]))

    return run
