"""Folds, bounded samples of labelled rows, hashed-feature counts and calibration."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gasledger.llm.common import stored, text_slices

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is never learnt from: crc32 of the id's text mod 5 is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def learnable(labels: DataFrame, label_col: str, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, label) with label 0 or 1, one row per id (the lower of repeated labels)."""
    return (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
            .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.min("label").alias("label")))


def sampled(docs: DataFrame, known: DataFrame, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """At most ``per_class`` labelled documents of each class as (doc_id, text, label), chosen by
    hash of the id, and the size of each class.

    Labels of ids that no document has are neither chosen nor counted.  Rows that share an
    id count once, with the lowest of their texts.
    """
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    present = stored(known.join(ids, "doc_id", "left_semi"), "labelled")
    sizes = {r["label"]: r["n"] for r in present.groupBy("label").agg(F.count("*").alias("n")).collect()}
    spark = docs.sparkSession
    chosen = [(r["doc_id"], r["label"]) for label in sorted(sizes)
              for r in present.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect()]
    few = spark.createDataFrame(chosen, "doc_id long, label int")     # at most 2 * per_class rows
    return (docs.join(F.broadcast(few), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
            .select("doc_id", "text", "label")), sizes


def feature_counts(docs: DataFrame, features: Callable[[list[bytes]], list[np.ndarray]], size: int,
                   label: str | None = None) -> np.ndarray:
    """Documents that hold each of ``size`` hashed features, [size] or by label [2, size].

    Every task adds up its own documents first and sends its non-zero counts only.
    """
    classes = 1 if label is None else 2

    def run(batches):
        counts = np.zeros((classes, size), np.int64)
        for batch in batches:
            kinds = batch.column(label).to_numpy() if label else np.zeros(batch.num_rows, np.int64)
            seen = 0
            for ids, texts in text_slices([batch]):
                for found in features(texts):
                    counts[kinds[seen]][found] += 1
                    seen += 1
        at = np.flatnonzero(counts)
        for i in range(0, len(at), 100_000):
            part = at[i: i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts.ravel()[part])], names=["at", "n"])

    out = np.zeros(classes * size, np.int64)
    total = docs.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()   # <= classes * size
    out[total.column("at").to_numpy()] = total.column("n").to_numpy()
    return out.reshape(classes, size) if label else out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and intercept of P(y = 1) = 1 / (1 + exp(-(a x + b))), by Newton steps."""
    a, b = 0.0, float(np.log((weight * y).sum() + 1) - np.log((weight * (1 - y)).sum() + 1))
    target = np.where(y == 1, (weight * y).sum() + 1, 1) / (np.where(y == 1, (weight * y).sum(), (weight * (1 - y)).sum()) + 2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = weight * (p - target)
        h = np.maximum(weight * p * (1 - p), 1e-9)
        grad = np.array([(g * x).sum() + 1e-3 * a, g.sum()])
        hess = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(float(a), 0.0), float(b)


def squashed(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
