"""Quality classifier: Naive Bayes support vectors.

A document is the set of its n-grams (byte trigrams, words, and whether a word
stands three times running), hashed to ``SIZE`` features.  Each feature is
scaled by the log-ratio of its smoothed document counts in the two classes,
counted over every learnable label.  A linear hinge-loss model is fitted to the
scaled indicators by dual coordinate descent, on at most ``PER_CLASS`` labelled
documents of each class, and its margins become probabilities by a logistic fit
to margins of documents left out in turn.

Defined results: null or empty texts have no features and get the score of
margin 0; without labels every score is 0.5, with one class only the smoothed
share of that class; repeated labels count once (the lower one); an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gasledger.llm.common import hash_words, map_arrow, mixed, text_slices, two_columns
from gasledger.llm.labelled import feature_counts, held_out, learnable, logistic, sampled, squashed

SIZE = 1 << 18
PER_CLASS = 6000       # labelled documents of each class that the linear model is fitted to
SMOOTHING = 1.0
COST = 1.0
ROUNDS = 12
FOLDS = 3


def features(texts: list[bytes]) -> list[np.ndarray]:
    """Distinct feature numbers of each text."""
    words, starts = hash_words(texts)
    half = np.uint64(SIZE // 2 - 1)
    word_at = ((words & half) + np.uint64(SIZE // 2)).astype(np.int64)
    same = np.zeros(len(words), bool)
    same[2:] = (words[2:] == words[1:-1]) & (words[1:-1] == words[:-2])
    seen, out = np.zeros(SIZE, np.int64), []
    for t, a, b in zip(texts, starts[:-1], starts[1:]):
        flat = np.frombuffer(t, np.uint8).astype(np.uint64)
        three = mixed((flat[:-2] << np.uint64(16)) | (flat[1:-1] << np.uint64(8)) | flat[2:]) if len(flat) > 2 else flat[:0]
        at = np.concatenate([(three & half).astype(np.int64), word_at[a:b],
                             [SIZE - 1] if b - a > 2 and same[a + 2: b].any() else []]).astype(np.int64)
        place = np.arange(len(at))
        seen[at] = place
        out.append(at[seen[at] == place])
    return out


def log_ratios(counts: np.ndarray) -> np.ndarray:
    smooth = counts + SMOOTHING
    return (np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())).astype(np.float64)


def fit(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of the hinge-loss model (the last one is the bias), by dual coordinate descent."""
    rng = np.random.default_rng(3)
    y = np.where(labels == 1, 1.0, -1.0)
    scaled = [_scaled(r, ratio) for r in rows]
    norms = np.array([1.0 + float(x @ x) for x in scaled])      # with the bias feature
    w, alpha, upper = np.zeros(SIZE + 1), np.zeros(len(rows)), COST * weight
    for _ in range(ROUNDS):
        most = 0.0
        for i in rng.permutation(len(rows)):
            at, x = rows[i], scaled[i]
            slope = y[i] * (w[at] @ x + w[SIZE]) - 1
            new = min(max(alpha[i] - slope / norms[i], 0.0), upper[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[at] += step * x
                w[SIZE] += step
                most, alpha[i] = max(most, abs(step)), new
        if most < 1e-3:
            break
    return w


def _scaled(at: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    x = ratio[at]
    size = float(np.sqrt(x @ x))
    return x / size if size else x


def margin(at: np.ndarray, ratio: np.ndarray, w: np.ndarray) -> float:
    return float(w[at] @ _scaled(at, ratio) + w[SIZE])


def train(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, sizes: dict[int, int]) -> dict:
    """The model, with the logistic curve of margins of left-out documents."""
    have = np.bincount(labels, minlength=2)
    share = np.array([sizes[c] / max(1, have[c]) for c in (0, 1)])[labels]
    balance = np.ones(len(labels))
    fold, left = np.arange(len(rows)) % FOLDS, np.zeros(len(rows))
    for f in range(FOLDS):
        part = np.flatnonzero(fold != f)
        w = fit([rows[i] for i in part], labels[part], ratio, balance[part])
        for i in np.flatnonzero(fold == f):
            left[i] = margin(rows[i], ratio, w)
    a, b = logistic(left, labels, share)
    return {"ratio": ratio, "w": fit(rows, labels, ratio, balance), "a": a, "b": b}


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, label_col: str = "quality",
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted."""
    spark, texts = docs.sparkSession, two_columns(docs, id_col, text_col)
    known = learnable(labels, label_col, id_col)
    few, sizes = sampled(texts, known, PER_CLASS)
    model = None
    if len(sizes) == 2:
        # the labels grow with the documents: the same sort-merge join at every size
        learnt = texts.where(~held_out(F.col("doc_id"))).join(known.hint("merge"), "doc_id")
        counts = feature_counts(learnt.select("doc_id", "text", "label"), features, SIZE, "label")
        model = _fitted(few, log_ratios(counts), sizes)
    if model is None:
        constant = 0.5 if not sizes else (sizes.get(1, 0) + 1) / (sum(sizes.values()) + 2)
        model = {"ratio": np.zeros(SIZE), "w": np.zeros(SIZE + 1), "a": 0.0, "b": float(np.log(constant / (1 - constant)))}
    shared = spark.sparkContext.broadcast({k: v.astype(np.float32) if isinstance(v, np.ndarray) else v for k, v in model.items()})

    def score(ids, found):
        m = shared.value
        x = np.array([margin(at, m["ratio"], m["w"]) for at in features(found)])
        return {"doc_id": ids, "score": squashed(m["a"] * x + m["b"])}

    return map_arrow(texts, "doc_id long, score double", score).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= F.lit(threshold)).cast("int").alias("predicted"))


def _fitted(few: DataFrame, ratio: np.ndarray, sizes: dict[int, int]) -> dict | None:
    """The model, fitted in one task to the bounded sample."""
    shared = few.sparkSession.sparkContext.broadcast(ratio)

    def run(batches):
        rows, labels, order = [], [], []
        for batch in batches:
            labels += batch.column("label").to_pylist()
            for ids, found in text_slices([batch]):
                rows += features(found)
                order += ids
        if len(set(labels)) < 2:
            return
        by = np.argsort(order, kind="stable")
        model = train([rows[i] for i in by], np.array(labels)[by], shared.value, sizes)
        yield pa.RecordBatch.from_pylist([{"w": model["w"].tobytes(), "a": model["a"], "b": model["b"]}])

    found = few.select("doc_id", "text", "label").repartition(1).mapInArrow(run, "w binary, a double, b double").collect()
    return {"ratio": ratio, "w": np.frombuffer(found[0]["w"]), "a": found[0]["a"], "b": found[0]["b"]} if found else None
