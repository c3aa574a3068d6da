"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Terms are lower-cased words and their first ``PREFIX`` bytes, as 64-bit hashes.  At most
``PER_CLASS`` labelled documents of each class are indexed, and their terms are the
vocabulary: vectors lie in its space, and a text's other terms have no part in them.
Each term's document frequency is counted over all documents and weighs it, however rare
or common (only what all documents hold weighs nothing).  The weights of the ``COMMON`` terms that most
examples hold lie in a table, which a matrix product applies to many texts at once.  For
all other terms the index is inverted and cut into blocks of ``BLOCK`` examples; for each
term and block it knows the largest weight.  The most that the table gives in a block and the
sum of these maxima bound the cosine of every example in it, so blocks are opened from the
most promising on until none left can reach the ``NEAREST`` best.  What may be among them is
compared once more, all in the same order: the result is that of comparing all.

The neighbours vote with weights that grow as their distance shrinks, each
example counting for the labelled documents it stands for, and the share of
toxic votes becomes a probability by a logistic fit to the votes on the
examples themselves, each left out of its own.

Defined results: null or empty texts and texts that share no term with any
example have no neighbours and get the score of the overall share; without
labels every score is 0.5; ties in similarity go to the lower example id;
repeated labels count once (the lower one), and so do rows that repeat a labelled id
(their lowest text is the example); empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gasledger.llm.common import hash_words_and_heads, map_arrow, mixed, text_slices, two_columns
from gasledger.llm.labelled import feature_counts, held_out, learnable, logistic, sampled, squashed

PREFIX = 4
PER_CLASS = 1024        # labelled documents of each class that are indexed
BLOCK = 256
COMMON = 1024           # terms whose weights lie in a table
CHUNK = 256             # vectors compared with the table at once
ROUNDING = 1e-11        # more than sums of products of two unit vectors differ by their order
NEAREST = 24
EVIDENCE = 5            # neighbours reported with each score


def terms_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The terms of all texts end to end (two a word), and the number of each text's first word."""
    words, heads, starts = hash_words_and_heads(texts, True, PREFIX)
    return np.stack([words, mixed(heads + np.uint64(99))], axis=1).ravel(), starts


class Vocabulary:
    """The terms of the examples, numbered; terms are looked up behind a table of their first bits."""

    def __init__(self, terms: np.ndarray):
        self.terms = np.unique(terms)
        bits = max(10, int(8 * len(self.terms)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.held = np.zeros(1 << bits, bool)
        self.held[self.terms >> self.shift] = True

    def lists(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(numbers of the distinct known terms, their counts) of each text."""
        terms, starts = terms_of(texts)
        at = np.flatnonzero(self.held[terms >> self.shift])
        if not len(at):
            return [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(texts)
        number = np.minimum(np.searchsorted(self.terms, terms[at]), len(self.terms) - 1)
        known = self.terms[number] == terms[at]
        text = np.searchsorted(2 * starts[1:], at[known], side="right")
        found, counts = np.unique(text * len(self.terms) + number[known], return_counts=True)
        text, number = np.divmod(found, len(self.terms))
        bounds = np.searchsorted(text, np.arange(len(texts) + 1)).tolist()
        return [(number[a:b], counts[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def weights(terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vector of a text over its distinct terms."""
    w = (1 + np.log(counts)) * idf[terms]
    size = np.sqrt(w @ w)
    return w / size if size else w


def vector(terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terms of a text that have weight, and the weights."""
    keep = idf[terms] > 0
    return terms[keep], weights(terms[keep], counts[keep], idf)


class BlockMaxIndex:
    """Unit vectors: the ``COMMON`` terms most of them hold as a table, all others as inverted lists
    in blocks with each list's largest weight per block.

    The table is applied to many queries at once by a matrix product, and lists of rare terms
    are short.  A product may round equal examples differently, by less than ``ROUNDING``, so it
    only chooses: whatever may be among the best gets its sum over the common terms once more,
    each example by the same steps.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, ids: np.ndarray):
        self.size, self.ids = len(vectors), ids
        term = np.concatenate([t for t, _ in vectors]) if vectors else np.zeros(0, np.int64)
        weight = np.concatenate([w for _, w in vectors]) if vectors else np.zeros(0)
        doc = np.repeat(np.arange(self.size), [len(t) for t, _ in vectors])
        held = np.bincount(term, minlength=n_terms)
        common = np.argsort(-held, kind="stable")[:COMMON]
        self.column = np.full(n_terms, -1)
        self.column[common] = np.arange(len(common))
        self.table = np.zeros((self.size, len(common)))
        column = self.column[term]
        listed = column < 0
        self.table[doc[~listed], column[~listed]] = weight[~listed]
        term, weight, doc = term[listed], weight[listed], doc[listed]
        order = np.lexsort((doc, term))
        term, self.weight, self.doc = term[order], weight[order], doc[order]
        cell = term * (self.size // BLOCK + 1) + self.doc // BLOCK
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        self.cell_start = np.append(first, len(cell))
        self.cell_block = self.doc[first] // BLOCK
        self.cell_max = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        self.term_start = np.searchsorted(term[first], np.arange(n_terms + 1))
        self.blocks = -(-self.size // BLOCK)

    def screened(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """What the common terms add to the similarity of each of ``vectors`` with each example."""
        queries = np.zeros((len(vectors), self.table.shape[1]))
        for query, (terms, weight) in zip(queries, vectors):
            column = self.column[terms]
            query[column[column >= 0]] = weight[column >= 0]
        return queries @ self.table.T

    def nearest(self, terms: np.ndarray, weight: np.ndarray, k: int, without: int = -1,
                screen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` most similar examples with a positive similarity, and the similarities.

        ``screen`` is the vector's row of ``screened``, if it is at hand.
        """
        if not len(terms) or not self.size:
            return np.zeros(0, np.int64), np.zeros(0)
        score = (self.screened([(terms, weight)])[0] if screen is None else screen).copy()
        if without >= 0:
            score[without] = 0
        column = self.column[terms]
        listed, common = column < 0, column >= 0
        cells, query = _ranges(self.term_start[terms[listed]], self.term_start[terms[listed] + 1], weight[listed])
        block = self.cell_block[cells]
        bound = np.maximum.reduceat(score, np.arange(0, self.size, BLOCK))
        bound = (bound + np.bincount(block, query * self.cell_max[cells], self.blocks)) * (1 + 1e-9)
        order = np.argsort(-bound, kind="stable")
        rest, at, floor, step = np.zeros(self.size), 0, self._floor(score, k), 4
        opened = np.zeros(self.blocks, bool)
        # a block that can only reach the floor may still hold a tie with a lower id
        while at < self.blocks and bound[order[at]] >= floor and bound[order[at]] > 0:
            now = order[at: at + step]
            now = now[(bound[now] >= floor) & (bound[now] > 0)]
            opened[:] = False
            opened[now] = True
            mine = np.flatnonzero(opened[block])
            at, step = at + len(now), step * 2
            places, value = _ranges(self.cell_start[cells[mine]], self.cell_start[cells[mine] + 1], query[mine])
            rest += np.bincount(self.doc[places], value * self.weight[places], self.size)
            if without >= 0:
                rest[without] = 0
            floor = self._floor(score + rest, k)
        score += rest
        best = np.flatnonzero((score >= floor) & (score > 0))
        similar = rest[best] + (self.table[best[:, None], column[common]] * weight[common]).sum(axis=1)
        first = np.lexsort((self.ids[best], -similar))[:k]
        return best[first], similar[first]

    def _floor(self, score: np.ndarray, k: int) -> float:
        """What an example must reach to be among the ``k`` best, rounding allowed for."""
        return np.partition(score, self.size - k)[self.size - k] - ROUNDING if self.size > k else 0.0


def _ranges(start: np.ndarray, end: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges end to end, and each range's value repeated."""
    n = end - start
    total = int(n.sum())
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(total), np.repeat(value, n)


class Voter:
    """The index with its examples' labels and the curve from votes to probabilities."""

    def __init__(self, ids, labels, found, idf: np.ndarray, sizes: dict[int, int]):
        self.idf = idf
        vectors = [vector(t, c, idf) for t, c in found]
        # examples of like vocabulary share blocks, which makes the bounds tight
        common = [int(t[np.argmax(c)]) if len(t) else -1 for t, c in found]
        by = np.lexsort((ids, labels, common))
        self.ids, self.labels = np.array(ids)[by], np.array(labels)[by]
        have = np.bincount(self.labels, minlength=2)
        self.stands = np.array([sizes.get(c, 0) / max(1, have[c]) for c in (0, 1)])[self.labels]
        self.share = (sizes.get(1, 0) + 1) / (sum(sizes.values()) + 2)
        vectors = [vectors[i] for i in by]
        self.index = BlockMaxIndex(vectors, len(idf), self.ids)
        self.a, self.b = 1.0, 0.0
        votes = np.array([logit for logit, _, _ in self.votes(vectors, leave_out=True)])
        if have.min() > 0:
            self.a, self.b = logistic(votes, self.labels, self.stands)

    def votes(self, vectors: list[tuple[np.ndarray, np.ndarray]], leave_out: bool = False) -> Iterator[tuple]:
        """Of each vector: log odds of toxic votes among the neighbours, the neighbours and their similarities.

        ``leave_out``: the vectors are the examples, none a neighbour of its own.
        """
        for begin in range(0, len(vectors), CHUNK):
            part = vectors[begin: begin + CHUNK]
            for i, ((terms, weight), screen) in enumerate(zip(part, self.index.screened(part)), begin):
                yield self._vote(*self.index.nearest(terms, weight, NEAREST, i if leave_out else -1, screen))

    def _vote(self, near: np.ndarray, similar: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        force = self.stands[near] / np.maximum(1.02 - similar, 0.02) ** 2
        toxic = float(force[self.labels[near] == 1].sum()) + self.share * 0.5
        return np.log(toxic / (float(force[self.labels[near] == 0].sum()) + (1 - self.share) * 0.5)), near, similar


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, label_col: str = "toxic",
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted and
    evidence (the nearest examples with similarity and label)."""
    spark, texts = docs.sparkSession, two_columns(docs, id_col, text_col)
    few, sizes = sampled(texts, learnable(labels, label_col, id_col), PER_CLASS)
    examples = _examples(few)
    vocabulary = Vocabulary(np.concatenate([e[2] for e in examples])) if examples else None
    voter = None
    if examples:
        known = spark.sparkContext.broadcast(vocabulary)
        counts = feature_counts(texts, lambda found: [t for t, _ in known.value.lists(found)], len(vocabulary.terms))
        idf = np.log((texts.count() + 1) / (counts + 1))
        lists = [(np.searchsorted(vocabulary.terms, terms), count) for _, _, terms, count in examples]
        voter = Voter([e[0] for e in examples], [e[1] for e in examples], lists, idf, sizes)
        voter.vocabulary = vocabulary
    shared = spark.sparkContext.broadcast(voter)

    def score(ids, found):
        v = shared.value
        if v is None:
            return {"doc_id": ids, "score": [0.5] * len(ids), "evidence": [[] for _ in ids]}
        logits, evidence = [], []
        for x, near, similar in v.votes([vector(t, c, v.idf) for t, c in v.vocabulary.lists(found)]):
            logits.append(x)
            evidence.append([{"doc_id": int(v.ids[i]), "similarity": float(s), "label": int(v.labels[i])}
                             for i, s in zip(near[:EVIDENCE], similar[:EVIDENCE])])
        return {"doc_id": ids, "score": squashed(v.a * np.array(logits) + v.b), "evidence": evidence}

    schema = "doc_id long, score double, evidence array<struct<doc_id:long,similarity:double,label:int>>"
    return map_arrow(texts, schema, score).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= F.lit(threshold)).cast("int").alias("predicted"), "evidence")


def _examples(few: DataFrame) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(id, label, distinct terms, counts) of the bounded sample; terms are counted in the tasks."""
    def run(batches):
        for batch in batches:
            labels, seen = batch.column("label").to_pylist(), 0
            for ids, found in text_slices([batch]):
                terms, starts = terms_of(found)
                lists = [np.unique(terms[2 * a: 2 * b], return_counts=True) for a, b in zip(starts[:-1], starts[1:])]
                yield pa.RecordBatch.from_pydict({
                    "id": pa.array(ids, pa.int64()), "label": pa.array(labels[seen: seen + len(ids)], pa.int32()),
                    "terms": pa.array([t.tobytes() for t, _ in lists], pa.binary()),
                    "counts": pa.array([c.astype(np.int32).tobytes() for _, c in lists], pa.binary())})
                seen += len(ids)

    rows = (few.select("doc_id", "text", "label").mapInArrow(run, "id long, label int, terms binary, counts binary")
            .orderBy(F.xxhash64("id"), "id"))
    return [(r["id"], r["label"], np.frombuffer(r["terms"], np.uint64), np.frombuffer(r["counts"], np.int32).astype(np.int64))
            for r in rows.toLocalIterator()]        # at most 2 * PER_CLASS rows
