"""Removal of repeated passages by relative Lempel-Ziv parsing.

Passages are compared in windows of ``WORDS`` words.  The text that can repeat
(``repeats``) is dealt into reference blocks by content, so that a passage and
everything it may equal share a block.  In a block, passages are taken in
document order and parsed greedily against what came before: at each place the
index of all earlier windows is asked; a hit is extended word by word to the
longest factor, and parsing goes on ``WORDS - 1`` words before the factor's
end, so that windows across the boundary of two factors are looked up too;
without a hit the window enters the index and parsing moves one word on.
Every factor is at least a window long and becomes a removed span.

Defined results: words are ``[^\\x20\\x09-\\x0D]+``; null or empty texts have no
words; a text shorter than a window keeps all of it; of equal texts the one of
the lowest id is parsed and the others go as a whole; a null id takes no part;
rows that repeat an id and its text are one document; empty tables give empty
results.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from gasledger.llm import anchors
from gasledger.llm.repeats import Kind, repeated

WORDS = 20
ANCHOR_WORDS = 8


def factors(passages: list[list[bytes]], width: int) -> list[tuple[int, int, int]]:
    """(passage, first, length) of the factors of ``passages``, parsed in the given order."""
    index: dict[bytes, tuple[int, int]] = {}
    out = []
    for p, words in enumerate(passages):
        i = 0
        while i + width <= len(words):
            key = b" ".join(words[i: i + width])
            if key not in index:
                index[key] = (p, i)
                i += 1
                continue
            q, j = index[key]
            n, source = width, passages[q]
            while i + n < len(words) and j + n < len(source) and words[i + n] == source[j + n]:
                n += 1
            out.append((p, i, n))
            i += n - width + 1
    return out


def _parsed(contexts: list[bytes], hashes: np.ndarray, lengths: np.ndarray):
    """Repeated windows of a reference block, sorted by anchor and document: (row, first, end)."""
    out = []
    bounds = [0, *(np.flatnonzero(np.diff(hashes)) + 1).tolist(), len(hashes)]
    for a, b in zip(bounds[:-1], bounds[1:]):
        out += [(a + p, i, i + n - WORDS + 1) for p, i, n in factors([c.split() for c in contexts[a:b]], WORDS)]
    return tuple(np.array(out, np.int64).reshape(-1, 3).T)


KIND = Kind(width=WORDS, gram=ANCHOR_WORDS, units=anchors.word_units, cut=bytes.split, glue=b" ".join,
            merge=lambda parts: b" ".join(chain.from_iterable(parts)), first_stays=True, compare=_parsed)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_units (words), n_removed, spans (of words) and kept_sha256."""
    return repeated(docs, KIND, id_col, text_col)
