"""Content-defined anchors: which stretches of a text can repeat elsewhere.

A window of ``width`` units (words or bytes) is represented by the smallest
hash among its ``gram``-unit pieces.  That choice depends on the window's
content alone, so windows that are equal have equal representatives, wherever
they stand.  Neighbouring windows mostly share theirs: a text becomes runs of
windows with one representative each, a small fraction of its length.  A window
can only repeat if its representative does, so all exact work is left to runs
whose representative occurs twice.  Nothing that repeats is missed.
"""

from __future__ import annotations

import numpy as np

from gasledger.llm.common import hash_words, mixed, rolled, sliding_min

CHUNK = 1 << 19      # windows handled at once

_BYTE_VALUE = np.random.default_rng(11).integers(0, 2**64, 256, dtype=np.uint64)


def word_units(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and where each text starts (total last)."""
    return hash_words(texts)


def byte_units(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each text starts (total last)."""
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    return np.frombuffer(b"".join(texts), np.uint8), starts


def grams(units: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every run of ``gram`` units; for bytes a power of two, by doubling."""
    if units.dtype != np.uint8:
        return rolled(units, gram)
    out, have = _BYTE_VALUE[units], 1
    while have < gram:
        out = out[: len(out) - have] * np.uint64(0x9E3779B97F4A7C15 + 2 * have) + out[have:]
        have *= 2
    return mixed(out)


def runs(units: np.ndarray, starts: np.ndarray, gram: int, width: int):
    """(text, first, length, hash, weight) of every run of windows, as arrays.

    ``first`` counts units within the text; ``weight`` is 2 where the
    representative occurs more than once in the run itself.
    """
    parts, inner = [], width - gram
    texts = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    for a in range(0, max(0, len(units) - width + 1), CHUNK):
        b = min(a + CHUNK, len(units) - width + 1)
        g = grams(units[a: b + width - 1], gram)
        low = sliding_min(g, inner + 1)
        valid = texts[a:b] == texts[a + width - 1: b + width - 1]
        change = np.ones(b - a, bool)
        change[1:] = (low[1:] != low[:-1]) | (valid[1:] != valid[:-1])
        first = np.flatnonzero(change)
        length = np.diff(first, append=b - a)
        keep = valid[first]
        first, length = first[keep], length[keep]
        if not len(first):
            continue
        span = length + inner
        begin = np.cumsum(span) - span
        inside = np.repeat(first - begin, span) + np.arange(int(span.sum()))
        times = np.add.reduceat(g[inside] == np.repeat(low[first], span), begin, dtype=np.int64)
        text = texts[a + first]
        parts.append((text, first + a - starts[text], length, low[first], 1 + (times > 1)))
    if not parts:
        return tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, np.uint64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*parts))
