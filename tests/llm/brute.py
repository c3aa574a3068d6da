"""Plain single-machine versions of what the operators compute."""

import hashlib
import re
from collections import Counter

import numpy as np


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def passages(docs, width=20):
    """doc_id -> (n_words, n_removed, kept_sha256), documents in the order of their ids."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        words = (text or "").encode().split()
        gone = np.zeros(len(words), bool)
        for i in range(len(words) - width + 1):
            key = tuple(words[i: i + width])
            if key in seen:
                gone[i: i + width] = True
            seen.add(key)
        out[doc_id] = (len(words), int(gone.sum()), sha(b" ".join(w for w, g in zip(words, gone) if not g)))
    return out


def byte_strings(docs, width=200):
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256)."""
    texts = {d: (t or "").encode() for d, t in docs}
    times = Counter(t[i: i + width] for t in texts.values() for i in range(len(t) - width + 1))
    out = {}
    for d, t in texts.items():
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - width + 1):
            if times[t[i: i + width]] > 1:
                gone[i: i + width] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[d] = (len(t), int(gone.sum()), spans, sha(bytes(b for b, g in zip(t, gone) if not g)))
    return out


def near(docs, k=3, percent=85):
    """doc_id -> (n_shingles, component_id)."""
    sets = {}
    for d, t in docs:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i: i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    comp = {d: d for d in sets}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}


def measures(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i: i + 3]) for i in range(len(words) - 2)]
    times, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            inside |= {i, i + 1, i + 2}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def line_runs(docs):
    """doc_id -> text without the lines of any two worded lines in a row that occur before."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        lines = (text or "").split("\n")
        worded = [i for i, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x)]
        gone = set()
        for i, j in zip(worded, worded[1:]):
            key = (lines[i], lines[j])
            if key in seen:
                gone |= set(range(i, j + 1))
            seen.add(key)
        out[doc_id] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out
