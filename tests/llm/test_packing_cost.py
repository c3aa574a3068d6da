"""Ids and packing cost little per new word and per example, and stay what the library and the rule give."""

import time

import numpy as np
import pytest

from gasledger.llm import packing, tokens

PATH = tokens.default_path()


class Counted:
    """The tokenizer, with a count of the texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


def library(texts):
    return [e.ids for e in tokens.load(PATH).encode_batch([t.decode() for t in texts], add_special_tokens=False)]


def test_new_words_are_read_many_at_a_time():
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdeéß.,'1"), 9)) for _ in range(6_000)]
    texts = [" ".join(words[i: i + 300]).encode() for i in range(0, 6_000, 150)]
    encoder = tokens.WordIds(PATH)
    encoder.tokenizer = counted = Counted(encoder.tokenizer)
    ids, sizes = encoder.encode(texts)
    want = library(texts)
    assert ids.tolist() == sum(want, []) and sizes.tolist() == [len(w) for w in want]
    assert 0 < counted.texts < 100
    again, _ = encoder.encode(texts)
    assert (again == ids).all() and counted.texts < 100


@pytest.mark.parametrize("group", [1, 2, 256])
def test_words_with_the_mark_and_special_strings(monkeypatch, group):
    monkeypatch.setattr(tokens, "READ_WORDS", group)
    texts = [b"", b" \t\n\x0b\x0c\r", b"a\0b \0 x", b"\0", b"\0\0 !\0 \0! q\xc2\x85<|endoftext|>z", b"<|endoftext|>" * 3,
             b"it's<|startoftext|> \xc2\xbd\x1cx \x1c\x1d", "ΑΣ ΟΔΟΣ İ É e ́x a b　c".encode(), b"x" * 5_000, b"plain words"]
    encoder, want = tokens.WordIds(PATH), library(texts)
    for part in (slice(0, 1), slice(9, 10), slice(0, 10), slice(9, None, -1), slice(0, 2)):
        ids, sizes = encoder.encode(texts[part])
        assert ids.tolist() == sum(want[part], []) and sizes.tolist() == [len(w) for w in want[part]]


def plain(demand, capacity):
    """The rule as it reads: the earliest row of the largest dot product, else the next sequence."""
    share, at = demand / capacity, dict.fromkeys(range(len(demand)))
    out, left, current, inside = np.zeros((len(demand), 2), int), capacity, 0, 0
    while at:
        fit = [i for i in at if (demand[i] <= left).all()]
        if not fit:
            left, current, inside = capacity, current + 1, 0
            continue
        best = max(fit, key=lambda i: (share[i] @ (left / capacity), -i))
        out[best], left, inside = (current, inside), left - demand[best], inside + 1
        del at[best]
    return out[:, 0], out[:, 1]


@pytest.mark.parametrize("seed", range(8))
def test_demands_that_grow_together_are_packed_by_the_same_rule(seed):
    rng = np.random.default_rng(seed)
    length = rng.integers(0, 31, 120)
    demand = np.stack([length, np.ones_like(length), length // (1 + seed % 3)], axis=1)
    capacity = np.array([32, [3, 40][seed % 2], 32])
    for got, want in zip(packing.pack_vectors(demand, capacity), plain(demand, capacity)):
        assert got.tolist() == want.tolist()


def test_time_to_pack_grows_with_the_rows():
    length = np.random.default_rng(2).integers(1, 2_049, 30_000)
    began = time.process_time()
    bins, _ = packing.pack_vectors(np.stack([length, np.ones_like(length), length], axis=1), np.array([2_048, 256, 2_048]))
    assert time.process_time() - began < 4
    filled = np.bincount(bins, weights=length)
    assert filled.max() <= 2_048 and filled.mean() > 2_000
