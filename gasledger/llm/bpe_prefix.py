"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

For every prefix of a piece the encoding ends in exactly one token.  That token is
found without merging anything: an automaton over the vocabulary lists the tokens that
are suffixes of the prefix, and the one whose predecessor (the last token of what is
left of the prefix) stays apart from it is stored.  The ids are read off by following
the stored tokens back from the end.  Work is proportional to the piece's length, also
for pieces without any white space.

Two neighbouring tokens stay apart when no merge across their border comes first
(``Vocabulary.apart``): going back in time, the border's two edge tokens are unmade in
the reverse order of their merges, and a pair of edges that coexist must not have a
merge earlier than the merge that consumes either.

``encode`` gives each row's ids as little-endian 32-bit integers, ``decode`` turns them
back into the tokens' text joined by spaces, which is what this vocabulary's decoder is.

Defined results: a null text is empty and has no ids; no ids decode to ''; rows are
treated one by one, so repeated rows and null ids change nothing; an empty table gives
an empty result.
"""

from __future__ import annotations

import json
from array import array
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gasledger.llm.common import map_arrow, two_columns, worker_cache
from gasledger.llm.tokens import Numbers, pre_tokens

END = "</w>"
_NEVER = 1 << 60
# what a worker remembers at most; it begins anew beyond that
KNOWN_PAIRS = KNOWN_PIECES = KNOWN_WORDS = 300_000
DECODED = 1 << 18            # ids spelt out at a time


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(0x100 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    """Tokens, their merges and the automaton that finds them; once per Python worker."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        vocab: dict[str, int] = data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        size = max(chain(vocab.values(), self.special.values())) + 1
        self.left, self.right, self.made, self.rank = [-1] * size, [-1] * size, [-1] * size, {}
        for rank, pair in enumerate(data["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            x, y, token = vocab[a], vocab[b], vocab[a + b]
            self.left[token], self.right[token], self.made[token], self.rank[x << 32 | y] = x, y, rank, rank
        self.letters = byte_letters()
        self.automaton = ahocorasick.Automaton()
        for text, token in vocab.items():
            symbols, last = (text[:-len(END)], True) if text.endswith(END) and text != END else (text, False)
            # the mark of a word's end is one more letter
            self.automaton.add_word(symbols + "\n" * last, (token, len(symbols), last))
        self.automaton.make_automaton()
        self.known: dict[int, bool] = {}
        texts = {i: t for t, i in chain(vocab.items(), self.special.items())}
        encoded = [(texts.get(i, "") + " ").encode() for i in range(size)]
        self.bytes = np.frombuffer(b"".join(encoded), np.uint8)
        self.sizes = np.array([len(t) for t in encoded], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def apart(self, x: int, y: int) -> bool:
        """Whether tokens ``x`` and ``y`` next to each other are not merged across their border."""
        made, rank = self.made, self.rank
        x_until = y_until = _NEVER
        while True:
            merge = rank.get(x << 32 | y)
            # of equal merges the left one comes first: the one in x before, the one in y after
            if merge is not None and merge < x_until and merge <= y_until:
                return False
            if made[x] > made[y]:
                x_until, x = made[x], self.right[x]
            elif made[y] >= 0:
                y_until, y = made[y], self.left[y]
            else:
                return True

    def encode_piece(self, piece: str) -> list[int]:
        """Ids of one pre-token."""
        if piece in self.special:
            return [self.special[piece]]
        letters = self.letters
        text = "".join([letters[b] for b in piece.encode()])
        n = len(text)
        last = [-1] * (n + 1)
        start = [0] * (n + 1)
        known = self.known
        for at, (token, size, closes) in self.automaton.iter(text + "\n"):
            end = n if closes else at + 1
            if last[end] >= 0 or (end == n and not closes):
                continue
            begin = end - size
            if begin:
                key = last[begin] << 32 | token
                fits = known.get(key)
                if fits is None:
                    fits = known[key] = self.apart(last[begin], token)
                if not fits:
                    continue
            last[end], start[end] = token, begin
        if len(known) > KNOWN_PAIRS:
            known.clear()
        ids = []
        end = n
        while end:
            if last[end] < 0:
                raise ValueError(f"no token ends the first {end} bytes of {piece!r}")
            ids.append(last[end])
            end = start[end]
        return ids[::-1]

    def _spelt(self, ids: np.ndarray) -> bytes:
        """The tokens' text, with a space after each."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.bytes[np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(int(ends[-1]))].tobytes()

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The tokens' text joined by spaces, for each run of ``counts`` ids."""
        flat = b"".join([self._spelt(ids[k: k + DECODED]) for k in range(0, len(ids), DECODED)])
        bounds = np.concatenate([[0], np.cumsum(self.sizes[ids])])[np.concatenate([[0], np.cumsum(counts)])]
        return [flat[a: max(a, b - 1)] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def vocabulary(path: str) -> Vocabulary:
    cache = worker_cache()
    if ("prefix", path) not in cache:
        cache["prefix", path] = Vocabulary(path)
    return cache["prefix", path]


class _Words:
    """Ids of the words a worker has met; a word is what stands between ASCII white space."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.pieces = vocab, {}
        self.clear()

    def clear(self) -> None:
        self.numbers, self.known = Numbers(), 0
        self.ids, self.counts, self.starts = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _piece(self, piece: str) -> bytes:
        out = self.pieces.get(piece)
        if out is None:
            if len(self.pieces) >= KNOWN_PIECES:
                self.pieces.clear()
            out = self.pieces[piece] = array("I", self.vocab.encode_piece(piece)).tobytes()
        return out

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and the number of ids of each text."""
        if self.known > KNOWN_WORDS:
            self.clear()
        words = [t.split() for t in texts]
        per_text = np.array([len(w) for w in words], np.int64)
        codes = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(words)), np.int64, int(per_text.sum()))
        if len(self.numbers) > self.known:
            new = [b"".join(map(self._piece, pre_tokens(w.decode()))) for w in islice(self.numbers, self.known, None)]
            counts = np.array([len(x) // 4 for x in new], np.int64)
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(new), np.uint32)])
            self.counts = np.concatenate([self.counts, counts])
            self.starts = np.cumsum(self.counts) - self.counts
            self.known = len(self.numbers)
        counts = self.counts[codes]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.starts[codes] - (ends - counts), counts) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_text)])]
        return ids, np.diff(bounds)


def _words(path: str) -> _Words:
    cache = worker_cache()
    if ("prefix words", path) not in cache:
        cache["prefix words", path] = _Words(vocabulary(path))
    return cache["prefix words", path]


def _packed(ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    data, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens and ids (binary, little-endian unsigned 32-bit)."""

    def run(doc_ids, texts):
        ids, counts = _words(path).encode(texts)
        return {"doc_id": doc_ids, "n_tokens": counts, "ids": _packed(ids, counts)}

    return map_arrow(two_columns(docs, id_col, text_col), "doc_id long, n_tokens long, ids binary", run)


def decode(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row of ``rows``: doc_id, n_tokens, ids and text (null ids are none)."""

    def run(doc_ids, packed):
        counts = np.array([len(p) // 4 for p in packed], np.int64)
        texts = vocabulary(path).decode(np.frombuffer(b"".join(packed), "<u4").astype(np.int64), counts)
        return {"doc_id": doc_ids, "n_tokens": counts, "ids": packed, "text": pa.array(texts, pa.binary()).cast(pa.string())}

    given = rows.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(ids_col), F.lit(b"")).alias("ids"))
    return map_arrow(given, "doc_id long, n_tokens long, ids binary, text string", run)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What ``decode`` gives for ``encode``'s ids, by one Python worker with one vocabulary."""

    def run(doc_ids, texts):
        ids, counts = _words(path).encode(texts)
        back = vocabulary(path).decode(ids.astype(np.int64), counts)
        return {"doc_id": doc_ids, "n_tokens": counts, "ids": _packed(ids, counts),
                "text": pa.array(back, pa.binary()).cast(pa.string())}

    return map_arrow(two_columns(docs, id_col, text_col), "doc_id long, n_tokens long, ids binary, text string", run)
