"""One finite-state pass over UTF-8 bytes: words, capitals, code points and symbols of texts.

The transducer has two states, between words and inside one.  ``NEXT`` gives the state
after a byte and ``EMIT`` what a byte adds, by the state before it.  The next state
depends on the byte alone, so that a batch of texts takes two table lookups a byte.
The spans of the words it finds go into a hash table that compares bytes before it
calls two spans equal (``first_of_kind``).
"""

from __future__ import annotations

import numpy as np

from gasledger.llm.common import mixed

WORD, CAPITAL, POINT, SYMBOL = 1, 2, 4, 8      # what a byte can add, as bits
WHITE = bytes([9, 10, 11, 12, 13, 32])
SYMBOLS = b"#$%&*|"
LANES = 8                                      # words of up to 64 bytes are compared eight bytes at a time

_MUL = np.uint64(0x9E3779B97F4A7C15)
_LANE_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def tables(symbols: bytes = SYMBOLS) -> tuple[np.ndarray, np.ndarray]:
    """(NEXT, EMIT), each by state * 256 + byte; state 0 is between words, 1 inside a word."""
    after, emit = np.zeros(512, np.uint8), np.zeros(512, np.uint8)
    for state in (0, 1):
        for byte in range(256):
            inside = byte not in WHITE
            after[state * 256 + byte] = inside
            emit[state * 256 + byte] = (
                WORD * (inside and state == 0) + CAPITAL * (65 <= byte <= 90)
                + POINT * (byte & 0xC0 != 0x80) + SYMBOL * (byte in symbols))
    return after, emit


def transduce(texts: list[bytes], symbols: bytes = SYMBOLS) -> dict[str, np.ndarray]:
    """n_words, n_distinct, n_capitals, n_points and n_symbols of each text (one or more texts)."""
    after, emit = tables(symbols)
    flat = np.frombuffer(b" ".join(texts) + b" ", np.uint8)     # the space after a text closes its last word
    starts = np.zeros(len(texts), np.int64)
    np.cumsum([len(t) + 1 for t in texts[:-1]], out=starts[1:])
    state = after[flat]
    out = emit[np.concatenate([[0], state[:-1]]).astype(np.int64) * 256 + flat]

    def count(bit: int) -> np.ndarray:
        return np.add.reduceat((out & bit != 0).astype(np.int64), starts)

    begin = np.flatnonzero(out & WORD)
    length = np.flatnonzero(state & np.concatenate([state[1:] == 0, [True]])) + 1 - begin
    owner = np.searchsorted(starts, begin, side="right") - 1
    first = first_of_kind(flat, begin, length, owner)
    return {"n_words": count(WORD), "n_distinct": np.bincount(owner[first], minlength=len(texts)).astype(np.int64),
            "n_capitals": count(CAPITAL), "n_points": count(POINT) - 1, "n_symbols": count(SYMBOL)}


def first_of_kind(flat: np.ndarray, begin: np.ndarray, length: np.ndarray, owner: np.ndarray,
                  hashed=None) -> np.ndarray:
    """Whether each span is the first of its bytes within its owner.

    Open addressing for all spans at once: in every round the waiting spans look at their
    slot; an empty slot goes to the earliest of them, a span equal to the slot's holder
    (owner, length and bytes) is settled, and the others go to the next slot.
    ``hashed`` replaces the hash values, for tests of colliding spans.
    """
    spans = _Spans(flat, begin, length)
    bits = max(4, int(2 * len(begin)).bit_length())
    mask = np.uint64((1 << bits) - 1)
    slots = mixed((spans.hash if hashed is None else hashed) + owner.astype(np.uint64) * _MUL) & mask
    holder = np.full(1 << bits, -1, np.int64)
    first = np.zeros(len(begin), bool)
    waiting = np.arange(len(begin))
    while len(waiting):
        at = slots[waiting]
        free = holder[at] < 0
        holder[at[free][::-1]] = waiting[free][::-1]
        held = holder[at]
        mine = held == waiting
        first[waiting[mine]] = True
        same = mine | (owner[held] == owner[waiting])
        check = np.flatnonzero(same & ~mine)
        same[check] = spans.equal(waiting[check], held[check])
        waiting = waiting[~same]
        slots[waiting] = (slots[waiting] + np.uint64(1)) & mask
    return first


class _Spans:
    """Byte spans, hashed and compared eight bytes at a time; what is beyond 64 bytes is numbered exactly."""

    def __init__(self, flat: np.ndarray, begin: np.ndarray, length: np.ndarray):
        padded = np.concatenate([flat, np.zeros(8, np.uint8)])
        self.at = np.ndarray((len(flat),), "<u8", padded, strides=(1,))
        self.begin, self.length = begin, length
        self.rest = np.zeros(len(begin), np.uint64)
        numbers: dict[bytes, int] = {}
        for i in np.flatnonzero(length > 8 * LANES):
            tail = flat[begin[i] + 8 * LANES: begin[i] + length[i]].tobytes()
            self.rest[i] = numbers.setdefault(tail, len(numbers) + 1)
        self.hash = mixed(self.lane(np.arange(len(begin)), 0) + length.astype(np.uint64) * _MUL)
        for j in range(1, LANES):
            more = np.flatnonzero(length > 8 * j)
            if not len(more):
                break
            self.hash[more] = mixed(self.hash[more] * _MUL + self.lane(more, j))
        self.hash = mixed(self.hash + self.rest)

    def lane(self, which: np.ndarray, j: int) -> np.ndarray:
        return self.at[self.begin[which] + 8 * j] & _LANE_MASK[np.minimum(self.length[which] - 8 * j, 8)]

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = (self.length[a] == self.length[b]) & (self.rest[a] == self.rest[b])
        for j in range(LANES):
            more = np.flatnonzero(out & (self.length[a] > 8 * j))
            if not len(more):
                break
            out[more] = self.lane(a[more], j) == self.lane(b[more], j)
        return out
