"""Token counts and ids by a public tokenizer file, one encoding per distinct pre-token.

``token_counts`` (operator 9) never materialises ids: documents are reduced to
the frequencies of their pre-tokens, every distinct pre-token of the corpus is
encoded once, and a document's count is the sum of frequency times pieces.

The frequencies stay in blocks: a block is a run of documents of one input
split (``BLOCK_BYTES`` of text) whose pre-tokens are numbered by a dictionary
of its own, so the shuffle carries each word once per block, not once per
document, and a word that every document holds meets one row per block.

Defined results: null or empty text has 0 bytes and 0 tokens; repeated rows are
counted row by row; a null id stays null; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import unicodedata
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gasledger.llm.common import CACHE_WORDS, stored, text_slices, two_columns, worker_cache

BLOCK_BYTES = 64 << 20
READ_WORDS = 256       # new words that the library reads as one text

# --- fixed values of the public tokenizer file word_bpe_49k.json ------------------
SPECIAL = "<|startoftext|>|<|endoftext|>"
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# --- end of fixed values -----------------------------------------------------------

_special = regex.compile("(" + SPECIAL.replace("|>", r"\|>").replace("<|", r"<\|") + ")")
_find = regex.compile(PRE_TOKEN).findall


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pre_tokens(text: str) -> list[str]:
    """The pieces a text is cut into before merging; special strings are pieces of their own."""
    if "<|" in text:
        out: list[str] = []
        for i, part in enumerate(_special.split(text)):
            out += [part] if i % 2 else _find(_normal(part))
        return out
    return _find(_normal(text))


def _normal(text: str) -> str:
    # character by character: a final sigma does not become another letter
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def load(path: str):
    """The tokenizer, once per Python worker."""
    cache = worker_cache()
    if ("tokenizer", path) not in cache:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        cache["tokenizer", path] = Tokenizer.from_file(path)
    return cache["tokenizer", path]


class Numbers(dict):
    """Numbers new keys in the order of their first use."""

    def __missing__(self, key):
        value = self[key] = len(self)
        return value


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (n_tokens > ``limit``)."""
    blocks = stored(
        two_columns(docs, id_col, text_col).mapInArrow(
            _blocks, "block long, words array<string>, doc_id array<long>, n_bytes array<long>, "
                     "ends array<long>, used binary, times binary"), "tokens")
    words = blocks.select("block", F.posexplode("words").alias("at", "word"))

    def count(batches):
        tokenizer = load(path)
        for batch in batches:
            found = tokenizer.encode_batch(batch.column(0).to_pylist(), add_special_tokens=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(e.ids) for e in found], pa.int64())], names=["word", "n"])

    pieces = words.select("word").distinct().mapInArrow(count, "word string, n long")
    # place and pieces of a word in one number: place * 2^32 + pieces
    size = F.shiftleft(F.col("at").cast("long"), 32) + F.col("n")
    sizes = (words.join(pieces, "word").select("block", size.alias("size"))
             .groupBy("block").agg(F.sort_array(F.collect_list("size")).alias("sizes")))

    def add(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n = np.array(row["sizes"] or [0], np.int64) & 0xFFFFFFFF
                used, times = _ints(row["used"]).cumsum(), _ints(row["times"])
                total = np.zeros(len(used) + 1, np.int64)
                np.cumsum(n[used] * times, out=total[1:])
                ends = np.array([0, *row["ends"]], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_id"], pa.int64()), pa.array(row["n_bytes"], pa.int64()),
                     pa.array(np.diff(total[ends]))], names=["doc_id", "n_bytes", "n_tokens"])

    return (blocks.drop("words").join(sizes, "block", "left")
            .select("doc_id", "n_bytes", "ends", "used", "times", "sizes")
            .mapInArrow(add, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > F.lit(limit)))


def _packed(parts: list[np.ndarray]) -> bytes:
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return zstandard.compress(flat.astype(np.int32).tobytes(), 3)


def _ints(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), np.int32).astype(np.int64)


def _blocks(batches):
    """Documents of a split as block rows; ``used`` holds differences of word numbers."""
    from pyspark import TaskContext

    def row():
        used = np.concatenate(uses) if uses else np.zeros(0, np.int64)
        return pa.RecordBatch.from_pylist(
            [{"block": block, "words": list(numbers), "doc_id": ids, "n_bytes": sizes, "ends": ends,
              "used": _packed([np.diff(used, prepend=0)]), "times": _packed(times)}],
            schema=pa.schema([("block", pa.int64()), ("words", pa.list_(pa.string())),
                              ("doc_id", pa.list_(pa.int64())), ("n_bytes", pa.list_(pa.int64())),
                              ("ends", pa.list_(pa.int64())), ("used", pa.binary()), ("times", pa.binary())]))

    block = TaskContext.get().partitionId() << 32
    numbers, ids, sizes, ends, uses, times, size = Numbers(), [], [], [], [], [], 0
    for doc_ids, texts in text_slices(batches):
        for doc_id, text in zip(doc_ids, texts):
            found = pre_tokens(text.decode())
            codes = np.fromiter(map(numbers.__getitem__, found), np.int64, len(found))
            use, time = np.unique(codes, return_counts=True)
            uses.append(use)
            times.append(time)
            ids.append(doc_id)
            sizes.append(len(text))
            ends.append(len(use) + (ends[-1] if ends else 0))
            size += len(text) + 64
            if size >= BLOCK_BYTES:
                yield row()
                block += 1
                numbers, ids, sizes, ends, uses, times, size = Numbers(), [], [], [], [], [], 0
    if ids:
        yield row()


class WordIds:
    """Ids of texts, out of the remembered ids of their words.

    Words are what is between ASCII white space.  No piece of the tokenizer
    reaches across white space, so a text's ids are those of its words in turn.
    For the same reason the library reads ``READ_WORDS`` new words as one text,
    with a null character alone between two; its id tells where a word ends.
    """

    def __init__(self, path: str):
        self.tokenizer = load(path)
        mark = self._read("\0")
        self.mark = int(mark[0]) if len(mark) == 1 else -1
        self.clear()

    def clear(self) -> None:
        self.numbers, self.known = Numbers(), 0
        self.flat, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _read(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)

    def _learn(self, words: list[str]) -> None:
        flat, lengths = [], []
        for k in range(0, len(words), READ_WORDS):
            group = words[k: k + READ_WORDS]
            ids = self._read(" \0 ".join(group))
            marks = np.flatnonzero(ids == self.mark)
            if len(marks) + 1 == len(group):
                flat.append(ids[ids != self.mark])
                lengths.append(np.diff(marks, prepend=-1, append=len(ids)) - 1)
            else:                                       # words that hold the mark's id themselves
                alone = [self._read(w) for w in group]
                flat += alone
                lengths.append(np.array([len(x) for x in alone], np.int64))
        self.flat = np.concatenate([self.flat, *flat], dtype=np.uint32, casting="unsafe")
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate(lengths))])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and the number of ids of each text."""
        if self.known > CACHE_WORDS:
            self.clear()
        words = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
        found = words.flatten().dictionary_encode()
        distinct = found.dictionary.to_numpy(zero_copy_only=False)
        codes = np.fromiter(map(self.numbers.__getitem__, distinct), np.int64, len(distinct))
        if len(self.numbers) > self.known:
            self._learn(list(islice(self.numbers, self.known, None)))
            self.known = len(self.numbers)
        codes = codes[found.indices.to_numpy()]
        # a word's ids as bytes: Arrow copies them in the order of the words
        store = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), self.known, [None, pa.py_buffer(4 * self.ends), pa.py_buffer(self.flat)])
        taken = store.take(pa.array(codes))
        _, bounds, data = taken.buffers()
        ends = np.frombuffer(bounds, np.int64, len(codes) + 1) // 4 if len(codes) else np.zeros(1, np.int64)
        ids = np.frombuffer(data, np.uint32, int(ends[-1])) if ends[-1] else np.zeros(0, np.uint32)
        return ids, np.diff(ends[words.offsets.to_numpy()])


def encoder(path: str) -> WordIds:
    cache = worker_cache()
    if ("ids", path) not in cache:
        cache["ids", path] = WordIds(path)
    return cache["ids", path]
