"""What a Python task needs at once for the words of texts stays far below an executor's share."""

import tracemalloc

import numpy as np
import pyarrow as pa

from gasledger.llm import near_dedup
from gasledger.llm.common import text_slices


def test_shingles_of_a_large_batch_take_bounded_memory():
    rng = np.random.default_rng(4)
    words = [f"word{i}" for i in range(500)]
    texts = [" ".join(words[i] for i in rng.integers(0, 500, 400)) for _ in range(4_000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(4_000)), "text": texts})
    assert batch.nbytes > 10_000_000
    tracemalloc.start()
    seen = []
    for ids, found in text_slices([batch]):
        seen += zip(ids, (len(s) for s in near_dedup.shingle_sets(found, 5)))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == [(i, len({tuple(t.split()[j: j + 5]) for j in range(396)})) for i, t in enumerate(texts)]
    assert most < 60_000_000
