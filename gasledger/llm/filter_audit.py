"""How filters interact: what each one removes in every order of application.

``measured`` takes one pass of the byte transducer over each text.  ``flags`` turns the
measures into a bit set of the filters that a row fails.  ``interaction`` needs the bit
sets alone: rows with the same part, labels and bits are counted together before
anything is shuffled, and what is left by any set of filters is a sum over 2^filters
counts.  The orders of application are then laid out from those sums, a part at a time.

Row identity: exact copies are found by the SHA-256 of the text; the copy of the lowest
``doc_id`` is the original, and each row of a larger id fails.  The original is joined
back by (id, digest), so a text that many rows share meets no hot key.

Defined results: a null text is empty, with no words (it fails A, and E if a smaller id
also has an empty text); a null id is neither smaller nor larger than any other, so it
never fails E and makes no other row fail; rows that repeat an id and a text do not fail
each other; a null part is ''; of several labels of one id the largest counts; labels
that are null or of unknown documents change nothing; an empty table has no parts and
gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from itertools import combinations, permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gasledger.llm.byte_transducer import transduce
from gasledger.llm.common import stored, text_slices

MEASURES = ["n_words", "n_distinct", "n_capitals", "n_points", "n_symbols"]



def filters() -> dict[str, Column]:
    """Filter letter -> whether a row fails it, over the measures and ``is_copy``."""
    return {
        "A": F.col("n_words") < 50,
        "B": F.lit(100) * F.col("n_distinct") < F.lit(65) * F.col("n_words"),
        "C": F.lit(100) * F.col("n_capitals") > F.lit(5) * F.col("n_points"),
        "D": F.col("n_symbols") > 0,
        "E": F.col("is_copy"),
    }


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Per row: doc_id, part, the measures and ``digest`` (SHA-256 of the text)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
    fields = [("doc_id", pa.int64()), ("part", pa.string()), *[(m, pa.int64()) for m in MEASURES], ("digest", pa.binary())]

    def run(batches):
        for batch in batches:
            done = 0
            for ids, texts in text_slices([batch.select([0, 1])]):
                found = transduce(texts)
                columns = [pa.array(ids, pa.int64()), batch.column(2).slice(done, len(ids)),
                           *[pa.array(found[m]) for m in MEASURES],
                           pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())]
                done += len(ids)
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    return rows.mapInArrow(run, "doc_id long, part string, " + ", ".join(f"{m} long" for m in MEASURES) + ", digest binary")


def flags(rows: DataFrame) -> DataFrame:
    """``rows`` of ``measured`` with ``is_copy`` and ``fails``, the bits of the failed filters (A is 1)."""
    first = (rows.where(F.col("doc_id").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
             .withColumn("original", F.lit(True)))
    marked = rows.join(first, ["doc_id", "digest"], "left").withColumn(
        "is_copy", F.col("doc_id").isNotNull() & F.col("original").isNull())
    bits = [F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(filters().values())]
    total = bits[0]
    for bit in bits[1:]:
        total = total + bit
    return marked.drop("original").withColumn("fails", total)


def labelled(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``rows`` with ``good`` (quality 1) and ``toxic`` (toxic 1), 0 without a label."""
    known = labels.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"))
    return rows.join(known, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})


def interaction(rows: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """One row per part, order of filters and step, from ``rows`` of (part, fails, good, toxic).

    Columns: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost and shapley (removed by the step's filter, summed over all orders).
    """
    sets = 1 << len(letters)
    combos = rows.groupBy("part", "fails").agg(
        F.count("*").alias("n"), F.sum("good").cast("long").alias("good"), F.sum("toxic").cast("long").alias("toxic"))
    # the sums of a part by bit set, as arrays
    sums = combos.groupBy("part").agg(*[
        F.array(*[F.coalesce(F.sum(F.when(F.col("fails") == s, F.col(c))), F.lit(0)) for s in range(sets)]).alias(c)
        for c in ("n", "good", "toxic")])

    def total(values: str, which) -> Column:
        """Sum of an array over the bit sets for which ``which`` holds."""
        return F.aggregate(F.transform(F.col(values), lambda v, s: F.when(which(s), v).otherwise(0)), F.lit(0).cast("long"),
                           lambda a, b: a + b)

    step = F.explode(F.from_json(F.lit(json.dumps(_steps(letters))),
                                 "array<struct<bit int, before int, step int, orders array<string>, weights array<bigint>>>"))
    before, bit = F.col("x.before"), F.col("x.bit")
    taken = lambda s: (s.bitwiseAND(before) == 0) & (s.bitwiseAND(bit) != 0)
    shares = F.zip_with(F.col("n"), F.col("x.weights"), lambda n, w: n * w)
    found = sums.select("*", step.alias("x")).select(
        "part", F.explode("x.orders").alias("filter_order"), F.col("x.step").alias("step"),
        total("n", lambda s: s.bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        total("n", taken).alias("removed"),
        total("n", lambda s: (s.bitwiseAND(before) != 0) & (s.bitwiseAND(bit) != 0)).alias("redundant"),
        total("n", lambda s: s == bit).alias("unique_fails"),
        total("good", taken).alias("good_lost"),
        total("toxic", taken).alias("toxic_lost"),
        F.aggregate(shares, F.lit(0).cast("long"), lambda a, b: a + b).alias("shapley"))
    return found


def _steps(letters: str) -> list[dict]:
    """Every (filters applied before, filter) with the orders in which it occurs.

    ``weights``: in how many orders the filter is the first of each bit set to be applied.
    """
    orders = ["".join(p) for p in permutations(letters)]
    out = []
    for i, letter in enumerate(letters):
        weights = [len(orders) // s.bit_count() if s >> i & 1 else 0 for s in range(1 << len(letters))]
        others = [j for j in range(len(letters)) if j != i]
        for size in range(len(letters)):
            for chosen in combinations(others, size):
                names = {letters[j] for j in chosen}
                out.append({"bit": 1 << i, "before": sum(1 << j for j in chosen), "step": size + 1, "weights": weights,
                            "orders": [o for o in orders if o[size] == letter and set(o[:size]) == names]})
    return out


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """The interaction of the five filters on ``docs``, by part."""
    rows = stored(measured(docs, id_col, text_col, part_col), "measured")
    return interaction(labelled(flags(rows), labels, id_col))
