"""Removal of repeated runs of lines, by content-defined chunks of lines.

A document's lines are cut into chunks: a chunk ends after a line where the
hash of that line's and the previous line's hashes falls on one of ``1 /
CUT_PARTS`` of all values, so an inserted or deleted line moves no boundary
but its neighbours.  Chunks of at least ``MIN_LINES`` lines with a word are
compared across all documents: equal hashes meet first, then the chunks' bytes
decide.  The first one (lowest doc_id, then place) stays, the others go.

``dedup_lines`` removes what the chunks find: a run that its chunks cut elsewhere
stays, and so does a chunk of one line.  ``drop_repeated_runs`` looks at every two
lines that follow each other instead, and removes each run of at least two lines
with a word that occurs before, wherever it begins.

DataFrame functions only.  Chunk hashes are pre-aggregated before the shuffle
and a hot chunk's rows meet only its one first row, so no group is gathered.

Defined results: null text stays null and has no lines; an empty text is one
empty line; rows are known by id and a hash of their text, so rows that share an id
but not a text are told apart, and rows that repeat both count as one document; a null
id comes before all others; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gasledger.llm.common import stored
from gasledger.llm.quality_rules import let

CUT_PARTS = 4     # chunks are this many lines long on average
MIN_LINES = 2     # lines with a word that a chunk needs to be removed


def chunks(text: Column) -> Column:
    """Array of struct<text, lines, worded>: a text's chunks in order."""
    def cut(lines: Column, hashes: Column) -> Column:
        digit = lambda i: F.conv(F.substring(F.md5(F.concat(F.coalesce(F.get(hashes, i - 1), F.lit("")), F.get(hashes, i))), 1, 4), 16, 10).cast("int")  # noqa: E501,E731
        last = F.size(lines) - 1
        return F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | (digit(i) % CUT_PARTS == 0))

    def piece(lines: Column, ends: Column, end: Column, j: Column) -> Column:
        first = F.coalesce(F.get(ends, j - 1) + 1, F.lit(0))
        return let(F.slice(lines, first + 1, end - first + 1), lambda part: F.struct(
            F.array_join(part, "\n").alias("text"), F.size(part).alias("lines"),
            F.size(F.filter(part, lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))).alias("worded")))

    return let(F.split(text, "\n"), lambda lines: let(
        F.transform(lines, F.md5),
        lambda hashes: let(cut(lines, hashes), lambda ends: F.transform(
            ends, lambda end, j: piece(lines, ends, end, j)))))


def repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key, gone): the numbers of each document's chunks that repeat an earlier one."""
    exploded = (docs.where(F.col(text_col).isNotNull())
                .select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"),
                        F.posexplode(chunks(F.col(text_col))).alias("k", "c"))
                .where(F.col("c.worded") >= MIN_LINES)
                .select("id", "key", "k", F.xxhash64("c.text").alias("h"), F.col("c.text").alias("chunk")))
    # aggregates are stored before they are joined: only a join whose two sides are plain
    # exchanges has its hot partitions split
    often = stored(exploded.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "hashes")
    again = stored(exploded.join(often, "h", "left_semi"), "chunks")
    first = stored(again.groupBy("h", "chunk").agg(F.min(F.struct("id", "key", "k")).alias("first")), "first")
    # the join on the chunk itself is the byte comparison
    return (again.join(first, ["h", "chunk"])
            .where(~F.struct("id", "key", "k").eqNullSafe(F.col("first")))
            .groupBy("id", "key").agg(F.collect_set("k").alias("gone")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated chunks cut out of the text, plus a struct ``line_dedup`` of
    n_lines, n_chunks, n_removed_chunks and n_removed_lines."""
    gone = repeated_chunks(docs, id_col, text_col)
    parts = F.transform(chunks(F.col("text")), lambda c, k: F.struct(
        c["text"].alias("text"), c["lines"].alias("lines"),
        F.coalesce(F.array_contains(F.col("gone"), k), F.lit(False)).alias("out")))

    def rebuilt(p: Column) -> Column:
        count = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda a, c: a + c["lines"])
        out = F.filter(p, lambda c: c["out"])
        return F.struct(
            F.array_join(F.transform(F.filter(p, lambda c: ~c["out"]), lambda c: c["text"]), "\n").alias("text"),
            F.struct(count(p).alias("n_lines"), F.size(p).cast("long").alias("n_chunks"),
                     F.size(out).cast("long").alias("n_removed_chunks"),
                     count(out).alias("n_removed_lines")).alias("figures"))

    zero = F.struct(*[F.lit(0).cast("long").alias(c) for c in ("n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines")])
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"),
                       F.col(text_col).alias("text"))
    out = rows.join(gone, _same_row(rows, gone), "left").select(
        "row", F.when(F.col("text").isNotNull(), let(parts, rebuilt)).alias("b"))
    names = [F.col("b.text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]
    return out.select(*names, F.coalesce(F.col("b.figures"), zero).alias("line_dedup"))


def pairs(text: Column) -> Column:
    """Array of struct<i, j, text>: every line with a word, and the next such line."""
    def piece(lines: Column, worded: Column) -> Column:
        return F.transform(F.slice(worded, 1, F.greatest(F.size(worded) - 1, F.lit(0))), lambda i, k: let(
            F.get(worded, k + 1), lambda j: F.struct(
                i.alias("i"), j.alias("j"), F.concat(F.get(lines, i), F.lit("\n"), F.get(lines, j)).alias("text"))))

    return let(F.split(text, "\n"), lambda lines: let(
        F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.get(lines, i).rlike("[^\\x20\\x09-\\x0D]")),
        lambda worded: piece(lines, worded)))


def repeated_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, key, gone): each document's pairs of lines (struct<i, j>) that repeat an earlier one.

    Only hashes of pairs are shuffled; the lines themselves are fetched for pairs whose hash
    repeats, and compared.
    """
    text = F.col(text_col)
    rows = docs.where(text.isNotNull()).select(F.col(id_col).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    hashed = rows.select("id", "key", F.explode(pairs(F.col("text"))).alias("p")).select(
        "id", "key", "p.i", "p.j", F.xxhash64("p.text").alias("h"))
    # aggregates are stored before they are joined, as above
    often = stored(hashed.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "hashes")
    again = hashed.join(often.hint("merge"), "h", "left_semi")
    places = stored(again.groupBy("id", "key").agg(F.collect_set(F.struct("i", "j", "h")).alias("places")), "places")
    found = rows.join(places.hint("merge"), _same_row(rows, places)).select(
        rows["id"], rows["key"], F.explode(let(F.split("text", "\n"), lambda lines: F.transform("places", lambda p: F.struct(
            p["i"].alias("i"), p["j"].alias("j"), p["h"].alias("h"),
            F.concat(F.get(lines, p["i"]), F.lit("\n"), F.get(lines, p["j"])).alias("pair"))))).alias("p"))
    found = stored(found.select("id", "key", "p.*").distinct(), "pairs")
    first = stored(found.groupBy("h", "pair").agg(F.min(F.struct("id", "key", "i")).alias("first")), "first")
    return (found.join(first.hint("merge"), ["h", "pair"])
            .where(~F.struct("id", "key", "i").eqNullSafe(F.col("first")))
            .groupBy("id", "key").agg(F.collect_set(F.struct("i", "j")).alias("gone")))


def _same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["id"].eqNullSafe(b["id"]) & (a["key"] == b["key"])


def drop_repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the lines of runs that occur before (lowest doc_id, then place)."""
    gone = stored(repeated_pairs(docs, id_col, text_col), "gone")
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"),
                       F.col(text_col).alias("text"))
    rows = rows.join(gone.hint("merge"), _same_row(rows, gone), "left").select("row", "text", "gone")
    kept = let(F.split("text", "\n"), lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1),
                       F.flatten(F.transform("gone", lambda p: F.sequence(p["i"], p["j"])))),
        lambda i: F.get(lines, i)), "\n"))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept)
    return rows.select(*[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
