"""Near-duplicate documents by a chosen-path set similarity join.

A document is its set of distinct word shingles.  Sets that are equal are one
record.  Every record is summarised by minwise tokens, ``POOL`` coordinates for
each tree; a node chooses ``BRANCH`` of its tree's coordinates by its own hash and
passes a record on to the child of the token it holds there, so two records of
similarity s stay together at a chosen coordinate with probability s.  Nodes of
one tree share its coordinates, which ``lost`` counts: a tree keeps a pair of
similarity 0.85 together down to the last level with probability 0.96.  Trees
share no coordinate, so their losses multiply; they are repeated until the wanted
recall (``trees_for``).

Per level, over all trees at once:
- nodes of one record, or whose records are known to be connected, are done;
- nodes of at most ``SMALL`` records are compared exhaustively;
- of larger nodes, records with too many shingles that no other such record holds
  cannot reach the similarity with any of them and are done;
- the rest of a larger node is compared with its most typical record (the one
  with most of its shingles shared) and one more, which connects what is close to
  either; the records that then lie outside the node's largest component are
  compared with all others and the node is done, if that is at most ``PAIRS``
  pairs (what two records lack of the typical one bounds what they share, so few
  remain; records more than half alike would meet as often on the next levels);
- what is left passes its records on to the next level.
A bit sketch of the minwise tokens screens pairs (it keeps a pair at the
threshold but for a chance below 1e-6); links are confirmed on the full sets.
After ``MAX_LEVELS`` any number of pairs is compared so.

Nodes are counted by pre-aggregation and joined back, so a node of any size is
spread over tasks; groups of copies shrink to one component after their first
comparison and are not expanded into pairs.

Defined results: null or empty texts have an empty set and are linked with
nothing; texts of fewer words than a shingle are one shingle; a null id is
linked with nothing and kept; repeated rows are equal sets; ties go to the
smallest id; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gasledger.llm.common import hash_words, map_arrow, mixed, rolled, stored, two_columns
from gasledger.llm.components import components

SHINGLE_WORDS = 5
PERCENT = 80          # similarity, in hundredths, from which documents are linked
RECALL = 0.99999
POOL = 16             # minwise tokens that one tree's nodes choose from
BITS = 128            # minwise tokens in the sketch
BRANCH = 2
SMALL = 48            # records that a node may have to be compared exhaustively
PAIRS = 1 << 32       # pairs of a node's records outside its largest component with all that are compared
OUTSIDE, INSIDE = 512, 1024    # records outside and of all of a node in a block of such pairs
WORDS = 64            # of 64 places; records of more make smaller blocks
TILE = 1 << 18        # pairs, or words of pairs, that are looked at at once
MAX_LEVELS = 10

_TREE = np.uint64(1023)     # the bits of a node that hold its tree


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashes, starts = hash_words(texts, lower=True)
    runs, out = rolled(hashes, k), []
    for a, b in zip(starts[:-1], starts[1:]):
        if b - a >= k:
            out.append(np.unique(runs[a: b - k + 1]))
        else:   # the whole sequence, if any, as one
            out.append(rolled(hashes[a:b], int(b - a)) + np.uint64(b - a) if b > a else hashes[:0])
    return out


def factors(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and addends of ``n`` minwise tokens; fewer are the first of more."""
    drawn = np.random.default_rng(20240229).integers(0, 2**63, (n, 2), dtype=np.uint64)
    return drawn[:, 0] * np.uint64(2) + np.uint64(1), drawn[:, 1].copy()


def minwise(shingles: np.ndarray, multiply: np.ndarray, add: np.ndarray) -> np.ndarray:
    """The minwise tokens of a set that is not empty."""
    low = np.full(len(add), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 512):
        held = shingles[i: i + 512, None] * multiply
        held += add
        low = np.minimum(low, held.min(axis=0))
    return (mixed(low) >> np.uint64(32)).astype(np.uint32)


def lost(similarity: float, levels: int) -> float:
    """Chance that one tree separates a pair within ``levels`` levels.

    Given that the pair agrees on m of the tree's ``POOL`` coordinates, nodes draw
    theirs independently; m is binomial.
    """
    total = 0.0
    for m in range(POOL + 1):
        apart = 0.0
        for _ in range(levels):
            apart = sum(math.comb(m, j) * math.comb(POOL - m, BRANCH - j) * apart**j
                        for j in range(BRANCH + 1)) / math.comb(POOL, BRANCH)
        total += math.comb(POOL, m) * similarity**m * (1 - similarity) ** (POOL - m) * apart
    return total


def trees_for(recall: float, similarity: float) -> int:
    """Trees until a pair at the threshold meets at the last level with probability ``recall``."""
    trees = max(1, math.ceil(math.log(1 - recall) / math.log(max(lost(similarity, MAX_LEVELS + 2), 1e-9))))
    if trees > int(_TREE):
        raise ValueError(f"recall {recall} at similarity {similarity} takes {trees} trees; at most {int(_TREE)}")
    return trees


def children(nodes: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """``BRANCH`` child nodes for each record: rows of ``tokens`` under ``nodes``, at different coordinates."""
    tree, drawn = nodes & _TREE, mixed(nodes)
    at = [drawn % np.uint64(POOL)]
    at.append((at[0] + np.uint64(1) + (drawn >> np.uint64(32)) % np.uint64(POOL - 1)) % np.uint64(POOL))
    out, rows = [], np.arange(len(nodes))
    for place in at:
        token = (place << np.uint64(32)) | tokens[rows, (tree * np.uint64(POOL) + place).astype(np.int64)].astype(np.uint64)
        out.append((mixed(mixed(nodes + np.uint64(0x51ED270B)) ^ token) & ~_TREE) | tree)
    return np.stack(out, axis=1)


def second_level(tokens: np.ndarray, trees: int) -> np.ndarray:
    """The nodes of each record at every tree's second level."""
    def root(r):
        return np.full(len(tokens), (mixed(np.array([r + 1], np.uint64))[0] & ~_TREE) | np.uint64(r))

    return np.concatenate([children(child, tokens) for r in range(trees) for child in children(root(r), tokens).T], axis=1)


def _summaries(docs: DataFrame, k: int, coords: int) -> DataFrame:
    multiply, add = factors(max(BITS, coords))

    def run(ids, texts):
        sets = shingle_sets(texts, k)
        digests = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
        tokens = [minwise(s, multiply, add) if len(s) else None for s in sets]
        bits = [np.packbits((t[:BITS] & 1).astype(np.uint8)).view("<i8") if t is not None else (0, 0) for t in tokens]
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        return {"doc_id": ids, "n_shingles": [len(s) for s in sets],
                "d1": [signed(d >> 64) for d in digests], "d2": [signed(d & (2**64 - 1)) for d in digests],
                "s1": [int(b[0]) for b in bits], "s2": [int(b[1]) for b in bits],
                "tokens": [t[:coords].tobytes() if t is not None else None for t in tokens]}

    return map_arrow(docs, "doc_id long, n_shingles long, d1 long, d2 long, s1 long, s2 long, tokens binary", run)


def _expand(records: DataFrame, trees: int) -> DataFrame:
    """Node rows (id, node, s1, s2, size): of every tree's second level, or the children of ``node``."""
    rooted = "node" in records.columns

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            tokens = np.frombuffer(b"".join(batch.column("tokens").to_pylist()), np.uint32).reshape(n, trees * POOL)
            if rooted:
                nodes = children(batch.column("node").to_numpy().view(np.uint64), tokens)
            else:
                nodes = second_level(tokens, trees)
            per = nodes.shape[1]
            keep = {c: pa.array(np.repeat(batch.column(c).to_numpy(), per)) for c in ("id", "s1", "s2", "size")}
            yield pa.RecordBatch.from_pydict({**keep, "node": pa.array(nodes.ravel().view(np.int64))})

    columns = ["id", "s1", "s2", "size", "tokens"] + (["node"] if rooted else [])
    return records.select(*columns).mapInArrow(run, "id long, s1 long, s2 long, size long, node long")


def _apart(x: Column, y: Column) -> Column:
    """Differing sketch bits."""
    return sum((F.bit_count(x[s].bitwiseXOR(y[s])) for s in ("s1", "s2")), F.lit(0))


def _bits_allowed(percent: int) -> int:
    """Differing bits beyond which a pair at the threshold is 6 deviations off."""
    p = (1 - percent / 100) / 2
    return math.ceil(BITS * p + 6 * math.sqrt(BITS * p * (1 - p)))


_ME = ("comp", "id", "s1", "s2", "size")


def _close(x: Column, y: Column, percent: int) -> Column:
    """Whether two records of different components may reach the similarity, by their sizes and sketches."""
    sized = 100 * F.least(x["size"], y["size"]) >= percent * F.greatest(x["size"], y["size"])
    return (x["comp"] != y["comp"]) & sized & (_apart(x, y) <= _bits_allowed(percent))


def _pair(df: DataFrame) -> DataFrame:
    return df.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))


def _within(small: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of the nodes of ``small``, all against all."""
    side = small.select("node", F.struct(*_ME).alias("x"))
    x, y = F.col("x"), F.col("y")
    return _pair(side.join(side.withColumnRenamed("x", "y"), "node").where((x["id"] < y["id"]) & _close(x, y, percent)))


def _ends(large: DataFrame) -> DataFrame:
    """(node, high, low): the most typical record of each node and its first one.

    The most typical one differs least from the bits that most of the node's sketches have;
    among many records nearly all share every shingle with some other, typical or not.
    """
    two = F.lit((1 << 32) | 1)      # bits i and i + 32 of a sketch are counted in the halves of one sum
    sums = [F.sum(F.shiftright(s, i).bitwiseAND(two)).alias(f"{s}_{i}") for s in ("s1", "s2") for i in range(32)]

    def usual(s: str) -> Column:
        bits = [F.when(2 * count > F.col("n"), F.lit(1 << (i + up) if i + up < 63 else -(1 << 63))).otherwise(0)
                for i in range(32) for up, count in ((0, F.col(f"{s}_{i}").bitwiseAND((1 << 32) - 1)), (32, F.shiftright(f"{s}_{i}", 32)))]
        return reduce(Column.bitwiseOR, bits)

    counts = large.groupBy("node").agg(F.count("*").alias("n"), *sums)
    most = stored(counts.select("node", F.struct(usual("s1").alias("s1"), usual("s2").alias("s2")).alias("usual")), "usual")
    typical = F.struct((-_apart(F.struct("s1", "s2"), F.col("usual"))).alias("near"), (F.col("shared") / F.col("all")).alias("share"), *_ME)
    return large.join(most, "node").groupBy("node").agg(F.max(typical).alias("high"), F.min(F.struct(*_ME)).alias("low"))


def _against_two(large: DataFrame, ends: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of all records of a node with its most typical one and its first one."""
    high = F.struct(*[F.col(f"high.{c}").alias(c) for c in _ME])
    star = (large.select("node", F.struct(*_ME).alias("x")).join(ends, "node")
            .select("x", F.explode(F.array(high, "low")).alias("y")))
    return _pair(star.where(_close(F.col("x"), F.col("y"), percent)))


def _against_all(few: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of the records outside a node's largest component (``top``) with all of the node.

    What two records share lies inside the node's most typical record, less what either
    of them lacks of it, or outside, where each shares ``shared - both`` with any other;
    pairs that cannot reach the similarity so are left out.  A node is cut into blocks of
    about ``OUTSIDE`` by ``INSIDE`` records (fewer of long ones), each compared on arrays.
    """
    words = F.greatest(F.size("lacks"), F.lit(WORDS))    # as many for all records of a node
    of = lambda n, most: F.ceil(F.col(n) * words / (WORDS * most))
    place = lambda blocks: F.pmod(F.xxhash64("id"), blocks)
    every = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
    columns = ["node", *_ME, "top", "whole", "all", "shared", "both", "lacks"]
    outside, inside = of("others", OUTSIDE), of("n", INSIDE)
    x = few.where("comp <> top").select(*columns, F.lit(True).alias("outer"), place(outside).alias("row"), every(inside).alias("column"))
    y = few.select(*columns, F.lit(False).alias("outer"), every(outside).alias("row"), place(inside).alias("column"))

    def run(block):
        kinds = np.asarray(block.column("outer"))
        rows, others = (_arrays(block.filter(pa.array(kind))) for kind in (kinds, ~kinds))
        a, b = _may_reach(rows, others, percent)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return x.union(y).groupBy("node", "row", "column").applyInArrow(run, "a long, b long")


def _arrays(block: pa.Table) -> dict[str, np.ndarray]:
    out = {c: block.column(c).to_numpy() for c in (*_ME, "top", "whole", "all", "shared", "both")}
    lacks = block.column("lacks").combine_chunks().flatten().to_numpy().reshape(block.num_rows, -1 if block.num_rows else 1)
    return out | {"s1": out["s1"].view(np.uint64), "s2": out["s2"].view(np.uint64), "lacks": lacks.view(np.uint64)}


def _may_reach(x: dict[str, np.ndarray], y: dict[str, np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the pairs of ``x`` and ``y``, of one node, that sketches, sizes and what they lack leave possible."""
    found_a, found_b = [x["id"][:0]], [y["id"][:0]]
    extra_x, extra_y = (np.maximum(r["shared"] - r["both"], 0) for r in (x, y))
    step, some = max(1, TILE // max(1, len(y["id"]))), max(1, TILE // x["lacks"].shape[1])
    for start in range(0, len(x["id"]), step):
        r = slice(start, start + step)
        of = lambda c: x[c][r, None]  # noqa: B023, E731
        # at most so many shared reach the similarity if 100 * most >= percent * (sizes - most)
        spare = (100 + percent) * (np.minimum(of("both"), y["both"]) + np.minimum(extra_x[r, None], extra_y)) >= percent * (of("all") + y["all"])
        spare &= of("comp") != y["comp"]
        spare &= (y["comp"] == y["top"]) | (of("id") < y["id"])     # else seen from the other side
        i, j = np.nonzero(spare)
        i += start
        low, high = np.minimum(x["size"][i], y["size"][j]), np.maximum(x["size"][i], y["size"][j])
        apart = sum(np.bitwise_count(x[s][i] ^ y[s][j]).astype(np.int64) for s in ("s1", "s2"))
        close = (100 * low >= percent * high) & (apart <= _bits_allowed(percent))
        i, j = i[close], j[close]
        for part in range(0, len(i), some):
            k, m = i[part: part + some], j[part: part + some]
            lack = np.bitwise_count(x["lacks"][k] | y["lacks"][m]).sum(axis=1, dtype=np.int64)
            most = x["whole"][k] - lack + np.minimum(extra_x[k], extra_y[m])
            reach = (100 + percent) * most >= percent * (x["all"][k] + y["all"][m])
            found_a.append(x["id"][k[reach]])
            found_b.append(y["id"][m[reach]])
    return np.concatenate(found_a), np.concatenate(found_b)


def _overlap(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, both, either, lacks): shingles that both and that either of the full sets hold, and
    a bit for each place of b's shingles that a lacks.

    Places are hashes over at least twice as many bits as b has shingles, so the bits set in the
    ``lacks`` of either of two records never exceed the shingles of b that they lack together.
    """
    pairs = stored(pairs, "compared")

    def side(end: str) -> DataFrame:    # only sets that are asked for cross the shuffle of the pairs
        mine = sets.select(F.col("id").alias(end), F.col("shingles").alias(f"s{end}"))
        return mine.join(pairs.select(end).distinct(), end, "left_semi")

    sides = pairs.join(side("a"), "a").join(side("b"), "b")

    def compared(x, y):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        held = np.isin(y, x, assume_unique=True)
        bits = np.zeros(64 * (len(y) // 32 + 1), np.uint8)
        bits[mixed(y[~held]) % np.uint64(len(bits))] = 1
        both = int(held.sum())
        return both, len(x) + len(y) - both, np.packbits(bits).view(np.int64)

    def run(batches):
        for batch in batches:
            found = [compared(x.as_buffer(), y.as_buffer()) for x, y in zip(batch.column("sa"), batch.column("sb"))]
            yield pa.RecordBatch.from_pydict({
                "a": batch.column("a"), "b": batch.column("b"), "both": pa.array([f[0] for f in found], pa.int64()),
                "either": pa.array([f[1] for f in found], pa.int64()),
                "lacks": pa.array([f[2] for f in found], pa.list_(pa.int64()))})

    return sides.mapInArrow(run, "a long, b long, both long, either long, lacks array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity."""
    return _overlap(pairs, sets).where(100 * F.col("both") >= percent * F.col("either")).select("a", "b")


def near_components(docs: DataFrame, k: int = SHINGLE_WORDS, percent: int = PERCENT, recall: float = RECALL,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest id reachable), kept."""
    texts = two_columns(docs, id_col, text_col)
    trees = trees_for(recall, percent / 100)
    seen = stored(_summaries(texts, k, trees * POOL), "summaries")
    groups = seen.where("n_shingles > 0 and doc_id is not null").groupBy("d1", "d2")
    records = stored(groups.agg(F.min(F.struct("doc_id", "s1", "s2", F.col("n_shingles").alias("size"), "tokens")).alias("r"))
                     .select("d1", "d2", F.col("r.doc_id").alias("id"), "r.s1", "r.s2", "r.size", "r.tokens"), "records")
    labels = _joined(texts, records, k, percent, trees)
    member = (seen.join(records.select("d1", "d2", F.col("id").alias("rep")), ["d1", "d2"], "left")
              .join(labels.withColumnRenamed("id", "rep"), "rep", "left"))
    linked = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.coalesce("comp", "rep"))
    return (member.withColumn("component_id", F.coalesce(linked, F.col("doc_id")))
            .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def _joined(texts: DataFrame, records: DataFrame, k: int, percent: int, trees: int) -> DataFrame:
    """Components (id, comp) of the records that are linked with another."""
    rows = _expand(records, trees).withColumn("comp", F.col("id"))
    sets = links = None
    for level in range(MAX_LEVELS + 1):
        last = level == MAX_LEVELS
        nodes = rows.groupBy("node").agg(F.count("*").alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high"))
        # stored before it is joined: only a join of two plain exchanges has its hot partitions split
        mixed_nodes = stored(nodes.where("n > 1 and low <> high").select("node", "n"), "nodes")
        live = stored(rows.join(mixed_nodes, "node"), "live")
        large = live.where(F.col("n") > SMALL)
        pairs = stored(_within(live.where(F.col("n") <= SMALL), percent).distinct(), "pairs")
        if sets is None:    # whatever comes later is of records of the large nodes
            wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).union(large.select("id")).distinct()
            sets = stored(_sets(texts, wanted, k), "sets")
        large = stored(_able(large, _sharing(sets, large), percent), "large")
        ends = stored(_ends(large), "ends")
        pairs = pairs.union(_against_two(large, ends, percent)).distinct()
        found = _confirmed(pairs, sets, percent)
        links = stored(found if links is None else links.union(found), "links")
        if large.isEmpty():
            return components(links)
        labels = components(links, rounds=1)
        large = large.join(ends.select("node", F.col("high.id").alias("typical")), "node")
        inside = stored(_overlap(large.select(F.col("id").alias("a"), F.col("typical").alias("b")).distinct(), sets), "inside")
        large = large.join(inside.withColumnsRenamed({"a": "id", "b": "typical"}), ["id", "typical"])
        whole = (F.col("either") + F.col("both") - F.col("all")).alias("whole")    # of the typical record
        large = large.select("id", "node", "s1", "s2", "size", "all", "shared", "both", "lacks", whole)
        large = stored(_relabelled(large, labels), "large")
        left = stored(_unsettled(large), "unsettled")
        done = F.lit(last) | (F.col("others").cast("double") * F.col("n") <= PAIRS)
        few = large.join(left.where(done), "node")
        links = stored(links.union(_confirmed(_against_all(few, percent).distinct(), sets, percent)), "links")
        many = left.where(~done)
        if many.isEmpty():
            return components(links)
        rows = large.join(many.select("node"), "node", "left_semi").select("id", "node").distinct()
        rows = _relabelled(_expand(rows.join(records.select("id", "s1", "s2", "size", "tokens"), "id"), trees), labels)
    raise AssertionError("unreachable")


def _relabelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "id", "left").withColumn("comp", F.coalesce("comp", "id"))


def _unsettled(large: DataFrame) -> DataFrame:
    """(node, top, n, others) of the nodes that hold several components: their rows, and those outside the largest."""
    sizes = large.groupBy("node", "comp").agg(F.count("*").alias("n"))
    return (sizes.groupBy("node").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("n"))
            .select("node", F.col("top.comp").alias("top"), "n", (F.col("n") - F.col("top.n")).alias("others")).where("others > 0"))


def _sharing(sets: DataFrame, rows: DataFrame) -> DataFrame:
    """(id, all, shared): shingles of each record of ``rows``, and those that another of them holds."""
    def tokens(batches):
        for batch in batches:
            for id_, data in zip(batch.column("id").to_pylist(), batch.column("shingles").to_pylist()):
                found = np.frombuffer(data, np.int64)
                yield pa.RecordBatch.from_pydict({"id": pa.array(np.full(len(found), id_)), "token": pa.array(found)})

    each = sets.join(rows.select("id").distinct(), "id", "left_semi").mapInArrow(tokens, "id long, token long")
    alone = stored(each.groupBy("token").agg(F.count("*").alias("n"), F.min("id").alias("id"))
                   .where("n = 1").groupBy("id").agg(F.count("*").alias("alone")), "alone")
    return (each.groupBy("id").agg(F.count("*").alias("all")).join(alone, "id", "left")
            .select("id", "all", (F.col("all") - F.coalesce("alone", F.lit(0))).alias("shared")))


def _able(large: DataFrame, sharing: DataFrame, percent: int) -> DataFrame:
    """The rows whose shared shingles suffice for the similarity with a record of their node's sizes."""
    sized = large.join(stored(sharing, "sharing"), "id")
    least = stored(sized.groupBy("node").agg(F.min("all").alias("least")), "least")
    shared, whole, other = F.col("shared"), F.col("all"), F.greatest("least", "shared")
    return sized.join(least, "node").where(100 * shared >= percent * (whole + other - shared))


def _sets(texts: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    def shingles(ids, found):
        return {"id": ids, "shingles": [s.tobytes() for s in shingle_sets(found, k)]}

    kept = texts.join(wanted.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")
    return map_arrow(kept, "id long, shingles binary", shingles).dropDuplicates(["id"])


def drop_near_duplicates(docs: DataFrame, k: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that are the first of their component, all columns kept.

    Of rows that repeat an id all stay, as nothing tells them apart; a null id stays.
    """
    gone = near_components(docs, k, percent).where("not kept").select(F.col("doc_id").alias("gone"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"))    # whatever the columns are called
    return rows.join(gone, F.col("id") == F.col("gone"), "left_anti").select("row.*")
