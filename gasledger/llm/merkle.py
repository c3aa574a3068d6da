"""A Merkle manifest of a table, with a membership proof for every row.

Each row is a leaf; the rows of one ``tree`` (a source) form a tree of ``ARITY``
children a node, and the trees' roots, in the order of their names, form the tree above.
Only every ``STRIDE`` levels are stored, as aligned subtrees of up to ARITY^STRIDE
nodes a row (``climb``).  A proof needs the levels between: ``proofs`` goes from the top
down, regenerates the missing nodes of one stored subtree at a time inside a row's
expression, emits the siblings of each of its members and lets them go.

Positions come from range partitions and their counts, so that a source of any size is
numbered without being gathered; every join is between unique (tree, subtree) keys, so
a source that holds most rows is no hot key.  DataFrame functions throughout.

Defined results: null columns are part of a leaf as ``-`` (an empty text is ``0:``); a
null source is a tree of its own, before all others; a null id comes first in its tree;
rows that share source and id are ordered by their leaf, and equal leaves are
interchangeable; an empty table has no leaves, no root and no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gasledger.llm.common import stored
from gasledger.llm.quality_rules import let

ARITY = 3
STRIDE = 4                     # levels between two stored ones
WIDTH = ARITY ** STRIDE        # nodes of a stored subtree
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_STEP = "struct<left:string,right:string>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(*values: Column) -> Column:
    """Hash of a row: each value as its UTF-8 length, ':' and itself, or '-' if null."""
    def framed(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*[framed(v) for v in values])


def tree_key(name: Column) -> Column:
    """A tree's name as a string that is never null and sorts null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), name.cast("string")), F.lit("-"))


def fold(node: Column, path: Column) -> Column:
    """The root that ``node`` leads to over its proof."""
    return F.aggregate(path, node, lambda h, s: digest(s["left"], h, s["right"]))


def path_digest(path: Column) -> Column:
    """Hash of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


# --- inside one subtree -----------------------------------------------------------

def _steps(n: Column, tier: int) -> Column:
    """Levels that a subtree of this tier climbs, in a tree of ``n`` leaves."""
    height = F.aggregate(F.sequence(F.lit(1), F.lit(40)), F.struct(F.lit(1).cast("decimal(38,0)").alias("w"), F.lit(0).alias("h")),
                         lambda a, _: F.when(a["w"] < n, F.struct((a["w"] * ARITY).cast("decimal(38,0)").alias("w"), (a["h"] + 1).alias("h"))).otherwise(a),
                         lambda a: a["h"])
    return F.least(F.lit(STRIDE), F.greatest(F.lit(0), height - tier * STRIDE))


def _levels(nodes: Column, steps: Column) -> Column:
    """The nodes of each level of a subtree, the given one first."""
    def parents(level: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor((F.size(level) - 1) / ARITY).cast("int")),
            lambda i: F.sha2(F.array_join(F.slice(level, i * ARITY + 1, ARITY), ""), 256))

    climbs = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(climbs, F.array(nodes), lambda done, _: F.concat(done, F.array(parents(F.element_at(done, -1)))))


def _path(levels: Column, at: Column) -> Column:
    """The siblings of member ``at`` (from 0), one step a level below the subtree's top."""
    def step(level: Column, k: Column) -> Column:
        place = F.floor(at / F.pow(F.lit(ARITY), k)).cast("int")
        run = F.floor(place / ARITY).cast("int") * ARITY
        return F.struct(
            F.array_join(F.slice(level, run + 1, place - run), "").alias("left"),
            F.array_join(F.slice(level, place + 2, run + ARITY - 1 - place), "").alias("right"))

    return F.transform(F.slice(levels, 1, F.size(levels) - 1), step)


# --- the whole forest -------------------------------------------------------------

def numbered(nodes: DataFrame, *order: str) -> DataFrame:
    """``nodes`` with ``pos`` (from 0, by ``order`` within its tree) and ``n`` (its tree's nodes)."""
    dealt = nodes.withColumn("tie", F.monotonically_increasing_id())      # equal rows may lie in several partitions
    keys = ["tree", *order, "tie"]
    rows = stored(dealt.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
                  .withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()), "ordered")
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (rows.groupBy("tree", "part").agg(F.min("at").alias("low"), F.count("*").alias("held"))
            .withColumns({"n": F.sum("held").over(tree), "skip": F.coalesce(F.sum("held").over(before), F.lit(0))})
            .drop("held"))
    return (rows.join(runs, ["tree", "part"]).withColumn("pos", F.col("at") - F.col("low") + F.col("skip"))
            .drop("part", "at", "low", "skip"))


@dataclass
class Forest:
    """The stored levels: ``tiers[t]`` has one row (tree, block, n, members) per aligned subtree of level t * STRIDE.

    ``tops[t]`` holds the roots (tree, node) of the trees that end at tier t."""

    tiers: list[DataFrame]
    tops: list[DataFrame]

    def roots(self) -> DataFrame:
        out = self.tops[0]
        for more in self.tops[1:]:
            out = out.unionByName(more)
        return out


def climb(nodes: DataFrame, *order: str) -> Forest:
    """Store every ``STRIDE``-th level of the trees over ``nodes`` (tree, node and any payload)."""
    members, tiers, tops = numbered(nodes, *order), [], []
    while True:
        payload = [c for c in members.columns if c not in ("tree", "n", "pos")]
        block = F.floor(F.col("pos") / WIDTH).cast("long")
        tier = stored(
            members.withColumn("block", block).groupBy("tree", "block")
            .agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("pos", *payload))).alias("members")), "subtrees")
        up = tier.select("tree", F.col("block").alias("pos"), "n", F.element_at(F.element_at(
            _levels(F.col("members.node"), _steps(F.col("n"), len(tiers))), -1), 1).alias("node"))
        up = stored(up, "nodes")
        single = F.col("n") <= WIDTH ** (len(tiers) + 1)
        tops.append(up.where(single).select("tree", "node"))
        tiers.append(tier)
        members = up.where(~single)
        if members.isEmpty():
            return Forest(tiers, tops)


def proofs(forest: Forest, above: DataFrame | None = None) -> DataFrame:
    """Every leaf with its payload, ``tree``, ``top`` (its tree's root), ``path`` and ``root``.

    ``above`` (tree, path, root) continues each tree's paths; without it a tree's root is the end.
    """
    down = None
    for t in reversed(range(len(forest.tiers))):
        ends = forest.tops[t].select("tree", F.lit(0).cast("long").alias("block"), F.col("node").alias("top"))
        if above is None:
            ends = ends.select("*", F.array().cast(f"array<{_STEP}>").alias("rest"), F.col("top").alias("root"))
        else:
            ends = ends.join(above.select("tree", F.col("path").alias("rest"), "root"), "tree")
        rest = ends if down is None else ends.unionByName(
            down.select("tree", F.col("pos").alias("block"), "top", F.col("path").alias("rest"), "root"))
        levels = _levels(F.col("members.node"), _steps(F.col("n"), t))
        found = forest.tiers[t].join(rest, ["tree", "block"]).select(
            "tree", "top", "root", F.inline(let(levels, lambda x: F.transform("members", lambda m, i: F.struct(
                m.alias("m"), F.concat(_path(x, i), F.col("rest")).alias("path"))))))
        down = found.select("tree", "top", "root", "path", "m.*")
    return down


def manifest(docs: DataFrame, tampered: Column | None = None, id_col: str = "doc_id", tree_col: str = "source",
             fields: tuple[str, ...] = FIELDS, text_col: str = "text") -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, path (struct<left, right> a level) and seen_leaf.

    ``seen_leaf`` is the leaf with the text replaced by ``tampered``, if that is given.
    """
    columns = [F.col(f) for f in fields]
    seen = [tampered if f == text_col and tampered is not None else F.col(f) for f in fields]
    nodes = docs.select(tree_key(F.col(tree_col)).alias("tree"), F.col(id_col).alias("doc_id"),
                        leaf(*columns).alias("node"), leaf(*seen).alias("seen"))
    forest = climb(nodes, "doc_id", "node", "seen")
    trees = forest.roots().select(F.lit("").alias("tree"), F.col("tree").alias("name"), "node")
    above = proofs(climb(trees, "name")).select(F.col("name").alias("tree"), "path", "root")
    return proofs(forest, above).select("doc_id", F.col("node").alias("leaf"), F.col("top").alias("subroot"), "root",
                                        "path", F.col("seen").alias("seen_leaf"))


def without_newlines(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text as a tamperer leaves it: newlines gone in rows whose id has an even CRC-32."""
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0
    return F.when(hit, F.translate(F.col(text_col), "\n", "")).otherwise(F.col(text_col))


def verified(rows: DataFrame) -> DataFrame:
    """``manifest`` rows with proof_sha256, folded_root (from ``seen_leaf`` over the path) and verified."""
    return (rows.withColumn("proof_sha256", path_digest(F.col("path")))
            .withColumn("folded_root", fold(F.col("seen_leaf"), F.col("path")))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
