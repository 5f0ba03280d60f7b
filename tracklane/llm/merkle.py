"""A Merkle manifest of a dataset: one hash tree per group, one tree over the groups' roots, and a proof for every row.

1. Leaves. Every row becomes the hash of its columns, each null or tagged by its length, so no two rows spell the same.
2. Places. Rows are sorted by (group, id) in ranges; a row's place in its group is its place in the range plus the
   counts of the ranges before (one row a range and group). No group is gathered, however large.
3. Levels, upwards. Windows over blocks of BLOCK places: columns at the fixed offsets lead 1 to FAN - 1, masked by slot
   and by the length of the run, and the first child of a run hashes them to its parent. A level is 1/FAN of the one below.
4. Proofs, downwards. The same windows with lag and lead columns give a node's siblings. A node's way to the root
   enters its children's window as one row in front of their run, so nothing is joined.

Only hashes move, never texts. Edge cases: a null is `-`; a null id sorts first, then ids ascend, rows of one id by their
hash, so rows that repeat are leaves of their own; a null group is a group, the first; a lone leaf is its group's
root; a run of one node has its own hash as parent as long as the level has other nodes; empty texts and texts of any
length are hashed whole; an empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracklane.llm.common import stored

#: Children of a node, and places a window block holds: a multiple of FAN, so no run is cut.
FAN, BLOCK = 16, 256
_WAY = "struct<path:array<struct<left:string,right:string>>,subroot:string,root:string>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts one after another."""
    return F.sha2(F.concat(*parts), 256)


def leaf_hash(columns: Sequence[Column]) -> Column:
    """Hash of a row: every column is ``-`` or its length in bytes, a colon and its text."""
    tagged = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string"))) for c in columns]
    return digest(*tagged)


@dataclass
class Tree:
    """levels[0] holds the leaves with what came with them; every level has g, pos, n (nodes of the group on it) and node."""

    levels: list[DataFrame]

    def roots(self) -> DataFrame:
        """g and node of every group's root, which stands on the level where the group has one node."""
        found = self.levels[0].where("n = 1").select("g", "node")
        for level in self.levels[1:]:
            found = found.unionByName(level.where("n = 1").select("g", "node"))
        return found


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """Add pos, the place of a row in its group ``g`` by ``order``, and n, the size of the group."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = rows.repartitionByRange(parts, "g", *order).sortWithinPartitions("g", *order)
    # Stored before it is counted: a second evaluation could cut the ranges elsewhere.
    laid = stored(laid.withColumn("part", F.spark_partition_id()).withColumn("seq", F.monotonically_increasing_id()), "places")
    counts = laid.groupBy("g", "part").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("rows"))
    group = W.partitionBy("g")
    before = F.sum("rows").over(group.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select("g", "part", "first", F.coalesce(before, F.lit(0)).alias("offset"), F.sum("rows").over(group).alias("n"))
    return laid.join(offsets, ["g", "part"]).withColumn("pos", F.col("offset") + F.col("seq") - F.col("first")).drop("part", "seq", "first", "offset")


def _window(*order: str) -> W:
    return W.partitionBy("g", F.floor(F.col("pos") / BLOCK)).orderBy(*order)


def _slot() -> Column:
    return F.col("pos") % FAN


def _behind(window: W) -> list[Column]:
    """The siblings behind a node, empty where the run has ended."""
    run = F.least(F.lit(FAN), F.col("n") - F.col("pos") + _slot())
    return [F.when(_slot() + k < run, F.lead("node", k).over(window)).otherwise("") for k in range(1, FAN)]


def _before(window: W) -> list[Column]:
    return [F.when(_slot() >= k, F.lag("node", k).over(window)).otherwise("") for k in range(FAN - 1, 0, -1)]


def build_tree(leaves: DataFrame) -> Tree:
    """The tree of every group from placed leaves (g, pos, n, node)."""
    levels = [stored(leaves, "leaves")]
    most = levels[0].agg(F.max("n")).first()[0] or 0
    while most > 1:
        below = levels[-1].where("n > 1").select("g", "pos", "n", "node")
        parents = below.withColumn("parent", digest(F.col("node"), *_behind(_window("pos")))).where(_slot() == 0)
        parents = parents.select("g", F.floor(F.col("pos") / FAN).alias("pos"), F.ceil(F.col("n") / FAN).alias("n"), F.col("parent").alias("node"))
        levels.append(stored(parents, f"level{len(levels)}"))
        most = -(-most // FAN)
    return Tree(levels)


def ways_up(tree: Tree, roots: DataFrame) -> DataFrame:
    """The leaves with ``way``: siblings left and right on every level up, subroot and root.

    ``roots`` has g and the way of every group's root.
    """
    above = None
    for depth in range(len(tree.levels) - 1, -1, -1):
        nodes = tree.levels[depth]
        alone = nodes.where("n = 1").select("g").join(roots, "g")
        heads = alone.select("g", F.lit(0).cast("long").alias("pos"), "way")
        if above is not None:
            heads = heads.unionByName(above.select("g", (F.col("pos") * FAN).alias("pos"), "way"))
        rows = nodes.withColumn("kind", F.lit(1)).unionByName(heads.withColumnRenamed("way", "head").withColumn("kind", F.lit(0)), allowMissingColumns=True)
        window = _window("pos", "kind")
        way = F.last("head", ignorenulls=True).over(window.rowsBetween(W.unboundedPreceding, W.currentRow))
        seen = rows.select("*", way.alias("up"), F.concat(*_before(window)).alias("left"), F.concat(*_behind(window)).alias("right")).where("kind = 1")
        own = F.concat(F.array(F.struct("left", "right")), F.col("up.path"))
        path = F.when(F.col("n") == 1, F.col("up.path")).otherwise(own)
        above = seen.withColumn("way", F.struct(path.alias("path"), F.col("up.subroot").alias("subroot"), F.col("up.root").alias("root")))
        above = above.select(*nodes.columns, "way")
        if depth:
            above = stored(above, f"ways{depth}")
    return above


def manifest(rows: DataFrame, group: str, order: Sequence[str], leaf: str) -> DataFrame:
    """Every row with its ``way``: path (siblings left and right, from its own level up to the root), subroot and root.

    Trees are built per ``group`` over the rows in ``order``, and one tree over the groups' roots in the order of the groups.
    """
    # A null group sorts first and equals itself.
    named = rows.withColumn("g", F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))).withColumnRenamed(leaf, "node")
    groups = build_tree(placed(named, *order, "node"))
    tops = groups.roots().select(F.lit("").alias("g"), F.col("g").alias("of"), "node")
    top = build_tree(placed(tops, "of"))
    nothing = F.lit(None).cast("string")
    whole = top.roots().select("g", F.struct(F.array().cast("array<struct<left:string,right:string>>").alias("path"), nothing.alias("subroot"), F.col("node").alias("root")).cast(_WAY).alias("way"))
    over = ways_up(top, whole).select(F.col("of").alias("g"), F.struct(F.col("way.path").alias("path"), F.col("node").alias("subroot"), F.col("way.root").alias("root")).alias("way"))
    return ways_up(groups, stored(over, "roots")).drop("g", "pos", "n").withColumnRenamed("node", leaf)


def siblings(path: Column) -> Column:
    """The hashes of a path in the order a verifier reads them."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda node, p: digest(p["left"], node, p["right"]))


def verify(docs: DataFrame, id_col: str = "doc_id", claimed: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    ``claimed`` replaces the text in what is verified; without it the text itself is.
    """
    columns = lambda text: [F.col(f"`{id_col}`"), F.col("source"), F.col("lang"), F.col("n_chars"), text]
    leaves = docs.select(F.col(f"`{id_col}`").alias("doc_id"), "source", leaf_hash(columns(F.col("text"))).alias("leaf"), leaf_hash(columns(F.col("text") if claimed is None else claimed)).alias("claim"))
    # Stored first: sorting by range reads its input twice, and texts are to be hashed once.
    proved = manifest(stored(leaves, "hashed"), "source", ["doc_id"], "leaf")
    folded = fold(F.col("claim"), F.col("way.path"))
    shown = proved.select("doc_id", "leaf", F.col("way.subroot").alias("subroot"), F.col("way.root").alias("root"), F.sha2(siblings(F.col("way.path")), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))
