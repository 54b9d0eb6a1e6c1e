"""A Merkle manifest of a dataset, with proofs checked against a changed copy.

Every row is a leaf. The leaves of a group, in the order of a key, make a binary tree:
while a group has several nodes, every two consecutive ones become the hash of both, and
a last one without a partner the hash of itself. The groups' roots, in the order of the
groups, make a last tree in the same way.

A leaf's place in its group comes from one sort by range, so a group may hold any share
of the rows. ``2 ** HEIGHT`` consecutive leaves are a superblock, which is a whole
subtree. Their nodes are combined where they lie, before a shuffle; what is left of a
superblock, a few nodes, meets in one group and becomes its root. Superblock roots are
leaves of a tree that is ``2 ** HEIGHT`` times smaller, climbed in the same way, so no
task holds more than one superblock at any size.

Then leaves and the outer nodes that their superblock needs (those beside its path to
the root) are cogrouped by superblock, once: each such group rebuilds its subtree, joins
inner and outer siblings to the proofs and folds every proof from the changed leaf.

Odd rows: a null field is ``-``; null groups make a group of their own, the first; null
keys come first in their group. Rows of equal group and key follow in the order of their
leaves, so equal rows keep leaves and roots whatever their order. An empty table gives
no row. Only the named columns are read.
"""

from __future__ import annotations

from functools import reduce
from hashlib import sha256
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

HEIGHT = 12
#: The way from a node to the top: per level the sibling, if there is one.
STEPS = "array<struct<alone: boolean, left: boolean, node: string>>"


def encoded(value: Column) -> Column:
    """``-`` for null, else the length in bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(encoded, fields)).cast("binary"), 256)


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def climbed(levels: dict[int, dict[int, str]], n: int, height: int) -> dict[int, dict[int, str]]:
    """Combines the nodes of a tree of ``n`` leaves, given as {level: {place: hash}},
    up to ``height`` levels. Returns those that still lack a partner, or are at the top."""
    rest: dict[int, dict[int, str]] = {}
    row: dict[int, str] = {}
    for level in range(height + 1):
        row.update(levels.get(level, {}))
        if n == 1 or level == height:
            if row:
                rest[level] = row
            break
        above: dict[int, str] = {}
        for place, node in row.items():
            if place & 1:
                if place - 1 not in row:
                    rest.setdefault(level, {})[place] = node
            elif place + 1 in row:
                above[place >> 1] = digest(node + row[place + 1])
            elif place + 1 == n:
                above[place >> 1] = digest(node)
            else:
                rest.setdefault(level, {})[place] = node
        row, n = above, (n + 1) >> 1
    return rest


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (tree, ...) with ``place``, the position in the tree by ``order``, and
    ``n``, the tree's size. Rows are sorted by range and stored; a row's number less
    that of its tree's first row in the partition, and the rows of the tree in earlier
    partitions, give its place."""
    number = F.monotonically_increasing_id()
    keys = ["tree", *order]
    # The last key tells equal rows apart, so that no range grows with them.
    spread = rows.withColumn("row", number).repartitionByRange(*keys, "row").sortWithinPartitions(*keys, "row")
    spread = stored(spread.withColumn("row", number), "leaves")
    part = F.shiftright("row", 33).alias("part")
    runs = spread.groupBy("tree", part).agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("size"))
    before = W.partitionBy("tree").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.select(
        "tree", "part", (F.col("first") - F.coalesce(F.sum("size").over(before), F.lit(0))).alias("offset"),
        F.sum("size").over(W.partitionBy("tree")).alias("n"),
    )
    found = spread.withColumn("part", part).join(runs, ["tree", "part"])
    return found.withColumn("place", F.col("row") - F.col("offset")).drop("row", "part", "offset")


def superblock_roots(leaves: DataFrame, height: int) -> DataFrame:
    """(tree, block, root, n) of every superblock of leaves (tree, place, n, leaf), with
    the superblocks that the tree has as ``n``."""

    def here(batches):
        """Subtrees of what one batch holds."""
        for batch in batches:
            trees: dict[tuple[str, int], dict[int, str]] = {}
            for tree, place, n, leaf in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                trees.setdefault((tree, n), {})[place] = leaf
            out = [
                (tree, place >> (height - level), n, level, place, node)
                for (tree, n), row in trees.items()
                for level, nodes in climbed({0: row}, n, height).items()
                for place, node in nodes.items()
            ]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                    names=["tree", "block", "n", "level", "place", "node"],
                )

    def together(nodes: pd.DataFrame) -> pd.DataFrame:
        levels: dict[int, dict[int, str]] = {}
        for level, place, node in zip(nodes["level"], nodes["place"], nodes["node"], strict=True):
            levels.setdefault(int(level), {})[int(place)] = node
        n = int(nodes["n"].iloc[0])
        (root,) = (node for row in climbed(levels, n, height).values() for node in row.values())
        return pd.DataFrame({"tree": nodes["tree"].iloc[:1], "place": nodes["block"].iloc[:1], "n": -(-n >> height), "leaf": [root]})

    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
    parts = leaves.select("tree", "place", "n", "leaf").mapInArrow(
        here, "tree string, block bigint, n bigint, level int, place bigint, node string"
    )
    return parts.groupBy("tree", "block").applyInPandas(together, "tree string, place bigint, n bigint, leaf string")


def path_of(place: int, n: int, levels: list[list[str]]) -> list[tuple[bool, bool, str | None]]:
    """(alone, whether the sibling is to the left, the sibling) per level."""
    path = []
    for row in levels[:-1]:
        beside = place ^ 1
        path.append((False, bool(place & 1), row[beside]) if beside < n else (True, False, None))
        place, n = place >> 1, (n + 1) >> 1
    return path


def subtree(leaves: list[str], whole: bool, height: int) -> list[list[str]]:
    """All levels of a superblock; one that is a whole tree ends at its single node."""
    levels = [leaves]
    while len(levels[-1]) > 1 or (not whole and len(levels) <= height):
        row = levels[-1]
        levels.append([digest("".join(row[i : i + 2])) for i in range(0, len(row), 2)])
    return levels


def outer_paths(nodes: DataFrame, height: int) -> DataFrame:
    """(tree, place, outer, top): the path of every node (tree, place, n, leaf) to the
    top of its tree, and the top. Trees beyond one superblock are climbed by
    superblocks of nodes first."""
    largest = nodes.agg(F.max("n")).first()[0] or 0
    key = [F.col("tree"), F.shiftright("place", height).alias("block")]
    nodes = nodes.select(*key, "place", "n", "leaf")
    if largest > 1 << height:
        blocks = stored(superblock_roots(nodes, height), "superblocks")
        above = outer_paths(blocks, height).withColumnRenamed("place", "block")
    else:
        above = nodes.where("place = 0").select("tree", "block", F.lit(None).cast(STEPS).alias("outer"), F.lit(None).cast("string").alias("top"))

    def run(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        n = int(rows["n"].iloc[0])
        start, further, top = int(rows["place"].iloc[0]), outer["outer"].iloc[0], outer["top"].iloc[0]
        levels = subtree(rows["leaf"].tolist(), n <= 1 << height, height)
        further = [] if further is None else [(s["alone"], s["left"], s["node"]) for s in further]
        paths = [path_of(i, len(levels[0]), levels) + further for i in range(len(rows))]
        paths = [[{"alone": a, "left": b, "node": c} for a, b, c in p] for p in paths]
        return pd.DataFrame({"tree": rows["tree"], "place": start + np.arange(len(rows)), "outer": paths, "top": top or levels[-1][0]})

    grouped = nodes.groupBy("tree", "block").cogroup(above.groupBy("tree", "block"))
    return stored(grouped.applyInPandas(run, f"tree string, place bigint, outer {STEPS}, top string"), "paths")


def manifest(
    rows: DataFrame, group: str, key: str, fields: list[str], tampered: dict[str, Column] | None = None, height: int = HEIGHT
) -> DataFrame:
    """A row per row of ``rows``: ``key``, ``group``, leaf, place, subroot, root, proof
    (the siblings from the leaf up, one string after the other), proof_sha256,
    folded_root and verified.

    ``fields`` name what a leaf is the hash of, in order. ``tampered`` holds the changed
    values of some of them; the leaf that a proof is folded from is recomputed with them.
    ``folded_root`` is where that ends with the original siblings, ``verified`` whether
    it is the root. ``height`` is the height of a superblock.
    """
    tampered = tampered or {}
    fold = F.lit(None).cast("string")
    if tampered:
        changed = reduce(and_, (v.eqNullSafe(F.col(c)) for c, v in tampered.items()))
        fold = F.when(~changed, leaf_hash([tampered.get(c, F.col(c)) for c in fields]))
    # A group as text that sorts like it, null first.
    tree = F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0"))
    rows = rows.select(tree.alias("tree"), F.col(key).alias("key"), leaf_hash([F.col(c) for c in fields]).alias("leaf"), fold.alias("other"))
    leaves = stored(placed(stored(rows, "hashes"), ["key", "leaf"]), "placed")
    blocks = stored(superblock_roots(leaves, height), "superblocks")
    inside = outer_paths(blocks, height)
    subroots = inside.where("place = 0").select(F.lit("").alias("tree"), F.col("tree").alias("group"), F.col("top").alias("leaf"))
    # The groups are the leaves of the last tree.
    groups = stored(placed(subroots, ["group"]), "groups")
    last = outer_paths(groups.select("tree", "place", "n", "leaf"), height)
    last = groups.select(F.col("group").alias("tree"), "place").join(
        last.select("place", F.col("outer").alias("further"), F.col("top").alias("root")), "place"
    )
    needed = inside.join(last.drop("place"), "tree").select(
        "tree", F.col("place").alias("block"), F.concat("outer", "further").alias("outer"), F.col("top").alias("subroot"), "root"
    )

    def run(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        root, subroot = outer["root"].iloc[0], outer["subroot"].iloc[0]
        further = [(s["alone"], s["left"], s["node"]) for s in outer["outer"].iloc[0]]
        levels = subtree(rows["leaf"].tolist(), int(rows["n"].iloc[0]) <= 1 << height, height)
        proofs, folded = [], []
        for i, (leaf, other) in enumerate(zip(rows["leaf"], rows["other"], strict=True)):
            node, siblings = other or leaf, []
            for alone, left, beside in path_of(i, len(rows), levels) + further:
                if not alone:
                    siblings.append(beside)
                node = digest(node if alone else beside + node if left else node + beside)
            proofs.append("".join(siblings))
            folded.append(node)
        return pd.DataFrame({
            "tree": rows["tree"], "key": rows["key"], "leaf": rows["leaf"], "place": rows["place"], "subroot": subroot, "root": root,
            "proof": proofs, "proof_sha256": [digest(p) for p in proofs], "folded_root": folded, "verified": [f == root for f in folded],
        })

    # The key as text, as pandas would turn integers with nulls into floating point.
    kind = rows.schema["key"].dataType
    leaves = leaves.withColumns({"block": F.shiftright("place", height), "key": F.col("key").cast("string")})
    found = leaves.groupBy("tree", "block").cogroup(needed.groupBy("tree", "block")).applyInPandas(
        run, "tree string, key string, leaf string, place bigint, subroot string, root string, proof string, proof_sha256 string, folded_root string, verified boolean"
    )
    name = F.when(F.col("tree") != "0", F.substring("tree", 2, 1 << 30))
    return found.select(F.col("key").cast(kind).alias(key), name.alias(group), *found.columns[2:])
