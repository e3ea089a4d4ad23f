"""Merkle manifest of a table: one tree per group, and one over the groups' roots.

A leaf is the SHA-256 of a row's columns. The leaves of a group stand in the order of
their ids; every ``fanout`` consecutive nodes, the last ones maybe fewer, are hashed
into their parent, until one node is left, the subroot. The subroots, in the order of
their groups, make a tree alike, whose last node is the root.

**Slot pivot.** A level is one aggregate by parent: the digest of the child in slot k
goes to column ``s<k>`` (a conditional maximum), the columns joined are what the parent
hashes, and the columns without a child's own slot are its siblings. Levels are written
and shrink by the fanout, so all of them together are a fraction of the leaves.

**Proofs.** From the root down each node takes over its parent's path, with the
siblings left and right of it put in front: one join per level on (group, place of the
parent), whose right side has a row per parent. A leaf folds its path: hash of left
siblings, own digest, right siblings, level by level. A path is as long as the tree is
high (``fanout`` digests a level).

**Places.** A group may hold a third of all rows, so its leaves are never numbered in
one task: they are dealt out by ranges of (group, id), and a row's place is its
position in its range after the rows of the same group in the ranges before.

Defined cases: a null column counts as ``-``, in a leaf; null ids stand first, and a
null group is the first group; rows with one id stand in the order of their leaves, so
repeated rows are leaves of their own; the lone leaf of a group is its subroot, a lone
subroot the root; an empty table gives an empty result. Columns not named are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import written

FANOUT = 16
#: What a leaf of ``documents`` is made of, in this order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Low bits of a row id: the position inside its partition.
_POSITION_BITS = (1 << 33) - 1


@dataclass(frozen=True)
class Tree:
    """``nodes`` (tree, place, size, digest and more) and the levels above them, each
    (tree, place, size, s0 ..., digest); ``size`` is the number of nodes of the tree at
    that level, so the one row of a tree with size 1 is its root."""

    nodes: DataFrame
    levels: list[DataFrame]
    fanout: int

    def roots(self) -> DataFrame:
        """(tree, digest) of each tree's last node."""
        last = [n.filter("size = 1").select("tree", "digest") for n in (self.nodes, *self.levels)]
        out = last[0]
        for one in last[1:]:
            out = out.unionByName(one)
        return out


def field(value: Column) -> Column:
    """A value in a leaf: its bytes counted, a colon, itself; ``-`` for null."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def group_key(group: Column) -> Column:
    """A text that is never null and sorts as the groups do, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``place``, from 0 in their ``tree`` in the given order, and
    ``size``, the number of rows of the tree. ``rows`` is read twice."""
    rows = rows.withColumn("_input", F.monotonically_increasing_id())
    by = ["tree", *order, "_input"]
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("_input")
    fixed = written(
        dealt.withColumns(
            {
                "_part": F.spark_partition_id(),
                "_at": F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)),
            }
        ),
        "ranges",
    )
    ranges = fixed.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    # One row per tree and range: as many as there are trees and tasks.
    tree = Window.partitionBy("tree")
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(
        "tree",
        "_part",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(tree).alias("size"),
    )
    return fixed.join(starts, ["tree", "_part"]).withColumn("place", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


def _slots(fanout: int) -> list[str]:
    return [f"s{k}" for k in range(fanout)]


def _parents(children: DataFrame, fanout: int) -> DataFrame:
    slot = F.col("place") % fanout
    spread = children.filter("size > 1").groupBy("tree", F.floor(F.col("place") / fanout).alias("place"))
    level = spread.agg(
        *[F.max(F.when(slot == k, F.col("digest"))).alias(s) for k, s in enumerate(_slots(fanout))],
        F.ceil(F.max("size") / fanout).alias("size"),
    )
    return level.withColumn("digest", F.sha2(F.concat_ws("", *_slots(fanout)), 256))


def build(nodes: DataFrame, fanout: int = FANOUT) -> Tree:
    """The trees over ``nodes`` (tree, place, size, digest), which are read per level."""
    most = nodes.agg(F.max("size")).first()[0] or 0
    levels: list[DataFrame] = []
    while most > 1:
        levels.append(written(_parents(levels[-1] if levels else nodes, fanout), "level"))
        most = -(-most // fanout)
    return Tree(nodes, levels, fanout)


def paths(tree: Tree, tops: DataFrame) -> DataFrame:
    """The nodes with the columns of ``tops`` (a row per tree: tree, path, more) and
    their own ``path``, from the siblings beside them up to the end of the tree's."""
    more = [c for c in tops.columns if c not in ("tree", "path")]
    above = None
    for rows in [*reversed(tree.levels), tree.nodes]:
        here = rows.filter("size = 1").join(tops, "tree")
        if above is not None:
            slot = F.col("place") % tree.fanout
            left = F.concat_ws("", *[F.when(slot > k, F.col(f"_{s}")) for k, s in enumerate(_slots(tree.fanout))])
            right = F.concat_ws("", *[F.when(slot < k, F.col(f"_{s}")) for k, s in enumerate(_slots(tree.fanout))])
            beside = F.array(F.struct(left.alias("left"), right.alias("right")))
            parents = above.select(
                "tree",
                F.col("place").alias("_parent"),
                F.col("path").alias("_path"),
                *[F.col(s).alias(f"_{s}") for s in _slots(tree.fanout)],
                *more,
            )
            below = rows.filter("size > 1").withColumn("_parent", F.floor(F.col("place") / tree.fanout))
            inner = below.join(parents, ["tree", "_parent"])
            here = here.unionByName(inner.select(*rows.columns, F.concat(beside, "_path").alias("path"), *more))
        above = here
    return above


def folded(path: Column, digest: Column) -> Column:
    """The root that a digest gives along its path."""
    return F.aggregate(path, digest, lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))


def siblings(path: Column) -> Column:
    """All siblings' digests, level by level, left to right."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")


def manifest(leaves: DataFrame, order: Sequence[str] = ("id", "digest"), fanout: int = FANOUT) -> DataFrame:
    """``leaves`` (tree, digest, and what ``order`` and the caller need) with ``subroot``,
    ``root`` and ``path``. ``tree`` is a ``group_key``."""
    groups = build(written(placed(written(leaves, "leaves"), order), "placed"), fanout)
    subroots = written(groups.roots().select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest"), "subroots")
    top = build(written(placed(subroots, ["group"]), "placed"), fanout)
    nothing = F.array().cast(PATH)
    root = top.roots().select("tree", nothing.alias("path"), F.col("digest").alias("root"))
    tops = paths(top, root).select(F.col("group").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    return paths(groups, written(tops, "subroots"))


def without_capitals(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def verify(
    docs: DataFrame, shown: Column, id_col: str = "doc_id", group_col: str = "source",
    columns: Sequence[str] = COLUMNS, text_col: str = "text", fanout: int = FANOUT,
) -> DataFrame:
    """A manifest of ``docs``, and every row held against it: doc_id, leaf, subroot, root,
    path, proof_sha256, folded_root, verified. Where ``shown`` is true the row is shown
    with its text in lower case (A-Z), otherwise as it is."""
    values = {c: F.col(c) for c in columns}
    changed = {**values, text_col: without_capitals(F.col(text_col))}
    leaves = docs.select(
        group_key(F.col(group_col)).alias("tree"),
        F.col(id_col).alias("id"),
        leaf(*values.values()).alias("digest"),
        F.when(shown, leaf(*changed.values())).alias("shown"),
    )
    rows = manifest(leaves, ["id", "digest"], fanout)
    out = rows.select(
        F.col("id").alias("doc_id"),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        "path",
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        folded(F.col("path"), F.coalesce("shown", "digest")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
