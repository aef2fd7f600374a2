"""Merkle manifest of a table: a tree of digests over its rows, and every row's proof.

Rows of a group stand in order and get a rank.  The rank's digits to the base
``RUN`` are grouped away one after the other: eight neighbours become one node,
whose struct holds the structs of the eight.  A block of ``RUN ** LEVELS`` ranks
ends as one row, so nothing larger is ever nested, and all its groupings use the
one exchange that brings a block together.  What is left of each block, a digest,
climbs on in the same way with the blocks' own ranks (one row for 4,096 leaves), and the groups'
roots after that.  On the way back every struct is transformed into the
digests on the left and on the right of each child and exploded, so a leaf
meets its proof without a join; only rows that stand for whole blocks are joined to what is above them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, join_counted, numbered

#: Neighbours that become one node, and digits of the rank that are grouped away in one block.
RUN, LEVELS = 8, 4
#: One step of a path: the digests beside the node, joined.
STEP = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts (text or digests as hex text), one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field ``-`` if null, else its number of UTF-8 bytes, ``:`` and the value as text."""
    def part(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return digest(*map(part, fields))


def fold(node: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path (``left, right`` of each step) lead to."""
    return F.aggregate(path, node, lambda at, step: digest(step["left"], at, step["right"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""))


def _above(n: Column, level: int) -> Column:
    """Nodes of a group of ``n`` leaves after ``level`` levels."""
    width = RUN ** level
    return F.floor((n + (width - 1)) / F.lit(width)).cast("long") if level else n


def _sides(children: Column) -> Column:
    """The children, each with the joined digests on its left and right."""
    hashes = F.transform(children, lambda c: c["hash"])
    return F.transform(children, lambda c, i: F.struct(
        F.array_join(F.slice(hashes, F.lit(1), i), "").alias("left"),
        F.array_join(F.slice(hashes, i + 2, F.lit(RUN)), "").alias("right"), c.alias("node")))


def rise(nodes: DataFrame, most: int) -> DataFrame:
    """Block rows ``grp, n, node, path, top`` of ``nodes`` (``grp, n, rank, hash`` and more).

    ``n`` is the group's number of nodes (``most`` at most, and not 0), ``rank`` runs from 0
    to ``n - 1``.  ``node`` is the tree over the nodes of the block, ``path`` leads from its
    digest to ``top``, the group's.
    """
    carried = [c for c in nodes.columns if c not in ("grp", "n", "rank", "hash")]
    block = F.floor(F.col("rank") / RUN ** LEVELS).cast("long")
    rolled = nodes.select("grp", block.alias("block"), "n", "rank", F.struct(
        F.col("rank").alias("at"), "hash", *carried).alias("node")).repartition("grp", "block")
    for level in range(LEVELS):  # after `level` digits: nodes at rank div RUN ** level
        runs = rolled.groupBy("grp", "block", "n", F.floor(F.col("rank") / RUN).cast("long").alias("rank")) \
            .agg(F.array_sort(F.collect_list("node")).alias("children"))  # RUN children at most
        text = F.array_join(F.transform("children", lambda c: c["hash"]), "")
        alone = _above(F.col("n"), level) == 1
        rolled = runs.select("grp", "block", "n", "rank", F.struct(
            F.col("rank").alias("at"), F.when(alone, F.col("children")[0]["hash"]).otherwise(digest(text)).alias("hash"),
            "children").alias("node"))
    rolled = cut(rolled)
    more = -(-most // RUN ** LEVELS)
    if more <= 1:
        return rolled.select("grp", "n", "node", F.array().cast(STEP).alias("path"), F.col("node.hash").alias("top"))
    above = descend(rise(rolled.select("grp", _above(F.col("n"), LEVELS).alias("n"), F.col("block").alias("rank"),
                                       "node.hash"), more))
    return rolled.join(above.select("grp", F.col("rank").alias("block"), "path", "top"), ["grp", "block"]) \
        .select("grp", "n", "node", "path", "top")


def descend(tree: DataFrame) -> DataFrame:
    """The nodes that :func:`rise` was given, without ``n`` and with their ``path`` and ``top``, from its rows.

    Levels of which a group has one node are no step of a path.
    """
    for level in reversed(range(LEVELS)):
        apart = tree.select("grp", "n", "path", "top", F.explode(_sides(F.col("node.children"))).alias("s"))
        step = F.array(F.struct("s.left", "s.right"))
        path = F.when(_above(F.col("n"), level) == 1, F.col("path")).otherwise(F.concat(step, F.col("path")))
        tree = apart.select("grp", "n", F.col("s.node").alias("node"), path.alias("path"), "top")
    carried = [c for c in tree.schema["node"].dataType.names if c not in ("at", "hash")]
    return tree.select("grp", F.col("node.at").alias("rank"), "node.hash",
                       *[F.col("node")[c].alias(c) for c in carried], "path", "top")


def manifest(rows: DataFrame, fields: Sequence[str], group: str, order: Sequence[str], keep: Sequence[str] = (),
             others: Mapping[str, Column] | None = None) -> DataFrame:
    """A row's ``leaf``, the ``subroot`` of its group, the ``root`` of all, its ``path``, and the columns ``keep``.

    The leaf is :func:`leaf` of ``fields``.  In each group of equal ``group``
    (a string; null is a group of its own, and the first) leaves ascend by the ``order`` columns (nulls
    first), then by digest; rows equal in all of these are equal leaves, in any order among themselves.
    While more than one node remains, eight consecutive ones (the last run may have fewer,
    even one) become the digest of their digests.  Groups ascend by the
    bytes of their name; their subroots become the root likewise.  A lone leaf or subroot stays as it is.
    ``path`` has one ``left, right`` for each level that was joined, from the leaf to
    the root: :func:`fold` gives the root again.

    ``others`` gives further digests of the same rows, such as the leaves of
    a changed copy.  An empty table gives an empty manifest.  The output holds only the columns named here.
    """
    others = dict(others or {})
    kept = [f"keep{i}" for i in range(len(keep))]
    more = [f"other{i}" for i in range(len(others))]
    sort = [f"order{i}" for i in range(len(order))]
    slim = rows.select(
        F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("grp"), leaf([F.col(c) for c in fields]).alias("hash"),
        *[F.col(c).alias(k) for c, k in zip(order, sort, strict=True)],
        *[F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)],
        *[c.alias(k) for c, k in zip(others.values(), more, strict=True)])
    slim = cut(slim.withColumn("same", F.monotonically_increasing_id()))  # spreads equal rows over ranges
    placed = numbered(slim, "grp", *sort, "hash", "same", to="number").drop("same", *sort)

    groups = cut(placed.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.min("number").alias("first")))
    total, most, count = groups.agg(F.sum("n"), F.max("n"), F.count(F.lit(1))).first()
    ranked = join_counted(placed, groups, ["grp"], "n", total or 0).select(
        "grp", "n", (F.col("number") - F.col("first")).alias("rank"), "hash", *kept, *more)
    tree = rise(ranked, most or 0)

    subroots = tree.groupBy("grp").agg(F.count(F.lit(1)).alias("blocks"), F.first("top").alias("hash"))
    subroots = numbered(subroots, "grp", to="rank").select(
        F.lit("").alias("grp"), F.lit(count).cast("long").alias("n"), "rank", "hash", F.col("grp").alias("of"), "blocks")
    over = descend(rise(subroots, count)).select(
        F.col("of").alias("grp"), "blocks", F.col("path").alias("rest"), F.col("top").alias("root"))
    tree = join_counted(tree, cut(over), ["grp"], "blocks", tree.count())
    whole = descend(tree.withColumns({"path": F.concat("path", "rest"), "top": F.struct("top", "root")}))
    named = dict(zip(kept, keep, strict=True)) | dict(zip(more, others, strict=True))
    return whole.select(*[F.col(k).alias(c) for k, c in named.items()], F.col("hash").alias("leaf"),
                        F.col("top.top").alias("subroot"), "top.root", "path")
