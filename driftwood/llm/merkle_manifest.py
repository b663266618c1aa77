"""Merkle manifest of a table by cogrouped subtree exchange.

Every row is a leaf, every source a tree of its leaves in id order, and the
roots of the sources make the top tree. Trees are cut into superblocks of
``ARITY ** levels`` consecutive nodes. One superblock's nodes meet in one
task, which reduces them to their top node; the tops are the nodes of the
next, far smaller round. On the way back each superblock is cogrouped with
the outer nodes that its proofs need, the siblings between its top node and
the root, so that one function finishes the local reduction, joins the
proofs and folds them. A superblock is bounded, whatever a source holds.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from driftwood.llm.common import cut

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(values: list[Column]) -> Column:
    """Lowercase hex sha256 of the fields, each ``-`` for null, else its UTF-8
    byte count, a colon and its text."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.when(t.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts)), 256)


def _digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def reduced(nodes: list[str], levels: int | None) -> list[list[str]]:
    """Nodes level by level, the given ones first. ``levels`` reductions, or
    (None) as many as leave one node."""
    out = [nodes]
    while len(out) <= levels if levels is not None else len(out[-1]) > 1:
        last = out[-1]
        out.append([_digest(last[i:i + ARITY]) for i in range(0, len(last), ARITY)])
    return out


def siblings(tree: list[list[str]], at: int) -> tuple[list[str], list[str]]:
    """What stands left and right of the node ``at`` of the lowest level in its
    run, and so on for the runs above: one text for each level and side."""
    left, right = [], []
    for level in tree[:-1]:
        first = at - at % ARITY
        left.append("".join(level[first:at]))
        right.append("".join(level[at + 1:first + ARITY]))
        at //= ARITY
    return left, right


def folded(node: str, left: list[str], right: list[str]) -> str:
    """The top node that ``node`` and the siblings give."""
    for a, b in zip(left, right):
        node = _digest([a, node, b])
    return node


def positions(nodes: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``nodes`` with ``pos``, their number (from 0) within their tree, and
    ``total``, the tree's nodes. Rows are dealt by ranges and numbered within
    a range; only a count per range and tree is ordered within a tree."""
    ranged = cut(nodes.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
                 .withColumn("__row", F.monotonically_increasing_id()))
    part = F.shiftright("__row", 33).alias("__part")
    counts = ranged.groupBy(tree, part).agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__n"))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(tree, "__part", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
                            F.sum("__n").over(whole).alias("total"))
    return (ranged.withColumn("__part", part).join(offsets, [tree, "__part"])
            .withColumn("pos", F.col("__row") - F.col("__first") + F.col("__before"))
            .drop("__row", "__part", "__first", "__before"))


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / ARITY ** levels).cast("long"))


def _local(nodes: pd.DataFrame, levels: int) -> list[list[str]]:
    """Levels of one superblock; a tree of one superblock is reduced to its root."""
    one = nodes["total"].iloc[0] <= ARITY ** levels
    return reduced(nodes["digest"].tolist(), None if one else levels)


def tops(nodes: DataFrame, levels: int) -> DataFrame:
    """Top node of each superblock of ``nodes`` (``tree, pos, total, digest``),
    as the nodes of a tree of superblocks, with the same columns."""
    size = ARITY ** levels

    def top(group: pd.DataFrame) -> pd.DataFrame:
        last = _local(group.sort_values("pos"), levels)[-1][0]
        return pd.DataFrame({"tree": group["tree"].iloc[:1], "pos": group["block"].iloc[:1],
                             "total": -(-group["total"].iloc[:1] // size), "digest": last})

    return cut(_blocks(nodes.select("tree", "pos", "total", "digest"), levels).groupBy("tree", "block")
               .applyInPandas(top, "tree string, pos long, total long, digest string"))


def paths(nodes: DataFrame, levels: int) -> DataFrame:
    """For each node (``tree, pos, total, digest``): ``tree, pos, root`` and
    ``left, right``, its siblings up to the root of its tree."""
    if nodes.where("total > 1").isEmpty():
        nothing = F.array().cast("array<string>")
        return nodes.select("tree", "pos", F.col("digest").alias("root"), nothing.alias("left"), nothing.alias("right"))
    outer = paths(tops(nodes, levels), levels)
    return cut(exchange(nodes.select("tree", "pos", "total", "digest"), outer, levels,
                        "tree string, pos long, root string, left array<string>, right array<string>",
                        lambda node, above, left, right: (node.tree, node.pos, above.root, left, right)))


def exchange(nodes: DataFrame, outer: DataFrame, levels: int, schema: str, row) -> DataFrame:
    """Cogroup the superblocks of ``nodes`` with the one row of ``outer``
    (``tree``, ``pos`` of the superblock, ``left``, ``right``) that each needs;
    ``row(node, above, left, right)`` gives the row of a node from that outer
    row and the node's siblings up to the root."""
    names = [f.split()[0] for f in schema.split(", ")]

    def finish(own: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        if not len(own):
            return pd.DataFrame(columns=names)
        own = own.sort_values("pos")
        tree, above = _local(own, levels), next(above.itertuples(index=False))
        a, b = list(above.left), list(above.right)
        out = []
        for at, node in enumerate(own.itertuples(index=False)):
            left, right = siblings(tree, at)
            out.append(row(node, above, left + a, right + b))
        return pd.DataFrame(out, columns=names)

    return _blocks(nodes, levels).groupBy("tree", "block").cogroup(
        outer.withColumnRenamed("pos", "block").groupBy("tree", "block")).applyInPandas(finish, schema)


def manifest(docs: DataFrame, tampered: Column | None = None, levels: int = 7, proofs: bool = True) -> DataFrame:
    """Leaf, roots and proof of every row of ``docs`` (``doc_id, source, lang,
    n_chars, text``; other columns play no part), and whether its proof holds.

    ``tampered``: the text to check against the manifest (default: the row's
    own). Returns one row per input row: ``doc_id, source, leaf, subroot,
    root, proof_sha256`` (of all siblings, level by level up to the root, left
    to right), ``folded_root`` (from the checked row's leaf), ``verified``
    and, with ``proofs``, ``left`` and ``right``: for each level the siblings
    on either side of the node, joined. Leaves ascend by doc_id within a
    source, null first, rows with one doc_id by leaf; sources ascend by their
    bytes, null first. Null sources are one tree; a null or empty field is
    told apart in the leaf. Rows that repeat are leaves of their own. An empty
    table gives an empty manifest. A superblock has 3 to the power ``levels``
    nodes, which bounds what a task holds.
    """
    checked = F.col("text") if tampered is None else tampered
    own = [F.col(c) for c in FIELDS]
    tree = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("s"), F.col("source")))
    leaves = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), tree.alias("tree"),
                             leaf_digest(own).alias("digest"),
                             leaf_digest([*own[:4], checked]).alias("checked")))
    placed = cut(positions(leaves, "tree", ["doc_id", "digest"])
                 .withColumn("id", F.col("doc_id").cast("string")).drop("doc_id"))
    inner = paths(tops(placed, levels), levels)
    # The sources' roots are the leaves of one more tree.
    roots = inner.where("pos = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"),
                                          F.col("root").alias("digest"))
    named = cut(positions(roots, "tree", ["name"]))
    above = paths(named.drop("name"), levels).join(named.select("pos", "name"), "pos")
    outer = (inner.withColumnRenamed("root", "subroot").withColumnsRenamed({"left": "l", "right": "r"})
             .join(above.select(F.col("name").alias("tree"), "root", "left", "right"), "tree")
             .select("tree", "pos", "subroot", "root", F.concat("l", "left").alias("left"),
                     F.concat("r", "right").alias("right")))

    def proven(node, above, left: list[str], right: list[str]) -> tuple:
        proof = _digest([x for pair in zip(left, right) for x in pair])
        found = (node.tree, node.id, node.digest, above.subroot, above.root, proof, folded(node.checked, left, right))
        return found + ((left, right) if proofs else ())

    schema = ("tree string, id string, leaf string, subroot string, root string, proof_sha256 string, "
              "folded_root string")
    out = exchange(placed, outer, levels, schema + ", left array<string>, right array<string>" * proofs, proven)
    return (out.withColumn("source", F.when(F.col("tree") != "-", F.expr("substring(tree, 2)")))
            .withColumn("verified", F.col("folded_root") == F.col("root"))
            .select(F.col("id").cast("long").alias("doc_id"), "source", "leaf", "subroot", "root", "proof_sha256",
                    "folded_root", "verified", *(("left", "right") if proofs else ())))
