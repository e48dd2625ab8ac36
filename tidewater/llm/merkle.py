"""Merkle manifest of a dataset, in blocks of van Emde Boas layout.

The leaves of a group (a language) stand in one order; two consecutive nodes, or
a last one alone, are hashed to the node above them until one is left, the group's
subroot, and the subroots form a tree of their own, whose top is the dataset's
root. The trees are cut into aligned blocks of ``height`` levels: a block is
built by one task from its leaves, and the roots of a group's blocks are the
leaves of the next round of blocks. Rounds end when every group is one block;
four of them hold a million million leaves.

A block is one byte string in van Emde Boas layout: the subtree of the upper half
of its levels, then the subtrees below from left to right, each split again at
half its height until it is one node. Where a node lies is arithmetic on its
depth and index (:func:`addresses`), which both construction and the lookup of
siblings use; a path from leaf to root touches few stretches of the string
whatever the size of a cache line.

Defined results: null fields are hashed as ``-``; rows with null or equal ids
stand in the order of their leaf digests, null ids first; a null language is a
group of its own and the first one; repeated rows are a leaf each; an empty table
has no root and gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache, reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import scratch, written
from tidewater.llm.positions import with_positions

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels of a block above its leaves: 1,024 leaves, 64 KB.
HEIGHT = 10
SIZE = 32  # bytes of a digest

BLOCKS = "grp string, block long, nodes_in_group long, root binary, nodes binary"
PATHS = "grp string, position long, digest binary, doc_id long, claimed binary, path string, siblings binary, subroot binary, root binary"


def leaf(columns: Sequence[Column]) -> Column:
    """Digest of a row, 32 bytes: each field as ``-`` if null, else the number of
    its bytes, a colon and the value."""
    def spelled(c: Column) -> Column:
        value = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(spelled, columns)), 256))


def addresses(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where the nodes ``index`` at ``depth`` (0 is the root) lie in a tree of
    ``levels`` levels, counted in nodes."""
    if levels == 1:
        return np.zeros_like(index)
    upper = levels // 2
    if depth < upper:
        return addresses(upper, depth, index)
    lower, below = levels - upper, depth - upper
    tree = index >> below
    inside = addresses(lower, below, index & ((1 << below) - 1))
    return (1 << upper) - 1 + tree * ((1 << lower) - 1) + inside


@lru_cache(maxsize=64)
def _rows(levels: int, depth: int) -> np.ndarray:
    """Addresses of all nodes at one depth, from left to right."""
    return addresses(levels, depth, np.arange(1 << depth))


def _height(in_group: int, height: int) -> int:
    """Levels above the leaves of a block, of a group of so many leaves: what one
    block needs to come to one node, the full height where there are more."""
    return min(height, (in_group - 1).bit_length())


def _count(leaves: int, up: int) -> int:
    """Nodes so many levels above so many leaves."""
    return -(-leaves >> up)


def build(digests: np.ndarray, height: int) -> np.ndarray:
    """The nodes of a block, from its leaves' digests (n x 32 bytes)."""
    levels = height + 1
    nodes = np.zeros(((1 << levels) - 1, SIZE), dtype=np.uint8)
    nodes[_rows(levels, height)[: len(digests)]] = digests
    for depth in range(height - 1, -1, -1):
        below, above = _count(len(digests), height - depth - 1), _count(len(digests), height - depth)
        kids = nodes[_rows(levels, depth + 1)[:below]].tobytes().hex().encode()
        pair = 4 * SIZE  # two digests as hex text
        sums = b"".join(sha256(kids[k * pair : (k + 1) * pair]).digest() for k in range(above))
        nodes[_rows(levels, depth)[:above]] = np.frombuffer(sums, dtype=np.uint8).reshape(-1, SIZE)
    return nodes


def siblings(nodes: np.ndarray, leaves: int, height: int, index: np.ndarray) -> tuple[list[str], list[bytes]]:
    """For the leaves ``index`` of a block: on which side their path's siblings
    stand, level by level (``l``, ``r``, or ``-`` for none), and the siblings."""
    levels, sides, found = height + 1, [], []
    for up in range(height):
        node = index >> up
        other = node ^ 1
        there = other < _count(leaves, up)
        sides.append(np.where(there, np.where(other < node, b"l", b"r"), b"-"))
        found.append(nodes[addresses(levels, height - up, np.where(there, other, node))])
    if not height:
        return [""] * len(index), [b""] * len(index)
    paths = [b"".join(row).decode() for row in np.stack(sides, axis=1).tolist()]
    every = np.stack(found, axis=1)
    return paths, [every[k][np.frombuffer(p.encode(), dtype="S1") != b"-"].tobytes() for k, p in enumerate(paths)]


def fold(digest: bytes, path: str, others: bytes) -> bytes:
    """The root that a leaf, its path and its siblings lead to."""
    at = 0
    for side in path:
        parts = [digest]
        if side != "-":
            parts.insert(0 if side == "l" else 1, others[at : at + SIZE])
            at += SIZE
        digest = sha256(b"".join(parts).hex().encode()).digest()
    return digest


def _digests(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, SIZE)


def _round(nodes: DataFrame, height: int) -> DataFrame:
    """The blocks over ``nodes`` (grp, position, nodes_in_group, digest)."""

    def block(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("position")
        in_group = rows["nodes_in_group"][0].as_py()
        made = build(_digests(rows["digest"]), _height(in_group, height))
        values = [[rows["grp"][0].as_py()], [key[1].as_py()], [in_group], [made[0].tobytes()], [made.tobytes()]]
        names = ["grp", "block", "nodes_in_group", "root", "nodes"]
        types = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.Table.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names)

    blocks = nodes.withColumn("block", F.shiftright("position", height))
    return blocks.groupBy("grp", "block").applyInArrow(block, BLOCKS)


def _above(blocks: DataFrame, height: int) -> DataFrame:
    """The roots of blocks, as the nodes of the next round."""
    return blocks.where(F.col("nodes_in_group") > 1 << height).select(
        "grp", F.col("block").alias("position"), F.ceil(F.col("nodes_in_group") / (1 << height)).cast("long").alias("nodes_in_group"),
        F.col("root").alias("digest"),
    )


def build_trees(nodes: DataFrame, path: str, height: int = HEIGHT) -> list[DataFrame]:
    """The block tables over ``nodes``, one for each round, written under ``path``."""
    rounds = []
    while not rounds or not nodes.isEmpty():
        rounds.append(written(_round(nodes, height), f"{path}/round{len(rounds)}"))
        nodes = _above(rounds[-1], height)
    return rounds


def subroots(rounds: list[DataFrame], height: int = HEIGHT) -> DataFrame:
    """grp, root: of each tree."""
    done = [r.where(F.col("nodes_in_group") <= 1 << height).select("grp", "root") for r in rounds]
    return reduce(DataFrame.unionByName, done)


def _descend(nodes: DataFrame, blocks: DataFrame, upper: DataFrame, height: int) -> DataFrame:
    """Paths of ``nodes`` to the root: within their blocks, then their blocks' own
    (``upper``: grp, block, path, siblings, subroot, root)."""

    def lookup(key: tuple, rows: pa.Table, block: pa.Table) -> pa.Table:
        in_group, first = block["nodes_in_group"][0].as_py(), key[1].as_py() << height
        up = _height(in_group, height)
        store = np.frombuffer(block["nodes"][0].as_py(), dtype=np.uint8).reshape(-1, SIZE)
        index = rows["position"].to_numpy() - first
        paths, others = siblings(store, min(in_group - first, 1 << height), up, index)
        path, sib = block["path"][0].as_py(), block["siblings"][0].as_py()
        same = {c: pa.array([block[c][0].as_py()] * len(paths), pa.binary()) for c in ("subroot", "root")}
        out = rows.select(["grp", "position", "digest", "doc_id", "claimed"])
        out = out.append_column("path", pa.array([p + path for p in paths], pa.string()))
        out = out.append_column("siblings", pa.array([o + sib for o in others], pa.binary()))
        return out.append_column("subroot", same["subroot"]).append_column("root", same["root"])

    keyed = nodes.withColumn("block", F.shiftright("position", height)).select("grp", "block", "position", "digest", "doc_id", "claimed")
    stored = blocks.select("grp", "block", "nodes_in_group", "nodes").join(upper, ["grp", "block"])
    return keyed.groupBy("grp", "block").cogroup(stored.groupBy("grp", "block")).applyInArrow(lookup, PATHS)


def paths(nodes: DataFrame, rounds: list[DataFrame], tops: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Path of every node to the root. ``nodes`` has grp, position, digest, doc_id
    and claimed; ``tops`` what lies above each tree: grp, path, siblings, subroot,
    root."""
    upper = None
    for k in range(len(rounds) - 1, -1, -1):
        last = rounds[k].where(F.col("nodes_in_group") <= 1 << height).select("grp", "block").join(tops, "grp")
        last = last.select("grp", "block", "path", "siblings", "subroot", "root")
        upper = last if upper is None else last.unionByName(upper)
        none = {"doc_id": F.lit(None).cast("long"), "claimed": F.lit(None).cast("binary")}
        these = _above(rounds[k - 1], height).withColumns(none) if k else nodes
        upper = _descend(these, rounds[k], upper, height)
        if k:
            upper = upper.select("grp", F.col("position").alias("block"), "path", "siblings", "subroot", "root")
    return upper


def manifest(
    docs: DataFrame, claimed: Column | None = None, fields: Sequence[str] = FIELDS, group: str = "lang", height: int = HEIGHT
) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, ``path`` and ``siblings``
    up to the root, and ``folded``, the root that the ``claimed`` digest (default:
    the leaf itself) leads to with them. Digests are 32 bytes. Each row's leaf is
    the digest of ``fields``; a tree holds the rows of one ``group`` by doc_id."""
    path = scratch(docs.sparkSession, "merkle")
    own = leaf([F.col(c) for c in fields])
    name = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))  # null comes before every name
    leaves = docs.select(
        name.alias("grp"), F.col("doc_id").cast("long").alias("doc_id"), own.alias("digest"),
        (F.lit(None) if claimed is None else claimed).cast("binary").alias("claimed"),
    )
    leaves = written(leaves, f"{path}/digests")  # the texts are read once
    order = [F.col(c).asc_nulls_first() for c in ("doc_id", "digest", "claimed")]
    placed = written(
        with_positions(leaves, "grp", order, f"{path}/order").withColumnRenamed("group_rows", "nodes_in_group"), f"{path}/leaves"
    )
    trees = build_trees(placed, f"{path}/trees", height)
    tops = subroots(trees, height).select(F.lit("").alias("grp"), F.col("grp").alias("of"), F.col("root").alias("digest"))
    tops = with_positions(tops, "grp", [F.col("of")], f"{path}/groups").withColumnRenamed("group_rows", "nodes_in_group")
    tops = written(tops, f"{path}/subroots")
    top = build_trees(tops, f"{path}/top", height)
    end = subroots(top, height).select("grp", F.lit("").alias("path"), F.lit(b"").alias("siblings"), F.lit(b"").alias("subroot"), "root")
    none = {"doc_id": F.lit(None).cast("long"), "claimed": F.lit(None).cast("binary")}
    above = paths(tops.withColumns(none), top, end, height)
    named = tops.select("of", "position").join(above.drop("grp"), "position")
    named = written(named.select(F.col("of").alias("grp"), "path", "siblings", F.col("digest").alias("subroot"), "root"), f"{path}/tops")
    return folded(paths(placed, trees, named, height))


def folded(proofs: DataFrame) -> DataFrame:
    """Adds ``folded`` to doc_id, digest, claimed, path, siblings, subroot, root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in ("digest", "claimed", "path", "siblings")), strict=True)
            roots = [fold(d if c is None else c, p, s) for d, c, p, s in rows]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(roots, pa.binary())], [*b.schema.names, "folded"])

    rows = proofs.select("doc_id", F.col("digest"), "claimed", "subroot", "root", "path", "siblings")
    out = rows.mapInArrow(run, "doc_id long, digest binary, claimed binary, subroot binary, root binary, path string, siblings binary, folded binary")
    return out.withColumnRenamed("digest", "leaf")
