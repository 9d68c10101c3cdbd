"""Links between rows as a graph: connected components, and the counting of
links within bounded blocks of candidates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EDGES = 1 << 20                 # that one task contracts
LINK_SCHEMA = "a long, b long, n long"
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges, and the smallest node that these edges connect
    each with.  Every root hooks to a smaller neighbour and all paths are
    compressed, so each pass at least halves the roots that have edges left."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while len(a):
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
        a, b = root[a], root[b]
        a, b = a[a != b], b[a != b]
    return nodes, nodes[root]


def _contract(batches):
    held = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches]
    if held:
        node, root = contract(*map(np.concatenate, zip(*held)))
        yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node) for every node of ``edges`` (a, b).

    Tasks of about ``EDGES`` edges first contract those they hold, without a
    shuffle: a graph that fits one of them is done.  The stars of several
    tasks are joined by alternating large and small stars: every round links
    the neighbours of a node to the smallest of them, so the number of rounds
    grows with the logarithm of the nodes.  All groups are minima with partial
    aggregation.  The minima are checkpointed before they are joined, so that
    side is a plain shuffle and AQE splits a hub, which is a skewed join key.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").checkpoint()
    tasks = max(1, -(-e.count() // EDGES))
    e = e.coalesce(tasks).mapInArrow(_contract, "u long, v long").checkpoint()
    if tasks == 1:
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    e, last = e.where("u <> v"), None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).checkpoint()
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = small.unionByName(low.select("u", F.col("m").alias("v"))).distinct().checkpoint()
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def block_pairs(rows: DataFrame, group: str, blocks: str, node: str) -> DataFrame:
    """Deal the members of each group to ``blocks`` blocks by a hash of the
    node and give every pair of blocks (``bi`` <= ``bj``) its members.  A
    group of one block stays one; a hot one becomes many small tasks."""
    own = F.pmod(F.xxhash64(node), F.col(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1))
    return rows.withColumn("block", own).withColumn("_other", other) \
        .withColumns({"bi": F.least("block", "_other"), "bj": F.greatest("block", "_other")}).drop("_other", blocks)


def forest(mask: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean matrix."""
    edges: list[tuple[int, int]] = []
    fresh = np.ones(len(mask), bool)
    fresh[~mask.any(axis=1)] = False
    for root in range(len(mask)):
        if not fresh[root]:
            continue
        fresh[root] = False
        stack = [root]
        while stack:
            i = stack.pop()
            found = np.flatnonzero(mask[i] & fresh)
            fresh[found] = False
            edges += [(i, j) for j in found.tolist()]
            stack += found.tolist()
    return edges


def links(nodes: np.ndarray, copies: np.ndarray, block: np.ndarray, same_block: bool, mask: np.ndarray) -> pa.Table:
    """Rows of ``LINK_SCHEMA`` for the linked pairs of one pair of blocks: per
    node the rows it links to (``b`` null), and the edges of a spanning forest
    (``n`` 0).  The pairs themselves are not emitted."""
    mask = mask & ~np.eye(len(nodes), dtype=bool)
    if not same_block:
        mask &= block[:, None] != block[None, :]
    count = mask @ copies.astype(np.int64)
    some = np.flatnonzero(count)
    edges = forest(mask)
    a = [*nodes[some].tolist(), *(int(nodes[i]) for i, _ in edges)]
    b = [*[None] * len(some), *(int(nodes[j]) for _, j in edges)]
    n = [*count[some].tolist(), *[0] * len(edges)]
    return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())],
                                schema=_LINKS)


def summary(linked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows of ``LINK_SCHEMA``: ``node, linked`` and ``node, component``."""
    linked = linked.checkpoint()
    count = linked.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("linked"))
    return count, components(linked.where("b is not null").select("a", "b"))
