"""Near-duplicate vectors by a pivot-permutation index.

Every vector is described by its ``prefix`` nearest pivots, a bounded sample of
the vectors themselves.  Inverted lists (label, pivot) bring together the
vectors that have the pivot in their description; a pair that shares at least
``shared`` pivots is verified by its cosine in double precision, in the list of
the smallest pivot it shares.  Long lists are cut into blocks, and every pair
of blocks is a task of its own; within a task the cosines are one matrix
product, and per vector only its number of links and the edges of a spanning
forest leave it.  Equal vectors are one class with a count.

The number of pivots follows the number of vectors, so a list keeps its size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import graph

LIST_SIZE = 400                 # aimed-at length of an inverted list
MAX_PIVOTS = 4096               # of up to some kilobytes each: broadcast
BLOCK = 1024                    # vectors of a block


def _usable(vector):
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)        # norms without overflow
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(flat), -1)


def _describer(pivots: dict[int, np.ndarray], prefix: int):
    units = {d: _unit(p) for d, p in pivots.items()}

    def describe(batches):
        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index("vector"))
            out = [None] * len(vectors)
            sizes = np.array([len(v) for v in vectors])
            for d in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == d)
                if d not in units:
                    for i in at.tolist():               # no pivot of this length: one list for all
                        out[i] = [0]
                    continue
                k = min(prefix, len(units[d]))
                x = _unit(_matrix(vectors.take(pa.array(at))))
                for first in range(0, len(at), 512):
                    near = np.argsort(-(x[first:first + 512] @ units[d].T), axis=1, kind="stable")[:, :k]
                    for i, row in zip(at[first:first + 512].tolist(), near.tolist()):
                        out[i] = row
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))],
                                             [*batch.schema.names, "pivots"])
    return describe


def _verifier(threshold: float, shared: int):
    def verify(key, table):
        _, _, pivot, bi, bj = (k.as_py() for k in key)
        nodes = table.column("node").to_numpy()
        x = _unit(_matrix(table.column("vector")))
        near = x @ x.T >= threshold
        i, j = np.nonzero(np.triu(near, 1))
        if len(i):
            described = _matrix(table.column("pivots")).astype(np.int64)
            keep = np.zeros(len(i), bool)
            for first in range(0, len(i), 1 << 16):
                a, b = described[i[first:first + (1 << 16)]], described[j[first:first + (1 << 16)]]
                common = (a[:, :, None] == b[:, None, :]).any(axis=2)
                smallest = np.where(common, a, np.iinfo(np.int64).max).min(axis=1)
                keep[first:first + (1 << 16)] = (common.sum(axis=1) >= min(shared, described.shape[1])) \
                    & (smallest == pivot)
            i, j = i[keep], j[keep]
        mask = np.zeros(near.shape, bool)
        mask[i, j] = mask[j, i] = True
        return graph.links(nodes, table.column("copies").to_numpy(), table.column("block").to_numpy(), bi == bj, mask)
    return verify


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, prefix: int = 12, shared: int = 2,
                    vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
                    max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """Per row: ``vec_id, n_links`` (other rows linked directly),
    ``component_id`` (smallest id reachable by links) and ``kept``.

    Rows link only if their labels are equal and not null and their vectors
    have the same length.  Vectors that are null, empty, zero or hold null or
    non-finite components, and rows with a null id, link with nothing and are
    their own component.  Rows with the same id are rows of their own that
    link if their vectors do.  Other columns are not read.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"),
                          F.col(embedding).cast("array<double>").alias("vector"))
    usable = rows.where(_usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    classes = usable.groupBy("label", "vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")) \
        .withColumn("size", F.size("vector")).checkpoint()
    number = classes.count()
    want = int(min(max_pivots, max(prefix, number * prefix // LIST_SIZE)))
    sample = classes.orderBy(F.xxhash64("node"), "node").limit(want).select("size", "vector").collect()
    pivots = {d: np.array([r.vector for r in sample if r.size == d]) for d in {r.size for r in sample}}
    described = classes.mapInArrow(
        _describer(pivots, prefix), "label " + dict(classes.dtypes)["label"] +
        ", vector array<double>, node long, copies long, size int, pivots array<int>")
    postings = described.select("label", "size", "node", "copies", "vector", "pivots",
                                F.explode("pivots").alias("pivot"))
    lengths = described.select("label", "size", F.explode("pivots").alias("pivot")) \
        .groupBy("label", "size", "pivot").count().where("count > 1") \
        .select("label", "size", "pivot", F.ceil(F.col("count") / BLOCK).alias("blocks"))
    dealt = graph.block_pairs(postings.join(lengths, ["label", "size", "pivot"]), "pivot", "blocks", "node") \
        .withColumn("vector", F.col("vector").cast("array<double>"))
    linked = dealt.groupBy("label", "size", "pivot", "bi", "bj") \
        .applyInArrow(_verifier(threshold, shared), graph.LINK_SCHEMA)
    count, component = graph.summary(linked)
    classes = classes.join(count, "node", "left").join(component, "node", "left").select(
        "label", "vector", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"))
    found = usable.join(classes, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    rest = rows.where(~(_usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull())) \
        .select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"),
                                                                 F.lit(True)))
