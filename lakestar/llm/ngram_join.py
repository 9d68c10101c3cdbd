"""N-gram Jaccard self-join by chosen paths.

Every document is the set of its shingles of ``n`` words.  In each of ``runs``
independent runs the sets are split on sampled shared tokens: a set goes to the
bucket of its minimum under a random order of all shingles, so two sets with
Jaccard similarity s meet with probability s.  Buckets of more than
``BUCKET`` sets are split again by the next order, up to ``LEVELS`` times; the
small ones are compared by brute force on a sketch of minima, which leaves the
edges of a spanning forest per bucket.  Runs are repeated until a pair at the
threshold is met with probability ``RECALL`` even if every level splits its
bucket in every run, s ** LEVELS a run: 18 runs for s = 0.8.

The connected candidates are then verified exactly: every pair within a
candidate component is compared by its true similarity, in blocks, one task
for each pair of blocks.  Links are counted where they are verified; only
counts and the edges of spanning forests leave a task.  Documents with equal
texts are one class with a count.

Nothing is capped: a bucket still large after the last level joins its sets to
one candidate component, which the blocks verify.
"""

from __future__ import annotations

from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import graph
from .textops import U64, mix, prefix_hash, range_hash, returns_memory, row_blocks, utf8, words

RECALL, LEVELS = 0.9999, 4
BUCKET = 256                    # sets that are compared by brute force
SKETCH_LEVELS = 2               # minima per run that a sketch holds
BLOCK_ROWS, BLOCK_BYTES = 1024, 4 << 20
TEXT_BYTES = 2 << 20


def runs_for(recall: float, threshold: float, levels: int) -> int:
    """Runs until a pair at ``threshold`` that is split at all ``levels`` in
    each of them is met at least once with probability ``recall``."""
    missed = 1 - threshold ** levels
    return 1 if missed <= 0 else max(1, ceil(log(1 - recall) / log(missed)))


def shingles(raw: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words of every row (a shorter row has one,
    of all its words), and the offsets of the rows in them."""
    low, start, end, first = words(raw, offsets)
    word = range_hash(prefix_hash(low), start, end)
    count = np.diff(first)
    size = np.where(count == 0, 0, np.maximum(count - n + 1, 1))
    cuts = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(cuts[-1]) + np.repeat(first[:-1] - cuts[:-1], size)
    width = np.repeat(np.minimum(count, n), size)
    out = width.astype(U64)
    padded = np.concatenate([word, np.zeros(n, U64)])
    for k in range(n):
        out = np.where(k < width, mix(out * U64(0x9E3779B97F4A7C15) + padded[at + k]), out)
    return out, cuts


def _minima(hashes: np.ndarray, cuts: np.ndarray, orders: int) -> np.ndarray:
    """Minimum of every non-empty row under ``orders`` random orders."""
    some = np.flatnonzero(np.diff(cuts) > 0)
    out = np.empty((len(some), orders), np.uint32)
    scratch = np.empty_like(hashes)
    seeds = mix(np.arange(1, 2 * orders + 1, dtype=U64))
    for k in range(orders):
        np.multiply(hashes, seeds[2 * k] | U64(1), out=scratch)
        np.add(scratch, seeds[2 * k + 1], out=scratch)
        np.right_shift(scratch, U64(32), out=scratch)
        out[:, k] = np.minimum.reduceat(scratch, cuts[some])
    return out


def _signer(n: int, orders: int):
    @returns_memory
    def sign(batches):
        for batch in batches:
            column = batch.schema.get_field_index("text")
            raw_all, offsets = utf8(batch.column(column))
            for a, b in row_blocks(offsets, TEXT_BYTES):
                hashes, cuts = shingles(raw_all[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], n)
                some = np.diff(cuts) > 0
                flat = _minima(hashes, cuts, orders).view(np.int32).ravel()
                ends = np.concatenate([[0], np.cumsum(np.where(some, orders, 0))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))
                block = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*(block.column(i) for i in range(block.num_columns) if i != column), lists],
                    [*(c for c in block.schema.names if c != "text"), "minima"])
    return sign


def _compare(sketch: int, need: int):
    def compare(key, table):
        nodes = table.column("node").to_numpy()
        rows = table.column("sketch").combine_chunks().flatten().to_numpy().reshape(len(nodes), sketch)
        same = np.zeros((len(nodes), len(nodes)), np.int16)
        for k in range(sketch):
            same += rows[:, k][:, None] == rows[:, k][None, :]
        edges = graph.forest((same >= need) & ~np.eye(len(nodes), dtype=bool))
        return pa.table({"a": pa.array([nodes[i] for i, _ in edges], pa.int64()),
                         "b": pa.array([nodes[j] for _, j in edges], pa.int64())})
    return compare


def candidate_edges(classes: DataFrame, runs: int, levels: int = LEVELS) -> DataFrame:
    """Edges (a, b) that connect the sets which the runs find alike, from a
    table ``node, minima``."""
    sketch = runs * SKETCH_LEVELS
    # 16 of 36 equal minima: a pair at 0.8 falls below with probability 1e-6
    need = int(sketch * 0.45)
    walks = classes.select("node", F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(runs - 1)),
        lambda r: F.struct(r.alias("run"), F.slice("minima", r * levels + 1, F.lit(levels)).alias("tokens")))).alias("w")) \
        .select("node", F.col("w.tokens").alias("tokens"),
                F.xxhash64("w.run", F.element_at("w.tokens", 1)).alias("path"))
    edges, groups = None, None
    for level in range(1, levels + 1):
        # checkpointed: a plain side of the join, so a hot path is split
        sizes = walks.groupBy("path").count().where("count > 1").checkpoint()
        met = walks.join(sizes, "path")
        small = met.where(F.col("count") <= BUCKET).groupBy("path") \
            .agg(F.array_sort(F.collect_list("node")).alias("nodes")).select("nodes")
        groups = small if groups is None else groups.unionByName(small)
        large = met.where(F.col("count") > BUCKET).drop("count")
        if level < levels:
            walks = large.select("node", "tokens",
                                 F.xxhash64("path", F.element_at("tokens", level + 1)).alias("path")).checkpoint()
            if walks.isEmpty():
                break
        else:       # still together after all levels: one candidate component
            root = large.groupBy("path").agg(F.min("node").alias("b"))
            edges = large.join(root, "path").select(F.col("node").alias("a"), "b").where("a <> b").distinct()
    # the same sets meet in most runs: each bucket is compared once
    groups = groups.distinct().withColumn("bucket", F.xxhash64("nodes"))
    members = groups.select("bucket", F.explode("nodes").alias("node")) \
        .join(classes.select("node", _sketch(runs, levels).alias("sketch")), "node")
    found = members.groupBy("bucket").applyInArrow(_compare(sketch, need), "a long, b long")
    return found if edges is None else found.unionByName(edges)


def _sketch(runs: int, levels: int):
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(runs - 1)),
                                 lambda r: F.slice("minima", r * levels + 1, F.lit(SKETCH_LEVELS))))


def alike(hashes: np.ndarray, cuts: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows, as sets of hashes, have at least this Jaccard similarity."""
    n = len(cuts) - 1
    row = np.repeat(np.arange(n), np.diff(cuts))
    _, token = np.unique(hashes, return_inverse=True)
    key = np.unique(row * (int(token.max(initial=0)) + 1) + token)
    row, token = np.divmod(key, int(token.max(initial=0)) + 1)
    size = np.bincount(row, minlength=n)
    shared = np.bincount(token) > 1
    keep = shared[token] if len(token) else np.zeros(0, bool)
    row, token = row[keep], (np.cumsum(shared) - 1)[token[keep]]
    common = np.zeros((n, n), np.float32)
    order = np.argsort(token, kind="stable")
    row, token = row[order], token[order]
    width = max(64, (1 << 22) // max(n, 1))
    for first in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(token, [first, first + width])
        dense = np.zeros((n, width), np.float32)
        dense[row[a:b], token[a:b] - first] = 1
        common += dense @ dense.T
    found = np.empty((n, n), bool)
    for a in range(0, n, 256):                  # strips: no matrix of doubles
        union = size[a:a + 256, None] + size[None, :] - common[a:a + 256].astype(float)
        found[a:a + 256] = (common[a:a + 256] >= threshold * union - 1e-9) & (union > 0)
    return found


def _all_shingles(raw: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``shingles`` of many rows, a few of them at a time."""
    parts = [shingles(raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], n)
             for a, b in row_blocks(offsets, TEXT_BYTES)]
    sizes = np.concatenate([np.diff(cuts) for _, cuts in parts])
    return np.concatenate([hashes for hashes, _ in parts]), np.concatenate([[0], np.cumsum(sizes)])


def _verifier(n: int, threshold: float):
    def verify(key, table):
        raw, offsets = utf8(table.column("text"))
        return graph.links(table.column("node").to_numpy(), table.column("copies").to_numpy(),
                           table.column("block").to_numpy(), key[1].as_py() == key[2].as_py(),
                           alike(*_all_shingles(raw, offsets, n), threshold))
    return verify


def _linked(rows: DataFrame, classes: DataFrame, threshold: float, n: int, runs: int, levels: int
            ) -> tuple[DataFrame, DataFrame]:
    """``node, linked`` and ``node, component`` of the classes that links
    reach, from rows ``doc_id, key, text`` and their classes ``key, least_id,
    node, copies, minima``."""
    near = graph.components(candidate_edges(classes, runs, levels))
    members = near.join(classes.select("node", "key", "copies", "least_id"), "node")
    # each class once, by its smallest id; the length decides the blocks
    texts = rows.select("doc_id", F.col("key").alias("_key"), "text")
    members = members.join(texts, F.expr("key = _key and doc_id <=> least_id")).dropDuplicates(["key"])
    sizes = members.groupBy("component").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum(F.octet_length("text")) / BLOCK_BYTES)).alias("blocks"))
    dealt = graph.block_pairs(members.select("component", "node", "copies", "text")
                              .join(sizes, "component"), "component", "blocks", "node")
    linked = dealt.groupBy("component", "bi", "bj").applyInArrow(_verifier(n, threshold), graph.LINK_SCHEMA)
    return graph.summary(linked)


def self_join(documents: DataFrame, threshold: float = 0.8, n: int = 5, doc_id: str = "doc_id",
              text: str = "text", recall: float = RECALL, levels: int = LEVELS) -> DataFrame:
    """Per document: ``doc_id, class_id`` (smallest doc_id that links reach)
    and ``n_links`` (other documents linked directly, copies included).

    Words are lower-cased runs of digits, a-z and non-ASCII characters; a text
    of fewer than ``n`` words is one shingle of all of them.  Null, empty and
    wordless texts, and rows with a null id, link with nothing and are their
    own class.  Rows that repeat an id are documents of their own.  Other
    columns are not read.  An empty table gives an empty one.
    """
    runs = runs_for(recall, threshold, levels)
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.md5(F.col(text)).alias("key"),
                            F.col(text).alias("text"))
    signed = rows.mapInArrow(_signer(n, runs * levels), "doc_id long, key string, minima array<int>").checkpoint()
    full = (F.size("minima") > 0) & F.col("doc_id").isNotNull()
    classes = signed.where(full).groupBy("key") \
        .agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"), F.first("minima").alias("minima")) \
        .withColumn("least_id", F.col("node")).checkpoint()
    count, component = _linked(rows, classes, threshold, n, runs, levels)
    classes = classes.select("key", "node", "copies").join(count, "node", "left").join(component, "node", "left") \
        .select("key", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
                F.coalesce("component", "node").alias("class_id"))
    found = signed.where(full).select("doc_id", "key").join(classes, "key").select("doc_id", "class_id", "n_links")
    rest = signed.where(~full).select("doc_id", F.col("doc_id").alias("class_id"),
                                      F.lit(0).cast("long").alias("n_links"))
    return found.unionByName(rest)


def deduplicate(documents: DataFrame, threshold: float = 0.8, n: int = 5) -> DataFrame:
    """One row of each class of linked texts: one with the smallest id in the
    class (null ids last).  What a row's class is depends on its text alone,
    so rows that share an id are judged apart, and rows with a null id too.
    Null, empty and wordless texts link with nothing and all stay.
    """
    runs = runs_for(RECALL, threshold, LEVELS)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("key"), "text")
    signed = rows.mapInArrow(_signer(n, runs * LEVELS), "doc_id long, key string, minima array<int>").checkpoint()
    # a class is a text; ids do not tell classes apart, so they are numbered
    classes = signed.where(F.size("minima") > 0).groupBy("key") \
        .agg(F.min("doc_id").alias("least_id"), F.count("*").alias("copies"), F.first("minima").alias("minima")) \
        .withColumn("node", F.monotonically_increasing_id()).checkpoint()
    _, component = _linked(rows, classes, threshold, n, runs, LEVELS)
    first = F.struct(F.col("least_id").isNull().alias("no_id"), "least_id", F.col("key").alias("_kept"))
    grouped = classes.select("key", "least_id", "node").join(component, "node")
    kept = grouped.groupBy("component").agg(F.min(first)["_kept"].alias("_kept"))
    # what happens to the rows of an id and a text: none, one or (no entry) all of them stay
    least = grouped.join(kept, "component").select("key", "least_id", (F.col("key") == F.col("_kept")).alias("stays")) \
        .unionByName(classes.where("copies > 1").join(component, "node", "left_anti")
                     .select("key", "least_id", F.lit(True).alias("stays")))
    stays = F.col("stays") & F.col("doc_id").eqNullSafe(F.col("least_id"))
    decided = signed.groupBy("doc_id", "key").agg(F.count("*").alias("n")).join(least, "key") \
        .select(_row_key(F.col("doc_id"), F.col("key")).alias("_row_key"), stays.alias("_stays"), "n") \
        .where("not _stays or n > 1").drop("n")
    # the join and the numbering share one shuffle of the texts
    number = F.row_number().over(Window.partitionBy("_row_key").orderBy("_row_key"))
    return documents.withColumn("_row_key", _row_key(F.col("doc_id").cast("long"), F.md5("text"))) \
        .join(decided, "_row_key", "left").withColumn("_number", number) \
        .where("_stays is null or _stays and _number = 1").select(*documents.columns)


def _row_key(doc_id, key):
    return F.concat(F.coalesce(key, F.lit("")), F.lit(":"), F.coalesce(doc_id.cast("string"), F.lit("")))
