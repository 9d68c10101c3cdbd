"""Ranked lexical search by MaxScore with bounds for pairs of terms.

*Shards.*  Every task indexes the documents of its split, ``SHARD_BYTES`` of
text at a time, for the terms that the items ask for, answers all items from
that index and keeps each item's best documents.  Only those leave a task, so
no posting is shuffled.  A pass before counts the documents that hold each of
these terms, and documents and terms in all: one row per term and task.

*Bounds.*  A document's score is a sum of impacts, one for each of the item's
terms that it holds.  The index of a shard has for each term its postings and
its greatest impact, and for each pair of terms that are neighbours in an
item's chain (terms by falling weight) the intersection of their lists with
the greatest joint impact.  A pair's bound is the greatest of its joint impact
and of either term alone: below the sum of the two, unless one document has
both at their best.  At query time a dynamic programme over the chain picks the
disjoint pairs and single terms whose bounds add up to the least.

*MaxScore.*  Groups (pairs and single terms) whose bounds together stay below
the threshold cannot bring a document among the best without the others.  The
postings of the other, essential groups give the candidates; the remaining
groups are looked up for candidates only, greatest bound first, and a candidate
goes as soon as its score and the bounds still open stay below the threshold.
The threshold is the item's k-th best score so far, or the k-th greatest impact
of one of its terms or pairs, if that is more.

Items are answered in blocks of ``BLOCK_BYTES`` of text, each with two passes
over the documents; what is broadcast, collected or held for the items is
bounded by a block.
"""

from __future__ import annotations

from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .textops import flat_ranges

BLOCK_BYTES = 1 << 20           # text of the items that are answered together
SHARD_BYTES = 16 << 20          # text that is indexed together
SLICES = 32                     # first level of merging the tasks' results

# terms are runs of digits, letters a-z (A-Z are lower-cased) and bytes from 0x80 on
_SPACED = bytes(b | 32 if 65 <= b < 91 else b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """All terms of a text, in order; a null text has none."""
    return text.encode().translate(_SPACED).split() if text else []


class Vocabulary(dict):
    """Numbers of the terms of a block of items; others have -1."""

    def __missing__(self, term: bytes) -> int:
        return -1


def postings(texts: list[str | None], vocabulary: Vocabulary):
    """Terms of each text (with repeats), and document, term and frequency of
    every known term in it, by ascending document and term."""
    number, sizes, found = vocabulary.__getitem__, [], []
    for text in texts:
        held = terms(text)
        sizes.append(len(held))
        found.append(np.fromiter(map(number, held), np.int64, len(held)))
    n = np.array(sizes, np.int64)
    known = np.concatenate([*found, np.zeros(0, np.int64)])
    width = len(vocabulary) + 1
    key = (np.repeat(np.arange(len(n)), n) * width + known)[known >= 0]
    key, tf = np.unique(key, return_counts=True)
    return n, key // width, key % width, tf.astype(np.int64)


def _chunks(batch: pa.RecordBatch, column: int, size: int = 1 << 20):
    """Runs of rows of about ``size`` characters."""
    texts = batch.column(column).to_pylist()
    first, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= size:
            yield first, texts[first:i + 1], held
            first, held = i + 1, 0
    if first < len(texts):
        yield first, texts[first:], held


_STATISTICS = "term int, n long"


def _count(shared):
    def count(batches):
        vocabulary = shared.value
        df = np.zeros(len(vocabulary), np.int64)
        with_terms = total = 0
        for batch in batches:
            for _, texts, _ in _chunks(batch, 0):
                n, _, term, _ = postings(texts, vocabulary)
                df += np.bincount(term, minlength=len(df))
                with_terms += int((n > 0).sum())
                total += int(n.sum())
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-2, -1], held]), pa.int32()),
             pa.array(np.concatenate([[total, with_terms], df[held]]), pa.int64())], ["term", "n"])
    return count


class Items:
    """A block of items as chains of terms, with the statistics of the
    corpus."""

    def __init__(self, numbers: list[int], held: list[list[int]], df: dict[int, int], k: int):
        self.numbers, self.k = numbers, k
        self.documents, self.terms = df.get(-1, 0), max(df.get(-2, 0), 1)
        size = 1 + max((t for ts in held for t in ts), default=-1)
        self.weight = np.array([floor(1000 * log((2 * self.documents + 2) / (2 * df.get(t, 0) + 1))) for t in range(size)], np.int64)
        # terms that no document holds add nothing
        self.chains = [np.array(sorted((t for t in ts if t in df), key=lambda t: (-self.weight[t], t)), np.int64)
                       for ts in held]


class Shard:
    """Index of some documents for the terms of a block of items."""

    def __init__(self, items: Items, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray):
        self.size, self.k = max(len(n), 1), items.k
        length = 10 + 90 * n * items.documents // items.terms
        impact = items.weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * length[doc]))
        keep = impact > 0
        key = term[keep] * self.size + doc[keep]
        order = np.argsort(key, kind="stable")
        self.key, self.impact = key[order], impact[keep][order]
        self.doc = self.key % self.size
        v = len(items.weight)
        self.start = np.searchsorted(self.key, np.arange(v + 1) * self.size)
        self.count = np.diff(self.start)
        self.most, self.kth = self._best(self.impact, self.count)
        # chains of the terms that occur here, and their neighbours as pairs
        self.chains = [c[self.count[c] > 0] for c in items.chains]
        pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *(self._pair(c[:-1], c[1:]) for c in self.chains)]))
        self.pairs = pairs
        self.joint, self.joint_kth = self._intersect(pairs // v, pairs % v)

    def _pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.minimum(a, b) * (len(self.start) - 1) + np.maximum(a, b)

    def _best(self, values: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greatest and k-th greatest value of each run (0 if there is none)."""
        start = np.cumsum(count) - count
        ranked = values[np.lexsort((-values, np.repeat(np.arange(len(count)), count)))]
        first, kth = np.zeros(len(count), np.int64), np.zeros(len(count), np.int64)
        some, enough = count > 0, count >= self.k
        first[some] = ranked[start[some]]
        kth[enough] = ranked[start[enough] + self.k - 1]
        return first, kth

    def find(self, term: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Impact of each term in each document, 0 if it is not there."""
        key = term * self.size + doc
        at = np.searchsorted(self.key, key)
        at[at == len(self.key)] = 0
        return np.where(self.key[at] == key, self.impact[at], 0) if len(self.key) else np.zeros(len(key), np.int64)

    def _intersect(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greatest and k-th greatest joint impact over the documents that
        hold both terms."""
        a, b = np.where(self.count[a] <= self.count[b], a, b), np.where(self.count[a] <= self.count[b], b, a)
        most, kth = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        ends = np.cumsum(self.count[a])
        first = 0
        while first < len(a):                       # lists of about 2 M postings at a time
            last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + (1 << 21), side="right")))
            some = slice(first, last)
            count = self.count[a[some]]
            at = flat_ranges(self.start[a[some]], count)
            other = self.find(np.repeat(b[some], count), self.doc[at])
            both = other > 0
            run = np.repeat(np.arange(len(count)), count)[both]
            x, y = self._best((self.impact[at] + other)[both], np.bincount(run, minlength=len(count)))
            most.append(x)
            kth.append(y)
            first = last
        return np.concatenate(most), np.concatenate(kth)

    def groups(self, chain: np.ndarray) -> tuple[list[tuple[int, list[int]]], int]:
        """Disjoint neighbours and single terms of the chain with the least
        sum of bounds, by rising bound, and a threshold that k documents
        reach."""
        alone = self.most[chain].tolist()
        at = np.searchsorted(self.pairs, self._pair(chain[:-1], chain[1:]))
        two = np.maximum(self.joint[at], np.maximum(self.most[chain[:-1]], self.most[chain[1:]])).tolist()
        least, paired = [0, alone[0]], [False, False]
        for i in range(1, len(chain)):
            one, both = least[i] + alone[i], least[i - 1] + two[i - 1]
            least.append(min(one, both))
            paired.append(both < one)
        out, i = [], len(chain)
        while i:
            if paired[i]:
                out.append((two[i - 2], [int(chain[i - 2]), int(chain[i - 1])]))
                i -= 2
            else:
                out.append((alone[i - 1], [int(chain[i - 1])]))
                i -= 1
        return sorted(out), int(max(self.kth[chain].max(), self.joint_kth[at].max(initial=0)))

    def search(self, chain: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the best, with their scores: all that
        reach the threshold."""
        groups, reached = self.groups(chain)
        threshold = max(threshold, reached)
        below = np.cumsum([0] + [bound for bound, _ in groups])       # of the first i groups
        cut = int(np.searchsorted(below[1:], threshold))              # these cannot reach it alone
        if cut == len(groups):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        essential = np.array([t for _, ts in groups[cut:] for t in ts], np.int64)
        at = flat_ranges(self.start[essential], self.count[essential])
        score = np.bincount(self.doc[at], self.impact[at], self.size).astype(np.int64)     # below 2**53
        doc = np.flatnonzero((score > 0) & (score + below[cut] >= threshold))
        score = score[doc]
        for i in range(cut - 1, -1, -1):
            for t in groups[i][1]:
                score = score + self.find(np.full(len(doc), t), doc)
            keep = score + below[i] >= threshold
            doc, score = doc[keep], score[keep]
            if not len(doc):
                break
        return doc, score


class Best:
    """The k best documents of each item so far."""

    def __init__(self, n: int, k: int):
        self.k, self.held = k, [(np.zeros(0, np.int64),) * 3 for _ in range(n)]

    def threshold(self, i: int) -> int:
        score = self.held[i][0]
        return int(score[-1]) if len(score) == self.k else 1

    def add(self, i: int, score: np.ndarray, doc_id: np.ndarray, null: np.ndarray) -> None:
        columns = [np.concatenate(c) for c in zip(self.held[i], (score, doc_id, null))]
        order = np.lexsort((columns[1], columns[2], -columns[0]))[:self.k]
        self.held[i] = tuple(c[order] for c in columns)


_HITS = "number long, doc_id long, score long"


def _searcher(shared_vocabulary, shared_items, shard_bytes: int):
    def search(batches):
        vocabulary, items = shared_vocabulary.value, shared_items.value
        best = Best(len(items.numbers), items.k)
        parts, ids, size, rows = [], [], 0, 0

        def answer():
            n, doc, term, tf = (np.concatenate(x) for x in zip(*parts))
            doc_ids = pa.concat_arrays(ids)
            null = np.asarray(doc_ids.is_null()).astype(np.int64)
            doc_ids = np.asarray(doc_ids.fill_null(0))
            shard = Shard(items, n, doc, term, tf)
            for i, chain in enumerate(shard.chains):
                if len(chain):
                    found, score = shard.search(chain, best.threshold(i))
                    if len(found):
                        best.add(i, score, doc_ids[found], null[found])

        for batch in batches:
            for first, texts, characters in _chunks(batch, 1):
                n, doc, term, tf = postings(texts, vocabulary)
                parts.append((n, doc + rows, term, tf))
                ids.append(batch.column(0).slice(first, len(texts)))
                rows, size = rows + len(texts), size + characters
                if size >= shard_bytes:
                    answer()
                    parts, ids, size, rows = [], [], 0, 0
        if parts:
            answer()
        sizes = [len(h[0]) for h in best.held]
        score, doc_id, null = (np.concatenate([h[c] for h in best.held] + [np.zeros(0, np.int64)]) for c in range(3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array(items.numbers, np.int64), sizes)), pa.array(doc_id, mask=null > 0), pa.array(score)],
            ["number", "doc_id", "score"])
    return search


def search(documents: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id",
           text: str = "text", block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``item_id, rank`` (1 to k), ``doc_id, score`` of each item's k best
    documents with a score above 0, equal scores by ascending doc_id.

    Null and empty texts hold no terms: such a document is never found, such
    an item finds none.  Each row of either table counts, also a repeated one:
    repeated documents share their score, repeated items (rows with one
    item_id) are ranked each for itself.  A null doc_id comes after all others,
    a null item_id is kept.  Other columns are not read.  Without documents or
    items the result is empty.
    """
    spark = documents.sparkSession
    asked = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")) \
        .withColumn("number", F.monotonically_increasing_id()).checkpoint()
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    root, paths = scratch_path(spark, "ranked-search"), []
    for block in range(blocks):
        some = asked.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == block).collect()
        held = [set(terms(r.text)) for r in some]
        vocabulary = Vocabulary((t, i) for i, t in enumerate(sorted(set().union(*held))))
        shared = spark.sparkContext.broadcast(vocabulary)
        df = {r.term: r.n for r in rows.select("text").mapInArrow(_count(shared), _STATISTICS)
              .groupBy("term").agg(F.sum("n").alias("n")).collect()}
        chains = spark.sparkContext.broadcast(
            Items([r.number for r in some], [sorted(map(vocabulary.__getitem__, h)) for h in held], df, k))
        hits = rows.mapInArrow(_searcher(shared, chains, shard_bytes), _HITS)
        best = Window.orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        # two levels: an item has k rows of every task
        for keys in (["number", F.pmod(F.spark_partition_id(), F.lit(SLICES))], ["number"]):
            hits = hits.withColumn("rank", F.row_number().over(best.partitionBy(*keys))).where(F.col("rank") <= k)
        paths.append(f"{root}/{block}")
        hits.write.parquet(paths[-1])
    return spark.read.parquet(*paths).join(asked.select("number", "item_id"), "number") \
        .select("item_id", "rank", "doc_id", "score")
