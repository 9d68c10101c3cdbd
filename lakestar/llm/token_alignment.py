"""Alignment of the tokens of two tokenizers over the same texts.

A is a byte-level tokenizer of the ``tokenizers`` library, which gets the text
behind one space; B is a ``sentencepiece`` model, which puts that space there
itself.  Both give a sequence of byte ranges over the same bytes.

*Overlaps.*  Per batch, ``pandas.merge_asof`` keyed by document finds for the
start of each A token the B token that covers it, and for the start of each B
token the A token that covers it.  Of two tokens that overlap, one starts
within the other, so the union of both directions is all overlaps; only pairs
that start together are found twice.

*Groups.*  Byte offsets where tokens of both sides end cut them into groups.

*Counts.*  How often a pair of ids is linked in the corpus is summed from each
document's distinct pairs, written beside its other results, so texts are
tokenised once.  The counts return to the documents as a broadcast table if
there are at most ``BROADCAST_PAIRS`` pairs; beyond, by a join.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .textops import flat_ranges, row_blocks, utf8
from .token_counts import piece_bytes

BLOCK_BYTES = 1 << 20           # text that is aligned together
CACHED_PARTS, CACHED_IDS = 300_000, 4_000_000       # that a worker remembers; beyond, it starts anew
BROADCAST_PAIRS = 4_000_000     # pairs of ids with their counts: 64 MB


class Tokens:
    """The two tokenizers, and the bytes of their ids."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True         # their strings are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        # the byte-level alphabet: printable bytes stand for themselves, the
        # others follow from U+0100 on
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}
        self.a_bytes = [self._a_bytes(i, byte) for i in range(self.a.get_vocab_size())]
        self.b_bytes = [piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        # an id within a group, and at the end of its side of the group
        self.shown = [f"{i}{end}" for n, ends in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;"))
                      for i in range(n) for end in ends]

    def _a_bytes(self, i: int, byte: dict[str, int]) -> bytes:
        token = self.a.id_to_token(i)
        return bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()

    def encode(self, parts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of A and of B of each part of a text."""
        a = self.a.encode_batch_fast([" " + p for p in parts], add_special_tokens=False)
        return list(zip((e.ids for e in a), self.b.encode(parts, num_threads=1)))


# neither kind of tokenizer joins a space to what stands before it, so a text's
# tokens are those of its parts, each behind a space
cut_parts = re.compile(r"(?<=\S) (?=\S)").split


class Parts:
    """Parts of texts that a worker has met, with their ids of A and of B."""

    def __init__(self, tokens: Tokens):
        self.tokens = tokens
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.same = np.zeros(0, bool)               # both sides give its bytes back
        self.flat, self.start, self.count = ([np.zeros(0, np.int64)] * 2 for _ in range(3))

    def _learn(self, new: list[str]) -> None:
        tokens = self.tokens
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
        encoded = tokens.encode(new)
        same = [b"".join(map(tokens.a_bytes.__getitem__, a)) == b"".join(map(tokens.b_bytes.__getitem__, b)) == (" " + p).encode()
                for p, (a, b) in zip(new, encoded)]
        self.same = np.concatenate([self.same, np.array(same, bool)])
        for side in (0, 1):
            sizes = np.array([len(e[side]) for e in encoded], np.int64)
            ids = np.fromiter(chain.from_iterable(e[side] for e in encoded), np.int64, int(sizes.sum()))
            self.start[side] = np.concatenate([self.start[side], len(self.flat[side]) + np.cumsum(sizes) - sizes])
            self.count[side] = np.concatenate([self.count[side], sizes])
            self.flat[side] = np.concatenate([self.flat[side], ids])

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and for B the ids of all texts, and how many each has: none
        where the bytes of either side are not those of the text behind a
        space."""
        if len(self.index) > CACHED_PARTS or len(self.flat[1]) > CACHED_IDS:
            self.clear()
        parts: list[str] = []
        ends = []
        for text in texts:
            if text:
                parts += cut_parts(text)
            ends.append(len(parts))
        if new := [p for p in dict.fromkeys(parts) if p not in self.index]:
            self._learn(new)
        at = np.fromiter(map(self.index.__getitem__, parts), np.int64, len(parts))
        cut = np.concatenate([[0], ends]).astype(np.int64)
        wrong = np.concatenate([[0], np.cumsum(~self.same[at])])[cut]
        lost = np.diff(wrong) > 0
        at = at[~np.repeat(lost, np.diff(cut))]
        held = np.concatenate([[0], np.cumsum(np.where(lost, 0, np.diff(cut)))])
        out = []
        for side in (0, 1):
            sizes = self.count[side][at]
            ids = self.flat[side][flat_ranges(self.start[side][at], sizes)]
            out.append((ids, np.diff(np.concatenate([[0], np.cumsum(sizes)])[held])))
        return out


@lru_cache(maxsize=2)
def load(a_path: str, b_path: str) -> Parts:
    return Parts(Tokens(a_path, b_path))


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and of ``b`` (columns ``doc`` and ``at``, the byte where a
    token starts, ascending) of all pairs of tokens that overlap."""
    a, b = a.assign(a=np.arange(len(a))), b.assign(b=np.arange(len(b)))
    starts_a = pd.merge_asof(a, b, on="at", by="doc")
    starts_b = pd.merge_asof(b.assign(start=b["at"]), a.assign(other=a["at"]), on="at", by="doc")
    starts_b = starts_b[starts_b["start"] != starts_b["other"]]         # those are found from the other side
    return (np.concatenate([starts_a["a"].to_numpy(), starts_b["a"].to_numpy()]).astype(np.int64),
            np.concatenate([starts_a["b"].to_numpy(), starts_b["b"].to_numpy()]).astype(np.int64))


def align_block(known: Parts, texts: list[str]) -> dict[str, list]:
    """Per text: numbers of tokens, groups and links, the groups as a string,
    and its distinct linked pairs of ids (``a * ids of B + b``) with their
    numbers of links."""
    tokens, n_docs, sides = known.tokens, len(texts), []
    wide = len(tokens.b_bytes)
    for (ids, sizes), length in zip(known.encode(texts), (tokens.a_length, tokens.b_length)):
        end = np.cumsum(length[ids])                # both sides have the same bytes, document by document
        sides.append((ids, sizes, np.repeat(np.arange(n_docs), sizes), end - length[ids], end))
    (a, n_a, a_doc, a_at, a_end), (b, n_b, b_doc, b_at, b_end) = sides
    link_a, link_b = overlaps(pd.DataFrame({"doc": a_doc, "at": a_at}), pd.DataFrame({"doc": b_doc, "at": b_at}))

    a_last, b_last = np.isin(a_end, b_end, assume_unique=True), np.isin(b_end, a_end, assume_unique=True)
    group_a, group_b = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
    before_a = np.concatenate([[0], np.cumsum(np.bincount(group_a, minlength=1))])
    before_b = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=1))])
    code = np.empty(len(a) + len(b), np.int64)      # a group's A ids, then its B ids
    code[np.arange(len(a)) + before_b[group_a]] = 2 * a + a_last
    code[np.arange(len(b)) + before_a[group_b + 1]] = 2 * (len(tokens.a_bytes) + b) + b_last
    ends = np.cumsum(n_a + n_b).tolist()
    shown = [tokens.shown[c] for c in code.tolist()]
    groups = ["".join(shown[first:last])[:-1] for first, last in zip([0, *ends], ends)]

    pair, n_links = a[link_a] * wide + b[link_b], np.bincount(a_doc[link_a], minlength=n_docs)
    size = len(tokens.a_bytes) * wide
    key, times = np.unique(a_doc[link_a] * size + pair, return_counts=True)
    cut = np.concatenate([[0], np.cumsum(np.bincount(key // size, minlength=n_docs))])
    return {"n_a": n_a, "n_b": n_b, "n_groups": np.bincount(a_doc[a_last], minlength=n_docs), "n_links": n_links,
            "groups": groups, "pairs": key % size, "times": times, "cut": cut}


_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string, " \
           "pairs array<bigint>, times array<bigint>, row long"
_LONGS = ("n_a", "n_b", "n_groups", "n_links")


def _aligner(a_path: str, b_path: str, with_groups: bool):
    def run(batches):
        known, row = load(a_path, b_path), TaskContext.get().partitionId() << 40
        for batch in batches:
            _, offsets = utf8(batch.column(1))
            for first, last in row_blocks(offsets, BLOCK_BYTES):
                n = last - first
                found = align_block(known, [t or "" for t in batch.column(1).slice(first, n).to_pylist()])
                cut = pa.array(found["cut"], pa.int32())
                digests = [sha256(g.encode()).hexdigest() if g else "" for g in found["groups"]]
                columns = [batch.column(0).slice(first, n), *(pa.array(found[c], pa.int64()) for c in _LONGS),
                           pa.array(found["groups"] if with_groups else [None] * n, pa.string()), pa.array(digests, pa.string()),
                           pa.ListArray.from_arrays(cut, pa.array(found["pairs"], pa.int64())),
                           pa.ListArray.from_arrays(cut, pa.array(found["times"], pa.int64())),
                           pa.array(np.arange(row, row + n))]
                row += n
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *_LONGS, "groups", "groups_sha256", "pairs", "times", "row"])
    return run


def align(documents: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text",
          with_groups: bool = True) -> DataFrame:
    """Per document: ``doc_id, n_a, n_b`` (tokens), ``n_groups, n_links``,
    ``groups`` (``a1,a2|b1;a3|b2,b3``; null unless ``with_groups``) and its
    ``groups_sha256``, and the distinct linked id pairs ``pairs`` (``a * ids of
    B + b``) with their ``times``; ``row`` numbers the rows.

    Null and empty texts, and texts that either side does not give back byte
    by byte behind one space, have no tokens: zeros and empty strings.
    Repeated rows are aligned each, whatever their id; texts of any length are
    tokenised in parts, a part that was met before is not tokenised again.  Other columns are not read.  An empty table gives an
    empty one.
    """
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_aligner(a_path, b_path, with_groups), _ALIGNED)


def pair_counts(aligned: DataFrame, wide: int) -> DataFrame:
    """``pair, n, best``: links of each pair of ids in the corpus, and whether
    no other pair of its B id has more.  ``wide``: ids of B."""
    counts = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")) \
        .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("n"))
    # rows of a window are bounded by the ids of A
    most = F.max("n").over(Window.partitionBy(F.pmod("pair", F.lit(wide))))
    return counts.select("pair", "n", (F.col("n") == most).alias("best"))


def _totals(shared, names: list[str]):
    def total(batches):
        pair, n, best = shared.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times").flatten().to_numpy()
            cut = np.concatenate([[0], np.cumsum(np.asarray(pairs.value_lengths()))])
            at = np.searchsorted(pair, pairs.flatten().to_numpy())
            added = (np.concatenate([[0], np.cumsum(times * weight[at])]) for weight in (best, n))
            sums = [pa.array(np.diff(run[cut])) for run in added]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *sums], [*names, "n_best", "count_sum"])
    return total


def report(documents: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text",
           broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Per document its numbers of tokens, groups and links, ``n_best`` (links
    whose pair no other pair of the B id exceeds in the corpus), ``count_sum``
    (the corpus counts of its links' pairs, added up) and ``groups_sha256``.
    Rows as in ``align``."""
    spark = documents.sparkSession
    path = scratch_path(spark, "token-alignment")
    align(documents, a_path, b_path, doc_id, text, with_groups=False).drop("groups") \
        .write.option("compression", "zstd").parquet(path + "/documents")
    aligned = spark.read.parquet(path + "/documents")
    pair_counts(aligned, len(load(a_path, b_path).tokens.b_bytes)).write.parquet(path + "/pairs")
    counted = spark.read.parquet(path + "/pairs")
    if counted.count() <= broadcast_pairs:
        table = counted.toArrow()
        pair = table["pair"].to_numpy()
        order = np.argsort(pair)
        shared = spark.sparkContext.broadcast(
            (pair[order], table["n"].to_numpy()[order], table["best"].to_numpy().astype(np.int64)[order]))
        names = ["doc_id", *_LONGS, "groups_sha256"]
        schema = T.StructType([*aligned.select(*names).schema, *(T.StructField(c, T.LongType()) for c in ("n_best", "count_sum"))])
        found = aligned.mapInArrow(_totals(shared, names), schema)
    else:
        links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")) \
            .select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times")).join(counted, "pair")
        totals = links.groupBy("row").agg(F.sum(F.col("times") * F.col("best").cast("long")).alias("n_best"),
                                          F.sum(F.col("times") * F.col("n")).alias("count_sum"))
        zero = F.lit(0).cast("long")
        found = aligned.drop("pairs", "times").join(totals, "row", "left") \
            .withColumns({c: F.coalesce(c, zero) for c in ("n_best", "count_sum")})
    return found.select("doc_id", *_LONGS, "n_best", "count_sum", "groups_sha256")
