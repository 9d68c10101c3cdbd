"""Byte-level BPE by merge replay.

Every shard of the corpus (a block of documents within a Spark task) is
reduced to its distinct pre-tokens.  ``MergeReplay`` holds them as linked
lists of symbols with an inverted index from the rank of a token pair to the
positions where that pair stands.  The merges are applied in rank order,
each to all its positions at once, and only the pairs that touch a merged
position enter the index anew.  Documents are then the concatenation of
their words' ids.  A word that a task has seen is not replayed again.

No shuffle is needed: 100 TB of text would move about 2e13 word occurrences
to join a corpus-wide word table back, while replaying a word once per task
costs a few percent of reading the task's text.  A lost task is recomputed
from its input split alone.
"""

from __future__ import annotations

import base64
import re
import sys
import unicodedata
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textops import flat_ranges, returns_memory, row_blocks, utf8

BLOCK_BYTES = 4 << 20           # text whose new words are replayed together
CACHED_WORDS = 300_000          # words a task remembers; beyond, it starts anew


class Ranks:
    """A rank file as arrays: ranks by bytes, the bytes of each id, and the
    sorted table of all pairs of ids whose bytes together are a token."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.of = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        size = max(self.of.values()) + 1
        self.token = [b""] * size
        for token, rank in self.of.items():
            self.token[rank] = token
        self.byte = np.array([self.of[bytes([i])] for i in range(256)], np.int64)
        keys, ranks, of = [], [], self.of
        for token, rank in of.items():
            for cut in range(1, len(token)):
                a, b = of.get(token[:cut]), of.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    ranks.append(rank)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.pair_key = np.array(keys, np.int64)[order]
        self.pair_rank = np.array(ranks, np.int64)[order]
        self.length = np.array([len(t) for t in self.token], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        self.blob = np.frombuffer(b"".join(self.token), np.uint8)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that each pair makes, or -1."""
        key = left << 32 | right
        at = np.searchsorted(self.pair_key, key)
        at[at == len(self.pair_key)] = 0
        return np.where(self.pair_key[at] == key, self.pair_rank[at], -1)

    def encode_one(self, word: bytes) -> list[int]:
        """Plain merge loop over one word, lowest rank first, leftmost on
        ties."""
        parts, of = [word[i:i + 1] for i in range(len(word))], self.of
        while True:
            best = min(((of[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1)
                        if parts[i] + parts[i + 1] in of), default=None)
            if best is None:
                return [of[p] for p in parts]
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of a sequence of ids."""
        return self.blob[flat_ranges(self.start[ids], self.length[ids])]


class MergeReplay:
    """Encodes many distinct words together."""

    def __init__(self, ranks: Ranks):
        self.ranks = ranks

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Concatenated ids of the words and the number of ids of each."""
        of = self.ranks.of
        whole = np.array([of.get(w, -1) for w in words], np.int64)
        counts = np.ones(len(words), np.int64)
        open_ = np.flatnonzero(whole < 0)
        if not len(open_):
            return whole, counts
        flat, n = self._replay([words[i] for i in open_])
        counts[open_] = n
        out = np.empty(int(counts.sum()), np.int64)
        starts = np.cumsum(counts) - counts
        done = whole >= 0
        out[starts[done]] = whole[done]
        out[flat_ranges(starts[open_], n)] = flat
        return out, counts

    def _replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ranks = self.ranks
        lengths = np.array([len(w) for w in words], np.int64)
        first = np.cumsum(lengths) - lengths
        sym = ranks.byte[np.frombuffer(b"".join(words), np.uint8)]
        n = len(sym)
        nxt = np.arange(1, n + 1)
        nxt[first + lengths - 1] = -1
        prv = np.arange(-1, n - 1)
        prv[first] = -1
        pair = np.full(n, -1, np.int64)        # rank of the pair that starts here
        alive = np.ones(n, bool)
        at = np.flatnonzero(nxt >= 0)
        pair[at] = ranks.merged(sym[at], sym[at + 1])

        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(positions: np.ndarray, found: np.ndarray) -> None:
            order = np.argsort(found, kind="stable")
            positions, found = positions[order], found[order]
            cuts = np.flatnonzero(found[1:] != found[:-1]) + 1
            bounds = [0, *cuts.tolist(), len(found)]
            for a, b in zip(bounds, bounds[1:]):
                rank = int(found[a])
                if rank in index:
                    index[rank].append(positions[a:b])
                else:
                    index[rank] = [positions[a:b]]
                    heappush(heap, rank)

        at = at[pair[at] >= 0]
        if len(at):
            enter(at, pair[at])
        heapify(heap)
        irregular: list[np.ndarray] = []
        while heap:
            rank = heappop(heap)
            lists = index.pop(rank)
            at = lists[0] if len(lists) == 1 else np.concatenate(lists)
            at = at[pair[at] == rank]
            if not len(at):
                continue
            if len(lists) > 1:
                at = np.unique(at)
            right = nxt[at]
            if len(at) > 1 and (right[:-1] == at[1:]).any():
                # overlapping pairs: of each run of neighbours every second stays
                linked = np.concatenate([[False], right[:-1] == at[1:]])
                run = np.maximum.accumulate(np.where(linked, 0, np.arange(len(at))))
                keep = (np.arange(len(at)) - run) % 2 == 0
                at, right = at[keep], right[keep]
            after = nxt[right]
            sym[at] = rank
            nxt[at] = after
            alive[right] = False
            pair[right] = -1
            inner = after >= 0
            prv[after[inner]] = at[inner]
            pair[at[~inner]] = -1
            before = prv[at]
            touched = np.concatenate([at[inner], before[before >= 0]])
            if len(touched):
                found = ranks.merged(sym[touched], sym[nxt[touched]])
                pair[touched] = found
                hit = found >= 0
                touched, found = touched[hit], found[hit]
                if len(touched):
                    early = found < rank
                    if early.any():
                        irregular.append(touched[early])
                    enter(touched, found)
        counts = np.add.reduceat(alive.astype(np.int64), first)
        ids = sym[alive]
        if irregular:
            # a merge made a pair that ranks before it: these words' order of
            # merges is not the corpus order, so they take the plain loop
            at = np.unique(np.searchsorted(first, np.concatenate(irregular), side="right") - 1)
            cut = np.split(ids, np.cumsum(counts)[:-1])
            for w in at.tolist():
                cut[w] = np.array(ranks.encode_one(words[w]), np.int64)
                counts[w] = len(cut[w])
            ids = np.concatenate(cut)
        return ids, counts


@lru_cache(maxsize=2)
def load_ranks(path: str) -> Ranks:
    return Ranks(path)


class WordTable:
    """Words that a task has met: index by word, ids of each."""

    def __init__(self, ranks: Ranks):
        self.replay = MergeReplay(ranks)
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)

    def lookup(self, pieces: list[str]) -> np.ndarray:
        if len(self.index) > CACHED_WORDS:
            self.clear()
        index = self.index
        known = len(index)
        new = [p for p in dict.fromkeys(pieces) if p not in index]
        index.update(zip(new, count(known)))
        at = np.fromiter(map(index.__getitem__, pieces), np.int64, len(pieces))
        if new:
            ids, counts = self.replay([w.encode() for w in new])
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(counts) - counts])
            self.count = np.concatenate([self.count, counts])
            self.flat = np.concatenate([self.flat, ids.astype(np.int32)])
        return at


@lru_cache(maxsize=16)
def _char_ranges(kind: str, last: int) -> str:
    """Characters up to ``last`` of a general category (``L``, ``N``, ``Lu``,
    ...) or, for ``s``, of the property White_Space, as ranges of a class."""
    # fixed values: the White_Space characters of the Unicode standard
    spaces = {*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}
    inside = (lambda c: c in spaces) if kind == "s" else \
        (lambda c: unicodedata.category(chr(c)).startswith(kind))
    out, first = [], None
    for c in range(last + 2):
        if c <= last and inside(c):
            first = c if first is None else first
        elif first is not None:
            out.append(f"\\U{first:08x}-\\U{c - 1:08x}")
            first = None
    return "".join(out)


@lru_cache(maxsize=8)
def compile_pattern(pattern: str, last: int = sys.maxunicode) -> re.Pattern:
    """A pre-tokenizer pattern for Python's ``re``: ``\\p{..}`` and ``\\s``
    become explicit classes, which match several times faster than property
    look-ups.  ``\\s`` is the Unicode property, not ``str.isspace``.  Classes
    hold characters up to ``last``; for texts of the basic plane ``re`` can
    then use bitmaps."""
    out, i, in_class = [], 0, False
    while i < len(pattern):
        if m := re.compile(r"\\(?:p\{(\w+)\}|(s)|(S))").match(pattern, i):
            chars = _char_ranges(m[1] or "s", last)
            if m[3]:
                if in_class:
                    raise ValueError("\\\\S within a class is not supported")
                out.append(f"[^{chars}]")
            else:
                out.append(chars if in_class else f"[{chars}]")
            i = m.end()
            continue
        c = pattern[i:i + 2] if pattern[i] == "\\" else pattern[i]
        in_class = (in_class or c == "[") and c != "]"
        out.append(c)
        i += len(c)
    return re.compile("".join(out))


def _encoder(path: str, pattern: str, text: str):
    @returns_memory
    def encode(batches):
        basic, full = compile_pattern(pattern, 0xFFFF).findall, None
        beyond = re.compile("[\U00010000-\U0010ffff]").search
        table = WordTable(load_ranks(path))
        for batch in batches:
            column = batch.schema.get_field_index(text)
            _, sizes = utf8(batch.column(column))
            for a, b in row_blocks(sizes, BLOCK_BYTES):
                block = batch.slice(a, b - a)
                pieces: list[str] = []
                ends = []
                for value in block.column(column).to_pylist():
                    if value and not beyond(value):
                        pieces += basic(value)
                    elif value:
                        full = full or compile_pattern(pattern).findall
                        pieces += full(value)
                    ends.append(len(pieces))
                at = table.lookup(pieces)
                del pieces
                counts = table.count[at]
                per_row = np.diff(np.concatenate([[0], np.concatenate([[0], np.cumsum(counts)])[ends]]))
                ids = table.flat[flat_ranges(table.start[at], counts)]
                offsets = np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)
                array = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*block.columns, array], [*block.schema.names, "ids"])
    return encode


def encode(documents: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """Adds ``ids`` (array<int>): each match of ``pattern`` in the whole text
    encoded separately, without special tokens.

    Null and empty texts have no ids.  Repeated rows are encoded alike, other
    columns (whatever their names, but for one called ``ids``, which is
    replaced) pass through.  An empty table gives an empty table.
    """
    documents = documents.drop("ids")
    schema = T.StructType([*documents.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return documents.mapInArrow(_encoder(ranks_path, pattern, text), schema)


def _decoder(path: str, ids: str):
    @returns_memory
    def decode(batches):
        ranks = load_ranks(path)
        for batch in batches:
            at = batch.schema.get_field_index(ids)
            sizes = np.concatenate([[0], np.cumsum([0 if n is None else n for n in
                                                    pa.compute.list_value_length(batch.column(at)).to_pylist()])])
            for a, b in row_blocks(sizes, BLOCK_BYTES // 16):
                block = batch.slice(a, b - a)
                column = block.column(at)
                flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                raw = ranks.decode(flat)
                ends = np.concatenate([[0], np.cumsum(ranks.length[flat])])
                cut = ends[sizes[a:b + 1] - sizes[a]].astype(np.int64)
                array = pa.Array.from_buffers(pa.large_binary(), b - a,
                                              [None, pa.py_buffer(cut.tobytes()), pa.py_buffer(raw.tobytes())])
                yield pa.RecordBatch.from_arrays([*block.columns, array.cast(pa.binary())],
                                                 [*block.schema.names, "decoded"])
    import pyarrow.compute  # noqa: F401  (loads pa.compute)
    return decode


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """Adds ``decoded`` (binary): the bytes of ``ids``.  Null ids decode to no
    bytes."""
    encoded = encoded.drop("decoded")
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])
    return encoded.mapInArrow(_decoder(ranks_path, ids), schema)


def round_trip(documents: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one pass: a task has one Python worker,
    and the ids do not travel between two.  The text is dropped; nulls, empty
    texts and other columns are as in ``encode``."""
    documents = documents.drop("ids", "decoded")
    kept = [f for f in documents.schema.fields if f.name != text]
    schema = T.StructType([*kept, T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.BinaryType())])
    encode_batches, decode_batches = _encoder(ranks_path, pattern, text), _decoder(ranks_path, "ids")

    def both(batches):
        encoded = (b.drop_columns([text]) for b in encode_batches(batches))
        return decode_batches(encoded)
    return documents.mapInArrow(both, schema)


def digests(decoded: DataFrame) -> DataFrame:
    """Number of ids, and hashes of the ids and of the decoded bytes."""
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
