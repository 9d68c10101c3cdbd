"""Token ids in grammar-compressed shards.

Documents are range-partitioned and sorted by id, tokenised, and cut into
shards of some megabytes of text.  Within a shard, batch Re-Pair replaces
frequent pairs of ids by nonterminals: each round counts all adjacent pairs
of the whole shard, takes those within half of the most frequent count, and
replaces their occurrences from left to right, until the best pair no longer
pays.  While it works, each document ends with a mark that no pair may hold on
either side, so no rule crosses a document, whatever ids its text has.  The
marks are not stored: a document is a slice of symbols that is decoded alone,
and its end id is put behind it when it is read.

File format: a Parquet table with one row per shard, in ascending order of
doc_id (nulls first):

====================  ======================================================
part, shard           writing partition, running number within it
first_doc             smallest doc_id of the shard
start                 ids of the partition before this shard
n_ids                 ids in the shard, with end ids
doc_ids               document ids
doc_starts            ids of the shard before each document
doc_symbols           symbols of the shard before each document (one more)
rule_left, rule_right symbols that rule r stands for; its symbol is
                      first_rule + r, and it refers to earlier rules only
rule_length           ids that rule r expands to (for random access)
first_rule            smallest nonterminal (one above the largest id)
end_id                id behind every document
width                 bytes per symbol, 2 or 4
symbols               little-endian symbols
====================  ======================================================
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import compile_pattern
from .textops import flat_ranges, row_blocks, utf8

SHARD_BYTES = 6 << 20           # text per shard
CACHED_WORDS = 600_000
MIN_SHARE = 1 / 4096          # a pair pays if it is this share of the symbols ...
MIN_COUNT = 8                   # ... and occurs so often at least

_MARK = np.uint32(0xFFFFFFFF)   # ends a document in compress

SCHEMA = ("part int, shard int, first_doc long, start long, n_ids long, doc_ids array<long>, doc_starts array<long>, "
          "doc_symbols array<long>, rule_left array<int>, rule_right array<int>, rule_length array<long>, "
          "first_rule int, end_id int, width int, symbols binary")


# the pattern that WordEncoder cuts on arrays
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
_SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")


class _Ids:
    """Strings with a sequence of ids each."""

    def __init__(self):
        self.index: dict[str | bytes, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)

    def add(self, strings: list[str] | list[bytes], sizes: np.ndarray, flat: np.ndarray) -> None:
        self.index.update(zip(strings, count(len(self.index))))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(sizes) - sizes])
        self.count = np.concatenate([self.count, sizes])
        self.flat = np.concatenate([self.flat, flat])

    def at(self, strings: list[str] | list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.index.__getitem__, strings), np.int64, len(strings))

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Concatenated ids of the strings, and how many each has."""
        sizes = self.count[at]
        return self.flat[flat_ranges(self.start[at], sizes)], sizes


def _values(strings: pa.Array) -> list[str] | list[bytes]:
    if not pa.types.is_binary(strings.type) or not len(strings):
        return strings.to_pylist()
    _, ends, data = strings.buffers()
    ends = np.frombuffer(ends, np.int32, len(strings) + 1, 4 * strings.offset).tolist()
    raw = data.to_pybytes()
    return [raw[a:b] for a, b in zip(ends, ends[1:])]


class WordEncoder:
    """Ids by the tokenizers library, each distinct piece once per task.

    Normalisation, pre-tokenization and merges of this kind of tokenizer do
    not look across white space, so a text's ids are its words' ids.  Texts
    of Latin letters are lower-cased here and cut by the tokenizer's own
    pattern, all of a shard at once; of other texts, and of those that hold
    the string of an added token, each word is encoded by the library as a
    whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # the model alone, over lines
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.Split("\n", "removed")
        with open(path, encoding="utf-8") as f:
            settings = json.load(f)
        vocabulary, suffix = settings["model"]["vocab"], settings["model"].get("end_of_word_suffix")
        self.final = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if suffix:
            self.final[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.split = settings["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # words that may hold an added token, which the library looks for first
        added = [re.escape(t["content"]) for t in settings.get("added_tokens", [])]
        self.added = re.compile("|".join(added) or "(?!)", re.IGNORECASE).search
        self.pieces = compile_pattern(self.split, 0x24F).findall
        self.plain = compile_pattern("[\x00-\u017f]*").fullmatch
        kinds = [compile_pattern(c, 0x24F).fullmatch for c in (r"[\s]", r"[\p{L}]", r"[\p{N}]")]
        self.kind = np.full(1 << 16, _OTHER, np.uint8)
        for i in range(0x250):
            self.kind[i] = next((k for k, match in enumerate(kinds) if match(chr(i))), _OTHER)
        # the byte-level alphabet: printable bytes stand for themselves, the
        # others follow from U+0100 on
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in shown]
        self.alphabet = {b: b for b in shown} | {b: 0x100 + i for i, b in enumerate(hidden)} | {0x0A: 0x0A}
        self.hidden = re.compile("[\x00-\x09\x0b-\x20\x7f]").search
        self.clear()

    def clear(self) -> None:
        self.seen = _Ids()

    def _learn(self, new: list[str] | list[bytes]) -> None:
        """Ids of words, or of the pieces of Latin texts, met for the first time."""
        if isinstance(new[0], str):
            found = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in new]
            ids, sizes = list(chain.from_iterable(found)), np.fromiter(map(len, found), np.int64, len(found))
        else:                   # one call of the model for all: no piece holds a line end
            lines = b"\n\0".join(new).decode("utf-16-le")
            if not lines.isascii() or self.hidden(lines):
                lines = lines.encode().decode("latin-1").translate(self.alphabet)
            ids = np.array(self.model.encode_batch_fast([lines], add_special_tokens=False)[0].ids, np.uint32)
            sizes = np.diff(np.concatenate([[-1], np.flatnonzero(self.final[ids])]))
            if len(sizes) != len(new) or sizes.sum() != len(ids):       # a model without marks at the end of words
                words = np.array(self.model.encode(lines, add_special_tokens=False).word_ids, np.int64)
                sizes = np.bincount(words, minlength=len(new))
        self.seen.add(new, sizes, np.asarray(ids, np.uint32))

    def _cut(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """Pieces (UTF-16) of Latin texts, and how many each has."""
        lowered = [t.lower() for t in texts]
        if self.split != SPLIT:
            found = [self.pieces(t) for t in lowered]
            return pa.array([p.encode("utf-16-le") for f in found for p in f], pa.binary()), \
                np.fromiter(map(len, found), np.int64, len(found))
        text = np.frombuffer("\n".join([*lowered, "\n\n\n"]).encode("utf-16-le"), np.uint16)
        kind = self.kind[text]
        change = np.concatenate([[True], kind[1:] != kind[:-1]])
        first = (kind != _SPACE) & change | (kind == _NUMBER)
        last = np.concatenate([kind[1:] == _NUMBER, [True]]) | np.concatenate([change[1:], [True]])
        # an apostrophe and a suffix are a piece where no other sign is before them
        quote = np.flatnonzero((text == ord("'")) & first)
        for suffix in _SUFFIXES:
            hit = quote
            for i, letter in enumerate(suffix, 1):
                hit = hit[text[hit + i] == ord(letter)]
            first[hit + 1] = False
            last[hit] = False
            end = hit + len(suffix)
            first[end + 1] |= kind[end + 1] == _LETTER
            last[end] = True
        start = np.flatnonzero(first)
        size = np.flatnonzero(last & (kind != _SPACE)) + 1 - start
        ends = np.concatenate([[0], np.cumsum(2 * size)]).astype(np.int32)
        found = pa.Array.from_buffers(pa.binary(), len(start), [
            None, pa.py_buffer(ends.tobytes()), pa.py_buffer(text[flat_ranges(start, size)].tobytes())])
        bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in lowered])]).astype(np.int64)
        return found, np.diff(np.searchsorted(start, bounds))

    def _words(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """Maximal runs without white space, and how many each text has.  The
        separators U+001C-U+001F are not white space for the tokenizer, but
        are for str.split."""
        found = [compile_pattern(r"[^\s]+").findall(t) for t in texts]
        return pa.array([w for f in found for w in f], pa.string()), np.fromiter(map(len, found), np.int64, len(found))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts; ids of each."""
        if len(self.seen.index) > CACHED_WORDS:
            self.clear()
        texts = [t or "" for t in texts]
        plain = np.fromiter((self.plain(t) is not None and self.added(t) is None for t in texts), bool, len(texts))
        units, parts = np.zeros(len(texts), np.int64), []
        for rows, cut in ((np.flatnonzero(plain), self._cut), (np.flatnonzero(~plain), self._words)):
            found, units[rows] = cut([texts[i] for i in rows.tolist()])
            coded = found.dictionary_encode()
            keys = _values(coded.dictionary)
            fresh = [k for k in keys if k not in self.seen.index]
            if fresh:
                self._learn(fresh)
            parts.append((rows, self.seen.at(keys)[coded.indices.to_numpy()]))
        cuts = np.concatenate([[0], np.cumsum(units)])
        at = np.empty(cuts[-1], np.int64)
        for rows, numbers in parts:
            at[flat_ranges(cuts[rows], units[rows])] = numbers
        ids, sizes = self.seen.take(at)
        return ids, np.diff(np.concatenate([[0], np.cumsum(sizes)])[cuts])


def compress(ids: np.ndarray, sizes: np.ndarray, min_count: int = MIN_COUNT, min_share: float = MIN_SHARE
             ) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]], int]:
    """Batch Re-Pair over documents of ``sizes`` ids: symbols, how many each
    document has, rules as pairs of symbols, and the symbol of the first
    rule."""
    first = int(ids.max()) + 1 if len(ids) else 1
    seq = np.full(len(ids) + len(sizes), _MARK, np.uint32)
    inner = np.ones(len(seq), bool)
    inner[np.cumsum(sizes + 1) - 1] = False
    seq[inner] = ids
    rules: list[tuple[int, int]] = []
    slots = 1 << 20
    while len(seq) > 1:
        need = max(min_count, int(len(seq) * min_share))
        left, right = seq[:-1], seq[1:]
        salt = np.uint32(0x85EBCA6B + 2 * len(rules))       # other pairs share a slot in the next round
        slot = (((left * np.uint32(0x9E3779B1)) ^ (right * salt)) >> np.uint32(12)).astype(np.intp)
        often = np.flatnonzero(np.bincount(slot, minlength=slots) >= need)
        number = np.full(slots, -1, np.int32)
        number[often] = np.arange(len(often))
        which = number[slot]
        at = np.flatnonzero((which >= 0) & (left != _MARK) & (right != _MARK))
        if not len(at):
            break
        # of the pairs that share a slot, the first one is counted in this round
        which = which[at]
        pair = left[at].astype(np.uint64) << np.uint64(32) | right[at]
        of_slot = np.zeros(len(often), np.uint64)
        of_slot[which[::-1]] = pair[::-1]
        same = pair == of_slot[which]
        at, which = at[same], which[same]
        counts = np.bincount(which, minlength=len(often))
        best = counts.max()
        if best < need:
            break
        chosen = counts >= max(need, best // 2)
        symbols = np.cumsum(chosen) - 1 + first + len(rules)
        take = chosen[which]
        at, symbol = at[take], symbols[which[take]]
        # of neighbours that overlap, every second stays
        linked = np.concatenate([[False], at[1:] == at[:-1] + 1])
        run = np.maximum.accumulate(np.where(linked, 0, np.arange(len(at))))
        keep = (np.arange(len(at)) - run) % 2 == 0
        at = at[keep]
        seq[at] = symbol[keep]
        gone = np.ones(len(seq), bool)
        gone[at + 1] = False
        seq = seq[gone]
        rules += [(int(p >> np.uint64(32)), int(p & np.uint64(0xFFFFFFFF))) for p in of_slot[chosen]]
    ends = np.flatnonzero(seq == _MARK)
    return seq[seq != _MARK], np.diff(np.concatenate([[-1], ends])) - 1, rules, first


def expand(symbols: np.ndarray, left, right, first_rule: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a slice of symbols, and how many ids each symbol stands for."""
    parts: list[np.ndarray] = []
    for a, b in zip(left, right):
        parts.append(np.concatenate([np.array([x], np.uint32) if x < first_rule else parts[x - first_rule]
                                     for x in (a, b)]))
    sizes = np.array([len(p) for p in parts], np.int64)
    flat = np.concatenate([np.arange(first_rule, dtype=np.uint32), *parts])
    start = np.concatenate([np.arange(first_rule), first_rule + np.cumsum(sizes) - sizes])
    length = np.concatenate([np.ones(first_rule, np.int64), sizes])
    return flat[flat_ranges(start[symbols], length[symbols])], length[symbols]


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _writer(path: str, end_id: int):
    def write(batches):
        encoder, part, shard, before = _encoder(path), TaskContext.get().partitionId(), 0, 0
        schema = None

        def flush(held):
            nonlocal shard, before
            ids, sizes = encoder.encode([t for _, t in held])
            symbols, own, rules, first = compress(ids, sizes)
            with_end = sizes + 1
            length: list[int] = []
            for a, b in rules:
                length.append(sum(1 if x < first else length[x - first] for x in (a, b)))
            width = 2 if first + len(rules) <= 1 << 16 else 4
            row = {"part": part, "shard": shard, "first_doc": held[0][0], "start": before, "n_ids": int(with_end.sum()),
                   "doc_ids": [d for d, _ in held], "doc_starts": np.cumsum(with_end) - with_end,
                   "doc_symbols": np.concatenate([[0], np.cumsum(own)]), "rule_left": [a for a, _ in rules],
                   "rule_right": [b for _, b in rules], "rule_length": length, "first_rule": first,
                   "end_id": end_id, "width": width, "symbols": symbols.astype(f"<u{width}").tobytes()}
            shard += 1
            before += row["n_ids"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), schema.types)],
                                              schema=schema)

        schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("first_doc", pa.int64()),
                            ("start", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                            ("doc_starts", pa.list_(pa.int64())), ("doc_symbols", pa.list_(pa.int64())),
                            ("rule_left", pa.list_(pa.int32())), ("rule_right", pa.list_(pa.int32())),
                            ("rule_length", pa.list_(pa.int64())), ("first_rule", pa.int32()), ("end_id", pa.int32()),
                            ("width", pa.int32()), ("symbols", pa.binary())])
        held: list[tuple[int | None, str]] = []
        size = 0
        for batch in batches:
            _, offsets = utf8(batch.column(1))
            for a, b in row_blocks(offsets, SHARD_BYTES):
                block = batch.slice(a, b - a)
                held += zip(block.column(0).to_pylist(), (t or "" for t in block.column(1).to_pylist()))
                size += int(offsets[b] - offsets[a])
                if size >= SHARD_BYTES // 2:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)
    return write


def write(documents: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, doc_id: str = "doc_id",
          text: str = "text") -> None:
    """Tokenise every whole text, append ``end_id`` and write the shards to
    ``path``.

    A null text has only its end id, as an empty one.  Rows with a null id
    come first; rows with the same id are kept, ordered by text.  Other
    columns are not read.  An empty table writes no shard.
    """
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # the last key splits a hot id: rows that agree in all else are interchangeable
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(parts, "doc_id", F.xxhash64("text"), "_row") \
        .sortWithinPartitions("doc_id", F.xxhash64("text")).select("doc_id", "text")
    ordered.mapInArrow(_writer(tokenizer_path, end_id), SCHEMA).write.parquet(path)


def _reader(wanted: set[int] | None):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids", pa.binary())])

    def decode(batches):
        for batch in batches:
            for row in batch.to_pylist():
                docs = np.array([i for i, d in enumerate(row["doc_ids"]) if wanted is None or d in wanted], np.int64)
                bounds = np.array(row["doc_symbols"])
                sizes = bounds[docs + 1] - bounds[docs]
                symbols = np.frombuffer(row["symbols"], f"<u{row['width']}")
                # only the symbols of the wanted documents are expanded
                ids, lengths = expand(symbols[flat_ranges(bounds[docs], sizes)].astype(np.int64), row["rule_left"],
                                      row["rule_right"], row["first_rule"])
                bare = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(sizes)])]
                cut = bare + np.arange(len(bare))
                out = np.full(int(cut[-1]), row["end_id"], "<u4")
                inner = np.ones(len(out), bool)
                inner[cut[1:] - 1] = False
                out[inner] = ids
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["doc_ids"][i] for i in docs.tolist()], pa.int64()),
                     pa.array(np.array(row["doc_starts"])[docs] + row["start"], pa.int64()),
                     pa.array(np.diff(cut), pa.int64()),
                     pa.Array.from_buffers(pa.binary(), len(docs), [
                         None, pa.py_buffer((4 * cut).astype(np.int32).tobytes()),
                         pa.py_buffer(out.tobytes())])], schema=schema)
    return decode


def read(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Documents of written shards: ``doc_id, start`` (ids of all documents
    before it), ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit).
    With ``doc_ids`` only these, from the shards that hold them."""
    shards = spark.read.schema(SCHEMA).parquet(path)
    # one row per writing partition reaches the driver
    parts = shards.groupBy("part").agg(F.min(F.struct("first_doc", "part")).alias("key"), F.sum("n_ids").alias("n")) \
        .select("part", "key.first_doc", "n").collect()
    base, before = [], 0
    for p in sorted(parts, key=lambda p: (p.first_doc is not None, p.first_doc or 0, p.part)):
        base.append((p.part, before))
        before += p.n
    offsets = F.broadcast(spark.createDataFrame(base, "part int, base long"))
    if doc_ids is not None:
        shards = shards.where(F.arrays_overlap("doc_ids", F.array(*[F.lit(d).cast("long") for d in doc_ids])))
    placed = shards.join(offsets, "part").withColumn("start", F.col("start") + F.col("base")).drop("base", "part")
    return placed.mapInArrow(_reader(None if doc_ids is None else set(doc_ids)), "doc_id long, start long, n_tokens long, ids binary")
