"""Removal of every byte in a string of ``length`` bytes that occurs again.

*Anchors.*  A position is an anchor if the hash of the ``GRAM`` bytes from it
is the smallest in some window of ``length`` bytes, so equal strings of
``length`` bytes have an anchor at the same offset.  Only anchors whose hash
occurs at two places are followed.  Their contexts, the bytes that a string of
``length`` around the anchor can reach, are all that is compared.

*Suffix sort.*  The contexts of a task are sorted as suffixes, once to the
right of the anchor and once, reversed, to the left.  Polynomial prefix hashes
and a binary search over the length give the common extension of two suffixes,
so the mergesort compares them in a logarithmic number of steps; all
comparisons of a merge level are made together.  The extensions of neighbours
are verified byte by byte, and a task in which a hash collided is sorted anew
by its bytes.

*Repeats.*  The two orders give, for each context, the partners with the
longest extension right among those that agree far enough left: walking up the
left order, sets of contexts are united, the smaller into the larger, and each
newcomer meets its neighbours in the right order only.  Left and right
extension that add up to ``length`` mark a repeat.

Equal texts are one text with a count, equal contexts one context with its
owners.  A hash shared by very many different contexts is cut into blocks, and
every pair of blocks is a task of its own.  Texts of fewer than ``length``
bytes hold no repeat.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .textops import U64, flat_ranges, powers, prefix_hash, range_hash, row_blocks, utf8

GRAM = 64
TEXT_BYTES = 2 << 20            # of a block of texts; positions in it need 24 bits
BLOCK = 4096                    # different contexts of one hash in a block
CHUNK = 8192                    # contexts that are sorted together, at least


def anchors(raw: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, position in the row and hash of every anchor."""
    n, window = len(raw), length - GRAM + 1
    if n < length:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, U64),)
    prefix = prefix_hash(raw)
    at = np.arange(n - GRAM + 1)
    hashes = range_hash(prefix, at, at + GRAM)
    # windows as the smallest (hash, position): block minima from both sides
    packed = hashes & ~U64((1 << 24) - 1) | (at & ((1 << 24) - 1)).astype(U64) if n <= 1 << 24 else None
    out = []
    if packed is None:          # a longer text: in overlapping parts
        step = (1 << 24) - length
        for a in range(0, n - length + 1, step):
            part = slice(a, min(n, a + (1 << 24)))
            r, p, h = anchors(raw[part], np.array([0, part.stop - a]), length)
            out.append((p + a, h))
        pos, first = np.unique(np.concatenate([p for p, _ in out]), return_index=True)
        return np.zeros(len(pos), np.int64), pos, np.concatenate([h for _, h in out])[first]
    size = -(-len(packed) // window) * window
    padded = np.full(size, np.iinfo(U64).max, U64)
    padded[:len(packed)] = packed
    table = padded.reshape(-1, window)
    before = np.minimum.accumulate(table, axis=1).ravel()
    after = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    sizes = np.maximum(np.diff(offsets) - length + 1, 0)
    start = flat_ranges(offsets[:-1], sizes)            # windows within a row
    chosen = np.zeros(n, bool)
    chosen[(np.minimum(after[start], before[start + window - 1]) & U64((1 << 24) - 1)).astype(np.int64)] = True
    pos = np.flatnonzero(chosen)
    row = np.searchsorted(offsets, pos, side="right") - 1
    return row, pos - offsets[row], hashes[pos]


class Suffixes:
    """Byte strings of at most ``width`` with a number each (their group);
    groups come before contents in the order."""

    def __init__(self, strings: list[bytes], group: np.ndarray, width: int):
        m = len(strings)
        self.group, self.width = group, width
        self.size = np.array([len(s) for s in strings], np.int64)
        self.bytes = np.zeros((m, width + 1), np.uint8)
        flat = np.frombuffer(b"".join(strings), np.uint8)
        starts = np.cumsum(self.size) - self.size
        self.bytes.reshape(-1)[flat_ranges(np.arange(m) * (width + 1), self.size)] = \
            flat[flat_ranges(starts, self.size)]
        up, _ = powers(width)
        self.hash = np.zeros((m, width + 1), U64)
        np.cumsum((self.bytes[:, :width].astype(U64) + U64(1)) * up, axis=1, out=self.hash[:, 1:])

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix lengths, by binary search over equal hashes."""
        low = np.zeros(len(a), np.int64)
        high = np.minimum(self.size[a], self.size[b])
        for _ in range(int(self.width).bit_length()):
            mid = (low + high + 1) >> 1
            same = self.hash[a, mid] == self.hash[b, mid]
            low = np.where(same, mid, low)
            high = np.where(same, high, mid - 1)
        return low

    def true_extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        limit = np.minimum(self.size[a], self.size[b])
        differ = self.bytes[a] != self.bytes[b]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), self.width + 1)
        return np.minimum(first, limit)

    def ascends(self, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether every a is before its b by its bytes."""
        at = self.true_extension(a, b)
        x = np.where(at < self.size[a], self.bytes[a, at].astype(np.int64) + 1, 0)
        y = np.where(at < self.size[b], self.bytes[b, at].astype(np.int64) + 1, 0)
        return bool(((self.group[a] < self.group[b]) | (self.group[a] == self.group[b]) & (x <= y)).all())

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether a sorts before b: group, contents, then number."""
        at = self.extension(a, b)
        x = np.where(at < self.size[a], self.bytes[a, at].astype(np.int64) + 1, 0)
        y = np.where(at < self.size[b], self.bytes[b, at].astype(np.int64) + 1, 0)
        x, y = np.where(x == y, a, x), np.where(x == y, b, y)
        return np.where(self.group[a] == self.group[b], x < y, self.group[a] < self.group[b])

    def order(self) -> np.ndarray | None:
        """Bottom-up mergesort; in every level each element finds its place
        in the neighbouring run by binary search, all at once.  None if the
        comparisons contradict each other, which takes a collision."""
        m = len(self.size)
        order, width = np.arange(m), 1
        place = np.arange(m)
        while width < m:
            run = place // width
            other = np.where(run % 2 == 0, run + 1, run - 1) * width
            low = np.minimum(other, m)
            high = np.minimum(other + width, m)
            start = low.copy()
            for _ in range(width.bit_length()):
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                mid = (low[open_] + high[open_]) >> 1
                less = self.before(order[mid], order[open_])
                low[open_[less]] = mid[less] + 1
                high[open_[~less]] = mid[~less]
            target = (run // 2) * 2 * width + (place - run * width) + (low - start)
            merged = np.full(m, -1)
            merged[target] = order
            if merged.min(initial=0) < 0:
                return None
            order, width = merged, width * 2
        return order

    def sorted(self) -> tuple[np.ndarray, np.ndarray]:
        """Order, and the common extension of each with the one before it
        (-1 across groups), verified."""
        order = self.order()
        if order is not None:
            a, b = order[:-1], order[1:]
            lcp = self.extension(a, b)
        if order is None or (lcp != self.true_extension(a, b)).any() or not self.ascends(a, b):
            # two different strings had one hash: compare bytes
            keys = [(int(g), self.bytes[i, :n].tobytes()) for i, (g, n) in enumerate(zip(self.group, self.size))]
            order = np.array(sorted(range(len(keys)), key=keys.__getitem__))
            a, b = order[:-1], order[1:]
            lcp = self.true_extension(a, b)
        return order, np.concatenate([[-1], np.where(self.group[a] == self.group[b], lcp, -1)])


def _partners(left_order, left_lcp, rank) -> list[tuple[int, int]]:
    """Pairs that decide the repeats of one group (see the module)."""
    member = {int(i): [(int(rank[i]), int(i))] for i in left_order}
    root = {int(i): int(i) for i in left_order}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    pairs = []
    for k in sorted(range(1, len(left_order)), key=lambda k: -left_lcp[k]):
        a, b = find(int(left_order[k - 1])), find(int(left_order[k]))
        if len(member[a]) < len(member[b]):
            a, b = b, a
        large = member[a]
        for item in member.pop(b):
            at = bisect_left(large, item)
            if at:
                pairs.append((item[1], large[at - 1][1]))
            if at < len(large):
                pairs.append((item[1], large[at][1]))
            large.insert(at, item)
        root[b] = a
    return pairs


def repeats(left: list[bytes], right: list[bytes], group: np.ndarray, length: int
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts (by number) with the bytes left and right of their anchor
    that repeats cover.  ``left`` is reversed; groups ascend."""
    lefts, rights = Suffixes(left, group, length - GRAM), Suffixes(right, group, length)
    left_order, left_lcp = lefts.sorted()
    right_order, _ = rights.sorted()
    rank = np.empty(len(group), np.int64)
    rank[right_order] = np.arange(len(group))
    bounds = np.flatnonzero(np.diff(np.concatenate([[-1], group, [-1]])))
    pairs: list[np.ndarray] = []
    sizes = np.diff(bounds)
    two = bounds[:-1][sizes == 2]
    pairs.append(np.stack([left_order[two], left_order[two + 1]], axis=1))
    for a, n in zip(bounds[:-1].tolist(), sizes.tolist()):
        if n > 2:
            found = _partners(left_order[a:a + n], left_lcp[a:a + n], rank)
            pairs.append(np.array(found, np.int64).reshape(-1, 2))
    pair = np.concatenate(pairs)
    a, b = pair[:, 0], pair[:, 1]
    before, after = lefts.extension(a, b), rights.extension(a, b)
    hit = before + after >= length
    # every repeat holds its anchor, so together they cover one range
    most = np.zeros((2, len(group)), np.int64)
    for side, found in zip(most, (before[hit], after[hit])):
        np.maximum.at(side, a[hit], found)
        np.maximum.at(side, b[hit], found)
    at = np.flatnonzero(most[1])
    return at, most[0, at], most[1, at]


_TEXT = ("k1", "k2")            # identity of a text: two 64-bit hashes with different seeds


def identity(text):
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]


def _anchor_rows(length: int):
    def scan(batches):
        for batch in batches:
            raw_all, offsets = utf8(batch.column(2))
            for a, b in row_blocks(offsets, TEXT_BYTES):
                row, pos, hashes = anchors(raw_all[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], length)
                take = pa.array(row + a)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(pos, pa.int64()),
                     pa.array(hashes.view(np.int64))], ["k1", "k2", "pos", "h"])
    return scan


def _context_rows(length: int):
    from hashlib import md5

    def cut(batches):
        schema = pa.schema([("c", pa.binary()), ("h", pa.int64()), ("left", pa.binary()), ("right", pa.binary()),
                            ("k1", pa.int64()), ("k2", pa.int64()), ("pos", pa.int64())])
        for batch in batches:
            rows = []
            for k1, k2, positions, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                raw = text.encode()
                for pos, h in ((p["pos"], p["h"]) for p in positions):
                    left = raw[max(0, pos - (length - GRAM)):pos][::-1]
                    right = raw[pos:pos + length]
                    c = md5(left + bytes([len(left) & 255, len(left) >> 8]) + right).digest()
                    rows.append((c, h, left, right, k1, k2, pos))
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)
    return cut


def _sorter(length: int):
    def flush(rows):
        group = np.cumsum([0] + [x[:3] != y[:3] for x, y in zip(rows, rows[1:])])
        at, before, after = repeats([r[4] for r in rows], [r[5] for r in rows], group, length)
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[i][3] for i in at.tolist()], pa.binary()), pa.array(before, pa.int64()),
             pa.array(after, pa.int64())], ["c", "before", "after"])

    def sort(batches):                      # rows arrive ordered by (h, bi, bj)
        rows = []
        for batch in batches:
            rows += zip(*(batch.column(i).to_pylist() for i in range(6)))
            if len(rows) > CHUNK:
                cut = len(rows) - 1
                while cut and rows[cut][:3] == rows[cut - 1][:3]:
                    cut -= 1
                if cut:
                    yield flush(rows[:cut])
                    rows = rows[cut:]
        if rows:
            yield flush(rows)
    return sort


def _cutter(batches):
    for batch in batches:
        columns = [[], [], []]
        for text, pieces in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            raw, spans, kept, end = text.encode(), [], [], 0
            for a, b in sorted((p["start"], p["end"]) for p in pieces):
                if spans and a <= spans[-1]["end"]:
                    spans[-1]["end"] = max(spans[-1]["end"], b)
                else:
                    spans.append({"start": a, "end": b})
            for s in spans:
                kept.append(raw[end:s["start"]])
                end = s["end"]
            for column, value in zip(columns, (len(raw), spans, b"".join(kept) + raw[end:])):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(columns[0], pa.int64()),
             pa.array(columns[1], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
             pa.array(columns[2], pa.binary())], ["k1", "k2", "n_bytes", "spans", "kept"])


_SPANS = "array<struct<start:bigint,end:bigint>>"


def changed_texts(documents: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The different texts from which bytes are removed: ``k1, k2`` (see
    ``identity``), ``n_bytes, spans`` (maximal removed byte ranges) and
    ``kept`` (the remaining bytes; not always valid UTF-8)."""
    spark = documents.sparkSession
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")) \
        .where(F.octet_length("text") >= length).select("doc_id", "text", *identity(F.col("text")))
    classes = rows.groupBy(*_TEXT).agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"),
                                       F.max(F.octet_length("text")).cast("long").alias("n_bytes")).checkpoint()
    whole = classes.where("copies > 1").select(
        *_TEXT, "n_bytes", F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
        .alias("spans"), F.lit(b"").alias("kept"))

    path = scratch_path(spark, "repeat-anchors")
    rows.select(*_TEXT, "text").mapInArrow(_anchor_rows(length), "k1 long, k2 long, pos long, h long") \
        .write.option("compression", "zstd").parquet(path)
    found = spark.read.parquet(path)
    place = F.xxhash64("k1", "k2", "pos")       # copies of a text have the same places
    again = found.groupBy("h").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("h") \
        .checkpoint()               # a plain side of the join, so a hot hash is split
    places = found.join(again, "h", "left_semi").groupBy(*_TEXT) \
        .agg(F.collect_set(F.struct("pos", "h")).alias("positions")).join(classes.drop("n_bytes"), list(_TEXT))
    # one row of each text; its smallest id is null if all of them are
    one = rows.join(places.withColumnsRenamed({"k1": "p1", "k2": "p2"}), F.expr("k1 = p1 and k2 = p2 and doc_id <=> node")) \
        .dropDuplicates(list(_TEXT))
    path = scratch_path(spark, "repeat-texts")
    one.select(*_TEXT, "positions", "text", "copies").write.option("compression", "zstd").parquet(path)
    texts = spark.read.parquet(path)

    path = scratch_path(spark, "repeat-contexts")
    texts.select(*_TEXT, "positions", "text").mapInArrow(
        _context_rows(length), "c binary, h long, left binary, right binary, k1 long, k2 long, pos long") \
        .write.option("compression", "zstd").parquet(path)
    contexts = spark.read.parquet(path)
    # contexts that are equal as a whole repeat each other wholly
    size = F.col("n_left") + F.col("n_right")
    distinct = contexts.groupBy("c").agg(
        F.first("h").alias("h"), F.first("left").alias("left"), F.first("right").alias("right"),
        F.count("*").alias("owners"))
    path = scratch_path(spark, "repeat-distinct")
    distinct.write.option("compression", "zstd").parquet(path)
    distinct = spark.read.parquet(path)
    equal = distinct.where("owners > 1").select(
        "c", F.octet_length("left").cast("long").alias("n_left"), F.octet_length("right").cast("long").alias("n_right")) \
        .where(size >= length).select("c", F.col("n_left").alias("before"), F.col("n_right").alias("after"))
    many = distinct.groupBy("h").count().where("count > 1") \
        .select("h", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")) \
        .checkpoint()               # plain, as above
    own = F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: (b != F.col("own")) | (F.col("blocks") == 1))
    dealt = distinct.join(many, "h").withColumn("own", own).withColumn("other", F.explode(others)).select(
        "h", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"), "c", "left", "right")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partial = dealt.repartition(parts, "h", "bi", "bj").sortWithinPartitions("h", "bi", "bj") \
        .mapInArrow(_sorter(length), "c binary, before long, after long")
    covered = equal.unionByName(partial).groupBy("c").agg(F.max("before").alias("before"), F.max("after").alias("after"))
    path = scratch_path(spark, "repeat-ranges")
    covered.write.option("compression", "zstd").parquet(path)
    covered = spark.read.parquet(path)      # a plain side of the join, so a context of many texts is split
    pieces = contexts.select("c", *_TEXT, "pos").join(covered, "c") \
        .groupBy(*_TEXT).agg(F.collect_set(F.struct((F.col("pos") - F.col("before")).alias("start"),
                                                    (F.col("pos") + F.col("after")).alias("end"))).alias("pieces"))
    cut = texts.where("copies = 1").select(*_TEXT, "text").join(pieces, list(_TEXT)) \
        .mapInArrow(_cutter, f"k1 long, k2 long, n_bytes long, spans {_SPANS}, kept binary")
    return whole.unionByName(cut)


def remove_repeats(documents: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id, n_bytes, spans, kept``.

    Null and empty texts have no bytes.  A text that occurs twice, also under
    the same id, loses all its bytes if it has ``length`` of them.  Other
    columns are not read.  An empty table gives an empty one.
    """
    changed = changed_texts(documents, length, doc_id, text)
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")) \
        .select("doc_id", "text", *identity(F.col("text")))
    return rows.join(changed.drop("n_bytes"), list(_TEXT), "left").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
        F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"),
        F.coalesce("kept", F.col("text").cast("binary")).alias("kept"))


def digests(documents: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``remove_repeats`` as counts and hashes, with the bytes kept and
    whether anything was removed; unchanged texts are hashed where they are
    read and are not shuffled."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    changed = changed_texts(documents, length, doc_id, text).select(
        *_TEXT, removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept"))
    body = F.coalesce(F.col(text), F.lit(""))
    rows = documents.select(F.col(doc_id).alias("doc_id"), F.octet_length(body).cast("long").alias("n_bytes"),
                            F.sha2(body, 256).alias("sha"), *identity(body))
    return rows.join(changed, list(_TEXT), "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"),
        F.coalesce("kept", "sha").alias("kept_sha256"),
        (F.col("n_bytes") - F.coalesce("n_removed", F.lit(0))).alias("n_kept"),
        F.col("n_removed").isNotNull().alias("has_repeat"))
