"""Benchmark decontamination with a generalised suffix automaton.

The automaton recognises every word sequence of the normalised test items.
Training documents stream through it word by word; at each word the state and
the length of the longest match that ends there are known.  A match of
``window`` words or more, or one that ends with a whole shorter item, marks
its words as hit.  Words that no item has reset the automaton, so only runs
of known words are streamed; these runs are found with word hashes over whole
Arrow batches, and their words are compared as text.

The items are read in blocks of at most ``BLOCK_ITEMS`` rows and
``BLOCK_WORD_BYTES`` bytes, each with an automaton of its own, so any number of
items works.  The driver holds one block (and the start of the next) at a time.
With a single block the documents stream through it once.  With more, they are
numbered and written once; each further block is a job of its own that writes
only the rows it hits, and the hits of all are combined at the end.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import scratch_path
from .textops import prefix_hash, range_hash, returns_memory, row_blocks, utf8, words

BLOCK_ITEMS = 20_000
BLOCK_WORD_BYTES = 16 << 20
TEXT_BYTES = 2 << 20


class Automaton:
    """Generalised suffix automaton over word ids, with the items whose
    windows end in each state."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[list[int]] = [[]]           # items with a window that ends here
        self.whole: list[int] = [0]            # longest shorter item that ends here, in words
        names = [name for name, _ in items]
        for number, (_, tokens) in enumerate(items):
            last = 0
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in tokens]
            for at, c in enumerate(ids):
                last = self._extend(last, c, ends)
                if at + 1 >= window:
                    ends[last].append(number)
            if 0 < len(ids) < window:
                ends[last].append(number)
                self.whole[last] = max(self.whole[last], len(ids))
        # along suffix links: a state's windows also end where longer matches end
        order = sorted(range(len(self.link)), key=self.length.__getitem__, reverse=True)
        at_window: list[set[int]] = [set(e) for e in ends]
        for s in order:
            if self.link[s] > 0 and self.length[self.link[s]] >= window:
                at_window[self.link[s]] |= at_window[s]
        short: list[list[tuple[int, int]]] = [[] for _ in self.link]
        lengths = [len(t) for _, t in items]
        for s in range(len(ends)):
            short[s] = sorted({(lengths[i], i) for i in ends[s] if lengths[i] < window})
        self.names = names
        self.items_at, self.short_at, self.longest_short = at_window, short, [0] * len(self.link)
        for s in reversed(order):
            up = max(self.link[s], 0)
            self.longest_short[s] = max(self.whole[s], self.longest_short[up] if s else 0)

    def _new(self, length: int, ends: list[list[int]]) -> int:
        self.next.append({})
        self.link.append(-1)
        self.length.append(length)
        self.whole.append(0)
        ends.append([])
        return len(self.next) - 1

    def _extend(self, last: int, c: int, ends: list[list[int]]) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:                      # the string is known from another item
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q, ends)
        cur = self._new(length[last] + 1, ends)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p == -1:
            link[cur] = 0
        else:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q, ends)
        return cur

    def _clone(self, p: int, c: int, q: int, ends: list[list[int]]) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = self._new(length[p] + 1, ends)
        nxt[clone] = dict(nxt[q])
        link[clone], link[q] = link[q], clone
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        return clone

    def stream(self, tokens: list[int], hit: np.ndarray, found: set[int]) -> None:
        """Mark the words of one run that matches cover, and collect the
        items matched."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        state = matched = 0
        for at, c in enumerate(tokens):
            while state and c not in nxt[state]:
                state = link[state]
                matched = length[state]
            if c in nxt[state]:
                state = nxt[state][c]
                matched += 1
            else:
                matched = 0
            cover = 0
            if matched >= window:
                cover = window
                # the state whose strings include the last ``window`` words
                s = state
                while length[link[s]] >= window:
                    s = link[s]
                found |= self.items_at[s]
            if self.longest_short[state]:
                s = state
                while s > 0:
                    for n, item in self.short_at[s]:
                        if n <= matched:
                            cover = max(cover, n)
                            found.add(item)
                    s = link[s]
            if cover:
                hit[at + 1 - cover:at + 1] = True


def _words_of(text: str | None) -> list[bytes]:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    low, start, end, _ = words(raw, np.array([0, len(raw)]))
    data = low.tobytes()
    return [data[a:b] for a, b in zip(start.tolist(), end.tolist())]


def _scanner(items: list[tuple[object, list[bytes]]], window: int):
    state: dict[str, object] = {}

    def prepare():
        automaton = Automaton(items, window)
        vocab = list(automaton.vocabulary)
        raw = np.frombuffer(b"".join(vocab), np.uint8)
        ends = np.cumsum([len(w) for w in vocab])
        starts = ends - np.array([len(w) for w in vocab], np.int64)
        known = np.sort(range_hash(prefix_hash(raw), starts, ends)) if vocab else np.zeros(0, np.uint64)
        shortest = min((len(t) for _, t in items if t), default=window)
        return automaton, known, min(window, shortest)

    @returns_memory
    def scan(batches):
        if "ready" not in state:
            state["ready"] = prepare()
        automaton, known, shortest = state["ready"]
        for batch in batches:
            raw_all, offsets = utf8(batch.column(batch.schema.get_field_index("text")))
            for a, b in row_blocks(offsets, TEXT_BYTES):
                raw, offs = raw_all[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                low, start, end, first = words(raw, offs)
                hits = np.zeros(len(start), bool)
                found: dict[int, set[int]] = {}
                if len(known) and len(start):
                    hashes = range_hash(prefix_hash(low), start, end)
                    at = np.searchsorted(known, hashes)
                    at[at == len(known)] = 0
                    inside = known[at] == hashes
                    # runs of known words within a document
                    edge = np.ones(len(start) + 1, bool)
                    edge[1:-1] = inside[1:] != inside[:-1]
                    edge[first] = True
                    bounds = np.flatnonzero(edge)
                    keep = inside[bounds[:-1]] & (np.diff(bounds) >= shortest)
                    data = low.tobytes()
                    for x, y in zip(bounds[:-1][keep].tolist(), bounds[1:][keep].tolist()):
                        # a word that only shares its hash with an item's gets id -1
                        tokens = [automaton.vocabulary.get(data[i:j], -1)
                                  for i, j in zip(start[x:y].tolist(), end[x:y].tolist())]
                        row = int(np.searchsorted(first, x, side="right")) - 1
                        automaton.stream(tokens, hits[x:y], found.setdefault(row, set()))
                block = batch.slice(a, b - a)
                yield _result(block, first, start, end, hits, found, automaton.names, offs)
    return scan


def _result(block, first, start, end, hits, found, names, offs):
    """The block with its words counted, runs of hit words and items."""
    edge = np.diff(np.concatenate([[False], hits, [False]]).astype(np.int8))
    run_a, run_b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    rows_a = np.searchsorted(first, run_a, side="right") - 1
    out = [[] for _ in range(block.num_rows)]
    for x, y, r in zip(run_a.tolist(), run_b.tolist(), rows_a.tolist()):
        while x < y:                            # a run does not continue into the next document
            stop = min(y, int(first[r + 1]))
            if stop > x:
                out[r].append({"word": x - int(first[r]), "words": stop - x,
                               "start": int(start[x] - offs[r]), "end": int(end[stop - 1] - offs[r])})
            x, r = max(x, stop), r + 1
    matched = [sorted(names[i] for i in found.get(r, ())) for r in range(block.num_rows)]
    return pa.RecordBatch.from_arrays(
        [*block.columns, pa.array(np.diff(first), pa.int64()), pa.array(out, _SPANS),
         pa.array(matched, pa.list_(pa.int64()))],
        [*block.schema.names, "n_words", "new_spans", "new_items"])


_SPANS = pa.list_(pa.struct([("word", pa.int64()), ("words", pa.int64()), ("start", pa.int64()),
                             ("end", pa.int64())]))
_SPAN_TYPE = "array<struct<word:bigint,words:bigint,start:bigint,end:bigint>>"


def item_blocks(benchmark: DataFrame, item_id: str, text: str, block_items: int = BLOCK_ITEMS):
    """Items as blocks of at most ``block_items`` (id, words) and
    ``BLOCK_WORD_BYTES`` (a longer item is a block of its own), without those
    that have no words."""
    block: list[tuple[object, list[bytes]]] = []
    held = 0
    for row in benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")) \
            .where("i is not null").toLocalIterator():
        tokens = _words_of(row.t)
        if not tokens:
            continue
        size = sum(map(len, tokens))
        if block and (len(block) == block_items or held + size > BLOCK_WORD_BYTES):
            yield block
            block, held = [], 0
        block.append((row.i, tokens))
        held += size
    if block:
        yield block


def scan(documents: DataFrame, benchmark: DataFrame, window: int = 13, doc_id: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text", block_items: int = BLOCK_ITEMS) -> DataFrame:
    """Per document: ``doc_id, n_words, spans`` (maximal runs of hit words:
    first word, number of words, byte range in the UTF-8 text) and ``items``
    (ids of the items matched, ascending).

    Null and empty texts have no words.  Items without words or with a null
    id match nothing; equal items are all reported.  Every row is reported,
    also of a repeated doc_id; repeated rows then agree.  Other columns are
    not read.  With an empty benchmark nothing is hit.
    """
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return _scan(rows, benchmark, window, item_id, item_text, block_items).select("doc_id", "n_words", "spans", "items")


def _scan(rows: DataFrame, benchmark: DataFrame, window: int, item_id: str = "item_id", item_text: str = "text",
          block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The rows, which have a ``text``, with ``n_words, spans, items``."""
    columns = rows.columns
    blocks = item_blocks(benchmark, item_id, item_text, block_items)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        found = _pass(rows, first, window)
        spans, items = F.col("new_spans"), F.col("new_items")
    else:
        # a row's number must be the same in every job, so it is written
        path = scratch_path(rows.sparkSession, "decontamination")
        numbered = rows.withColumn("_row", F.monotonically_increasing_id()).checkpoint()
        for k, block in enumerate(chain([second], blocks)):
            _pass(numbered.select("_row", "text"), block, window).where(F.size("new_items") > 0) \
                .select("_row", "new_spans", "new_items").write.parquet(f"{path}/block={k}")
        more = rows.sparkSession.read.parquet(path).groupBy("_row") \
            .agg(F.flatten(F.collect_list("new_spans")).alias("more_spans"),
                 F.flatten(F.collect_list("new_items")).alias("more_items"))
        found = _pass(numbered, first, window).join(more, "_row", "left")
        spans = F.concat("new_spans", F.coalesce("more_spans", F.array().cast(_SPAN_TYPE)))
        items = F.concat("new_items", F.coalesce("more_items", F.array().cast("array<long>")))
    return found.select(*columns, "n_words", _union_spans(spans).alias("spans"),
                        F.array_sort(F.array_distinct(items)).alias("items"))


def _pass(rows: DataFrame, block: list, window: int) -> DataFrame:
    """The rows with ``n_words, new_spans, new_items`` by one block."""
    schema = StructType([*rows.schema.fields, StructField("n_words", LongType()),
                         *StructType.fromDDL(f"new_spans {_SPAN_TYPE}, new_items array<long>").fields])
    return rows.mapInArrow(_scanner(block, window), schema)


def _union_spans(spans):
    """Overlapping or touching runs of words as one."""
    ordered = F.array_sort(spans)
    return F.aggregate(
        ordered, F.lit(None).cast(_SPAN_TYPE),
        lambda acc, s: F.when(acc.isNull(), F.array(s)).otherwise(
            F.when(s["word"] <= F.element_at(acc, -1)["word"] + F.element_at(acc, -1)["words"],
                   F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
                       F.element_at(acc, -1)["word"].alias("word"),
                       (F.greatest(F.element_at(acc, -1)["word"] + F.element_at(acc, -1)["words"],
                                   s["word"] + s["words"]) - F.element_at(acc, -1)["word"]).alias("words"),
                       F.element_at(acc, -1)["start"].alias("start"),
                       F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end")))))
            .otherwise(F.concat(acc, F.array(s)))),
        lambda acc: F.coalesce(acc, F.array().cast(_SPAN_TYPE)))


def _n_hit():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["words"])


def _contaminated(n_hit, n_words):
    return (n_hit > 0) & (20 * n_hit >= n_words)


def report(scanned: DataFrame) -> DataFrame:
    """The digest per document, with the coverage rule: contaminated if at
    least a twentieth of the words is hit."""
    names = F.array_sort(F.col("items").cast("array<string>"))
    return scanned.select("doc_id", "n_words", _n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                          F.sha2(F.concat_ws(",", names), 256).alias("items_sha256")) \
        .withColumn("contaminated", _contaminated(F.col("n_hit"), F.col("n_words")))


def remove(documents: DataFrame, benchmark: DataFrame, window: int = 13) -> DataFrame:
    """Rows that are not contaminated, unchanged.  Each is judged by its own
    text, whatever its id; all columns pass through the scan."""
    names = {c: "text" if c == "text" else f"_c{k}" for k, c in enumerate(documents.columns)}
    scanned = _scan(documents.withColumnsRenamed(names), benchmark, window)
    return scanned.where(~_contaminated(_n_hit(), F.col("n_words"))) \
        .select(*[F.col(own).alias(c) for c, own in names.items()])
