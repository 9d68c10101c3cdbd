"""Token counts of whole texts by a piece model, from two tiers of lengths.

A piece never continues over a space that follows another character, and no
piece holds a line end, so a text's count is the sum over its *segments*: runs
of spaces with the word behind them, and line ends.  Every segment's length in
tokens is looked up where the text is read:

1. a table of the corpus's frequent segments, learned over all texts and
   broadcast.  Each task keeps a summary of ``FREQUENT`` counters (Misra and
   Gries); summaries are merged ``FAN`` at a time, so no task and not the
   driver holds more than a bounded number of bounded summaries.  A segment
   that makes up more than 1 / ``FREQUENT`` of all is in the table for certain;
2. a cache of its worker for the others, which the library encodes once each.

No segment is shuffled: one summary per task is.  The counts do not depend on
what the tables hold.  A model whose pieces do cross such a place (see
``divisible``) is applied to whole texts instead.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FREQUENT = 16_384               # segments of a summary and of the broadcast table, at most
FAN = 64                        # summaries that are merged at a time
CACHED = 400_000                # segments a worker remembers; beyond, it starts anew
LONGEST = 64                    # characters of a segment that is remembered

SPACE = "▁"                # the model's space
segments = re.compile(" *[^ \n]+| +|\n").findall


@lru_cache(maxsize=2)
def load_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def piece_bytes(piece: str) -> bytes:
    """The bytes that a piece stands for."""
    if m := re.fullmatch("<0x([0-9A-F]{2})>", piece):
        return bytes([int(m[1], 16)])
    return piece.replace(SPACE, " ").encode()


@lru_cache(maxsize=2)
def divisible(path: str) -> bool:
    """Whether the model keeps texts as they are, and none of its pieces
    holds a space behind another character or a line end beside one."""
    model = load_model(path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    crossing = re.compile(f"[^{SPACE}]{SPACE}|.\n|\n.", re.DOTALL).search
    # characters that a normaliser would change
    probe = "\ufb01 \u2460  \u212b\u3000x \u00a0 e\u0301"
    kept = b"".join(piece_bytes(pieces[i]) for i in model.encode(probe))
    return not any(map(crossing, pieces)) and kept == (" " + probe).encode()


class Lengths(dict):
    """Tokens of a segment; what is not there is encoded and remembered."""

    def __init__(self, path: str, frequent: dict[str, int]):
        super().__init__(frequent)
        self.frequent, self.model = frequent, load_model(path)
        # a line end is a token of its own, and nothing joins what stands behind it
        self.before = len(self.model.encode("\n"))

    def __missing__(self, segment: str) -> int:
        n = len(self.model.encode("\n" + segment)) - self.before
        if len(segment) <= LONGEST:
            if len(self) >= CACHED:
                self.clear()
                self.update(self.frequent)
            self[segment] = n
        return n

    def of_text(self, text: str | None) -> int:
        """The model puts a space before a text that is not empty."""
        return sum(map(self.__getitem__, segments(" " + text.replace(SPACE, " ")))) if text else 0


def heaviest(counts: Counter, size: int = FREQUENT) -> Counter:
    """The ``size`` largest counters, each less by the largest one dropped
    (Misra-Gries): what every segment loses is bounded by the total / size."""
    if len(counts) <= size:
        return counts
    ranked = counts.most_common(size + 1)
    least = ranked.pop()[1]
    return Counter({segment: n - least for segment, n in ranked if n > least})


_SUMMARY = "part int, segments array<string>, counts array<bigint>"
_SUMMARY_TYPE = pa.schema([("part", pa.int32()), ("segments", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])


def _row(part: int, counts: Counter) -> dict:
    counts = heaviest(counts)
    return {"part": [part], "segments": [list(counts)], "counts": [list(counts.values())]}


def _summarise(batches):
    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                counts.update(s for s in segments(" " + text.replace(SPACE, " ")) if len(s) <= LONGEST)
                if len(counts) > 16 * FREQUENT:
                    counts = heaviest(counts)
    yield pa.RecordBatch.from_pydict(_row(TaskContext.get().partitionId(), counts), schema=_SUMMARY_TYPE)


def _merge(key, table):
    counts: Counter = Counter()
    for segments_, numbers in zip(table.column("segments").to_pylist(), table.column("counts").to_pylist()):
        counts.update(dict(zip(segments_, numbers)))
        counts = heaviest(counts, 2 * FREQUENT)
    return pa.Table.from_pydict(_row(key[0].as_py(), counts), schema=_SUMMARY_TYPE)


def frequent_segments(documents: DataFrame, text: str = "text") -> list[str]:
    """At most ``FREQUENT`` segments, among them all that hold more than
    1 / ``FREQUENT`` of the occurrences in all texts."""
    rows = documents.select(F.col(text).alias("text"))
    parts = rows.rdd.getNumPartitions()
    summaries = rows.mapInArrow(_summarise, _SUMMARY)
    while parts > 1:
        parts = -(-parts // FAN)
        summaries = summaries.groupBy(F.pmod("part", F.lit(parts)).alias("to")).applyInArrow(_merge, _SUMMARY)
    found = summaries.select("segments").first()
    return found.segments if found else []


def _counter(path: str, table, column: int):
    def count(batches):
        lengths = None
        for batch in batches:
            texts = batch.column(column).to_pylist()
            if table is None:
                numbers = [len(ids) for ids in load_model(path).encode([t or "" for t in texts], num_threads=1)]
            else:
                lengths = lengths or _worker_lengths(path, table)
                numbers = list(map(lengths.of_text, texts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())],
                                             [*batch.schema.names, "n_tokens"])
    return count


_caches: dict[tuple, Lengths] = {}


def _worker_lengths(path: str, table) -> Lengths:
    """The cache of this worker, which outlives a task."""
    key = (path, table.id if hasattr(table, "id") else id(table))
    if key not in _caches:
        _caches.clear()
        _caches[key] = Lengths(path, table.value)
    return _caches[key]


def count_tokens(documents: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """Adds ``n_tokens`` (long): tokens of each whole text as the sentencepiece
    library gives them, without begin, end or added special tokens.

    Null and empty texts have none.  Repeated rows count alike; other columns
    pass through, but for one called ``n_tokens``, which is replaced.  Texts of
    any length are handled, as are segments of any length (those of more than
    ``LONGEST`` characters are encoded each time).  An empty table gives an
    empty one.
    """
    documents = documents.drop("n_tokens")
    table = None
    if divisible(model_path):
        known = Lengths(model_path, {})
        table = documents.sparkSession.sparkContext.broadcast(
            {s: known[s] for s in frequent_segments(documents, text)})
    schema = T.StructType([*documents.schema.fields, T.StructField("n_tokens", T.LongType())])
    return documents.mapInArrow(_counter(model_path, table, documents.columns.index(text)), schema)


def report(documents: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` (more tokens than ``limit``)."""
    rows = documents.select("doc_id", F.col("text"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return count_tokens(rows, model_path).select("doc_id", "n_bytes", "n_tokens",
                                                 (F.col("n_tokens") > limit).alias("over_limit"))
