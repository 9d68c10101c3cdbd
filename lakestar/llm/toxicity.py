"""Toxicity scores by a factorization machine over hashed terms.

A document's terms are its distinct lower-cased words and the beginnings of
words that 1, 2 or 4 of its distinct words share (inflected and compound
forms of a stem), hashed to ``HASH_BITS`` bits.  The machine adds to the
linear weight of each term the product of the factors of each pair of terms,
so a pair can weigh more than its members; the pair sum is divided by the
number of known terms, which keeps long documents comparable.  It is fitted in
one task on a bounded sample of labelled rows (``max_rows``): terms are chosen
by a sparse linear model, then the weights and factors of ``pair_terms`` of
them are trained together.  Terms and scores of all documents are computed
where their text is read: nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import flat_ranges, mix, prefix_hash, range_hash, returns_memory, row_blocks, utf8, words

HASH_BITS = 40
STEMS = (4, 6)                  # bytes of a word's beginning
SHARED = (1, 2, 4)              # distinct words that share it
MAX_ROWS = 8_000                # labelled rows that the machine is fitted on, at most
TEXT_BYTES = 2 << 20


def block_terms(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms of every row, ascending, and the n + 1 offsets of the
    rows in them."""
    low, start, end, first = words(raw, offsets)
    prefix, shift = prefix_hash(low), np.uint64(64 - HASH_BITS)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first)).astype(np.uint64) << np.uint64(HASH_BITS)
    word, at = np.unique(row | range_hash(prefix, start, end) >> shift, return_index=True)
    found = [word]
    row, start, size = row[at], start[at], end[at] - start[at]
    for stem in STEMS:
        long = size >= stem
        hashes = range_hash(prefix, start[long], start[long] + stem)
        key, count = np.unique(row[long] | hashes >> shift, return_counts=True)
        low_bits = np.uint64((1 << HASH_BITS) - 1)
        for n in SHARED:
            some = key[count >= n]
            salted = mix((some & low_bits) + np.uint64((stem << 8 | n) << HASH_BITS)) >> shift
            found.append(some & ~low_bits | salted)
    key = np.sort(np.concatenate(found))
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    cuts = np.searchsorted(key, np.arange(len(first)).astype(np.uint64) << np.uint64(HASH_BITS))
    return (key & np.uint64((1 << HASH_BITS) - 1)).astype(np.int64), cuts


@dataclass
class Machine:
    """Weights and factors of ``term`` (ascending); other terms have none."""

    bias: float
    term: np.ndarray
    weight: np.ndarray          # terms
    factor: np.ndarray          # terms x factors

    def scores(self, terms: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        n = len(cuts) - 1
        slot = _slots(self.term, terms)
        row = np.repeat(np.arange(n), np.diff(cuts))
        keep = slot >= 0
        logit, *_ = _forward(self.bias, self.weight, self.factor, slot[keep], row[keep], n)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _slots(known: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Index of each term among the known ones, or -1."""
    if not len(known):
        return np.full(len(terms), -1)
    at = np.searchsorted(known, terms)
    at[at == len(known)] = 0
    return np.where(known[at] == terms, at, -1)


def _row_sum(values: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(row, weights=values, minlength=n)


def _forward(bias, weight, factor, slot, row, n):
    size = np.maximum(np.bincount(row, minlength=n), 1)
    v = factor[slot]
    total = np.stack([_row_sum(v[:, f], row, n) for f in range(v.shape[1])], axis=1)
    squares = _row_sum((v * v).sum(axis=1), row, n)
    pairs = ((total * total).sum(axis=1) - squares) / (2 * size)
    return bias + _row_sum(weight[slot], row, n) + pairs, v, total, size


def _distinct_rows(terms: np.ndarray, cuts: np.ndarray, label: np.ndarray) -> np.ndarray:
    """First row of every set of terms with its label: copies of a document
    say no more than one of them."""
    seen: dict[tuple, int] = {}
    for i in range(len(label)):
        seen.setdefault((md5(terms[cuts[i]:cuts[i + 1]].tobytes()).digest(), label[i]), i)
    return np.array(sorted(seen.values()), np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _loss(logit: np.ndarray, label: np.ndarray) -> float:
    p = np.clip(_sigmoid(logit), 1e-9, 1 - 1e-9)
    return float(-(label * np.log(p) + (1 - label) * np.log(1 - p)).mean())


def fit(terms: np.ndarray, cuts: np.ndarray, label: np.ndarray, factors: int = 4, rounds: int = 120,
        epochs: int = 120, rate: float = 0.05, decay: float = 3e-4, evidence: float = 3.5, min_rows: int = 4,
        pair_rows: int = 20, pair_terms: int = 256, seed: int = 7) -> Machine:
    """Logistic loss.  First linear weights, by proximal AdaGrad: a term's
    weight leaves zero only if its rows' errors sum to ``evidence`` standard
    deviations of chance, so labels without a reason are not memorised by the
    rare words of their text; half of the rounds choose the terms, the others
    set their weights with a tenth of that penalty.

    Then factors: the chosen terms and, up to ``pair_terms``, those of at least
    ``pair_rows`` rows that tell the labels apart best by themselves take part.
    Their weights and factors are trained together by Adam on nine tenths of
    the rows with weight decay, and the epoch with the least loss on the other
    tenth stays.  Terms of fewer than ``min_rows`` rows are left out.  Without
    rows every score is 0."""
    rows = _distinct_rows(terms, cuts, label)
    sizes = cuts[rows + 1] - cuts[rows]
    if len(rows) < len(label):
        terms, label = terms[flat_ranges(cuts[rows], sizes)], label[rows]
    ordered = np.sort(terms)
    edge = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]])) if len(terms) else np.zeros(1)
    kept = ordered[edge[:-1][np.diff(edge) >= min_rows].astype(np.int64)]
    del ordered, edge
    n, d = len(label), len(kept)
    weight, factor = np.zeros(d), np.zeros((d, factors))
    if not n:
        return Machine(-30.0, kept, weight, factor)
    share = float(np.clip(label.mean(), 1e-3, 1 - 1e-3))
    bias = float(np.log(share / (1 - share)))
    # a million terms at a time, so no array of them all is wider than needed
    row = np.repeat(np.arange(n, dtype=np.int32), sizes)
    parts = [_slots(kept, terms[k:k + (1 << 20)]).astype(np.int32) for k in range(0, len(terms), 1 << 20)]
    of = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    del parts, terms
    of, row = of[of >= 0], row[of >= 0]

    count = np.bincount(of, minlength=d)
    penalty = evidence * np.sqrt(count * share * (1 - share))
    seen_bias, seen = 1e-8, np.full(d, 1e-8)
    for k in range(rounds):
        if k == rounds // 2:                # the terms are chosen; now with little shrinkage
            penalty = np.where(weight == 0, np.inf, penalty / 10)
        error = _sigmoid(bias + _row_sum(weight[of], row, n)) - label
        slope = np.bincount(of, weights=error[row], minlength=d)
        # at zero the penalty absorbs the slope; only what exceeds it moves a weight
        inactive = (weight == 0) & (np.abs(slope) <= penalty)
        seen += np.where(inactive, 0, slope ** 2)
        step = 1 / np.sqrt(seen)
        moved = weight - step * slope
        weight = np.where(inactive, 0, np.sign(moved) * np.maximum(np.abs(moved) - step * np.where(inactive, 0, penalty), 0))
        seen_bias += error.sum() ** 2
        bias -= 0.5 * float(error.sum()) / seen_bias ** 0.5

    error = share - label
    z = np.abs(np.bincount(of, weights=error[row], minlength=d)) / np.sqrt(np.maximum(count, 1) * share * (1 - share))
    able = np.flatnonzero((weight != 0) | (count >= pair_rows))
    able = able[np.lexsort((-z[able], weight[able] == 0))]
    used = np.sort(able[:max(pair_terms, int((weight != 0).sum()))])
    if not len(used):
        return Machine(bias, kept[:0], weight[:0], factor[:0])
    place = np.full(d, -1, np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    some = place[of] >= 0
    held = np.zeros((n, len(used)), np.float32)         # rows x terms: 8 MB by default
    held[row[some], place[of[some]]] = 1
    del of, row, some
    test = np.arange(n) % 10 == 0
    state = _train_pairs(held[~test], label[~test], held[test], label[test], bias, weight[used], factors, epochs, rate,
                         decay, np.random.default_rng(seed))
    return Machine(float(state[0][0]), kept[used], state[1], state[2])


def _dense(held: np.ndarray, size: np.ndarray, bias, weight, factor) -> tuple[np.ndarray, np.ndarray]:
    """Logits of rows of ones and zeros, and the sum of each row's factors."""
    total = held @ factor.astype(np.float32)
    squares = held @ (factor * factor).sum(axis=1).astype(np.float32)
    return bias[0] + held @ weight.astype(np.float32) + ((total * total).sum(axis=1) - squares) / (2 * size), total


def _train_pairs(held, label, held_test, label_test, bias, weight, factors, epochs, rate, decay, rng) -> list[np.ndarray]:
    """Bias, weights and factors together, by Adam over all rows."""
    size, size_test = (np.maximum(x.sum(axis=1), 1) for x in (held, held_test))
    state = [np.array([bias]), weight.copy(), rng.normal(0, 0.1, (len(weight), factors))]
    mean, square = ([np.zeros_like(x) for x in state] for _ in range(2))
    best, kept = np.inf, [x.copy() for x in state]
    for epoch in range(1, epochs + 1):
        logit, total = _dense(held, size, *state)
        error = (_sigmoid(logit) - label) / len(label)
        scaled = (error / size).astype(np.float32)
        slopes = [np.array([error.sum()]), held.T @ error.astype(np.float32) + decay * (state[1] - weight),
                  held.T @ (scaled[:, None] * total) - (held.T @ scaled)[:, None] * state[2] + decay * state[2]]
        for x, slope, m, q in zip(state, slopes, mean, square):
            m += 0.1 * (slope - m)
            q += 0.001 * (slope * slope - q)
            x -= rate * (m / (1 - 0.9 ** epoch)) / (np.sqrt(q / (1 - 0.999 ** epoch)) + 1e-8)
        loss = _loss(_dense(held_test, size_test, *state)[0], label_test)
        if loss < best:
            best, kept = loss, [x.copy() for x in state]
    return kept


@returns_memory
def _featurise(batches):
    for batch in batches:
        raw_all, offsets = utf8(batch.column(2))
        for a, b in row_blocks(offsets, TEXT_BYTES):
            terms, cuts = block_terms(raw_all[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(terms, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], batch.column(1)[a:b], lists],
                                             ["doc_id", "label", "terms"])


def _trainer(options: dict):
    @returns_memory
    def train(batches):
        rows = [(d, y, np.array(t, np.int64)) for batch in batches for d, y, t in zip(
            batch.column(0).to_pylist(), batch.column(1).to_pylist(),
            (x.values.to_numpy() for x in batch.column(2)))]
        rows.sort(key=lambda x: (x[0], x[1], len(x[2])))    # the order that rows arrive in has no effect
        cuts = np.concatenate([[0], np.cumsum([len(t) for _, _, t in rows])]).astype(np.int64)
        terms = np.concatenate([t for _, _, t in rows]) if rows else np.zeros(0, np.int64)
        label = np.array([y for _, y, _ in rows], float)
        rows.clear()
        m = fit(terms, cuts, label, **options)
        yield pa.RecordBatch.from_pydict(
            {"bias": [m.bias], "factors": pa.array([m.factor.shape[1]], pa.int32()),
             "term": pa.array([m.term.astype("<i8").tobytes()], pa.binary()),
             "weight": pa.array([m.weight.astype("<f4").tobytes()], pa.binary()),
             "factor": pa.array([m.factor.astype("<f4").tobytes()], pa.binary())})
    return train


def train(documents: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_ROWS,
          doc_id: str = "doc_id", text: str = "text", **options) -> Machine:
    """Fit on at most ``max_rows`` labelled documents, those with the smallest
    hash of their id.  Labels other than 0 and 1 and null ids are left out; a
    document labelled twice counts once with its larger label."""
    given = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()) \
        .groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("label")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    # bounded by max_rows, so broadcast
    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")) \
        .join(F.broadcast(given), "doc_id").select("doc_id", "label", "text")
    features = rows.mapInArrow(_featurise, "doc_id long, label int, terms array<long>")
    model = features.repartition(1).mapInArrow(
        _trainer(options), "bias double, factors int, term binary, weight binary, factor binary").first()
    return Machine(model.bias, np.frombuffer(model.term, "<i8"), np.frombuffer(model.weight, "<f4").astype(float),
                   np.frombuffer(model.factor, "<f4").astype(float).reshape(-1, model.factors))


def _scorer(machine: Machine, text: str):
    @returns_memory
    def score(batches):
        for batch in batches:
            raw_all, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
            for a, b in row_blocks(offsets, TEXT_BYTES):
                terms, cuts = block_terms(raw_all[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(a, b - a).columns, pa.array(machine.scores(terms, cuts))],
                    [*batch.schema.names, "score"])
    return score


def score(documents: DataFrame, machine: Machine, text: str = "text") -> DataFrame:
    """Adds ``score``, the probability that the label is 1.

    Null and empty texts get the score of a document without terms.  Repeated
    rows get the same score; other columns pass through (one called score is
    replaced).
    """
    from pyspark.sql import types as T

    documents = documents.drop("score")
    schema = T.StructType([*documents.schema.fields, T.StructField("score", T.DoubleType())])
    return documents.mapInArrow(_scorer(machine, text), schema)


def held_out(doc_id="doc_id"):
    """Rows that no label is learnt from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0
