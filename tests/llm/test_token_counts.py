import random

import pytest

P = pytest.importorskip("public_tokenizers")
import sentencepiece  # noqa: E402

from lakestar.llm import token_counts  # noqa: E402

MODEL = P.path("piece_bpe_32k.model")
EDGE = [None, "", " ", "  ", "\n", "\n\n", " \n ", "a ", " a  b ", "a\nb\t\tc\r\n", "▁x▁", "<s>hi</s> <unk><0x41>", "\x00", "﻿ab",
        "ﬁ Å é 　 ", "w" * 5_000, " " * 3_000, "\U0001f600 中文 " * 400, "the cat " * 9_000]


def texts(n=300):
    rng = random.Random(7)
    words = ["the", "of", "naïve", "x1", "don't", "\n", " ", "\t", "中文", "😀", "▁", "<s>", "...", "Zürich,", "\n\n", "a" * 90]
    return EDGE + [" ".join(rng.choice(words) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_counts_equal_the_library(make):
    assert token_counts.divisible(MODEL)
    rows = [(i, t, 1) for i, t in enumerate(texts())] + [(None, "the cat", 2), (3, "\n", 3), (3, "\n", 3)]
    table = make("doc_id long, text string, n_tokens int", rows)           # a clashing column
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = token_counts.count_tokens(table, MODEL).collect()
    assert len(got) == len(rows)
    assert [(r.text, r.n_tokens) for r in got] == [(t, len(library.encode(t or ""))) for _, t, _ in rows]


def test_counts_without_tables_and_with_tiny_caches(make, monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    monkeypatch.setattr(token_counts, "CACHED", 3)
    lengths = token_counts.Lengths(MODEL, {" the": 1})
    assert [lengths.of_text(t) for t in texts()] == [len(library.encode(t or "")) for t in texts()]
    assert len(lengths) <= 4


def test_model_that_cannot_be_divided_is_applied_to_whole_texts(make, monkeypatch):
    monkeypatch.setattr(token_counts, "divisible", lambda path: False)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = token_counts.count_tokens(make("text string", [(t,) for t in EDGE]), MODEL).collect()
    assert [r.n_tokens for r in got] == [len(library.encode(t or "")) for t in EDGE]


def test_frequent_segments_cover_all_partitions(spark, make, monkeypatch):
    rows = [(i, "rare%d often also%d" % (i, i % 5)) for i in range(400)] + [(i, None) for i in range(9)]
    table = make("doc_id long, text string", rows).repartition(150)       # more than one merge of FAN
    found = token_counts.frequent_segments(table)
    assert {" often", *(f" also{i}" for i in range(5))} <= set(found)
    assert len(found) <= token_counts.FREQUENT


def test_summary_keeps_what_is_frequent():
    from collections import Counter
    rng = random.Random(3)
    total, kept = Counter(), Counter()
    for _ in range(60):
        part = Counter(rng.choice(["hot", "warm", *map(str, range(300))]) if rng.random() < 0.4 else "hot" for _ in range(500))
        total += part
        kept.update(part)
        kept = token_counts.heaviest(kept, 40)
    bound = sum(total.values()) / 40
    assert len(kept) <= 40 and all(n - kept[s] <= bound for s, n in total.items())
    assert "hot" in kept


def test_report_of_null_empty_and_long_texts(make):
    out = {r.doc_id: r for r in token_counts.report(
        make("doc_id long, text string", [(1, None), (2, ""), (3, "the " * 5_000), (4, "é")]), MODEL).collect()}
    assert (out[1].n_bytes, out[1].n_tokens, out[1].over_limit) == (0, 0, False) == (out[2].n_bytes, out[2].n_tokens, out[2].over_limit)
    assert out[3].over_limit and out[4].n_bytes == 2
    assert token_counts.report(make("doc_id long, text string", []), MODEL).count() == 0
