import random
from collections import Counter
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
import pytest

P = pytest.importorskip("public_tokenizers")
import sentencepiece  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from lakestar.llm import token_alignment  # noqa: E402

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
EDGE = [None, "", " ", "a", "  two  spaces ", "▁ is not kept", "<s> plain <|endoftext|> <0x41>", "naïve Zürich 中文😀", "\x00\n\t\r\n",
        "x" * 3000, "internationalisation of tokenizers", "the cat", "the cat"]


def texts(n=120):
    rng = random.Random(11)
    words = ["the", "unbelievable", "naïve", "x1-y2", "don't", "\n", "", "中文", "😀", "▁", "Zürich,", "...", "0x41", "’"]
    return EDGE + [" ".join(rng.choice(words) for _ in range(rng.randrange(25))) for _ in range(n)]


@lru_cache
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def spans(text):
    """Ids and byte ranges of both sides, straight from the libraries."""
    a, b = libraries()
    alphabet = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(x): x for x in alphabet} | {chr(0x100 + i): x for i, x in enumerate(x for x in range(256) if x not in alphabet)}
    pieces = [[(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids], []]
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        pieces[1].append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    if any(b"".join(x for _, x in side) != (" " + text).encode() for side in pieces):
        return [], []
    out = []
    for side in pieces:
        at, found = 0, []
        for i, raw in side:
            found.append((i, at, at + len(raw)))
            at += len(raw)
        out.append(found)
    return out


def brute(rows):
    aligned, count = [], Counter()
    for doc, text in rows:
        a, b = spans(text) if text else ([], [])
        links = [(x[0], y[0]) for x in a for y in b if max(x[1], y[1]) < min(x[2], y[2])]
        count.update(links)
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups = ["|".join(",".join(str(i) for i, s, e in side if first <= s and e <= last) for side in (a, b))
                  for first, last in zip([0, *cuts], cuts)]
        aligned.append((doc, len(a), len(b), groups, links))
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return sorted(((d, a, b, len(g), len(ls), sum(count[p] == most[p[1]] for p in ls), sum(count[p] for p in ls),
                    sha256(";".join(g).encode()).hexdigest() if g else "") for d, a, b, g, ls in aligned), key=repr)


@pytest.fixture(scope="module")
def rows():
    return [(i, t) for i, t in enumerate(texts())] + [(None, "the cat"), (3, "a"), (3, "a")]


@pytest.mark.parametrize("broadcast_pairs", [10**6, 0])
def test_report_equals_brute_force(make, rows, broadcast_pairs):
    table = make("doc_id long, text string, row int, pairs string, n_a int", [(d, t, 1, "x", 2) for d, t in rows]).repartition(3)
    got = token_alignment.report(table, A, B, broadcast_pairs=broadcast_pairs)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_align_returns_groups(make):
    row = token_alignment.align(make("doc_id long, text string", [(1, "unbelievable cat")]), A, B).first()
    assert row.groups.count(";") + 1 == row.n_groups and sum(row.times) == row.n_links
    assert sha256(row.groups.encode()).hexdigest() == row.groups_sha256


def test_empty_table_and_texts_without_tokens(make):
    assert token_alignment.report(make("doc_id long, text string", []), A, B).count() == 0
    got = token_alignment.report(make("doc_id long, text string", [(1, None), (2, "▁")]), A, B).collect()
    assert [tuple(r)[1:] for r in got] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_parts_give_the_tokens_of_whole_texts():
    known = token_alignment.load(A, B)
    some = [t for t in texts() if t] + ["the cat sat  on \n the mat " * 50]
    (a, n_a), (b, n_b) = known.encode(some)
    want = [spans(t) for t in some]
    assert n_a.tolist() == [len(x) for x, _ in want] and n_b.tolist() == [len(y) for _, y in want]
    assert a.tolist() == [i for x, _ in want for i, *_ in x] and b.tolist() == [i for _, y in want for i, *_ in y]


def test_overlaps_equal_brute_force():
    rng = np.random.default_rng(5)
    sides = []
    for _ in range(2):
        starts = [np.concatenate([[0], np.flatnonzero(rng.random(39) < 0.4) + 1]) + 40 * d for d in range(30)]
        sides.append(pd.DataFrame({"doc": np.repeat(np.arange(30), [len(s) for s in starts]), "at": np.concatenate(starts)}))
    a, b = sides
    ends = [np.append(s["at"].to_numpy()[1:], 1200) for s in sides]
    want = sorted((i, j) for i in range(len(a)) for j in range(len(b))
                  if max(a["at"][i], b["at"][j]) < min(ends[0][i], ends[1][j]))
    assert sorted(zip(*(x.tolist() for x in token_alignment.overlaps(a, b)))) == want
