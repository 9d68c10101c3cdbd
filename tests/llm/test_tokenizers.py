import base64
import random
import sys
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
import tiktoken  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from lakestar.llm import byte_bpe, repair_store  # noqa: E402
from lakestar.session import scratch_path  # noqa: E402

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")
EDGE = ["", None, " ", "a", "a" * 30_000, " " * 5_000, "ab" * 4_000, "naïve\x1c\x85 ünï中文😀", "it's THE END\r\n\n x"]


def texts(seed=1, n=200):
    rng = random.Random(seed)
    alphabet = "ab \n\t'stréß中文😀12!?́‍\x1c\x85ΣσİA<|endoftext|>"
    return EDGE + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(150))) for _ in range(n)]


def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_equals_library_and_decodes(make):
    rows = [(i, t, "x") for i, t in enumerate(texts())] + [(0, "", "x")]      # a repeated row
    df = make("doc_id long, text string, ids string", rows)                   # a clashing column
    out = byte_bpe.decode(byte_bpe.encode(df, RANKS, P.PATTERN), RANKS).collect()
    enc = reference()
    assert len(out) == len(rows)
    for r in out:
        text = r.text or ""
        assert r.ids == enc.encode_ordinary(text)
        assert r.decoded == text.encode()


def test_byte_bpe_round_trip_in_one_pass(make):
    rows = [(i, t, "x", b"y") for i, t in enumerate(texts())]
    df = make("doc_id long, text string, ids string, decoded binary", rows)
    once = byte_bpe.round_trip(df, RANKS, P.PATTERN)
    assert once.columns == ["doc_id", "ids", "decoded"]
    twice = byte_bpe.decode(byte_bpe.encode(df, RANKS, P.PATTERN), RANKS).select(*once.columns)
    assert sorted(once.collect()) == sorted(twice.collect())
    assert byte_bpe.round_trip(df.limit(0), RANKS, P.PATTERN).count() == 0


def test_byte_bpe_empty_table(make):
    df = make("doc_id long, text string", [])
    assert byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(df, RANKS, P.PATTERN), RANKS)).count() == 0


def test_merge_replay_handles_runs_and_inversions():
    ranks = byte_bpe.load_ranks(RANKS)
    rng = random.Random(5)
    words = [bytes(rng.choice(b"aeinrst ") for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    words += [b"a" * n for n in range(1, 60)]
    ids, counts = byte_bpe.MergeReplay(ranks)(words)
    for word, got in zip(words, np.split(ids, np.cumsum(counts)[:-1])):
        want = [ranks.of[word]] if word in ranks.of else ranks.encode_one(word)
        assert got.tolist() == want


def test_store_round_trip(spark, make):
    rows = [(i * 7 % 211, t, i) for i, t in enumerate(texts(2))] + [(None, "no id", 0), (3, "again", 1), (3, "again", 1)]
    path = scratch_path(spark, "test-store")
    repair_store.write(make("doc_id long, text string, start int", rows), path, WORDS)
    out = [(r.doc_id, r.start, r.n_tokens, r.ids) for r in repair_store.read(spark, path).collect()]
    lib = Tokenizer.from_file(WORDS)
    lib.encode_special_tokens = True
    want = sorted((d is not None, d or 0, np.array(lib.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes())
                  for d, t, _ in rows)
    assert sorted((d is not None, d or 0, bytes(ids)) for d, _, _, ids in out) == want
    some = {(r.doc_id, r.start, bytes(r.ids)) for r in repair_store.read(spark, path, [3, 7, 10**9]).collect()}
    assert some == {(d, start, bytes(ids)) for d, start, _, ids in out if d in (3, 7)}
    before = 0
    for d, start, n, ids in sorted(out, key=lambda r: r[1]):        # starts add up in ascending order of id
        assert start == before and n == len(ids) // 4
        before += n
    order = [d for d, *_ in sorted(out, key=lambda r: r[1])]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))


def test_store_encodes_added_tokens_as_the_library(spark, make):
    some = ["the end<|endoftext|> again", "<|startoftext|>a b<|endoftext|>", "É<|endoftext|>é 中<|startoftext|>", "<|ENDOFTEXT|> x",
            "<|endoftext|><|endoftext|>", "<|endof text|> <|endoftext| >", "a\x1c<|endoftext|>\x1cb", "the end again"]
    path = scratch_path(spark, "test-store")
    repair_store.write(make("doc_id long, text string", list(enumerate(some))), path, WORDS)
    lib = Tokenizer.from_file(WORDS)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in repair_store.read(spark, path).collect()}
    assert got == {i: lib.encode(t, add_special_tokens=False).ids + [1] for i, t in enumerate(some)}
    assert 49407 in got[0]


def test_latin_texts_are_cut_as_by_the_pattern():
    encoder = repair_store.WordEncoder(WORDS)
    rng = random.Random(7)
    some = ["", "a's 's ''s x'sy 'S 're've'm'll'd'x 'tis don''t 1's2't ½x²", "'", "'r", "l'l", "İ'S ſt\x00'd\n\n", "a'v", "'s't"] + \
        ["".join(rng.choices("ab'strevmldé1½ \n\x85\xa0×ª?\x00\x7f\xadİ", k=rng.randrange(40))) for _ in range(2000)]
    found, sizes = encoder._cut(some)
    want = [encoder.pieces(t.lower()) for t in some]
    assert sizes.tolist() == list(map(len, want))
    assert [p.decode("utf-16-le") for p in found.to_pylist()] == [p for w in want for p in w]
    ids, sizes = encoder.encode(some)
    lib = Tokenizer.from_file(WORDS)
    assert ids.tolist() == [i for t in some for i in lib.encode(t, add_special_tokens=False).ids]


def test_new_words_cost_no_calls_each():
    """CPU per word met for the first time: one call for all of a shard."""
    encoder = repair_store.WordEncoder(WORDS)
    rng = random.Random(8)
    some = [" ".join("".join(rng.choices("abcdefghijk", k=9)) + rng.choice(["", ",", "."]) for _ in range(50)) for _ in range(100)]
    calls = [0]

    def count(frame, event, arg):
        calls[0] += event in ("call", "c_call")
    sys.setprofile(count)
    try:
        encoder.encode(some)
    finally:
        sys.setprofile(None)
    assert calls[0] < 2500          # of 5000 new words


def test_store_empty_table(spark, make):
    path = scratch_path(spark, "test-store")
    repair_store.write(make("doc_id long, text string", []), path, WORDS)
    assert repair_store.read(spark, path).count() == 0


def test_grammar_replaces_frequent_pairs_and_expands():
    rng = np.random.default_rng(3)
    ids = np.concatenate([np.tile([5, 6, 7, 8], 400), rng.integers(1, 50, 2000), np.full(301, 9)]).astype(np.uint32)
    sizes = np.array([0, 1601, 0, 1999, 300, 1])
    symbols, own, rules, first = repair_store.compress(ids, sizes, min_count=4, min_share=0)
    assert len(symbols) < len(ids) / 2 and rules and own.sum() == len(symbols) and len(own) == len(sizes)
    back, lengths = repair_store.expand(symbols.astype(np.int64), [a for a, _ in rules], [b for _, b in rules], first)
    assert (back == ids).all() and lengths.sum() == len(ids)
    # every document is whole symbols of its own
    ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(own)]
    assert ends.tolist() == np.cumsum(sizes).tolist()
    nothing = repair_store.compress(np.zeros(0, np.uint32), np.array([0, 0]))
    assert len(nothing[0]) == 0 and nothing[1].tolist() == [0, 0] and nothing[2] == []


def test_written_shards_hold_a_grammar(spark, make):
    # the texts hold the end id as a token of their own, and pairs before every end
    rng = random.Random(4)
    words = ["the", "cat", '"', "sat on", "a mat", "again%", "!"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(60))) + ' "% the end') for i in range(600)] + [(900, None)]
    path = scratch_path(spark, "test-store")
    repair_store.write(make("doc_id long, text string", rows), path, WORDS)
    lib = Tokenizer.from_file(WORDS)
    want = {d: lib.encode(t or "", add_special_tokens=False).ids + [1] for d, t in rows}
    assert any(1 in ids[:-1] for ids in want.values())
    shards = spark.read.schema(repair_store.SCHEMA).parquet(path).collect()
    for s in shards:
        assert len(s.rule_left) > 10 and len(s.symbols) // s.width < 0.6 * s.n_ids
        assert s.n_ids == sum(len(want[d]) for d in s.doc_ids)
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in repair_store.read(spark, path).collect()} == want
    some = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in repair_store.read(spark, path, [5, 900]).collect()}
    assert some == {d: want[d] for d in (5, 900)}


def test_store_query_digest(spark, make):
    path = scratch_path(spark, "test-store")
    repair_store.write(make("doc_id long, text string", [(1, "The cat"), (0, None)]), path, WORDS)
    got = {r.doc_id: (r.start, r.n_tokens, zlib.crc32(r.ids)) for r in repair_store.read(spark, path).collect()}
    assert got[0] == (0, 1, zlib.crc32(np.array([1], "<u4").tobytes()))
    assert got[1][0] == 1
