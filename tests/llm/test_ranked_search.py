import random
import re
from collections import Counter
from math import floor, log

import numpy as np

from lakestar.llm import ranked_search


def words(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return [re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), w) for w in found]


def brute(docs, items, k):
    held = [(d, Counter(words(t))) for d, t in docs]
    n_docs, total = sum(1 for _, c in held if c), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for d, c in held:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // max(total, 1)
            score = sum(floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in set(words(text)) if c[t])
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, i + 1, None if null else d, -s) for i, (s, null, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def corpus(seed, n_docs=160, n_items=25):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(70)] + ["É", "中文", "I", "X9"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(0, 40)))) for i in range(n_docs)]
    docs += [(1000 + i, docs[5][1]) for i in range(30)] + [(None, docs[5][1]), (7, docs[7][1]), (500, None), (501, ""), (502, "...")]
    items = [(i, ", ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 30)))) for i in range(n_items)]
    return docs, items + [(100, docs[5][1].upper()), (101, None), (102, ""), (103, "unknown"), (None, "w1 w2")]


def run(make, docs, items, **options):
    got = ranked_search.search(make("doc_id long, text string, rank int, score string", [(d, t, 1, "x") for d, t in docs]).repartition(5),
                               make("item_id long, text string, number int", [(i, t, 1) for i, t in items]), **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_equals_brute_force(make):
    docs, items = corpus(1)
    assert run(make, docs, items) == brute(docs, items, 10)


def test_equals_brute_force_with_many_shards_and_blocks(make):
    docs, items = corpus(2)
    assert run(make, docs, items, k=3, shard_bytes=600, block_bytes=900) == brute(docs, items, 3)


def test_one_document_and_very_long_texts(make):
    docs = [(1, "Solo " * 40_000 + "tail"), (2, "solo")]
    assert run(make, docs, [(1, "solo tail"), (2, "tail")]) == brute(docs, [(1, "solo tail"), (2, "tail")], 10)


def test_empty_tables(make):
    docs, items = corpus(3, 20, 2)
    assert run(make, [], items) == []
    assert run(make, docs, []) == []
    assert run(make, [(1, None)], items) == []


def shard(docs, items, k=10):
    vocabulary = ranked_search.Vocabulary((t, i) for i, t in enumerate(sorted({t for x in items for t in ranked_search.terms(x)})))
    n, doc, term, tf = ranked_search.postings(docs, vocabulary)
    df = Counter(term.tolist()) | {-1: int((n > 0).sum()), -2: int(n.sum())}
    held = [sorted({vocabulary[t] for t in ranked_search.terms(x)}) for x in items]
    block = ranked_search.Items(list(range(len(items))), held, df, k)
    return ranked_search.Shard(block, n, doc, term, tf)


def test_pairs_tighten_the_bounds_and_stay_bounds():
    docs, items = corpus(4)
    index = shard([t for _, t in docs], [t for _, t in items])
    tighter = 0
    for chain in index.chains:
        if not len(chain):
            continue
        groups, reached = index.groups(chain)
        assert sorted(t for _, ts in groups for t in ts) == sorted(chain.tolist())
        together, alone = sum(b for b, _ in groups), int(index.most[chain].sum())
        every = np.arange(index.size)
        scores = sum(index.find(np.full(index.size, t), every) for t in chain)
        for bound, ts in groups:
            assert sum(index.find(np.full(index.size, t), every) for t in ts).max() <= bound
        assert scores.max() <= together <= alone
        assert (scores >= reached).sum() >= 10 or reached == 0
        tighter += together < alone
        found, score = index.search(chain, 1)
        best = np.sort(scores[scores > 0])[::-1][:10]
        assert np.sort(score)[::-1][:len(best)].tolist() == best.tolist()
    assert tighter > len(index.chains) // 2


def test_terms_of_rare_pairs_are_skipped_only_thanks_to_their_joint_bound():
    # a and b never meet, so together they cannot reach what c and d give
    docs = ["c d"] * 10 + ["a x x x x"] * 2 + ["b x x x x"] * 2 + ["y"] * 30
    index = shard(docs, ["a b c d"])
    chain = index.chains[0]
    a, b = chain[:2]
    joint = index.joint[np.searchsorted(index.pairs, index._pair(chain[:1], chain[1:2]))][0]
    assert joint == 0 and max(index.most[a], index.most[b]) < index.most[a] + index.most[b]
    groups, _ = index.groups(chain)
    assert sum(bound for bound, _ in groups) < index.most[chain].sum()
