import hashlib
import itertools
import random
import re

import numpy as np

from pyspark.sql import DataFrameWriter

from lakestar.llm import graph, ngram_join, substring_dedup, vector_dedup


def components(edges, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def words(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def corpus(seed=2):
    """Random texts, copies, near copies in a chain and in a large group."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(3000)]
    base = [rng.choices(vocabulary, k=rng.randrange(8, 120)) for _ in range(60)]
    out = [" ".join(b) for b in base]
    for b in base[:20]:
        for _ in range(rng.randrange(4)):
            c = list(b)
            c[rng.randrange(len(c))] = "changed"
            out.append(" ".join(c).upper() if rng.random() < 0.3 else " ".join(c))
    hub = rng.choices(vocabulary, k=100)
    for k in range(60):
        c = list(hub)
        c[rng.randrange(100)] = f"x{k}"
        out.append(" ".join(c))
    passage = " ".join(rng.choices(vocabulary, k=30))
    out += [passage + " " + " ".join(rng.choices(vocabulary, k=60)) for _ in range(20)]
    return out + out[:5] * 2 + ["", None, "...", "one", "one", "one two", "a " * 3000]


def test_join_equals_brute_force(make, monkeypatch):
    monkeypatch.setattr(ngram_join, "BUCKET", 8)           # recursion and blocks at this size
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 16)
    rows = [(i, t, "k") for i, t in enumerate(corpus())]
    sets = {i: shingles(t) for i, t, _ in rows}
    edges = [(a, b) for a, b in itertools.combinations(sets, 2)
             if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]
    want = components(edges, sets)
    out = ngram_join.self_join(make("doc_id long, text string, key string", rows)).collect()
    assert {r.doc_id: r.class_id for r in out} == want and len(out) == len(rows)
    for r in out:
        assert r.n_links == sum(r.doc_id in e for e in edges)


def test_join_runs_follow_from_the_target_recall():
    assert ngram_join.runs_for(0.9999, 0.8, 4) == 18 and ngram_join.runs_for(0.99, 0.8, 1) == 3
    assert ngram_join.runs_for(0.9999, 1.0, 4) == 1
    for recall, s, levels in [(0.9, 0.5, 2), (0.999, 0.8, 3), (0.9999, 0.9, 4)]:
        runs = ngram_join.runs_for(recall, s, levels)
        assert (1 - s ** levels) ** runs <= 1 - recall < (1 - s ** levels) ** (runs - 1)


def test_shingles_of_many_rows_are_those_of_each(monkeypatch):
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcdefg", k=rng.randrange(40))) for _ in range(50)] + ["", "x " * 300]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    whole = ngram_join.shingles(raw, offsets, 5)
    monkeypatch.setattr(ngram_join, "TEXT_BYTES", 64)
    parts = ngram_join._all_shingles(raw, offsets, 5)
    assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])


def test_join_edge_tables(make):
    assert ngram_join.self_join(make("doc_id long, text string", [])).count() == 0
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, None)]
    out = sorted((r.doc_id or 0, r.class_id or 0, r.n_links) for r in
                 ngram_join.self_join(make("doc_id long, text string", rows)).collect())
    assert out == [(0, 0, 0), (1, 1, 1), (1, 1, 1), (2, 2, 0)]


def test_deduplicate_keeps_one_of_each_class(make):
    rows = [(5, "a b c d e f g"), (3, "A b c d e f g"), (4, "z"), (6, None)]
    assert sorted(r.doc_id for r in ngram_join.deduplicate(make("doc_id long, text string", rows)).collect()) == [3, 4, 6]


def test_deduplicate_judges_rows_and_not_ids(make):
    a, b = "a b c d e f g", "p q r s t u v w"
    rows = [(1, a, "x"), (1, a, "x"), (1, b, "own"), (None, a.upper(), "x"), (None, "k l m n o p", "null"),
            (None, "k l m n o p", "null"), (7, b, "later"), (None, "", "e"), (None, None, "e"), (2, "", "e"), (1, "other", "o")]
    out = ngram_join.deduplicate(make("doc_id long, text string, copies string", rows)).collect()
    assert sorted(r.copies for r in out) == ["e", "e", "e", "null", "o", "own", "x"]
    assert {(r.doc_id, r.text) for r in out if r.copies in ("x", "own")} == {(1, a), (1, b)}


def test_components_of_paths_and_hubs(make):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 301), (301, 300)]
    got = {r.node: r.component for r in graph.components(make("a long, b long", edges)).collect()}
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    assert got == {n: c for n, c in components(edges, nodes).items()}


def test_components_of_many_tasks_and_of_one(make, monkeypatch):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(500 + i, 501 + i) for i in range(50)] + [(600, k) for k in range(601, 660)]
    want = components(edges, {n for e in edges for n in e if e[0] != e[1]})
    nodes, roots = graph.contract(*np.array(edges).T)
    assert {n: r for n, r in zip(nodes.tolist(), roots.tolist()) if n in want} == want
    for most in (graph.EDGES, 7):
        monkeypatch.setattr(graph, "EDGES", most)
        got = graph.components(make("a long, b long", edges).repartition(5)).collect()
        assert {r.node: r.component for r in got} == want and len(got) == len(want)


def test_a_small_graph_needs_no_shuffles(spark, make):
    """Tasks, and so their files on disk, follow the edges and not the number of partitions."""
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    edges = make("a long, b long", [(i, i + 1) for i in range(200)]).coalesce(2)
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("small graph", "components")
        assert {r.component for r in graph.components(edges).collect()} == {0}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    jobs = spark.sparkContext.statusTracker()
    stages = {s for j in jobs.getJobIdsForGroup("small graph") for s in jobs.getJobInfo(j).stageIds}
    assert 0 < sum(jobs.getStageInfo(s).numTasks for s in stages) < 64


def vectors(seed=4):
    rng = np.random.default_rng(seed)
    out, centres = [], rng.normal(size=(30, 16))
    for c in centres:
        for _ in range(rng.integers(1, 8)):
            out.append((c + rng.normal(scale=0.3 * rng.random(), size=16)).astype(np.float32))
    out += [out[0], out[0], 2 * out[0]]
    return out


def test_vectors_equal_brute_force(make, monkeypatch):
    monkeypatch.setattr(vector_dedup, "BLOCK", 8)
    v = vectors()
    rows = [(i, [float(x) for x in e], i % 2 if i < len(v) - 3 else 0) for i, e in enumerate(v)]
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [0.0] * 16, 0), (n + 2, [float("nan")] + [1.0] * 15, 0),
             (n + 3, rows[0][1], None), (n + 4, [1.0, 2.0], 0), (n + 5, [2.0, 4.0], 0), (n + 6, [None] + [1.0] * 15, 0),
             (n + 7, [], 0)]
    unit = {i: np.array(e) / np.linalg.norm(e) for i, e, label in rows
            if label is not None and e and None not in e and np.isfinite(e).all() and np.any(e)}
    label = {i: y for i, _, y in rows}
    edges = [(a, b) for a, b in itertools.combinations(unit, 2) if label[a] == label[b]
             and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.93]
    want = components(edges, [r[0] for r in rows])
    out = vector_dedup.near_duplicates(make("vec_id long, embedding array<float>, label int", rows)).collect()
    assert len(out) == len(rows)
    found = sum(r.n_links for r in out) / 2
    assert found >= 0.99 * len(edges)
    for r in out:
        assert r.n_links <= sum(r.vec_id in e for e in edges)
        assert r.kept == (r.vec_id == r.component_id)
    if found == len(edges):
        assert {r.vec_id: r.component_id for r in out} == want


def test_vectors_empty_table(make):
    assert vector_dedup.near_duplicates(make("vec_id long, embedding array<float>, label int", [])).count() == 0


def brute_repeats(texts, length):
    count, places = {}, {}
    for i, t in enumerate(texts):
        for p in range(len(t) - length + 1):
            count[t[p:p + length]] = count.get(t[p:p + length], 0) + 1
    for i, t in enumerate(texts):
        spans = []
        for p in range(len(t) - length + 1):
            if count[t[p:p + length]] > 1:
                if spans and p <= spans[-1][1]:
                    spans[-1][1] = p + length
                else:
                    spans.append([p, p + length])
        places[i] = spans
    return places


def repeat_corpus(seed=6):
    rng = random.Random(seed)
    letters = "abcdefgh é"

    def text(n):
        return "".join(rng.choice(letters) for _ in range(n))
    passage = text(700)
    out = [text(rng.randrange(0, 1500)) for _ in range(30)]
    out += [text(200) + passage[rng.randrange(150):700 - rng.randrange(150)] + text(rng.randrange(300)) for _ in range(25)]
    near = text(1500)
    for k in range(25):
        p = rng.randrange(1500)
        out.append(near[:p] + f"#{k}" + near[p + 2:])
    return out + [out[0], out[3], "a" * 1200, "xy" * 700, "b" * 399, "", None, text(420) * 2]


def test_repeats_equal_brute_force(make, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCK", 5)        # hot hashes in blocks at this size
    texts = repeat_corpus()
    want = brute_repeats([(t or "").encode() for t in texts], 400)
    out = substring_dedup.remove_repeats(make("doc_id long, text string, kept int", [(i, t, 1) for i, t in enumerate(texts)]))
    digest = {r.doc_id: r for r in substring_dedup.digests(make("doc_id long, text string", list(enumerate(texts)))).collect()}
    rows = out.collect()
    assert len(rows) == len(texts)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        spans = sorted((s.start, s.end) for s in r.spans)
        assert spans == [tuple(s) for s in want[r.doc_id]], r.doc_id
        kept, end = b"", 0
        for a, b in spans:
            kept, end = kept + raw[end:a], b
        kept += raw[end:]
        assert r.kept == kept and r.n_bytes == len(raw)
        d = digest[r.doc_id]
        assert (d.n_bytes, d.n_removed, d.n_spans) == (len(raw), len(raw) - len(kept), len(spans))
        assert d.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_repeats_shared_with_rows_without_id(make):
    rng = random.Random(8)

    def text(n):
        return "".join(rng.choice("abcdefgh") for _ in range(n))
    passage, again = text(500), text(450)
    rows = [(1, text(300) + passage), (None, passage + text(200)), (None, again + text(90)), (None, text(80) + again),
            (2, text(600)), (None, rows_twice := text(500)), (None, rows_twice)]
    out = substring_dedup.remove_repeats(make("doc_id long, text string", rows)).collect()
    want = brute_repeats([t.encode() for _, t in rows], 400)
    got = sorted((len(r.kept), r.n_bytes, sorted((s.start, s.end) for s in r.spans)) for r in out)
    assert got == sorted((len(t) - sum(b - a for a, b in want[i]), len(t), [tuple(s) for s in want[i]])
                         for i, (_, t) in enumerate(rows))
    assert [sorted((s.start, s.end) for s in r.spans) for r in out if r.doc_id == 1] == [[(300, 800)]]


def test_hash_and_context_of_many_texts_are_split(spark, make, monkeypatch):
    rng = random.Random(11)

    def text(n):
        return "".join(rng.choice("abcdefgh") for _ in range(n))
    passage = text(1000)
    rows = [(i, text(20) + passage + text(20)) for i in range(4000)] + [(4000 + i, text(600) * 2) for i in range(300)]
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.shuffle.partitions": "40",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    written, parquet = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: (written.append(self._df), parquet(self, path))[1])
    try:
        changed = substring_dedup.changed_texts(make("doc_id long, text string", rows).repartition(16))
        out = changed.collect()
        ranges = next(df for df in written if df.columns == ["c", "before", "after"])
        ranges.collect()
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (ranges, changed)]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(out) == 4300
    assert sum(s.start <= 20 and s.end >= 1020 for r in out for s in r.spans) >= 4000
    for plan, key in zip(plans, "hc"):
        joins = plan.split("SortMergeJoin")[1:]
        assert any(j.startswith(f"(skew=true) [{key}#") for j in joins), [j[:60] for j in joins]


def test_repeats_empty_table(make):
    assert substring_dedup.remove_repeats(make("doc_id long, text string", [])).count() == 0


def test_suffix_sort_survives_hash_collisions(monkeypatch):
    rng = random.Random(1)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 30))) for _ in range(300)]
    group = np.sort(np.array([rng.randrange(4) for _ in strings]))
    good = substring_dedup.Suffixes(strings, group, 32)
    bad = substring_dedup.Suffixes(strings, group, 32)
    bad.hash &= np.uint64(7)                                # nearly every comparison collides
    want = sorted(range(len(strings)), key=lambda i: (group[i], strings[i]))
    for s in (good, bad):
        order, lcp = s.sorted()
        assert [(group[i], strings[i]) for i in order] == [(group[i], strings[i]) for i in want]
        for k in range(1, len(order)):
            a, b = strings[order[k - 1]], strings[order[k]]
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert lcp[k] == (same if group[order[k - 1]] == group[order[k]] else -1)
