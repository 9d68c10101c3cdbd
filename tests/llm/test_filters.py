import hashlib
import random
import re
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestar.llm import decontaminate, license_scan, secret_scan, toxicity, url_filter


# ---- decontamination ----------------------------------------------------------

def words(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(text, items):
    w = words(text)
    hit, found = set(), set()
    for item, t in items:
        iw = words(t)
        n = min(13, len(iw))
        windows = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i:i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(item)
    return len(w), hit, found


def contamination_cases(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(12)] + ["é", "ß"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 40)))) for i in range(25)]
    items += [(90, None), (91, ""), (92, "v1, V2!"), (93, "v1 v2"), (94, items[0][1]), (None, "v3 v4")]
    docs = []
    for i in range(60):
        parts = [rng.choice(vocabulary + ["other"]) for _ in range(rng.randrange(60))]
        if i % 2:
            source = words(items[rng.randrange(25)][1])
            at = rng.randrange(len(source))
            parts[5:5] = source[at:at + 20]
        docs.append((i, "  ".join(p.upper() if rng.random() < 0.2 else p for p in parts), "x"))
    return docs + [(100, None, "x"), (101, "", "x"), (102, "...", "x"), (0, docs[0][1], "x"), (103, "v1 v2 " * 20_000, "x")], items


@pytest.mark.parametrize("block_items", [20_000, 7])
def test_decontamination_equals_brute_force(make, block_items):
    docs, items = contamination_cases()
    out = decontaminate.scan(make("doc_id long, text string, items string", docs), make("item_id long, text string", items),
                             block_items=block_items)
    rows = out.collect()
    assert len(rows) == len(docs)
    text = {d: t for d, t, _ in docs}
    named = [(i, t) for i, t in items if i is not None]
    for r in rows:
        if r.doc_id == 103:
            assert r.n_words == 40_000 and sum(s.words for s in r.spans) == 40_000
            continue
        n, hit, found = brute_hits(text[r.doc_id], named)
        assert r.n_words == n and set(r["items"]) == found and r["items"] == sorted(found)
        assert {w for s in r.spans for w in range(s.word, s.word + s.words)} == hit
        for s in r.spans:
            raw = (text[r.doc_id] or "").encode()[s.start:s.end].decode()
            assert words(raw) == words(text[r.doc_id])[s.word:s.word + s.words]
    for r in decontaminate.report(out).where("doc_id <> 103").collect():
        n, hit, found = brute_hits(text[r.doc_id], named)
        ids = ",".join(sorted(map(str, found)))
        assert (r.n_hit, r.n_items) == (len(hit), len(found))
        assert r.items_sha256 == hashlib.sha256(ids.encode()).hexdigest()
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= n)


def test_decontamination_edge_tables(make):
    docs = make("doc_id long, text string", [(1, "a b"), (2, None)])
    none = make("item_id long, text string", [])
    assert [r.n_words for r in decontaminate.report(decontaminate.scan(docs, none)).orderBy("doc_id").collect()] == [2, 0]
    assert decontaminate.scan(docs.limit(0), make("item_id long, text string", [(1, "a")])).count() == 0
    assert decontaminate.remove(docs, make("item_id long, text string", [(1, "a")])).collect()[0].doc_id == 2


def test_decontamination_removes_rows_and_not_ids(make):
    rows = [(1, "x v1 v2", "bad"), (1, "clean", "good"), (None, "v1 v2", "bad"), (None, "also clean", "good"), (2, None, "good")]
    out = decontaminate.remove(make("doc_id long, text string, spans string", rows), make("item_id long, text string", [(1, "v1 v2")]))
    assert out.columns == ["doc_id", "text", "spans"]
    assert sorted((r.doc_id or 0, r.text or "") for r in out.collect()) == [(0, "also clean"), (1, "clean"), (2, "")]


def test_decontamination_blocks_are_bounded_by_items_and_bytes(make, monkeypatch):
    items = make("item_id long, text string", [(i, f"a{i} " * 50) for i in range(10)] + [(None, "x"), (11, None), (12, "...")])
    sizes = [len(b) for b in decontaminate.item_blocks(items, "item_id", "text", 4)]
    assert sizes == [4, 4, 2]
    monkeypatch.setattr(decontaminate, "BLOCK_WORD_BYTES", 250)
    assert [len(b) for b in decontaminate.item_blocks(items, "item_id", "text", 4)] == [2, 2, 2, 2, 2]
    monkeypatch.setattr(decontaminate, "BLOCK_WORD_BYTES", 1)           # longer items are blocks of their own
    assert [len(b) for b in decontaminate.item_blocks(items, "item_id", "text", 4)] == [1] * 10


def test_decontamination_removes_by_the_hits_of_all_blocks(make, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORD_BYTES", 1)
    a, b = "p q", "r s"
    filler = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"{a} {filler}", 1), (1, f"{a} {b} {filler}", 2), (None, f"{a} {filler} {b}", 3), (None, filler, 4), (2, None, 5)]
    out = decontaminate.remove(make("doc_id long, text string, _row long", rows),
                               make("item_id long, text string", [(1, a), (2, b), (3, "none of it")]))
    assert out.columns == ["doc_id", "text", "_row"]
    assert sorted(r._row for r in out.collect()) == [1, 4, 5]           # 2 of 62 words stay, 4 of 64 go


# ---- toxicity -------------------------------------------------------------------

def toxic_table(n=600, seed=1):
    rng = random.Random(seed)
    filler = [f"f{i}" for i in range(200)]
    docs, labels = [], []
    for i in range(n):
        w = rng.choices(filler, k=rng.randrange(5, 60))
        bad = rng.random() < 0.3
        if bad:
            w.insert(rng.randrange(len(w)), rng.choice(["scum", "vermin"]))
        docs.append((i, " ".join(w), "s"))
        labels.append((i, int(bad)))
    return docs, labels


def test_toxicity_learns_terms_and_scores_every_row(make):
    docs, labels = toxic_table()
    extra = [(1000, None, "s"), (1001, "", "s"), (1002, "SCUM! " * 20_000, "s"), (0, docs[0][1], "s"), (None, "f1", "s")]
    df = make("doc_id long, text string, score string", docs + extra)
    lab = make("doc_id long, toxic int", labels + [(5, None), (None, 1), (7, 9)])
    machine = toxicity.train(df, lab.where(~toxicity.held_out()))
    out = toxicity.score(df, machine).collect()
    assert len(out) == len(docs) + len(extra) and all(0 <= r.score <= 1 for r in out)
    label = dict(labels)
    right = [(r.score >= 0.5) == bool(label[r.doc_id]) for r in out if r.doc_id in label]
    assert sum(right) / len(right) > 0.97
    by_id = {r.doc_id: r.score for r in out}
    assert by_id[1000] == by_id[1001] < 0.5 <= by_id[1002]


def test_toxicity_learns_pairs_that_no_single_term_shows(make):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(1200):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        w = ["insult"] * a + ["group"] * b + [f"f{rng.randrange(3)}"]
        docs.append((i, " ".join(w) + f" u{i}"))
        labels.append((i, int(a == b)))                   # only the combination tells
    df = make("doc_id long, text string", docs)
    machine = toxicity.train(df, make("doc_id long, toxic int", labels))               # the query's settings
    label = dict(labels)
    out = toxicity.score(df, machine).collect()
    assert sum((r.score >= 0.5) == bool(label[r.doc_id]) for r in out) / len(out) > 0.9
    linear = toxicity.Machine(machine.bias, machine.term, machine.weight, machine.factor * 0)
    out = toxicity.score(df, linear).collect()
    assert sum((r.score >= 0.5) == bool(label[r.doc_id]) for r in out) / len(out) < 0.8


def test_scores_are_the_formula_of_the_machine():
    rng = np.random.default_rng(8)
    machine = toxicity.Machine(-0.3, np.sort(rng.choice(60, 25, replace=False)), rng.normal(size=25), rng.normal(size=(25, 3)))
    rows = [np.sort(rng.choice(60, k, replace=False)) for k in (0, 1, 2, 7, 30)]
    cuts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    for row, got in zip(rows, machine.scores(np.concatenate(rows), cuts)):
        known = [i for i, t in enumerate(machine.term) if t in row]
        pairs = sum(machine.factor[i] @ machine.factor[j] for i in known for j in known if i < j)
        logit = machine.bias + sum(machine.weight[i] for i in known) + pairs / max(len(known), 1)
        assert abs(got - 1 / (1 + np.exp(-logit))) < 1e-9


def test_toxicity_without_labels(make):
    df = make("doc_id long, text string", [(1, "a")])
    machine = toxicity.train(df, make("doc_id long, toxic int", []))
    assert [r.score < 0.01 for r in toxicity.score(df, machine).collect()] == [True]
    assert toxicity.score(df.limit(0), machine).count() == 0


# ---- secrets ----------------------------------------------------------------------

def secret_docs(n=120):
    rng = random.Random(4)
    docs, truth = [], {}
    for i in range(n):
        h = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        t = [f'x token = "{h}" y', f"see commit {h} y", "Donaudampfschiffahrtsgesellschaft here", f"card {rng.randrange(10**16):016d}",
             "no candidate"][i % 5]
        docs.append((i, t, len(t)))
        truth[i] = i % 5 == 0
    return docs, truth


def test_secrets_found_and_redacted(make):
    docs, truth = secret_docs()
    docs += [(500, None, None), (501, "", 0), (0, docs[0][1], docs[0][2]), (None, docs[5][1], 1), (502, "a" * 50_000, 50_000)]
    df = make("doc_id long, text string, n_chars long", docs)
    out = secret_scan.scan(df).collect()
    for r in out:
        if r.doc_id in truth:
            assert r.secret == truth[r.doc_id], r
    clean = secret_scan.redact(df).collect()
    assert len(clean) == len(docs) and set(clean[0].asDict()) == {"doc_id", "text", "n_chars"}
    for r in clean:
        if truth.get(r.doc_id):
            assert r.text == 'x token = "[SECRET]" y' and r.n_chars == len(r.text)
    assert {(r.doc_id, r.text) for r in clean if not truth.get(r.doc_id)} == \
        {(d, t) for d, t, _ in docs if not truth.get(d)}


def test_secrets_are_redacted_row_by_row(make):
    docs, truth = secret_docs()
    other = docs[5][1].split('"')[1]
    rows = [d[:2] for d in docs] + [(None, docs[0][1]), (None, "plain"), (5, f"see commit {other} y"), (None, None)]
    clean = secret_scan.redact(make("doc_id long, text string", rows), null_ids=True).collect()
    assert sorted(r.text or "" for r in clean if r.doc_id is None) == ["", "plain", 'x token = "[SECRET]" y']
    assert sorted(r.text for r in clean if r.doc_id == 5) == [f"see commit {other} y", 'x token = "[SECRET]" y']


def test_secrets_given_findings_and_edge_tables(make):
    docs, truth = secret_docs()
    df = make("doc_id long, text string", [d[:2] for d in docs])
    given = make("candidate string, before string, after string, label int", [
        (f"{k:032x}", "commit ", None, 1) for k in range(900, 940)] + [(f"{k:032x}", 'token = "', '"', 0) for k in range(40)]
        + [(None, None, None, 1), ("", None, None, 0)])
    out = secret_scan.scan(df, given).collect()              # the given labels decide, here the wrong way round
    assert not any(r.secret for r in out if truth[r.doc_id])
    assert secret_scan.scan(df.limit(0)).count() == 0
    assert secret_scan.scan(make("doc_id long, text string", [(1, f'token = "{"a1" * 20}"')])).collect()[0].secret


# ---- urls -------------------------------------------------------------------------

URLS = [(1, "http://A.Example.ORG/es/x?y#z"), (2, "https://example.org?q=/es/"), (3, "no scheme"), (4, None), (5, ""),
        (6, "x://bad.com"), (7, "x://sub.bad.com/de/1"), (8, "x://notbad.com/"), (9, "x://example.org/en/12"),
        (10, "x://com/fr/"), (11, "x://a://b/c"), (1, "http://A.Example.ORG/es/x?y#z"), (12, "x://..bad.com/"),
        (13, "x:///p"), (14, "x://h" + "o" * 20_000 + ".bad.com/")]
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


@pytest.mark.parametrize("max_bits", [url_filter.MAX_BITS, 16])
def test_urls_equal_set_membership(make, max_bits):
    rng = random.Random(3)
    rows = URLS + [(100 + k, f"http://h{rng.randrange(900)}.d{rng.randrange(60)}.net/p") for k in range(1500)]
    listed = {"bad.com"} | {f"d{k}.net" for k in range(0, 60, 3)} | {f"h{k}.d1.net" for k in range(0, 900, 2)}
    listed_rows = [(k,) for k in sorted(listed)] + [(None,), ("",), ("bad.com",)]
    if max_bits == 16:
        listed_rows, listed = [("bad.com",), ("d3.net",), ("unseen.org",)], {"bad.com", "d3.net"}
    out = url_filter.flag(make("page_id long, url string, path int", [(i, u, 0) for i, u in rows]),
                          make("key string", listed_rows), max_bits=max_bits).collect()
    assert len(out) == len(rows)
    for r in out:
        labels = r.host.split(".")
        assert r.in_list == any(".".join(labels[i:]) in listed for i in range(len(labels)) if r.host), r


def test_url_rules(make):
    out = {r.page_id: r for r in url_filter.judge(make("page_id long, url string", URLS), make("key string", [("bad.com",)]),
                                                  RULES).collect()}
    got = {i: (r.host, r.path, r.rule, r.verdict) for i, r in out.items()}
    assert got[1] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[2] == ("example.org", "", None, "allow")
    assert got[3] == got[4] == got[5] == ("", "", None, "allow")
    assert got[6] == ("bad.com", "", None, "block") and got[7][2:] == ("com/de/", "block")
    assert got[8][3] == "allow" and got[9][2:] == ("example.org/en/1", "block")
    assert got[10][2:] == ("com/fr/", "allow") and got[11][:2] == ("a:", "//b/c")


def test_urls_empty_tables(make):
    none = make("key string", [])
    assert url_filter.judge(make("page_id long, url string", []), none, RULES).count() == 0
    assert {r.verdict for r in url_filter.judge(make("page_id long, url string", URLS[5:6]), none, RULES).collect()} == {"allow"}


# ---- licences ---------------------------------------------------------------------

def test_licences_by_ordered_sentences(make):
    s = license_scan.SENTENCES
    bsd = [s["bsd-redistribution"], s["bsd-source"], s["bsd-binary"]]
    wrapped = s["mit-grant"].replace("to deal in", "to\n// deal in").replace("including", "\n  including")
    rows = [(1, "é éa\nReleased under the MIT License.\nx"), (2, " ".join(bsd)), (3, bsd[2] + " " + bsd[0] + " " + bsd[1]),
            (4, wrapped + "\n\n" + s["mit-notice"].upper()), (5, None), (6, ""), (7, "mitigation of the license"),
            (8, s["gpl-free"] + " " + s["gpl-hope"] + "\n" + s["all-rights"] + " " + s["all-rights"]),
            (9, "word " * 30_000 + "\nLicensed under CC BY 4.0."), (1, "plain")]
    out = license_scan.scan(make("doc_id long, text string, sentences int", [(*r, 0) for r in rows])).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r["licenses"] for r in out if r["licenses"]}
    assert got == {1: ["MIT"], 2: ["BSD-2-Clause"], 4: ["MIT"], 8: ["GPL-3.0-or-later", "LicenseRef-all-rights-reserved"],
                   9: ["CC-BY-4.0"]}
    assert [r["sentences"] for r in out if r.doc_id == 3] == [["bsd-binary", "bsd-redistribution", "bsd-source"]]


def test_licences_wrapped_over_any_number_of_lines(make):
    s = license_scan.SENTENCES
    rows = []
    for key in ("mit-grant", "gpl-free", "bsd-binary", "apache-2-ref"):
        for width in (55, 40, 30, 25, 1):
            rows.append((len(rows), key, "x y\n# " + "\n#   ".join(textwrap.wrap(s[key], width, break_long_words=False)) + "\nz"))
    rows += [(100, "", s["mit-grant"].replace("to deal in", "to\n\nnot deal in")), (101, "", s["mit-grant"][:-1] + " more")]
    out = license_scan.scan(make("doc_id long, key string, text string", rows)).collect()
    assert {r.doc_id: r["sentences"] for r in out} == {i: [k] if k else [] for i, k, _ in rows}


def test_licences_empty_table(make):
    assert license_scan.scan(make("doc_id long, text string", [])).count() == 0


def test_native_plans_have_no_python(make):
    docs = make("doc_id long, text string", [(1, "x")])
    for df in (license_scan.scan(docs), secret_scan.candidates(docs), secret_scan.features(secret_scan.candidates(docs)),
               url_filter.flag(make("page_id long, url string", URLS), make("key string", [("bad.com",)]))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
        assert F is not None


# ---- secrets: candidates, planted findings, the forest against the pattern ----------

def test_values_of_secret_names_are_candidates_of_any_length_and_alphabet(make):
    rows = [(1, 'password = "hunter2"'), (2, "api_key: 'Tr0ub4dor&3.x!' end"), (3, 'secret: "P@ssw0rd!2024#abcdefghij"'),
            (4, "the password was reset"), (5, "pwd=a1;user=x"), (6, "x 0123456789abcdef0 y"), (7, None), (8, "")]
    got = {r.doc_id: (r.candidate, r.before[-4:], r.after[:1]) for r in
           secret_scan.candidates(make("doc_id long, text string", rows)).collect()}
    assert got == {1: ("hunter2", '= "', '"')[:1] + (' = "', '"'), 2: ("Tr0ub4dor&3.x!", "y: '", "'"),
                   3: ("P@ssw0rd!2024#abcdefghij", 't: "', '"'), 5: ("a1", "pwd=", ";"), 6: ("0123456789abcdef0", "x ", " ")}


def test_forest_beats_the_pattern_on_held_out_findings(make):
    rng = random.Random(9)
    vocabulary = ["the", "garden", "königlich", "report", "niñosque", "ouverture", "windows", "trans", "mission", "alpha"]
    df = make("doc_id long, text string", [(i, " ".join(rng.choices(vocabulary, k=30)) + f" {i}") for i in range(200)])
    described = secret_scan.features(secret_scan.planted(df)).checkpoint()
    assert described.count() > 5_000 and described.select("label").distinct().count() == 2
    held_out = F.pmod(F.xxhash64("candidate", "before"), F.lit(5)) == 0
    forest = secret_scan.train(described.where(~held_out))
    judged = secret_scan.judge(described.where(held_out), forest).select(
        "label", "candidate", (F.col("score") >= 0.5).alias("forest"), secret_scan.by_pattern(described).alias("pattern")).collect()

    def figures(which):
        hit = sum(r[which] and r.label == 1 for r in judged)
        return hit / max(1, sum(r[which] for r in judged)), hit / sum(r.label for r in judged)

    (precision, recall), (pattern_precision, _) = figures("forest"), figures("pattern")
    print("forest", precision, recall, "pattern", figures("pattern"))
    assert precision > 0.95 and recall > 0.9 and pattern_precision < 0.9
    # values set to a secret's name that the forest overrules
    assert any(r.pattern and not r.forest and "your-" in r.candidate for r in judged)
    docs = [(1, 'token = "your-garden-token-here"'), (2, f'token = "{"4f9ac1d07be2" * 3}a1"'), (3, f"commit {'4f9ac1d07be2' * 3}a1")]
    found = {r.doc_id: r.secret for r in secret_scan.scan(make("doc_id long, text string", docs), described.select(
        "candidate", "before", "after", "label")).collect()}
    assert found == {1: False, 2: True, 3: False}


def test_features_equal_brute_force(make):
    rows = [("aB3-xyz/the9", "my token = \"", "\" x"), ("4444444444444444", "commit ", ""), ("the/and/ing", "see /", "")]
    got = secret_scan.features(make("candidate string, before string, after string", rows)).collect()
    for r, (c, before, after) in zip(got, rows):
        n = len(c)
        assert r.length == n and abs(r.digits - sum(x.isdigit() for x in c) / n) < 1e-12
        assert abs(r.letters - sum(x.isalpha() for x in c) / n) < 1e-12 and abs(r.uppers - sum(x.isupper() for x in c) / n) < 1e-12
        kinds = ["d" if x.isdigit() else "u" if x.isupper() else "l" if x.isalpha() else " " for x in c]
        assert abs(r.transitions - sum(a != b and " " not in (a, b) for a, b in zip(kinds, kinds[1:])) / n) < 1e-12
        assert abs(r.distinct - len(set(c.lower())) / min(n, 36)) < 1 / 12 and r.slashes == c.count("/")
        assert r.quoted == (before[-1:] == '"' and after[:1] == '"') and r.path_before == before.endswith("/")
        assert r.secret_word == ("token" in before) and r.harmless_word == ("commit" in before)


def test_licences_by_their_own_sentences(spark, make):
    s = license_scan.SENTENCES
    bsd = [s["bsd-redistribution"], "1. " + s["bsd-source"], "2. " + s["bsd-binary"]]
    gpl = s["gpl-2-free"].replace(" modify", "\n// modify").replace("; either", ";\n// either")
    texts = {1: ("\n".join(bsd), "BSD-2-Clause"), 2: ("\n".join([*bsd, "3. " + s["bsd-endorse"]]), "BSD-3-Clause"),
             3: ("\n".join([*bsd, s["bsd-advertising"], s["bsd-endorse"]]), "BSD-4-Clause"), 4: (gpl, "GPL-2.0-or-later"),
             5: (s["mpl-2-header"] + " If a copy", "MPL-2.0"), 6: ("# SPDX-License-Identifier: LGPL-2.1-or-later\nimport x", "LGPL-2.1-or-later"),
             7: ("/* SPDX-License-Identifier: MIT */", "MIT"), 8: ("SPDX-License-Identifier: MIT OR Apache-2.0", ""),
             9: (s["agpl-3-free"] + "\n" + s["gpl-hope"], "AGPL-3.0-or-later"), 10: (s["isc-grant"], "ISC"), 11: (s["0bsd-grant"], "0BSD"),
             12: (s["gpl-free"].replace(" ", "\n"), "GPL-3.0-or-later"), 13: (s["unlicense-domain"], "Unlicense")}
    docs = make("doc_id long, text string", [(k, t) for k, (t, _) in texts.items()])
    got = {r.doc_id: ",".join(r["licenses"]) for r in license_scan.scan(docs).collect()}
    assert got == {k: name for k, (_, name) in texts.items()}
    import duckdb
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    assert {r[0]: r[3] for r in con.execute(license_scan.oracle()).fetchall()} == got
    assert all(name in s for _, seq in license_scan.RULES for name in seq)
    assert len({license_scan.normalise_text(x) for x in s.values()}) == len(s)
