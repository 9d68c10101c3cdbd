"""Registered queries of this package: ``opN_<name>`` applies operator N to
its whole table and derives the columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import byte_bpe, decontaminate, license_scan, ngram_join, ranked_search, repair_store, secret_scan, substring_dedup, token_alignment, token_counts, toxicity, url_filter, vector_dedup


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 4 MB, whatever the length of a row's text."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = byte_bpe.encode(documents, ranks, public_tokenizers.PATTERN).drop("text")
    return byte_bpe.digests(byte_bpe.decode(encoded, ranks))


def op2_repair_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "repair-store")
    repair_store.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return repair_store.read(spark, path).select("doc_id", "start", "n_tokens",
                                                 F.crc32("ids").alias("ids_crc32"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.self_join(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.train(documents, table(spark, sf_dir, "labels").where(~toxicity.held_out()))
    return toxicity.score(documents, machine).select(
        "doc_id", F.coalesce(toxicity.held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.report(found)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "number", F.length("candidate").alias("n_chars"),
                        F.sha2("candidate", 256).alias("candidate_sha256"), "score", "secret")


# The rules of the contract, and terms of listed domains.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]
LISTED_TERMS = "casino|bets|pills|adult"


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    # listed: the domains whose first label has a listed term, without the
    # prefixes of their subdomains
    host, _ = url_filter.host_and_path(F.col("url"))
    domain = F.regexp_replace(host, "^(www|m|blog)\\.", "")
    listed = pages.select(domain.alias("key")).where(F.substring_index("key", ".", 1).rlike(LISTED_TERMS)).distinct()
    return url_filter.judge(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("sentences").cast("long").alias("n_sentences"),
                        F.array_join("sentences", ",").alias("sentence_ids"),
                        F.array_join("licenses", ",").alias("licenses"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.report(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_alignment.report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                  public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {name: fn for name, fn in sorted(globals().items()) if name.startswith("op")}
ORACLES: dict[str, str] = {
    # all pairs that share a shingle, by their true similarity
    "op3_ngram_join": r"""
WITH RECURSIVE w AS (
    SELECT doc_id, md5(text) AS k, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
f AS (SELECT k, min(doc_id) AS doc_id, count(*) AS copies, any_value(ws) AS ws FROM w WHERE len(ws) > 0 GROUP BY k),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + least(5, len(ws)) - 1], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM f)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g)
      WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE c >= 0.8 * (x.n + y.n - c)),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a, min(b) AS m FROM r GROUP BY a),
d AS (SELECT a, sum(copies)::BIGINT AS n FROM l JOIN f ON b = f.doc_id GROUP BY a)
SELECT w.doc_id, least(f.doc_id, coalesce(m, f.doc_id), CASE WHEN f.doc_id IS NULL THEN w.doc_id END) AS class_id,
       (coalesce(copies - 1, 0) + coalesce(d.n, 0))::BIGINT AS n_links
FROM w LEFT JOIN f ON w.k = f.k LEFT JOIN m ON f.doc_id = m.a LEFT JOIN d ON f.doc_id = d.a""",
    # every pair of a label by its cosine
    "op5_vector_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a), c AS (SELECT a, min(b) AS m FROM r GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON vec_id = n.a LEFT JOIN c ON vec_id = c.a""",
    # windows as text: n-grams of item words against n-grams of document words
    "op7_decontaminate": r"""
WITH w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
iw AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (
    SELECT DISTINCT item_id, least(13, len(ws)) AS n,
           array_to_string(ws[i:i + least(13, len(ws)) - 1], ' ') AS gram
    FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS i FROM iw WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
g AS (
    SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS gram
    FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, sizes WHERE len(ws) >= n)),
m AS (SELECT g.doc_id, g.n, g.i, win.item_id FROM g JOIN win ON g.n = win.n AND g.gram = win.gram),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
              string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM m GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)""",
    # membership by comparing every host with every listed domain
    "op9_url_filter": r"""
WITH p AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
listed AS (
    SELECT DISTINCT key FROM (SELECT regexp_replace(host, '^(www|m|blog)\.', '') AS key FROM p)
    WHERE regexp_matches(split_part(key, '.', 1), 'casino|bets|pills|adult')),
r(verdict, h, pre) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
    ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
best AS (
    SELECT host, path, arg_max(h || pre, length(h || pre)) AS rule, arg_max(verdict, length(h || pre)) AS verdict
    FROM (SELECT DISTINCT host, path FROM p), r
    WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre) GROUP BY host, path),
bad AS (SELECT DISTINCT host FROM (SELECT DISTINCT host FROM p), listed
        WHERE host = key OR ends_with(host, '.' || key))
SELECT page_id, p.host, p.path, rule,
       coalesce(verdict, CASE WHEN bad.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN best ON p.host = best.host AND p.path = best.path LEFT JOIN bad ON p.host = bad.host""",
    "op10_license_scan": license_scan.oracle(),
    # every document's score for every item
    "op12_ranked_search": r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ts FROM documents),
total AS (SELECT count(*) FILTER (len(ts) > 0) AS n_docs, sum(len(ts))::BIGINT AS n_terms FROM d),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(ts) AS n, unnest(ts) AS term FROM d)
       GROUP BY doc_id, n, term),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
      FROM tf, total GROUP BY term, n_docs),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
      FROM q JOIN tf USING (term) JOIN w USING (term), total GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0
QUALIFY rank <= 10""",
}
