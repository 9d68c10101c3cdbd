import hashlib
import random

import pytest

pytest.importorskip("public_tokenizers")
import corpus_pipeline  # noqa: E402

WORDS = ["river", "stone", "garden", "maß", "niño", "window", "cloud", "paper", "été", "signal", "copper", "maple"]


def tables(spark, path, docs, labels, items):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, _text_key string") \
        .write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def row(i, text):
    return (i, text, "en", "s", None if text is None else len(text), f"key{i}")


def test_stages_take_effect_and_clean_documents_stay(spark, tmp_path):
    rng = random.Random(5)

    def prose(n=60):
        return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))

    clean = {i: prose() for i in range(300)}
    bad = {i: prose() + " scum vermin " + prose(10) for i in range(300, 500)}
    exam = prose(40)
    docs = [row(i, t) for i, t in (clean | bad).items()]
    copies = [row(900, clean[7]), row(901, clean[7] + " end"), row(7, clean[7]), row(None, clean[7])]
    tainted = [row(910, exam), row(911, prose(10) + " " + exam.replace("river", "RIVER"))]
    token = hashlib.sha1(b"x").hexdigest()
    secret = [row(920, prose() + f' token = "{token}" ' + prose(5)), row(None, f'{prose()} token = "{token}"')]
    odd = [row(930, None), row(931, ""), row(None, None), row(932, "?!"), row(933, "long " * 30_000)]
    labels = [(i, 1, int(i >= 300)) for i in range(500)] + [(None, 1, 1), (5, None, None)]
    out = corpus_pipeline.run(spark, tables(spark, tmp_path, docs + copies + tainted + secret + odd, labels,
                                            [(1, exam), (2, None), (3, "")])).collect()
    ids = [r.doc_id for r in out]
    assert set(clean) - {7} - set(ids) == set()
    assert set(ids) & (set(bad) | {900, 901, 910, 911}) == set()
    assert ids.count(7) == 1 and {920, 930, 931, 932, 933} <= set(ids)
    digest = {r.doc_id: r.decoded_sha256 for r in out}
    assert digest[3] == hashlib.sha256(clean[3].encode()).hexdigest()
    assert digest[920] == hashlib.sha256(secret[0][1].replace(token, "[SECRET]").encode()).hexdigest()
    kept_null = {r.decoded_sha256 for r in out if r.doc_id is None}
    assert hashlib.sha256(secret[1][1].replace(token, "[SECRET]").encode()).hexdigest() in kept_null


def test_stages_pass_on_the_columns_of_documents(spark, tmp_path):
    sf_dir = tables(spark, tmp_path, [row(1, "one two"), row(1, "one two"), row(None, None)], [(1, 1, 0)], [(1, "a b")])
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).dtypes == docs.dtypes, name


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, tables(spark, tmp_path, [], [], [])).count() == 0
