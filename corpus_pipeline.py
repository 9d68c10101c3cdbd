"""The corpus pipeline: each stage applies one operator of ``lakestar.llm`` to
everything its predecessor kept, through Parquet."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakestar.llm import byte_bpe, decontaminate, ngram_join, secret_scan, toxicity
from lakestar.llm.queries import bounded_batches, table
from lakestar.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents that the factorization machine gives at least 0.5
    go."""
    bounded_batches(spark)
    machine = toxicity.train(docs, table(spark, sf_dir, "labels").where(~toxicity.held_out()))
    return toxicity.score(docs, machine).where("score < 0.5").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join: of each group of near-duplicates one document with
    the smallest id stays."""
    return ngram_join.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents of which benchmark passages cover
    a twentieth of the words go."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scan: all documents stay, their secrets are replaced, whatever
    their id."""
    return secret_scan.redact(docs, null_ids=True)


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: the kept documents with their ids, checked by decoding
    them again."""
    bounded_batches(spark)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(byte_bpe.round_trip(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN))


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scan", redact_secrets),
    ("byte-level BPE", encode_bytes),
]
ORACLE_SQL = None               # fitted models and tokenizers have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written to the
    shared folder and read again."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex[:12]}"
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        out = f"{root}/{k}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
