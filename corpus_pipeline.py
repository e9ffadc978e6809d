"""A corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickmill.llm import bpe, common, decontam, ngram_join, quality, substring

#: Bytes of an Arrow batch in all stages: less than for one operator alone, since an executor's memory has grown over earlier stages when a later one runs.
BATCH_BYTES = 4 << 20


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality network, fitted on a bounded sample of the labelled documents, accepts."""
    common.bounded_batches(spark, BATCH_BYTES)
    network = quality.fit(docs, common.table(spark, sf_dir, "labels"))
    return quality.classify(docs, network, docs.columns, names=("_quality", "_accepted")).where(F.col("_accepted") == 1).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document of least id."""
    common.bounded_batches(spark, BATCH_BYTES)
    return ngram_join.representatives(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document of smaller id holds too.

    Untouched texts stay as they are; a cut text is its words left, joined by single spaces, and n_chars
    follows it. Documents of which nothing is left go. All other columns stay.
    """
    common.bounded_batches(spark, BATCH_BYTES)
    got = substring.without_repeats(docs, carry=True)
    changed = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    columns = [F.when(F.col("n_removed") > 0, changed[c]).otherwise(F.col(f"carried.{c}")).alias(c) if c in changed else F.col(f"carried.{c}").alias(c) for c in docs.columns]
    return got.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words"))).select(*columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    common.bounded_batches(spark, BATCH_BYTES)
    return decontam.clean(docs, common.table(spark, sf_dir, "benchmark"))


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the digests of the ids and of the decoded bytes."""
    import public_tokenizers

    common.bounded_batches(spark, BATCH_BYTES)
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")).select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality", keep_quality),
    ("near_copies", keep_one_of_near_copies),
    ("repeated_passages", cut_repeated_passages),
    ("benchmark_leaks", drop_benchmark_leaks),
    ("tokens", tokenised),
]

#: A trained network and BPE aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each result written as Parquet in the shared folder and read again."""
    import uuid

    folder = f"{common.shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
