"""A training-corpus pipeline out of the operators in terrasift.llm.

Each stage takes (spark, docs, sf_dir) and returns the documents that stay, with their columns; the last returns token digests.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.llm import bpe, decontam, jaccard, pii, toxicity
from terrasift.llm.queries import RANK_FILE
from terrasift.session import checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject."""
    return toxicity.keep_clean(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return jaccard.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked and lengths renewed."""
    return pii.redact(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens, and digests of the ids and of the text decoded from them, for each document.

    Executors are full by the last stage, so it runs with a small cache and small slices.
    """
    return bpe.encode_digest(docs, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN, cache_entries=40_000, slice_chars=1_000_000)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("byte_bpe", tokenize),
]

#: The toxicity model and the byte-pair merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared folder, read by the next, and deleted once that is written.

    Null texts pass all stages (as empty in the digests), rows without an id are judged by their text alone, repeated rows of one group leave one, and an empty table gives no rows.
    What the last stage reads stays, since its result is computed when it is asked for.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark)}/corpus-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            done = spark._jvm.org.apache.hadoop.fs.Path(before)
            done.getFileSystem(spark._jsc.hadoopConfiguration()).delete(done, True)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
