"""From raw documents to packed training sequences, in five stages.

Each stage works on all documents that its predecessor kept and is written as
Parquet before the next begins, so that a lost executor costs one stage's work
at most.  All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnstile.llm.common import release, staged, table
from turnstile.llm.near_copies import one_of_each
from turnstile.llm.packing import SEQUENCES, pack, pieces_of, sequences
from turnstile.llm.pseudonyms import pseudonymized
from turnstile.llm.quality import accepted
from turnstile.llm.tiling import without_leaks
from turnstile.session import shared_folder

PSEUDONYM_KEY = "key of the deployment"
SEQUENCE_TOKENS, END_ID = 2048, 0


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to pseudonyms of their format."""
    return pseudonymized(docs, PSEUDONYM_KEY)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of tokens: sequence_id, n_tokens, ids and which document lies where."""
    import public_tokenizers

    # Best fit sees lengths and places alone, so no group carries ids into a Python worker; the ids join their pieces
    # again by a row key that is written with the staged pieces.
    pieces = pieces_of(docs, public_tokenizers.path("byte_bpe_50k.json"), END_ID, SEQUENCE_TOKENS, keep_ids=True)
    pieces = staged(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    placed = pack(pieces.drop("ids"), SEQUENCES)
    return sequences(placed.join(pieces.select("_row", "ids"), "_row").drop("_row"))


STAGES = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: The classifier and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of the documents in ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        release(spark)
    return docs
