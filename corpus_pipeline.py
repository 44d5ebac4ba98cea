"""A training-data pipeline over `documents`: each stage works on all that the stage before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.checkpoints import materialise
from docloom.llm.common import read
from docloom.llm.decontamination import decontaminate
from docloom.llm.language import identify_documents
from docloom.llm.mixing import mix
from docloom.llm.near_dedup import near_dedup
from docloom.llm.token_ids import encode_and_read


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the evidence agrees on."""
    return identify_documents(docs).where(F.col("accepted")).select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources; a document that the mix takes twice is there twice."""
    return mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as compressed token ids: per document its place, length and checksum, read back from the blocks."""
    return encode_and_read(docs, public_tokenizers.path("word_bpe_49k.json"), 2)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_ids", token_ids),
]

#: SQL has no SimHash, model likelihoods or tokenizers; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
