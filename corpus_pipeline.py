"""A training corpus from ``documents``: identify languages, keep one of each group of near copies, mask secrets,
mix the sources, and encode into pieces. Each stage is written as Parquet and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quire.llm.common import in_small_batches, table, written
from quire.llm.languages import keep_identified
from quire.llm.mixing import mixed_documents
from quire.llm.piece_encoding import encode_documents
from quire.llm.secrets import redact_secrets
from quire.llm.shingle_join import keep_first_of_class


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learnt language; texts without a letter or with more noise than language go."""
    in_small_batches(spark)
    return keep_identified(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class that n-gram Jaccard links make."""
    in_small_batches(spark)
    return keep_first_of_class(docs)


def mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, ends) of each document taken."""
    in_small_batches(spark)
    return encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language ID", identify),
    ("n-gram Jaccard join", deduplicate),
    ("secret scans", mask),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", encode),
]

#: SQL can express neither the mixture inference of the first stage nor the pieces of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
