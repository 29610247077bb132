"""From documents to tokens: language, quality, near-duplicates, mixture, byte-level BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import language, mixing, quality, simhash
from tidemark.llm.common import read_table
from tidemark.llm.queries import token_digests
from tidemark.session import cut

#: Cosine below which even a very short text is of no language that was learned; the model's limit for longer texts is higher.
LEAST_COSINE = 0.05


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in a language that the documents themselves teach; texts without a letter go, and so do null texts."""
    return language.accepted(docs, language.learn(docs), LEAST_COSINE)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that score as good; the labels come from the table of that name. Null and empty texts, if any are left, score alike."""
    return quality.accepted(docs, quality.learn(docs, read_table(spark, sf_dir, "labels")))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates."""
    return simhash.first_of_each(docs)


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them: not at all, once or twice. Rows that repeat an id and a text go together; a null source is one of its own."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """For each row, repeated ones too, the number and digest of its tokens, and the digest of the text they decode to; nothing for null."""
    return token_digests(docs)


STAGES = [
    ("language", known_language),
    ("quality", good_quality),
    ("near-dedup", without_near_copies),
    ("mixing", to_target_weights),
    ("tokens", tokens),
]

#: SQL has neither of the two models, nor the hash and links of near-duplicates, nor BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's result is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
