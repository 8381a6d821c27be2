"""A training-data pipeline over the table of documents, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; `run` applies them
one after another, each result written to the shared folder and read again.  All but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import lines, mixing, quality, sentencepiece, simhash
from tidewatch.llm.common import table
from tidewatch.settings import settle


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(spark, docs, sf_dir)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines whose template recurs go from all documents but the first; so do documents
    that lose all their words by it."""
    return lines.drop_emptied(lines.dedup_lines(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least id."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a copy is a row of its own."""
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of the ids, and digest of the text they decode to, per row."""
    return sentencepiece.digests(docs)


STAGES = [
    ("quality classifier", classify),
    ("line dedup", drop_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", tokenize),
]

#: A fitted classifier and a tokenizer have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
