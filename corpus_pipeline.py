"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept and returns the columns of `documents`; the last returns pieces
with their place in a sequence. Null texts are dropped by the first stage, as empty ones are; a null id is
kept. Columns that a stage does not know pass through it. `n_chars`, where there is one, follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.llm import packing, pii, quality, simhash, suffix
from medloom.llm.common import read, stored
from medloom.llm.queries import BYTES


def _sized(docs: DataFrame) -> DataFrame:
    """`docs` with n_chars as long as the text is now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return quality.kept(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group whose fingerprints are linked: shingles of four words, four bits."""
    return simhash.without_near_duplicates(docs, words=4, max_bits=4)


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 100 bytes and more that an earlier document has."""
    return _sized(suffix.without_repeats(docs, length=100))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data masked."""
    return _sized(pii.masked(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 2048 tokens."""
    return packing.pack(docs, BYTES, capacity=2048)


STAGES = [
    ("quality_classifier", quality_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("suffix_array_dedup", repeat_stage),
    ("pii", pii_stage),
    ("best_fit_packing", packing_stage),
]

#: SQL cannot express the stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
