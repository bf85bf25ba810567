"""The corpus pipeline: five stages over documents, each written as Parquet and read again as the next one's docs.

Toxic documents go; of equal texts and of near copies (five-word shingles, similarity 0.8) one stays; secrets in texts
are replaced by a mark; what is left is packed into sequences.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession

from gristmill.llm import exactdedup, ngramjoin, packing, secretscan, toxicity
from gristmill.llm.common import discard, stored, table


HELD_WORDS = 30_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that score 0.3 or more; the model is trained on the labelled rows of docs."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without white space, the longest original stays."""
    return exactdedup.dedup_new(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that links of similarity 0.8 or more connect, the smallest id stays."""
    return ngramjoin.keep_one(docs, 5, Fraction(4, 5))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces the secrets that the forest finds in texts; no document goes."""
    return secretscan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Workers remember fewer words than those of the operator alone, as executors still hold what the stages before left."""
    return packing.pack_documents(docs, packing.default_tokenizer(), most=HELD_WORDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
            if k:
                discard(before)
    return docs


#: Toxicity, near copies, secrets and packing are beyond SQL; tests/llm compares them with brute force.
ORACLE_SQL = None
