"""The corpus pipeline: toxicity, near-duplicates, repeated passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet and reads again for the next.  All stages but the last return
the columns of their input, which holds at least those of ``documents``; further
columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import neardup, packing, pii, repeats, toxicity
from quire.llm.common import staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold of the toxicity operator."""
    return toxicity.below(docs, toxicity.trained(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each class of near-duplicates; rows without an id stay."""
    return neardup.representatives(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of strings of 100 bytes that start earlier in the corpus."""
    return repeats.without_repeats(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return pii.without_pii(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the texts in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_neardup", drop_near_duplicates),
    ("suffix_dedup", drop_repeated_passages),
    ("pii", mask_personal_data),
    ("packing", pack),
]

#: The toxicity network, sketches and encoder are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
