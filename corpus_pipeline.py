"""A training corpus in five stages over ``documents``; each stage is written and read again as the next one's input.

Quality, exact copies, near copies and benchmark passages decide which documents stay; packing lays out the tokens of
those that do. Nothing else drops a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelmood.llm.base import prepared, stored, table
from parcelmood.llm.decontaminate import drop_contaminated
from parcelmood.llm.exact_dedup import drop_copies
from parcelmood.llm.near_dedup import drop_near_copies
from parcelmood.llm.packing import pack
from parcelmood.llm.quality import drop_low_quality


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on ``labels``, keeps."""
    prepared(spark)
    return drop_low_quality(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    prepared(spark)
    return drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    prepared(spark)
    return drop_near_copies(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    prepared(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of at most 4096 tokens."""
    import public_tokenizers

    prepared(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Tokens and trained models are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepared(spark), sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
