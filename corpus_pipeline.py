"""Corpus preparation over ``documents``: five stages, each on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns
of ``docs``; the last returns the packed pieces. Nulls, empty and long texts, repeated rows, empty
tables and further columns are handled as the operators' modules say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidepanel.llm.common import table
from tidepanel.llm.decontaminate import drop_contaminated
from tidepanel.llm.exact_dedup import drop_exact_duplicates
from tidepanel.llm.near_copies import drop_near_copies
from tidepanel.llm.packing import pack_documents
from tidepanel.llm.toxicity import drop_toxic
from tidepanel.session import cut_lineage


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches 0.5 go; the classifier learns from ``labels``."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, the one with the largest doc_id."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts joined by five-word similarities of 0.8 or more, the document with the smallest doc_id stays."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of ``benchmark`` go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of 4096."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("exact dedup", exact_dedup), ("near dedup", near_dedup), ("decontamination", decontamination), ("packing", packing)]
#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = docs if i == len(STAGES) - 1 else cut_lineage(docs)
    return docs
