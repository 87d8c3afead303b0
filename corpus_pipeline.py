"""Corpus pipeline: quality rules, toxicity, near duplicates, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept; the first three return documents with their own columns, the
last one packed token sequences. Between stages the rows are written as
Parquet into the shared checkpoint folder and read again.

Defined for any table of documents: extra columns, whatever their names, come
back unchanged from the first three stages; repeated rows are judged alike; an
empty table gives an empty result of the same columns.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import neardup, packing, quality, toxicity
from cohortlens.llm.common import read_table
from cohortlens.session import checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current rule policy. Null and empty texts and
    those of fewer than 50 words fail it; the id plays no part."""
    return quality.keep_good(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated toxicity is below one half. Texts without
    words are scored like any other; without labels of both classes every
    document has the labelled mean, and without labels all stay."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one of smallest id, a
    null id first. Texts without words are in no class and all stay."""
    return neardup.keep_one_of_each(docs)


def length_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document as token sequences, with their ids, in length
    buckets. A null or empty text is its end id alone."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("packing", length_packing),
]

# The learned toxicity scores and the encoder are beyond SQL; tests compare
# each stage with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}-{name}")
            docs = spark.read.parquet(f"{folder}/{k}-{name}")
    return docs
