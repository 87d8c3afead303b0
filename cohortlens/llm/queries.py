"""Registered queries of the training-data operators: name -> (spark, sf_dir)
-> DataFrame. Each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bwt_dedup, byte_bpe, fingerprints, lm, neardup, packing, quality, ranking, runs, token_counts,
               token_files, toxicity, url_filter)
from .common import read_table
from .sql import ORACLE_SQL  # noqa: F401 - re-exported for the entry point

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(read_table(spark, sf_dir, "documents"))


@register
def op2_length_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(read_table(spark, sf_dir, "documents"),
                                    public_tokenizers.path("byte_bpe_50k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@register
def op3_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.document_scores(read_table(spark, sf_dir, "documents"), lm.held_out_fold(F.col("doc_id")))


@register
def op4_edited_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_edited(
        read_table(spark, sf_dir, "documents"), token_counts.sample_edits(F.col("text")),
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@register
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_ids_by_key(read_table(spark, sf_dir, "documents"),
                                        public_tokenizers.path("byte_bpe_50k.json"))


# The rules that the urls are judged by.
URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/"))


@register
def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), [url_filter.parse_rule(*r) for r in URL_RULES])


@register
def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.jaccard_join(read_table(spark, sf_dir, "documents"))


@register
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.token_digests(read_table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@register
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality.quality_ledger(read_table(spark, sf_dir, "documents"))
    base = F.lit(quality.mask_of(quality.BASE)).cast("long")
    return (quality.verdicts(ledger)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    (F.col("failure_bits").bitwiseAND(base) != 0).alias("base_failed"),
                    "kept", "failure_bits"))


@register
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@register
def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.document_runs(read_table(spark, sf_dir, "documents"), reorder=runs.planted_period)


@register
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@register
def op13_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
