"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of characters outside these six ASCII separators.
SEPARATORS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


TEXT_ROWS_PER_BATCH = 1000


def text_batches(spark: SparkSession) -> None:
    """Texts can be long, so at most ``TEXT_ROWS_PER_BATCH`` rows go to a
    Python worker at once; a smaller setting of the session stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= TEXT_ROWS_PER_BATCH:
        spark.conf.set(key, str(TEXT_ROWS_PER_BATCH))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often
    ``body`` uses it: a lambda variable over a one-element array. (A plain
    alias may be inlined by the optimizer into every use.)"""
    return F.transform(F.array(value), body)[0]


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of ``text``; null and empty texts have none."""
    return F.array_remove(F.split(text_or_empty(text), SEPARATORS), "")


def crc_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n``; a null id counts as ''."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def fresh(df, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it, whatever the case."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def settled(df: DataFrame) -> DataFrame:
    """``df`` if its rows come in the same order whenever a task is repeated (a
    scan with projections and filters), else a checkpoint of it: for operators
    that number rows or words as they come."""
    moves = ("Join", "Aggregate", "Repartition", "Rebalance", "Sort", "Window", "Deduplicate", "Distinct", "Limit",
             "MapInPandas", "FlatMapGroups", "MapInArrow")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return df.checkpoint() if any(re.search(rf"^\W*(Global|Local)?{m}", line) for line in plan.splitlines() for m in moves) else df
