"""Keys that hold a large share of a table's rows, exactly, without shuffling
the rows by key.

Frequent-items sketches (mergeable counters of bounded size) are filled per
group of tasks and merged; every key above the share is among the sketch's top
items, and the candidates alone are counted exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKETCH_GROUPS = 64           # sketches that are merged in one task
MOST_TRACKED = 1_000_000     # the largest sketch Spark takes


def heavy_keys(df: DataFrame, key: str, parts: int, total: int | None = None) -> DataFrame:
    """(key, rows) of the keys with more than 1 / ``parts`` of the rows: fewer
    than ``parts`` rows. Null keys are left out. Runs a job for the number of
    rows with a key, unless it is given as ``total``.

    A key above the share has more than n / parts rows. With 16 items tracked
    per part an estimate is off by less than n / (4 parts), so the first
    2 * parts estimates hold every such key: that many others would need more
    than n rows."""
    rows = df.where(F.col(key).isNotNull())
    total = rows.count() if total is None else total
    tracked = max(1000, 16 * parts)
    if not total or tracked > MOST_TRACKED:              # sketches of nothing cannot be merged
        counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    else:
        sketches = (rows.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_g"))
                    .agg(F.expr(f"approx_top_k_accumulate(`{key}`, {tracked})").alias("_s")))
        top = sketches.agg(F.expr(f"approx_top_k_combine(_s, {tracked})").alias("_s"))
        found = (top.select(F.explode(F.expr(f"approx_top_k_estimate(_s, {2 * parts})")).alias("_t"))
                 .select(F.col("_t.item").alias(key)))
        counts = (rows.join(F.broadcast(found), key, "left_semi")          # at most 2 * parts keys
                  .groupBy(key).agg(F.count(F.lit(1)).alias("rows")))
    return counts.where(F.col("rows") * parts > total)
