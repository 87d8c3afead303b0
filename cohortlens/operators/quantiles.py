"""Exact medians without a single-task merge.

A global ``median``/``percentile`` keeps a value -> count map per map task
and merges every task's map in one reducer: with many tasks that reducer
receives (tasks x distinct values) entries. Here the rows are first counted
per distinct value (a grouped aggregation spread over all reducers), the
counts below each value come from the two-level prefix sums of
``metrics.cumulative`` (no global window), and the median is read off the
one or two values holding the middle ranks, interpolated as ``percentile``
does: 0.5 * lower + 0.5 * upper.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .metrics import DEFAULT_BUCKETS, cumulative


def stacked_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(_col, score): every non-null value of the columns, from one scan."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    stacked = df.selectExpr(f"stack({len(cols)}, {pairs}) AS (_col, score)")
    return stacked.where(F.col("score").isNotNull())


def exact_medians(df: DataFrame, cols: Sequence[str], prefix: str = "",
                  buckets: int | None = DEFAULT_BUCKETS, aliases: Sequence[str] | None = None) -> DataFrame:
    """One row with the exact median of each column (``<prefix><col>`` or the
    given ``aliases``); NULL for a column without values. The columns are keys
    of one cumulative pass: one scan, one checkpoint of the counts per distinct
    value, one set of cut points. Runs jobs when called."""
    x = stacked_values(df, cols).select("_col", "score", F.lit(1).alias("label"))
    c = cumulative(x, "score", "label", buckets, by=["_col"])       # pos = rows at the value, P = all rows
    lo = F.floor((F.col("P") - 1) / 2)
    hi = F.floor(F.col("P") / 2)

    def at(rank, col):
        here = (F.col("_col") == F.lit(col)) & (F.col("pos_below") <= rank) & (rank < F.col("pos_below") + F.col("pos"))
        return F.max(F.when(here, F.col("score")))

    names = list(aliases) if aliases else [prefix + c for c in cols]
    return c.agg(*[(F.lit(0.5) * at(lo, col) + F.lit(0.5) * at(hi, col)).alias(n) for col, n in zip(cols, names)])


def exact_median(df: DataFrame, col: str, alias: str | None = None,
                 buckets: int | None = DEFAULT_BUCKETS) -> DataFrame:
    """One row, one column: the exact median of the non-null values (NULL if none)."""
    return exact_medians(df, [col], buckets=buckets, aliases=[alias or col])
