"""Frame-level helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _max_rows(df: DataFrame):
    """The optimizer's proven upper bound on the row count, or None."""
    opt = df._jdf.queryExecution().optimizedPlan().maxRows()
    return int(opt.get()) if opt.isDefined() else None


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame to every row of ``df``.

    ``one_row`` must be provably a single row -- a global aggregate (``agg``
    without grouping keys) or a combination of such -- which the optimizer's
    ``maxRows`` bound confirms. The result has exactly the rows of ``df``:
    no pairs are formed. The single row is broadcast to every task."""
    bound = _max_rows(one_row)
    if bound is None or bound > 1:
        raise ValueError(f"attach_row needs a one-row frame, got a bound of {bound}")
    return df.crossJoin(F.broadcast(one_row))
