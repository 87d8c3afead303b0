"""E1, E2, E4, E5, E8, E10 and E12 from one scan of the master.

One aggregation over grouping sets (all rows, phase, sponsor class, status,
phase x status) leaves a small table of additive measures: a scan, a partial
aggregation in each task and one shuffle of group rows. Every report is a
projection of the cells of its grouping set. The cells' number is that of the
dimension values, not of the trials; written once, they serve all reports.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C
from ..functions.frames import attach_row
from . import funnel as FU

DIMENSIONS = ("phase", "agency_class", "overall_status")
SETS = {"all": (), "phase": ("phase",), "sponsor": ("agency_class",), "status": ("overall_status",),
        "phase_status": ("phase", "overall_status")}


def report_cells(master: DataFrame) -> DataFrame:
    """One row per group of each grouping set: the set's name, the dimensions
    (NULL where the set has none), row counts and sums."""
    done = F.col("overall_status") == F.lit(K.STATUS_COMPLETED)
    cells = master.groupingSets([list(s) for s in SETS.values()], *DIMENSIONS).agg(
        F.grouping_id().alias("_gid"),
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("is_terminated"), F.lit(0)).cast("long").alias("terminated"),
        F.count_if(done).alias("completed"),
        F.coalesce(F.sum("results_posted"), F.lit(0)).cast("long").alias("posted"),
        F.count_if(F.col("results_posted") == 1).alias("posted_rows"),
        F.count_if(done & (F.col("results_posted") == 1)).alias("posted_completed"),
        F.count("primary_completion_date").alias("primary_reached"),
        F.count("enrollment_actual").alias("enrollment_n"), F.sum("enrollment_actual").alias("enrollment_sum"),
        F.count("duration_months").alias("duration_n"),
        F.sum(F.round(F.col("duration_months") * 10).cast("long")).alias("duration_tenths"),
        F.count("total_withdrawals").alias("withdrawals_n"), F.sum("total_withdrawals").alias("withdrawals_sum"),
        F.min("phase_numeric").alias("phase_ord"))
    name = F.lit(None).cast("string")
    for s, dims in SETS.items():
        gid = sum(1 << (len(DIMENSIONS) - 1 - i) for i, d in enumerate(DIMENSIONS) if d not in dims)
        name = F.when(F.col("_gid") == gid, F.lit(s)).otherwise(name)
    return cells.select(name.alias("grouping"), *[c for c in cells.columns if c != "_gid"])


def _of(cells: DataFrame, grouping: str) -> DataFrame:
    return cells.where(F.col("grouping") == grouping)


def _average(what: str, places: int, scale: float = 1.0):
    return F.round(F.col(f"{what}_sum") / F.nullif(F.col(f"{what}_n"), F.lit(0)) / F.lit(scale), places)


def _months():
    return F.round(F.col("duration_tenths") / F.nullif(F.col("duration_n"), F.lit(0)) / F.lit(10.0), 1)


def funnel_stages(cells: DataFrame) -> DataFrame:
    """One row; zeros if there are no trials."""
    counts = ("n", "enrollment_n", "primary_reached", "completed", "posted_rows")
    return _of(cells, "all").agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(s)
                                   for c, s in zip(counts, FU.STAGE_COLUMNS)])


def funnel_with_rates(cells: DataFrame) -> DataFrame:
    """E2."""
    return FU.rates_of(funnel_stages(cells))


def phase_segmentation(cells: DataFrame) -> DataFrame:
    """E4."""
    return (_of(cells, "phase").orderBy(F.asc_nulls_last("phase_ord"), "phase")
            .select("phase", F.col("n").alias("total_trials"), "terminated", "completed",
                    F.col("posted").alias("results_posted"),
                    C.pct("terminated", "n").alias("termination_rate_pct"),
                    C.pct("posted", "n").alias("results_compliance_pct"),
                    _average("enrollment", 0).alias("avg_actual_enrollment"),
                    _months().alias("avg_duration_months"),
                    _average("withdrawals", 1).alias("avg_withdrawals")))


def sponsor_segmentation(cells: DataFrame, min_trials: int | None = None) -> DataFrame:
    """E5."""
    out = (_of(cells, "sponsor").where(F.col("agency_class").isNotNull())
           .select("agency_class", F.col("n").alias("total_trials"), "terminated",
                   C.pct("terminated", "n").alias("termination_rate_pct"),
                   _average("enrollment", 0).alias("avg_actual_enrollment"),
                   _months().alias("avg_duration_months")))
    if min_trials is not None:
        out = out.where(F.col("total_trials") > F.lit(min_trials))
    return out.orderBy(F.desc_nulls_last("termination_rate_pct"), "agency_class")


def results_compliance(cells: DataFrame) -> DataFrame:
    """E8."""
    return (_of(cells, "phase")
            .select("phase", F.col("n").alias("total"), "posted", C.pct("posted", "n").alias("compliance_pct"),
                    "completed", "posted_completed",
                    C.pct("posted_completed", "completed").alias("compliance_completed_pct"))
            .orderBy("phase"))


def class_balance(cells: DataFrame) -> DataFrame:
    """E10 by status."""
    total = _of(cells, "all").agg(F.sum("n").alias("_total"))
    return attach_row(_of(cells, "status").select("overall_status", "n"), total).select(
        "overall_status", "n", C.pct("n", "_total").alias("pct"))


def phase_status_crosstab(cells: DataFrame, statuses: Sequence[str] = K.COHORT_STATUSES,
                          terminated: str = K.STATUS_TERMINATED) -> DataFrame:
    """E12."""
    counts = (_of(cells, "phase_status").groupBy("phase")
              .agg(*[F.coalesce(F.sum(F.when(F.col("overall_status") == s, F.col("n"))), F.lit(0)).alias(s)
                     for s in statuses]))
    total = sum((F.col(f"`{s}`") for s in statuses[1:]), F.col(f"`{statuses[0]}`"))
    return (counts.withColumn("total", total.cast("long"))
            .withColumn("termination_rate_pct", C.pct(F.col(f"`{terminated}`"), "total")).orderBy("phase"))


CELL_REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "funnel_with_rates": funnel_with_rates,
    "phase_segmentation": phase_segmentation,
    "sponsor_segmentation": sponsor_segmentation,
    "results_compliance": results_compliance,
    "class_balance": class_balance,
    "phase_status_crosstab": phase_status_crosstab,
}
