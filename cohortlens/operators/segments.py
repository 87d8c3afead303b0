"""Segment reports over the master table.

Each report is one ``groupBy`` with conditional aggregates (partial per task,
one small exchange); ordering is applied to the final, segment-sized frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C
from ..functions.frames import attach_row
from ..session import checkpoint_dir
from . import quantiles as Q


def _done():
    return F.col("overall_status") == F.lit(K.STATUS_COMPLETED)


def _avg_tenths(col: str):
    """Mean of a column of one decimal, added up as whole tenths: the sum does
    not depend on the order of the rows."""
    return F.sum(F.round(F.col(col) * 10).cast("long")) / F.count(col) / F.lit(10.0)


def phase_segmentation(master: DataFrame) -> DataFrame:
    """Per phase totals, rates and averages; ordered by phase code."""
    return (master.groupBy("phase")
            .agg(F.count(F.lit(1)).alias("total_trials"),
                 F.sum("is_terminated").cast("long").alias("terminated"),
                 F.count_if(_done()).alias("completed"),
                 F.sum("results_posted").cast("long").alias("results_posted"),
                 F.avg("enrollment_actual").alias("_enr"),
                 _avg_tenths("duration_months").alias("_dur"),
                 F.avg("total_withdrawals").alias("_wd"),
                 F.min("phase_numeric").alias("_ord"))
            .select("phase", "total_trials", "terminated", "completed", "results_posted",
                    C.pct("terminated", "total_trials").alias("termination_rate_pct"),
                    C.pct("results_posted", "total_trials").alias("results_compliance_pct"),
                    F.round("_enr", 0).alias("avg_actual_enrollment"),
                    F.round("_dur", 1).alias("avg_duration_months"),
                    F.round("_wd", 1).alias("avg_withdrawals"),
                    "_ord")
            .orderBy(F.asc_nulls_last("_ord"), "phase")
            .drop("_ord"))


def sponsor_segmentation(master: DataFrame, min_trials: int | None = None) -> DataFrame:
    """E5: per lead-sponsor class (NULL class dropped); rate descending.
    ``min_trials`` keeps classes with more than that many trials (B18)."""
    out = (master.where(F.col("agency_class").isNotNull())
           .groupBy("agency_class")
           .agg(F.count(F.lit(1)).alias("total_trials"),
                F.sum("is_terminated").cast("long").alias("terminated"),
                F.avg("enrollment_actual").alias("_enr"),
                _avg_tenths("duration_months").alias("_dur"))
           .select("agency_class", "total_trials", "terminated",
                   C.pct("terminated", "total_trials").alias("termination_rate_pct"),
                   F.round("_enr", 0).alias("avg_actual_enrollment"),
                   F.round("_dur", 1).alias("avg_duration_months")))
    if min_trials is not None:
        out = out.where(F.col("total_trials") > F.lit(min_trials))
    return out.orderBy(F.desc_nulls_last("termination_rate_pct"), "agency_class")


def results_compliance(master: DataFrame) -> DataFrame:
    """Results posting by phase, over all trials (as the code computes) and
    over completed trials (as the prose states)."""
    return (master.groupBy("phase")
            .agg(F.count(F.lit(1)).alias("total"),
                 F.sum("results_posted").cast("long").alias("posted"),
                 F.count_if(_done()).alias("completed"),
                 F.count_if(_done() & (F.col("results_posted") == 1)).alias("posted_completed"))
            .select("phase", "total", "posted", C.pct("posted", "total").alias("compliance_pct"),
                    "completed", "posted_completed",
                    C.pct("posted_completed", "completed").alias("compliance_completed_pct"))
            .orderBy("phase"))


def key_insights(master: DataFrame) -> DataFrame:
    """One row of headline numbers. Runs jobs: the few columns it needs are
    checkpointed once, so the master behind them is computed once.

    Medians are exact and distributed (``quantiles.exact_median``: counts per
    distinct value, prefix sums by range, no single-task merge). The worst
    sponsor class is the minimum of
    (-rate, class) over the sponsor report; both inputs are one-row
    aggregates, so combining them pairs exactly one row with one row."""
    checkpoint_dir(master.sparkSession)
    master = master.select("phase", "agency_class", "overall_status", "is_terminated", "results_posted",
                           "primary_completion_date", "duration_months", "enrollment_actual").checkpoint()
    term, n = F.col("is_terminated"), F.count(F.lit(1))
    p2, p3 = F.col("phase") == "PHASE2", F.col("phase") == "PHASE3"
    overall = master.agg(
        n.alias("n_trials"),
        C.pct(F.sum(term), n).alias("termination_rate_pct"),
        C.pct(n - F.sum(term), n).alias("completion_rate_pct"),
        C.pct(F.count("primary_completion_date"), n).alias("reached_primary_pct"),
        C.pct(F.sum("results_posted"), n).alias("results_posted_pct"),
        C.pct(F.count_if(_done() & (F.col("results_posted") == 1)), F.count_if(_done()))
        .alias("results_posted_of_completed_pct"),
        C.pct(F.count_if(p2 & (term == 1)), F.count_if(p2)).alias("phase2_termination_rate_pct"),
        C.pct(F.count_if(p3 & (term == 1)), F.count_if(p3)).alias("phase3_termination_rate_pct"),
    )
    seg = sponsor_segmentation(master)
    # highest rate; ties -> smallest class name
    worst = (seg.agg(F.min(F.struct((-F.col("termination_rate_pct")).alias("neg"),
                                    F.col("agency_class").alias("cls"))).alias("w"))
             .select(F.col("w.cls").alias("worst_sponsor_class"),
                     (-F.col("w.neg")).alias("worst_sponsor_rate_pct")))
    medians = Q.exact_medians(master, ["duration_months", "enrollment_actual"],
                              aliases=["median_duration_months", "median_actual_enrollment"])
    return attach_row(attach_row(overall, medians), worst)
