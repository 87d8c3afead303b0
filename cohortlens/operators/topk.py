"""The two top-k reports.

Both end in ``orderBy(...).limit(k)`` with a total order (explicit
tie-breakers), which Spark plans as ``TakeOrderedAndProject``: each task keeps
its own k best rows and one merge keeps the global k, with no full sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C
from . import cohort as CO


def withdrawal_reasons(withdrawals: DataFrame, cohort_ids: DataFrame, key: str = "nct_id",
                       k: int = K.TOP_WITHDRAWAL_REASONS) -> DataFrame:
    """Top-k normalised withdrawal reasons in the cohort, with the total
    count and the number of trials affected.

    Plan: pre-aggregate (trial, reason) pairs (partial aggregation absorbs a
    hot trial or a hot reason), restrict the pairs to the cohort (kept above
    the aggregation, see ``cohort.restrict_aggregated``), then group
    by reason. After the pre-aggregation each (trial, reason) is one row, so
    the distinct-trial count is a plain count."""
    pairs = (withdrawals.where(F.col("reason").isNotNull())
             .select(key, C.normalize_reason("reason").alias("withdrawal_reason"), F.col("count"))
             .groupBy(key, "withdrawal_reason")
             .agg(F.sum("count").alias("pair_count")))
    return (CO.restrict_aggregated(pairs, cohort_ids, key)
            .groupBy("withdrawal_reason")
            .agg(F.sum("pair_count").alias("total_count"),
                 F.count(F.lit(1)).alias("trials_affected"))
            .orderBy(F.desc_nulls_last("total_count"), F.asc("withdrawal_reason"))
            .limit(k))


def risk_flag_score(terminated_weight: int = K.RISK_FLAG_TERMINATED_WEIGHT,
                    no_results_weight: int = K.RISK_FLAG_NO_RESULTS_WEIGHT,
                    withdrawal_threshold: int = K.RISK_FLAG_WITHDRAWAL_THRESHOLD):
    """3*terminated + 2*(1-results_posted) + [withdrawals > 100]."""
    return (F.col("is_terminated") * F.lit(terminated_weight)
            + (F.lit(1) - F.col("results_posted")) * F.lit(no_results_weight)
            + C.flag(F.col("total_withdrawals") > F.lit(withdrawal_threshold))).cast("int")


HIGH_RISK_COLUMNS = ("nct_id", "overall_status", "phase", "agency_class", "enrollment_actual",
                     "duration_months", "total_withdrawals", "has_outcomes_posted",
                     "results_posted", "why_stopped")


def high_risk_trials(master: DataFrame, k: int = K.TOP_HIGH_RISK, key: str = "nct_id") -> DataFrame:
    """The k trials with the highest flag score (then most withdrawals,
    then smallest id)."""
    return (master.select(*HIGH_RISK_COLUMNS, risk_flag_score().alias("risk_flag_score"))
            .orderBy(F.desc("risk_flag_score"), F.desc_nulls_last("total_withdrawals"), F.asc(key))
            .limit(k))
