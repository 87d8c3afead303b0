"""The master trial table (one row per cohort trial).

Rollups are aggregated first and joined second (aggregate-before-join): every
right side then has one row per key, so the left joins never fan out and the
skew of the raw child tables is absorbed by partial aggregation. All joins
share the trial key, so each side is exchanged at most once and the rollups
reuse the hash partitioning of their own aggregation.

Two fills exist because the reference's two paths disagree (quirks 5, 6):
``fill='sql'`` counts facility rows and fills missing site info with 1/1/0;
``fill='pandas'`` counts non-null countries and leaves missing site info NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..sources.tables import TrialTables
from . import cohort as CO
from . import rollups as R

MASTER_TRIAL_COLUMNS = (
    "nct_id", "overall_status", "is_terminated", "phase", "phase_numeric", "enrollment",
    "enrollment_type", "enrollment_actual", "start_date", "completion_date",
    "primary_completion_date", "results_first_submitted_date", "results_posted",
    "number_of_arms", "why_stopped", "agency_class", "sponsor_name", "site_count",
    "country_count", "is_multinational", "total_withdrawals", "distinct_withdrawal_reasons",
    "num_primary_outcomes", "has_outcomes_posted", "duration_days", "duration_months",
)

MASTER_FUNNEL_COLUMNS = (
    "nct_id", "overall_status", "is_terminated", "phase", "phase_numeric", "enrollment",
    "enrollment_type", "enrollment_actual", "start_date", "completion_date",
    "primary_completion_date", "duration_days", "duration_months", "number_of_arms",
    "agency_class", "site_count", "is_multinational", "total_withdrawals",
    "num_primary_outcomes", "num_outcomes_posted", "results_posted", "why_stopped",
)


SITE_COLUMNS = ("site_count", "country_count", "is_multinational")


def _joined(tables: TrialTables, key: str, **kw) -> DataFrame:
    base = CO.base_cohort(tables.studies, **kw)
    ids = CO.cohort_ids(tables.studies, key, **kw)
    # facilities may come as raw rows or, from the load step, one row per trial
    sites = (tables.facilities if "site_rows" in tables.facilities.columns
             else R.site_summary(tables.facilities, key))
    for side in (R.lead_sponsor(tables.sponsors, key), sites, R.withdrawal_summary(tables.drop_withdrawals, key),
                 R.outcome_summary(tables.outcomes, key)):
        # with a broadcastable cohort this prunes the child rows before they
        # are aggregated; otherwise it meets one row per trial
        base = base.join(CO.restrict_aggregated(side, ids, key), key, "left")
    return base


def master_trial(tables: TrialTables, fill: str = "sql", key: str = "nct_id", **kw) -> DataFrame:
    """D5, 26 columns (``fill='sql'``), the same columns with pandas fills, or
    (``fill='both'``) the SQL fills plus the three unfilled site columns as
    ``raw_<name>``, from which ``funnel_of`` takes the other fill."""
    df = _joined(tables, key, **kw)
    days = C.duration_days()
    if fill in ("sql", "both"):
        site = [F.coalesce("site_rows", F.lit(1).cast("long")).alias("site_count"),
                F.coalesce("country_count", F.lit(1).cast("long")).alias("country_count"),
                F.coalesce("is_multinational", F.lit(0)).alias("is_multinational")]
    elif fill == "pandas":
        site = [F.col(c) for c in SITE_COLUMNS]
    else:
        raise ValueError(f"fill must be 'sql', 'pandas' or 'both', not {fill!r}")
    if fill == "both":
        site += [F.col(c).alias(f"raw_{c}") for c in SITE_COLUMNS]
    return df.select(
        key, "overall_status", "is_terminated", "phase", "phase_numeric", "enrollment",
        "enrollment_type", C.enrollment_actual().alias("enrollment_actual"),
        "start_date", "completion_date", "primary_completion_date",
        "results_first_submitted_date",
        C.not_null_flag("results_first_submitted_date").alias("results_posted"),
        "number_of_arms", "why_stopped", "agency_class", "sponsor_name",
        *site,
        F.coalesce("total_withdrawals", F.lit(0.0)).alias("total_withdrawals"),
        F.coalesce("distinct_withdrawal_reasons", F.lit(0).cast("long")).alias("distinct_withdrawal_reasons"),
        F.coalesce("num_primary_outcomes", F.lit(0).cast("long")).alias("num_primary_outcomes"),
        F.coalesce("has_outcomes_posted", F.lit(0)).alias("has_outcomes_posted"),
        days.alias("duration_days"),
        C.duration_months(days).alias("duration_months"),
        F.coalesce("num_outcomes_posted", F.lit(0).cast("long")).alias("num_outcomes_posted"),
    )


def master_funnel(tables: TrialTables, key: str = "nct_id", **kw) -> DataFrame:
    """D5, the 22-column master of the pandas path (``fill='pandas'``)."""
    return master_trial(tables, fill="pandas", key=key, **kw).select(*MASTER_FUNNEL_COLUMNS)


def funnel_of(both: DataFrame) -> DataFrame:
    """The 22-column pandas-path master from a ``fill='both'`` master."""
    return both.select(*[F.col(f"raw_{c}").alias(c) if c in SITE_COLUMNS else F.col(c)
                         for c in MASTER_FUNNEL_COLUMNS])


def master_trial_sql(tables: TrialTables, key: str = "nct_id", **kw) -> DataFrame:
    """The 26 published columns of the SQL path."""
    return master_trial(tables, fill="sql", key=key, **kw).select(*MASTER_TRIAL_COLUMNS)


def pick_columns(df: DataFrame, wanted) -> DataFrame:
    """Project the wanted columns that exist, in the wanted order."""
    have = set(df.columns)
    return df.select([c for c in wanted if c in have])


__all__ = ["master_trial", "master_trial_sql", "master_funnel", "funnel_of", "pick_columns",
           "MASTER_TRIAL_COLUMNS", "MASTER_FUNNEL_COLUMNS"]
