"""Child tables rolled up to one row per trial.

Every rollup is a single ``groupBy`` on the trial key: map-side partial
aggregation shrinks each task's rows to one per key before the exchange, so a
trial holding a third of a child table costs one row per map task, not a hot
reducer. The outputs are hash-partitioned on the key, which the master join
reuses without another exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C


def lead_sponsor(sponsors: DataFrame, key: str = "nct_id", lead: str = K.LEAD) -> DataFrame:
    """One lead sponsor per trial: the smallest (name, agency_class).

    ``min(struct)`` is a partial aggregate (no window sort); struct order puts
    NULL fields first. The reference's pick is arbitrary; this one is fixed."""
    m = (sponsors.where(F.col("lead_or_collaborator") == F.lit(lead))
         .groupBy(key)
         .agg(F.min(F.struct(F.col("name"), F.col("agency_class"))).alias("m")))
    return m.select(key, F.col("m.agency_class").alias("agency_class"),
                    F.col("m.name").alias("sponsor_name"))


def site_summary(facilities: DataFrame, key: str = "nct_id") -> DataFrame:
    """Per trial ``site_rows`` (all rows, SQL count), ``site_count`` (non-null
    country, pandas count), ``country_count`` (distinct) and ``is_multinational``.

    The single distinct aggregate is planned as partial aggregation on
    (key, country) then on key: two exchanges, both after reduction, and a hot
    trial splits over its countries."""
    return (facilities.groupBy(key)
            .agg(F.count(F.lit(1)).alias("site_rows"),
                 F.count("country").alias("site_count"),
                 F.count_distinct("country").alias("country_count"))
            .withColumn("is_multinational", C.flag(F.col("country_count") > 1)))


def reported_events_rollup(events: DataFrame, key: str = "nct_id") -> DataFrame:
    """Per trial and event type, summed affected / at-risk (all-NULL -> 0)."""
    return (events.groupBy(key, "event_type")
            .agg(F.coalesce(F.sum("subjects_affected"), F.lit(0.0)).alias("total_affected"),
                 F.coalesce(F.sum("subjects_at_risk"), F.lit(0.0)).alias("total_at_risk")))


def withdrawal_summary(withdrawals: DataFrame, key: str = "nct_id") -> DataFrame:
    """D3: total withdrawals (sum of ``count``; all-NULL -> NULL, filled by the
    master) and distinct raw reasons per trial."""
    return (withdrawals.groupBy(key)
            .agg(F.sum(F.col("count")).alias("total_withdrawals"),
                 F.count_distinct("reason").alias("distinct_withdrawal_reasons")))


def outcome_summary(outcomes: DataFrame, key: str = "nct_id",
                    primary: str = K.OUTCOME_PRIMARY) -> DataFrame:
    """One pass for all outcome counts: total rows, PRIMARY rows, rows with
    a type (the pandas 'posted' count) and the has-outcomes flag."""
    return (outcomes.groupBy(key)
            .agg(F.count(F.lit(1)).alias("total_outcomes"),
                 F.count_if(F.col("outcome_type") == F.lit(primary)).alias("num_primary_outcomes"),
                 F.count("outcome_type").alias("num_outcomes_posted"))
            .withColumn("has_outcomes_posted", C.flag(F.col("total_outcomes") > 0)))
