"""Map the driver's TPC-H-ish test tables onto the registry's logical tables.

Only ``__spark_entry__.py``, ``bench.py`` and tests import this module: the
library itself works on any ``TrialTables``. The mapping plants the NULLs,
duplicate leads, missing leads and padded reasons the operators must handle
(see FIXTURES.md §3). Every child table is derived from the whole driver
tables, so its size grows with the scale factor.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import TrialTables

# The columns that the mapping uses; with fixed types no footer is read to plan a query.
DRIVER_TABLES = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_name string, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_type string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, user_id bigint, event_type string, value double",
}


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(DRIVER_TABLES[name]).parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _studies(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    # per-order first/last ship date: partial aggregation before the exchange
    ship = (lineitem.select("l_orderkey", F.col("l_shipdate").cast("date").alias("d"))
            .groupBy("l_orderkey")
            .agg(F.min("d").alias("d0"), F.max("d").alias("d1")))
    o = orders.join(ship, orders.o_orderkey == ship.l_orderkey, "left")
    k = F.col("o_orderkey")
    status = (F.when(F.col("o_orderstatus") == "F", "COMPLETED")
              .when(F.col("o_orderstatus") == "P", "TERMINATED")
              .otherwise("RECRUITING"))
    return o.select(
        k.alias("nct_id"),
        status.alias("overall_status"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "PHASE3")
        .when(F.col("o_orderpriority") == "2-HIGH", "PHASE2")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "PHASE2/PHASE3")
        .when(F.col("o_orderpriority") == "5-LOW", "PHASE1").alias("phase"),
        F.when(k % 17 != 0, F.floor(F.col("o_totalprice") / 1000).cast("double")).alias("enrollment"),
        F.when(k % 5 == 0, "ESTIMATED").otherwise("ACTUAL").alias("enrollment_type"),
        F.when(k % 10 == 9, "OBSERVATIONAL").otherwise("INTERVENTIONAL").alias("study_type"),
        F.when(k % 23 != 0, F.col("o_orderdate").cast("date")).alias("start_date"),
        F.col("d1").alias("completion_date"),
        F.col("d0").alias("primary_completion_date"),
        F.lit(None).cast("date").alias("study_first_submitted_date"),
        F.when(F.col("o_custkey") % 3 == 0, F.col("d1")).alias("results_first_submitted_date"),
        F.when(k % 11 != 0, (F.col("o_custkey") % 4 + 1).cast("double")).alias("number_of_arms"),
        F.lit(None).cast("double").alias("number_of_groups"),
        F.when((F.col("o_orderstatus") == "P") & (k % 7 == 0), "Low accrual").alias("why_stopped"),
        F.lit(None).cast("string").alias("has_expanded_access"),
    )


def _sponsors(orders, lineitem, customer, supplier) -> DataFrame:
    seg = F.col("c_mktsegment")
    from_customers = (
        orders.join(customer, F.col("c_custkey") == F.col("o_custkey"))
        .select(
            F.col("o_orderkey").alias("nct_id"),
            F.when(seg == "AUTOMOBILE", "INDUSTRY").when(seg == "BUILDING", "NIH")
            .when(seg == "FURNITURE", "FED").when(seg == "MACHINERY", "INDIV").alias("agency_class"),
            F.when(F.col("o_orderkey") % 19 == 0, "collaborator").otherwise("lead").alias("lead_or_collaborator"),
            F.col("c_name").alias("name"),
        )
    )
    from_suppliers = (
        lineitem.join(supplier, F.col("s_suppkey") == F.col("l_suppkey"))
        .select(
            F.col("l_orderkey").alias("nct_id"),
            F.lit("OTHER").alias("agency_class"),
            F.when((F.col("l_orderkey") % 13 == 0) & (F.col("l_linenumber") == 1), "lead")
            .otherwise("collaborator").alias("lead_or_collaborator"),
            F.col("s_name").alias("name"),
        )
    )
    return from_customers.unionByName(from_suppliers)


def _facilities(lineitem, supplier, nation) -> DataFrame:
    return (lineitem.join(supplier, F.col("s_suppkey") == F.col("l_suppkey"))
            .join(nation, F.col("n_nationkey") == F.col("s_nationkey"))
            .select(F.col("l_orderkey").alias("nct_id"),
                    F.when(F.col("l_linenumber") != 7, F.col("n_name")).alias("country")))


def _withdrawals(lineitem) -> DataFrame:
    line, rf = F.col("l_linenumber"), F.col("l_returnflag")
    reason = (F.when(line == 6, F.lit(None).cast("string"))
              .when(rf == "A", " Adverse Event")
              .when((rf == "R") & (F.col("l_linestatus") == "F"), "withdrawal by subject \u00a0")
              .when(rf == "R", "Withdrawal by Subject")
              .otherwise("Lost to Follow-up"))
    return (lineitem.select(F.col("l_orderkey").alias("nct_id"), F.lit("Overall Study").alias("period"),
                    reason.alias("reason"),
                    F.when(line != 5, F.col("l_quantity")).cast("double").alias("count")))


def _outcomes(lineitem) -> DataFrame:
    otype = (F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
             .when(F.col("l_linestatus") == "F", "PRIMARY").otherwise("SECONDARY"))
    none = F.lit(None).cast("string")
    return (lineitem.select(F.col("l_orderkey").alias("nct_id"), otype.alias("outcome_type"),
                    none.alias("title"), none.alias("time_frame"), none.alias("population")))


def _reported_events(events) -> DataFrame:
    return events.select(F.col("user_id").alias("nct_id"), "event_type",
                         F.floor("value").cast("double").alias("subjects_affected"),
                         (F.col("event_id") % 100).cast("double").alias("subjects_at_risk"))


def _conditions(lineitem, part) -> DataFrame:
    return (lineitem.join(part, F.col("p_partkey") == F.col("l_partkey"))
            .select(F.col("l_orderkey").alias("nct_id"), F.col("p_name").alias("name"),
                    F.lower("p_name").alias("downcase_name")))


def _interventions(lineitem, part) -> DataFrame:
    return (lineitem.join(part, F.col("p_partkey") == F.col("l_partkey"))
            .select(F.col("l_orderkey").alias("nct_id"), F.col("p_type").alias("intervention_type"),
                    F.col("p_name").alias("name")))


def _eligibilities(orders) -> DataFrame:
    none = F.lit(None).cast("string")
    return orders.select(F.col("o_orderkey").alias("nct_id"), none.alias("gender"),
                         none.alias("minimum_age"), none.alias("maximum_age"),
                         none.alias("healthy_volunteers"), none.alias("criteria"))


def fixture_tables(spark: SparkSession, sf_dir: str) -> TrialTables:
    """The nine logical tables over the driver tables in ``sf_dir`` (lazy)."""
    t = {n: read_driver(spark, sf_dir, n) for n in DRIVER_TABLES}
    li = t["lineitem"]
    return TrialTables(
        studies=_studies(t["orders"], li),
        sponsors=_sponsors(t["orders"], li, t["customer"], t["supplier"]),
        eligibilities=_eligibilities(t["orders"]),
        drop_withdrawals=_withdrawals(li),
        outcomes=_outcomes(li),
        conditions=_conditions(li, t["part"]),
        facilities=_facilities(li, t["supplier"], t["nation"]),
        reported_events=_reported_events(t["events"]),
        interventions=_interventions(li, t["part"]),
    )

