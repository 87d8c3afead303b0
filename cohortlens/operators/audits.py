"""Data-quality audits and descriptive statistics.

Each audit is one aggregation pass over its input (conditional counts for all
columns at once, never one job per column); results are small frames.
Where a total is needed next to grouped counts, the total is a one-row
aggregate of the grouped frame, paired with it by a one-row join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C
from ..functions.frames import attach_row
from ..sources.footers import footer_counts
from ..sources.tables import TrialTables
from . import cohort as CO
from . import quantiles as Q


def class_balance(df: DataFrame, by: str = "overall_status") -> DataFrame:
    """Count and % of rows per class (NULL class kept as its own row)."""
    g = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    total = g.agg(F.sum("n").alias("_total"))
    return (attach_row(g, total)
            .select(by, "n", C.pct("n", "_total").alias("pct")))


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column NULL count and %, only columns with NULLs, most first.

    One aggregate computes every column's count; ``stack`` unpivots it."""
    cols = list(columns or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_c{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', _c{i}" for i, c in enumerate(cols))
    long = agg.selectExpr("_n", f"stack({len(cols)}, {pairs}) AS (column_name, null_count)")
    return (long.where(F.col("null_count") > 0)
            .select("column_name", F.col("null_count").cast("long").alias("null_count"),
                    C.pct("null_count", "_n").alias("null_pct"))
            .orderBy(F.desc("null_pct"), F.desc("null_count"), "column_name"))


def null_audit_written(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """E11 of a written Parquet table from its footers: no data page is read
    (``sources.footers``). Runs a job; the same rows as ``null_audit``."""
    found = footer_counts(spark, path, list(columns) if columns is not None else None)
    rows = [(c, found.rows - n, found.rows) for c, n in found.present.items() if n < found.rows]
    long = spark.createDataFrame(rows, "column_name string, null_count long, _n long")
    return (long.select("column_name", "null_count", C.pct("null_count", "_n").alias("null_pct"))
            .orderBy(F.desc("null_pct"), F.desc("null_count"), "column_name"))


def row_counts_written(spark: SparkSession, raw: Mapping[str, str], reduced: Mapping[str, str]) -> DataFrame:
    """E15 of written tables from their footers: rows per table as loaded and
    after the cohort reduction (NULL where a table was not written)."""
    def rows(paths: Mapping[str, str], name: str) -> int | None:
        return footer_counts(spark, paths[name], []).rows if name in paths else None
    names = [*raw, *[n for n in reduced if n not in raw]]
    return spark.createDataFrame([(n, rows(raw, n), rows(reduced, n)) for n in names],
                                 "table_name string, raw_rows long, cohort_rows long")


def phase_status_crosstab(cohort: DataFrame, statuses: Sequence[str] = K.COHORT_STATUSES,
                          terminated: str = K.STATUS_TERMINATED) -> DataFrame:
    """Phase x status counts (0-filled), total and termination %.

    Pivot values are given, so Spark needs no extra job to discover them."""
    pv = (cohort.groupBy("phase").pivot("overall_status", list(statuses))
          .agg(F.count(F.lit(1))).fillna(0, subset=list(statuses)))
    total = sum((F.col(f"`{s}`") for s in statuses[1:]), F.col(f"`{statuses[0]}`"))
    return (pv.withColumn("total", total.cast("long"))
            .withColumn("termination_rate_pct", C.pct(F.col(f"`{terminated}`"), "total"))
            .orderBy("phase"))


def sponsor_distribution(studies: DataFrame, sponsors: DataFrame, key: str = "nct_id",
                         lead: str = K.LEAD) -> DataFrame:
    """Cohort trials per lead-sponsor class, most first; duplicate lead
    rows are kept (the audit does not dedupe), NULL class dropped.

    Lead rows are pre-counted per (trial, class) so a trial with very many
    lead rows reaches the join as one row per class."""
    leads = (sponsors.where((F.col("lead_or_collaborator") == F.lit(lead))
                            & F.col("agency_class").isNotNull())
             .groupBy(key, "agency_class").agg(F.count(F.lit(1)).alias("_rows")))
    return (CO.restrict_aggregated(leads, CO.cohort_ids(studies, key), key)
            .groupBy("agency_class").agg(F.sum("_rows").alias("n_trials"))
            .orderBy(F.desc("n_trials"), "agency_class"))


def enrollment_stats(cohort: DataFrame, col: str = "enrollment", places: int = 4) -> DataFrame:
    """Count, mean, exact median, min, max, sample std over non-null values
    (mean and std rounded to ``places`` so the last float bit does not depend
    on partitioning; the median from ``quantiles.exact_median``)."""
    x = F.col(col)
    kept = cohort.where(x.isNotNull())
    stats = kept.agg(F.count(x).alias("n"),
                     F.round(F.avg(x), places).alias("mean_enrollment"),
                     F.min(x).alias("min_enrollment"),
                     F.max(x).alias("max_enrollment"),
                     F.round(F.stddev_samp(x), places).alias("std_enrollment"))
    return (attach_row(stats, Q.exact_median(kept, col, "median_enrollment"))
            .select("n", "mean_enrollment", "median_enrollment", "min_enrollment", "max_enrollment",
                    "std_enrollment"))


def row_count_audit(tables: TrialTables, key: str = "nct_id", **kw) -> DataFrame:
    """Rows per table as loaded and after the cohort reduction, plus the
    group counts of the two tables the reference aggregates on load; one plan
    for all tables (``cohort.table_counts``)."""
    ids = CO.cohort_ids(tables.studies, key, **kw)
    frames = dict(tables.items())
    frames["facilities"] = (tables.facilities, {"facilities_aggregated": []})
    frames["reported_events"] = (tables.reported_events, {"reported_events_aggregated": ["event_type"]})
    return (CO.table_counts(frames, ids, key)
            .select("table_name", F.col("before").alias("raw_rows"), F.col("after").alias("cohort_rows")))


def median_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill NULLs of each column with that column's exact median.

    The medians (``quantiles.exact_medians``: no single-task merge) are one
    aggregate row, broadcast to every task."""
    med = Q.exact_medians(df, list(columns), prefix="_med_")
    out = attach_row(df, med)
    return out.select(*[F.coalesce(F.col(c), F.col(f"_med_{c}")).alias(c) if c in columns else F.col(c)
                        for c in df.columns])


def na_token_audit(df: DataFrame, tokens: Sequence[str] = K.NA_TOKENS,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """A2 audit: per string column, values present before and after turning the
    missing-value tokens into NULL (one pass)."""
    cols = list(columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"])
    agg = df.agg(*[F.count(F.col(c)).alias(f"_b{i}") for i, c in enumerate(cols)],
                 *[F.count(C.na_to_null(F.col(c), tokens)).alias(f"_a{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', _b{i}, _a{i}" for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, present_raw, present_clean)")
