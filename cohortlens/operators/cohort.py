"""Cohort filter, base-cohort columns, semi-join reduction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C
from ..sources.tables import TrialTables

BASE_COLUMNS = (
    "nct_id", "overall_status", "phase", "enrollment", "enrollment_type", "study_type",
    "start_date", "completion_date", "primary_completion_date",
    "results_first_submitted_date", "number_of_arms", "why_stopped",
)


def cohort_predicate(study_type: str = K.STUDY_TYPE_INTERVENTIONAL,
                     phases: Sequence[str] = K.COHORT_PHASES,
                     statuses: Sequence[str] = K.COHORT_STATUSES):
    """B1 as one Column: equality AND two IN-lists (all pushable to Parquet)."""
    return ((F.col("study_type") == F.lit(study_type))
            & F.col("phase").isin(list(phases))
            & F.col("overall_status").isin(list(statuses)))


def filter_cohort(studies: DataFrame, **kw) -> DataFrame:
    """B1: the studies in the cohort, all columns kept."""
    return studies.where(cohort_predicate(**kw))


def base_cohort(studies: DataFrame, **kw) -> DataFrame:
    """Cohort rows with the projection of the SQL path plus
    ``is_terminated`` and ``phase_numeric``."""
    return (filter_cohort(studies, **kw)
            .select(*BASE_COLUMNS,
                    C.is_terminated().alias("is_terminated"),
                    C.phase_numeric().alias("phase_numeric")))


def cohort_ids(studies: DataFrame, key: str = "nct_id", **kw) -> DataFrame:
    return filter_cohort(studies, **kw).select(key)


def semi_reduce(child: DataFrame, ids: DataFrame, key: str = "nct_id") -> DataFrame:
    """Rows of ``child`` whose key is in ``ids`` (a left-semi join).

    Never collects ids to the driver. AQE turns this into a broadcast hash
    semi-join when the id side is measured small at runtime; otherwise a
    sort-merge semi-join whose skewed partitions AQE splits."""
    return child.join(ids, on=key, how="left_semi")


def reduce_children(tables: TrialTables, key: str = "nct_id", **kw) -> TrialTables:
    """C1 for all eight child tables, plus the cohort itself as ``studies``."""
    ids = cohort_ids(tables.studies, key, **kw)
    reduced = {n: semi_reduce(df, ids, key) for n, df in tables.children()}
    return tables.replace(studies=filter_cohort(tables.studies, **kw), **reduced)


def restrict_aggregated(agg: DataFrame, ids: DataFrame, key: str = "nct_id") -> DataFrame:
    """Keep rows of a key-aggregated frame whose key is in ``ids``: a left-semi
    join. The optimizer moves it below the aggregation only where the id side
    can be broadcast (it then prunes the scan and no key is shuffled); with a
    large id side it stays above and meets pre-aggregated rows."""
    return agg.join(ids, key, "left_semi")


def key_counts(df: DataFrame, key: str = "nct_id", grain=None) -> DataFrame:
    """Rows per key (or, with ``grain``, distinct ``grain`` groups per key);
    partial aggregation: a hot key costs one row per task."""
    if grain is not None:
        df = df.groupBy(key, *grain).agg(F.lit(1).alias("_g"))
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))


def table_counts(frames, ids: DataFrame, key: str = "nct_id") -> DataFrame:
    """Per named frame: total rows and rows whose key is in ``ids``.

    ``frames`` maps a name to a DataFrame, or to ``(DataFrame, grains)`` where
    ``grains`` maps further names to column lists: each counts the distinct
    (key, *columns) groups from the same pass. Every frame is scanned once; the
    per-key counts of all frames meet the flagged ids in one left join, and one
    aggregation adds up both columns."""
    parts = []
    for name, spec in frames.items():
        df, grains = spec if isinstance(spec, tuple) else (spec, {})
        columns = sorted({c for g in grains.values() for c in g})
        cells = df.groupBy(key, *columns).agg(F.count(F.lit(1)).alias("_n"))
        counts = [F.struct(F.lit(name).alias("table_name"), F.sum("_n").alias("_rows"))]
        for extra, g in grains.items():
            if g and sorted(g) != columns:
                raise ValueError("a frame's grains must share one column list")
            groups = F.count(F.lit(1)) if g else F.lit(1).cast("long")
            counts.append(F.struct(F.lit(extra).alias("table_name"), groups.alias("_rows")))
        per_key = cells.groupBy(key).agg(F.array(*counts).alias("_c")) if columns or grains else (
            cells.select(key, F.array(F.struct(F.lit(name).alias("table_name"), F.col("_n").alias("_rows"))).alias("_c")))
        parts.append(per_key.select(key, F.inline("_c")))
    per = parts[0]
    for p in parts[1:]:
        per = per.unionByName(p)
    flagged = ids.select(F.col(key).alias("_id")).distinct()
    return (per.join(flagged, per[key] == F.col("_id"), "left")
            .groupBy("table_name")
            .agg(F.sum("_rows").cast("long").alias("before"),
                 F.coalesce(F.sum(F.when(F.col("_id").isNotNull(), F.col("_rows"))), F.lit(0))
                 .cast("long").alias("after")))


def semi_child_counts(tables: TrialTables, key: str = "nct_id", **kw) -> DataFrame:
    """Row counts of each child table before and after the semi-join reduction
    (C1), from one plan over all eight tables (see ``table_counts``)."""
    ids = cohort_ids(tables.studies, key, **kw)
    c = table_counts(dict(tables.children()), ids, key)
    return c.select("table_name", F.col("before").alias("rows_before"), F.col("after").alias("rows_after"))
