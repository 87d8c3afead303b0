"""Pivots and dashboard views served from one additive cube.

The cube is one ``groupBy`` over the scored table keyed by every dimension the
views use (phase, sponsor class, risk band, 0.05-wide score bin) with additive
measures only (row count, terminated count). Every pivot and view is a
re-aggregation of the cube, so over a materialized cube a dashboard refresh
or a cross-filter click never rescans trial rows; the cube's size is bounded by the product of the
dimension cardinalities, not by the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C
from ..session import checkpoint_dir

CUBE_DIMS = ("phase", "agency_class", "risk_band", "score_bin")

# view name -> (dimensions, measure kind)
VIEWS = {
    "score_bins": (("score_bin", "risk_band"), "count"),
    "phase": (("phase",), "avg_terminated"),
    "sponsor": (("agency_class",), "avg_terminated"),
    "bands": (("risk_band",), "count"),
}


def score_bin(score: str | Column = "risk_score", width: float = K.DASH_SCORE_BIN_WIDTH) -> Column:
    """Integer index of the ``width``-wide score bin: floor(score * (1/width))."""
    s = F.col(score) if isinstance(score, str) else score
    return F.floor(s * F.lit(round(1.0 / width))).cast("long")


def cube(scored: DataFrame, key: str = "nct_id", score: str = "risk_score",
         label: str = K.TARGET) -> DataFrame:
    """E19 base: additive cube over the dashboard dimensions. ``n`` counts
    non-null ids (as the BI view counts), ``terminated`` sums the label."""
    return (scored.groupBy("phase", "agency_class", "risk_band", score_bin(score).alias("score_bin"))
            .agg(F.count(key).alias("n"), F.sum(label).cast("long").alias("terminated")))


def materialized(cube_df: DataFrame) -> DataFrame:
    """The cube computed once (a reliable checkpoint; runs a job), so all views
    and selections read its few rows and trial rows are not scanned again."""
    checkpoint_dir(cube_df.sparkSession)
    return cube_df.checkpoint()


def rollup(cube_df: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Re-aggregate the cube to ``dims`` with count, terminated and rates."""
    return (cube_df.groupBy(*dims)
            .agg(F.sum("n").cast("long").alias("n"), F.sum("terminated").cast("long").alias("terminated"))
            .withColumn("avg_terminated", F.round(C.ratio("terminated", "n"), 6))
            .withColumn("termination_rate_pct", C.pct("terminated", "n")))


def pivot(cube_df: DataFrame, dim: str) -> DataFrame:
    """Trials, terminated and termination rate per value of ``dim``."""
    out = rollup(cube_df, [dim]).select(dim, F.col("n").alias("trials"), "terminated",
                                        "termination_rate_pct")
    if dim == "risk_band":
        return out.orderBy(C.band_order(dim))
    return out.orderBy(dim)


def view(cube_df: DataFrame, name: str, where: Column | None = None) -> DataFrame:
    """One dashboard view, optionally under a filter predicate."""
    dims, kind = VIEWS[name]
    src = cube_df.where(where) if where is not None else cube_df
    r = rollup(src, dims)
    if kind == "count":
        out = r.select(*dims, "n")
    else:
        out = r.select(*dims, "n", "avg_terminated")
    if name == "sponsor":
        return out.orderBy(F.desc("avg_terminated"), *dims)
    if name == "bands":
        return out.orderBy(C.band_order("risk_band"))
    return out.orderBy(*dims)


def dashboard_views(cube_df: DataFrame, selections: Mapping[str, Column] | None = None) -> dict[str, DataFrame]:
    """Every view filtered by the AND of the selections made in the
    *other* views (a view never filters itself)."""
    selections = dict(selections or {})
    out = {}
    for name in VIEWS:
        preds = [p for src, p in selections.items() if src != name]
        where = None
        for p in preds:
            where = p if where is None else (where & p)
        out[name] = view(cube_df, name, where)
    return out


def views_long(views: Mapping[str, DataFrame]) -> DataFrame:
    """All views in one frame: view, first and second dimension as text, n,
    and the average (NULL for count views)."""
    parts = []
    for name, df in views.items():
        dims, kind = VIEWS[name]
        d1 = F.col(dims[0]).cast("string")
        d2 = F.col(dims[1]).cast("string") if len(dims) > 1 else F.lit(None).cast("string")
        avg = F.col("avg_terminated") if kind != "count" else F.lit(None).cast("double")
        parts.append(df.select(F.lit(name).alias("view"), d1.alias("dim1"), d2.alias("dim2"),
                               "n", avg.alias("avg_terminated")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
