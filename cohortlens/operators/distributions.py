"""Plot-ready distributions (the frames behind the charts).

Histograms publish integer bin indices (no float bin labels) from one
grouped count; the scatter sample is a seeded, hash-ordered top-n, the same
at any partitioning and after recompute.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C


def histogram(df: DataFrame, col: str, width: float, by: str | None = None,
              lo: float | None = None, hi: float | None = None,
              lo_open: bool = True) -> DataFrame:
    """Counts per ``floor(x / width)`` bin (and per ``by``) over lo < x < hi."""
    x = F.col(col)
    cond = x.isNotNull()
    if lo is not None:
        cond = cond & ((x > F.lit(lo)) if lo_open else (x >= F.lit(lo)))
    if hi is not None:
        cond = cond & (x < F.lit(hi))
    keys = [C.bin_index(x, width).alias("bin_index")] + ([F.col(by)] if by else [])
    return (df.where(cond).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .withColumn("bin_start", F.round(F.col("bin_index") * F.lit(width), 6)))


def enrollment_histogram(master: DataFrame, hi: float = K.ENROLLMENT_HIST_MAX,
                         bins: int = K.ENROLLMENT_HIST_BINS) -> DataFrame:
    """Actual enrollment in (0, 1000) by status, 50 bins of width 20."""
    return histogram(master, "enrollment_actual", hi / bins, by="overall_status", lo=0, hi=hi)


def duration_scatter_sample(master: DataFrame, n: int = K.SCATTER_SAMPLE_SIZE,
                            seed: int = K.SAMPLE_SEED, hi: float = K.DURATION_SCATTER_MAX,
                            key: str = "nct_id") -> DataFrame:
    """E17 (B18 + B20): duration vs withdrawals for at most ``n`` trials with
    0 < duration < 300 months, chosen by the seeded hash of the id.

    The cap applies after the range filter (the reference sized it on the
    unfiltered frame). ``orderBy + limit`` runs as TakeOrderedAndProject."""
    d = F.col("duration_months")
    return (master.where(d.isNotNull() & (d > 0) & (d < F.lit(hi)))
            .select(key, "duration_months", "total_withdrawals", "overall_status",
                    C.hash_key(key, seed).alias("_h"))
            .orderBy("_h", key).limit(n).drop("_h"))


def risk_score_histogram(scored: DataFrame, score: str = "risk_score", label: str = "is_terminated",
                         bins: int = K.RISK_HIST_BINS) -> DataFrame:
    """Score histogram by outcome, ``bins`` bins over [0, 1] (1.0 joins the
    last bin)."""
    s = F.col(score)
    idx = F.least(F.floor(s * F.lit(bins)), F.lit(bins - 1)).cast("long")
    return (scored.where(s.isNotNull())
            .groupBy(idx.alias("bin_index"), F.col(label))
            .agg(F.count(F.lit(1)).alias("n")))
