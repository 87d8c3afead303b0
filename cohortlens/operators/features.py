"""Model features, the hash split and class weights.

All features are narrow projections of the master (no shuffle). Missing arms
and duration are left NULL by default so the median imputer is fitted on the
training rows only; ``mode='reference'`` reproduces the reference, which fills
them with medians over all rows before the split.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import columns as C
from ..functions.frames import attach_row
from .audits import median_fill

IMPUTED = ("number_of_arms", "duration_months")


def ml_features(master: DataFrame, mode: str = "train", key: str = "nct_id",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Id, the 11 features (in order), the target and ``keep``.

    Expects the pandas-fill master (site info NULL when absent)."""
    site = F.coalesce(F.col("site_count").cast("double"), F.lit(float(K.SITE_COUNT_DEFAULT)))
    out = master.select(
        key,
        F.coalesce("phase_numeric", F.lit(K.PHASE_NUMERIC_DEFAULT)).alias("phase_numeric"),
        C.log1p0("enrollment").alias("log_enrollment"),
        C.flag(F.col("enrollment_type") == F.lit(K.ENROLLMENT_ACTUAL)).alias("is_actual_enrollment"),
        F.col("duration_months").cast("double").alias("duration_months"),
        F.col("number_of_arms").cast("double").alias("number_of_arms"),
        C.sponsor_code().alias("sponsor_encoded"),
        F.log1p(site).alias("log_site_count"),
        F.coalesce(F.col("is_multinational"), F.lit(0)).cast("int").alias("is_multinational"),
        C.log1p0("total_withdrawals").alias("log_withdrawals"),
        F.coalesce(F.col("num_primary_outcomes").cast("double"), F.lit(0.0)).alias("num_primary_outcomes"),
        C.flag(F.coalesce(F.col("num_outcomes_posted"), F.lit(0)) > 0).alias("has_outcomes_posted"),
        F.col(K.TARGET).cast("int").alias(K.TARGET),
        *keep,
    )
    if mode == "reference":
        out = median_fill(out, list(IMPUTED))
    elif mode != "train":
        raise ValueError("mode must be 'train' or 'reference'")
    return out


def with_split(df: DataFrame, key: str = "nct_id", fraction: float = K.TEST_FRACTION,
               seed: int = K.SAMPLE_SEED) -> DataFrame:
    """M1: add ``is_test`` from the seeded hash of the id.

    No shuffle, no random state: the same rows are test rows at any
    partitioning and after a recompute; each class gets about ``fraction``."""
    return df.withColumn("is_test", C.in_test_split(key, fraction, seed).cast("int"))


def with_exact_split(df: DataFrame, key: str = "nct_id", label: str = K.TARGET,
                     fraction: float = K.TEST_FRACTION, seed: int = K.SAMPLE_SEED,
                     bucket_hex_digits: int = 4) -> DataFrame:
    """M1, exact-count mode: ``ceil(fraction * n)`` test rows, allocated to the
    classes in proportion (largest remainder, ties by class), each class taking
    its rows in hash order ``(md5('<seed>:' || id), id)``.

    Distributed: rows are counted per (class, hash bucket) -- at most
    ``classes x 16**digits`` rows, a bound fixed by construction -- which
    locates, per class, the one bucket where the test quota runs out; its rows
    are counted again by their next hash digits. Only rows of that second
    boundary bucket are ranked (about n / 16**(2 * digits) rows); every other
    row is decided by comparing buckets."""
    frac = F.lit(Decimal(str(fraction)))
    d = (df.withColumn("_h", C.hash_key(key, seed))
         .withColumn("_b", F.conv(F.substring("_h", 1, bucket_hex_digits), 16, 10).cast("int")))
    counts = d.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    cls = counts.groupBy(label).agg(F.sum("_n").alias("_nc"))
    # one row per class: the allocation needs the grand total next to each class
    w_all = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cls = (cls.withColumn("_ntot", F.sum("_nc").over(w_all))
           .withColumn("_ntest", F.ceil(F.col("_ntot") * frac).cast("long"))
           .withColumn("_base", F.floor(F.col("_ntest") * F.col("_nc") / F.col("_ntot")).cast("long"))
           .withColumn("_rem", (F.col("_ntest") * F.col("_nc")) % F.col("_ntot")))
    cls = (cls.withColumn("_extra", F.max("_ntest").over(w_all) - F.sum("_base").over(w_all))
           .withColumn("_rk", F.row_number().over(Window.orderBy(F.desc("_rem"), F.asc(label))))
           .select(label, (F.col("_base") + (F.col("_rk") <= F.col("_extra")).cast("long")).alias("_quota")))
    first = _boundary(counts, cls, label, "_b")
    d = d.join(F.broadcast(first.select(label, F.col("_bb").alias("_b1"), F.col("_need").alias("_n1"))), label, "left")
    d = d.withColumn("_c", F.conv(F.substring("_h", bucket_hex_digits + 1, bucket_hex_digits), 16, 10).cast("int"))
    edge_counts = (d.where(F.col("_b") == F.col("_b1")).groupBy(label, F.col("_c").alias("_b"))
                   .agg(F.count(F.lit(1)).alias("_n")))
    second = _boundary(edge_counts, first.select(label, F.col("_need").alias("_quota")), label, "_b")
    j = d.join(F.broadcast(second.select(label, F.col("_bb").alias("_b2"), F.col("_need").alias("_n2"))), label, "left")
    j = j.fillna({"_b1": -1, "_b2": -1, "_n2": 0})
    on_edge = (F.col("_b") == F.col("_b1")) & (F.col("_c") == F.col("_b2"))
    before = (F.col("_b") < F.col("_b1")) | ((F.col("_b") == F.col("_b1")) & (F.col("_c") < F.col("_b2")))
    clear = j.where(~on_edge).withColumn("is_test", before.cast("int"))
    w_edge = Window.partitionBy(label, "_b", "_c").orderBy("_h", key)
    edge = j.where(on_edge).withColumn("is_test", (F.row_number().over(w_edge) <= F.col("_n2")).cast("int"))
    return clear.unionByName(edge).drop("_h", "_b", "_c", "_b1", "_n1", "_b2", "_n2")


def _boundary(counts: DataFrame, quotas: DataFrame, label: str, bucket: str) -> DataFrame:
    """Per class (``_quota`` rows wanted): the bucket in which the running
    count reaches the quota, and how many rows of it are still wanted. Both
    inputs are bounded by construction."""
    w_cum = Window.partitionBy(label).orderBy(bucket)
    return (counts.join(F.broadcast(quotas), label)
            .withColumn("_incl", F.sum("_n").over(w_cum.rowsBetween(Window.unboundedPreceding, 0)))
            .where((F.col("_incl") >= F.col("_quota")) & (F.col("_quota") > 0))
            .groupBy(label)
            .agg(F.min(F.struct(F.col(bucket).alias("_b"), (F.col("_quota") - F.col("_incl") + F.col("_n")).alias("_need")))
                 .alias("_m"))
            .select(label, F.col("_m._b").alias("_bb"), F.col("_m._need").alias("_need")))


def split_counts(df: DataFrame, label: str = K.TARGET) -> DataFrame:
    """Rows per (split, class): the stratification check."""
    return df.groupBy("is_test", label).agg(F.count(F.lit(1)).alias("n"))


def class_weights(train: DataFrame, label: str = K.TARGET) -> DataFrame:
    """M3: per class ``n``, the balanced weight n_total / (2 * n_class) and the
    boosting weight (positives neg/pos, negatives 1)."""
    g = train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    tot = g.agg(F.sum("n").alias("_total"),
                F.sum(F.when(F.col(label) == 1, F.col("n"))).alias("_pos"),
                F.sum(F.when(F.col(label) == 0, F.col("n"))).alias("_neg"))
    return (attach_row(g, tot)
            .select(label, "n",
                    (F.col("_total").cast("double") / (F.lit(2.0) * F.col("n"))).alias("balanced_weight"),
                    F.when(F.col(label) == 1, F.col("_neg").cast("double") / F.nullif(F.col("_pos"), F.lit(0)))
                    .otherwise(F.lit(1.0)).alias("boost_weight")))


def with_weights(df: DataFrame, weights: DataFrame, which: str = "balanced_weight",
                 label: str = K.TARGET, out: str = "weight") -> DataFrame:
    """Attach a per-class weight column (the weight table has one row per
    class, so it is broadcast)."""
    w = weights.select(label, F.col(which).alias(out))
    return df.join(F.broadcast(w), label, "left")
