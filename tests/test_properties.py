"""Property tests: metrics against brute force, invariants of the reports."""

import numpy as np
from hypothesis import HealthCheck, Phase, given, settings, strategies as st
from pyspark.sql import functions as F

from cohortlens.operators import bands as BA
from cohortlens.operators import funnel as FU
from cohortlens.operators import master as MA
from cohortlens.operators import metrics as ME
from cohortlens.operators import segments as SE
from cohortlens.adapters.fixtures import fixture_tables
from conftest import SF_SMALL


def brute_auc(s, y):
    s, y = np.asarray(s, float), np.asarray(y)
    pos, neg = s[y == 1], s[y == 0]
    if len(pos) == 0 or len(neg) == 0:
        return None
    gt = (pos[:, None] > neg[None, :]).sum()
    eq = (pos[:, None] == neg[None, :]).sum()
    return (gt + 0.5 * eq) / (len(pos) * len(neg))


def brute_ap(s, y):
    s, y = np.asarray(s, float), np.asarray(y)
    P = (y == 1).sum()
    ap, prev_r = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        tp = ((s >= t) & (y == 1)).sum()
        fp = ((s >= t) & (y == 0)).sum()
        r = tp / P
        ap += (r - prev_r) * (tp / (tp + fp))
        prev_r = r
    return ap


pairs = st.lists(st.tuples(st.integers(0, 20).map(lambda i: i / 20), st.integers(0, 1)),
                 min_size=2, max_size=60).filter(lambda xs: len({y for _, y in xs}) == 2)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture],
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(pairs, st.sampled_from([1, 3, 1024]))
def test_auc_ap_match_brute_force(spark, xs, buckets):
    df = spark.createDataFrame([(s, y) for s, y in xs], "score double, label int")
    s, y = zip(*xs)
    assert abs(ME.auc(df, buckets=buckets, places=None).first().auc - brute_auc(s, y)) < 1e-12
    ap = ME.average_precision(df, buckets=buckets, places=None).first().average_precision
    assert abs(ap - brute_ap(s, y)) < 1e-12
    neg = df.select((-F.col("score")).alias("score"), "label")
    assert abs(ME.auc(neg, places=None).first().auc - (1 - brute_auc(s, y))) < 1e-12


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture],
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(st.lists(st.floats(-0.5, 1.5, allow_nan=False), min_size=1, max_size=40))
def test_bands_partition_unit_interval(spark, xs):
    df = BA.with_bands(spark.createDataFrame([(x,) for x in xs], "risk_score double"))
    for r in df.collect():
        assert (r.risk_band is not None) == (0 < r.risk_score <= 1)


def test_roc_points_monotone(spark):
    rng = np.random.default_rng(0)
    rows = [(float(rng.integers(0, 50)) / 50, int(rng.integers(0, 2))) for _ in range(500)]
    df = spark.createDataFrame(rows, "score double, label int")
    pts = sorted(ME.roc_points(df, buckets=8).collect(), key=lambda r: -r.threshold)
    fpr = [p.fpr for p in pts]
    tpr = [p.tpr for p in pts]
    assert fpr == sorted(fpr) and tpr == sorted(tpr) and fpr[-1] == 1.0 and tpr[-1] == 1.0


def test_reports_invariants_and_repartition(spark):
    t = fixture_tables(spark, SF_SMALL)
    m = MA.master_trial(t).cache()
    n = m.count()
    nested = list(FU.funnel_stages(m, nested=True).first())
    assert nested[0] == n and all(a >= b for a, b in zip(nested, nested[1:]))
    seg = SE.phase_segmentation(m).collect()
    assert sum(r.total_trials for r in seg) == n
    a = sorted(map(tuple, SE.phase_segmentation(m.repartition(1)).collect()))
    b = sorted(map(tuple, SE.phase_segmentation(m.repartition(7, "phase")).collect()))
    assert a == b
    m.unpersist()


def sklearn_like_thinned(s, y):
    """Distinct thresholds kept by a drop-intermediate ROC, computed directly."""
    s, y = np.asarray(s, float), np.asarray(y)
    ts = sorted(set(s), reverse=True)
    tps = np.array([((s >= t) & (y == 1)).sum() for t in ts])
    fps = np.array([((s >= t) & (y == 0)).sum() for t in ts])
    keep = np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True]
    return sorted(t for t, k in zip(ts, keep) if k)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture],
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(pairs, st.sampled_from([1, 2, 5, 1024]))
def test_thinned_roc_matches_direct(spark, xs, buckets):
    df = spark.createDataFrame([(s, y) for s, y in xs], "score double, label int")
    got = sorted(r.threshold for r in ME.roc_points(df, buckets=buckets, thin=True).collect())
    s, y = zip(*xs)
    assert got == sklearn_like_thinned(s, y)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture],
          phases=[Phase.explicit, Phase.reuse, Phase.generate])
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50).map(lambda i: i / 4)), min_size=0, max_size=50),
       st.sampled_from([1, 3, 1024]))
def test_exact_median_matches_percentile(spark, xs, buckets):
    from cohortlens.operators.quantiles import exact_median
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = exact_median(df, "x", buckets=buckets).first().x
    want = df.agg(F.median("x")).first()[0]
    assert got == want


def test_metrics_exact_when_cut_points_are_sampled(spark):
    """2,000 distinct scores over 8 ranges: cut points come from a sample
    (more than 32 values per range); results must still be exact."""
    rng = np.random.default_rng(3)
    s = rng.random(2000).round(6)
    y = (rng.random(2000) < s).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "score double, label int")
    assert abs(ME.auc(df, buckets=8, places=None).first().auc - brute_auc(s, y)) < 1e-12
    assert abs(ME.average_precision(df, buckets=8, places=None).first().average_precision
               - brute_ap(s, y)) < 1e-12
    from cohortlens.operators.quantiles import exact_median
    assert exact_median(df, "score", buckets=8).first().score == df.agg(F.median("score")).first()[0]


def test_topk_sample_and_split_independent_of_partitioning(spark):
    from cohortlens.operators import cohort as CO
    from cohortlens.operators import distributions as DI
    from cohortlens.operators import features as FE
    from cohortlens.operators import topk as TK
    t = fixture_tables(spark, SF_SMALL)
    m = MA.master_trial(t).cache()
    fm = MA.master_funnel(t).cache()

    def answers(parts):
        mm, ff = m.repartition(parts), fm.repartition(parts)
        wd = t.drop_withdrawals.repartition(parts)
        return (
            [tuple(r) for r in TK.high_risk_trials(mm).collect()],
            [tuple(r) for r in TK.withdrawal_reasons(wd, CO.cohort_ids(t.studies)).collect()],
            sorted(tuple(r) for r in DI.duration_scatter_sample(mm).collect()),
            sorted(r.nct_id for r in FE.with_exact_split(FE.ml_features(ff)).where("is_test = 1").collect()),
        )

    assert answers(1) == answers(7)
    m.unpersist()
    fm.unpersist()
