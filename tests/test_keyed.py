"""Reports from one scan, and ranking metrics and medians per key."""

import random
import re

import pytest
from pyspark.sql import functions as F

from cohortlens.adapters.fixtures import fixture_tables
from cohortlens.operators import audits as AU
from cohortlens.operators import cells as CE
from cohortlens.operators import cohort as CO
from cohortlens.operators import funnel as FU
from cohortlens.operators import master as MA
from cohortlens.operators import metrics as ME
from cohortlens.operators import quantiles as QU
from cohortlens.operators import segments as SE
from cohortlens.plans.reports import REPORTS, run_reports
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def master(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("m") / "master")
    MA.master_trial(fixture_tables(spark, SF_SMALL), fill="both").write.parquet(path)
    return spark.read.parquet(path)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_cells_give_the_reports(spark, master):
    cells = CE.report_cells(master).checkpoint()
    assert rows(CE.funnel_stages(cells)) == rows(FU.funnel_stages(master))
    assert rows(CE.funnel_with_rates(cells)) == rows(FU.funnel_with_rates(master))
    assert rows(CE.phase_segmentation(cells)) == rows(SE.phase_segmentation(master))
    for least in (None, 50):
        assert rows(CE.sponsor_segmentation(cells, least)) == rows(SE.sponsor_segmentation(master, least))
    assert rows(CE.results_compliance(cells)) == rows(SE.results_compliance(master))
    assert sorted(rows(CE.class_balance(cells))) == sorted(rows(AU.class_balance(master)))
    assert rows(CE.phase_status_crosstab(cells)) == rows(AU.phase_status_crosstab(master))


def test_cells_of_odd_masters(spark, master):
    """Null dimensions are groups of their own; no trials give no groups, and
    a funnel of zeros."""
    odd = master.select(*[F.when(F.col("nct_id") % 3 == 0, F.col(c)).alias(c) if c in ("phase", "overall_status",
                          "agency_class", "duration_months") else F.col(c) for c in master.columns])
    cells = CE.report_cells(odd).checkpoint()
    assert rows(CE.phase_segmentation(cells)) == rows(SE.phase_segmentation(odd))
    assert rows(CE.sponsor_segmentation(cells)) == rows(SE.sponsor_segmentation(odd))
    assert sorted(rows(CE.class_balance(cells)), key=str) == sorted(rows(AU.class_balance(odd)), key=str)
    none = CE.report_cells(master.limit(0)).checkpoint()
    assert rows(CE.funnel_with_rates(none)) == rows(FU.funnel_with_rates(master.limit(0)))
    assert rows(CE.phase_segmentation(none)) == rows(CE.class_balance(none)) == []


def test_cells_scan_the_master_once(spark, master):
    plan = CE.report_cells(master)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan", plan)) == 1 and len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "Python" not in plan


def test_reports_from_cells_keep_failures_apart(spark, master):
    cells = CE.report_cells(master).checkpoint()
    t = fixture_tables(spark, SF_SMALL)
    run = run_reports(t, master=master, cells=cells)
    assert not run.errors and set(run.frames) == set(REPORTS)
    for name in CE.CELL_REPORTS.keys() & REPORTS.keys():
        plan = run.frames[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "enrollment_actual" not in plan          # no column of the master itself
        assert rows(run.frames[name]) == rows(REPORTS[name](t, master))
    broken = run_reports(t, master=master, cells=cells.drop("completed"))
    assert set(broken.errors) == {"funnel_with_rates", "phase_segmentation"}
    own = run_reports(t, names=["phase_segmentation"], master=master, cells=cells,
                      reports={"phase_segmentation": lambda tb, m: m.select("nct_id")})
    assert own.frames["phase_segmentation"].columns == ["nct_id"]


def scored(spark, n, keys, seed):
    rng = random.Random(seed)
    data = [(rng.choice(keys), rng.randrange(20) / 7.0 * (1 + 50 * (i % 5 == 0)), int(rng.random() < 0.4), i % 2)
            for i in range(n)]
    return data, spark.createDataFrame(data, "k string, score double, label int, prediction int").repartition(5)


@pytest.mark.parametrize("buckets", (None, 1, 7))
def test_metrics_per_key_equal_those_of_the_key_alone(spark, monkeypatch, buckets):
    if buckets is None:
        monkeypatch.setattr(ME, "ROWS_PER_RANGE", 5)
    data, df = scored(spark, 400, ["a", "b", "c", None], 3)
    got = {r.k: (r.auc, r.average_precision) for r in ME.ranking_metrics(df, buckets=buckets, by=["k"]).collect()}
    f1 = {r.k: r.f1_macro for r in ME.f1_macro(df, by=["k"]).collect()}
    points = ME.roc_points(df, buckets=buckets, thin=True, by=["k"]).collect()
    assert set(got) == set(f1) == {"a", "b", "c", None}
    for k in got:
        pos = [s for x, s, y, _ in data if x == k and y]
        neg = [s for x, s, y, _ in data if x == k and not y]
        brute = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
        assert abs(got[k][0] - brute) < 1e-9
        one = df.where(F.col("k").eqNullSafe(F.lit(k)))
        alone = ME.ranking_metrics(one).first()
        assert got[k] == (alone.auc, alone.average_precision) and f1[k] == ME.f1_macro(one).first()[0]
        if k == "a":
            assert sorted(tuple(r)[1:] for r in points if r.k == k) == sorted(
                map(tuple, ME.roc_points(one, thin=True).collect()))


def test_a_key_without_a_class_has_no_auc(spark):
    df = spark.createDataFrame([("x", 0.1, 1), ("x", 0.2, 1), ("y", 0.5, 0), ("y", 0.6, 1), ("z", None, 1)],
                               "k string, score double, label int")
    assert {r.k: r.auc for r in ME.auc(df, by=["k"]).collect()} == {"x": None, "y": 1.0}
    assert ME.auc(df.limit(0), by=["k"]).count() == 0


def test_cuts_of_all_keys_bound_every_range(spark, monkeypatch):
    """Two keys on different scales: neither falls into one range."""
    monkeypatch.setattr(ME, "ROWS_PER_RANGE", 100)
    df = spark.range(2000).select((F.col("id") % 2).alias("k"),
                                  F.when(F.col("id") % 2 == 0, F.col("id") / 1e6).otherwise(F.col("id") * 1e3).alias("score"),
                                  F.lit(1).alias("label"))
    groups = ME.score_groups(df, by=["k"])
    cuts = ME._cut_points(groups, None, by=["k"])
    import bisect
    sizes = {}
    for r in groups.collect():
        b = r.k, bisect.bisect_right(cuts, r.score)
        sizes[b] = sizes.get(b, 0) + 1
    assert max(sizes.values()) <= 200 and len(sizes) >= 20


def test_medians_of_many_columns_take_one_pass(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ME, "ROWS_PER_RANGE", 20)
    rng = random.Random(8)
    data = [(rng.randrange(90), rng.random() * 1000 if i % 3 else None, None, float(i % 2)) for i in range(301)]
    df = spark.createDataFrame(data, "a int, b double, c double, d double")
    calls = []
    real = type(df).checkpoint
    monkeypatch.setattr(type(df), "checkpoint", lambda self, *a, **k: calls.append(1) or real(self, *a, **k))
    got = QU.exact_medians(df, ["a", "b", "c", "d"], prefix="m_").first()
    want = df.agg(*[F.median(c).alias(c) for c in "abcd"]).first()
    assert tuple(got) == tuple(want) and got.__fields__ == ["m_a", "m_b", "m_c", "m_d"] and len(calls) == 1
    assert tuple(QU.exact_medians(df.limit(0), ["a", "b"]).first()) == (None, None)
