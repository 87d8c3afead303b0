"""Plan-shape tests: the physical plans we want, asserted from explain()."""

import pytest

import __spark_entry__ as E
from cohortlens.adapters.catalog import ORACLE_SQL
from cohortlens.adapters.fixtures import fixture_tables
from cohortlens.operators import cohort as CO
from cohortlens.operators import master as MA
from cohortlens.operators import topk as TK
from cohortlens.sources.sinks import write_parquet
from conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_topk_is_take_ordered(spark):
    t = fixture_tables(spark, SF_SMALL)
    assert "TakeOrderedAndProject" in plan(TK.high_risk_trials(MA.master_trial(t)))
    assert "TakeOrderedAndProject" in plan(TK.withdrawal_reasons(t.drop_withdrawals, CO.cohort_ids(t.studies)))


def test_cohort_filter_pushed_to_parquet(spark, tmp_path):
    t = fixture_tables(spark, SF_SMALL)
    p = str(tmp_path / "studies")
    write_parquet(t.studies, p)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    df = CO.base_cohort(spark.read.parquet(p))
    txt = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in txt and "EqualTo(study_type,INTERVENTIONAL)" in txt
    assert "In(phase" in txt and "In(overall_status" in txt


def test_semi_join_is_left_semi(spark):
    t = fixture_tables(spark, SF_SMALL)
    red = CO.semi_reduce(t.facilities, CO.cohort_ids(t.studies))
    assert "LeftSemi" in plan(red)


def test_column_pruning_reaches_scan(spark):
    t = fixture_tables(spark, SF_SMALL)
    txt = plan(CO.cohort_ids(t.studies))
    # the orders scan reads only the columns the cohort needs
    scan = [l for l in txt.splitlines() if "FileScan parquet" in l and "o_orderkey" in l][0]
    assert "o_totalprice" not in scan


@pytest.mark.parametrize("name", sorted(set(ORACLE_SQL)))
def test_no_python_udf_in_any_query(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    p = plan(df)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_cohort_restriction_by_threshold(spark, threshold):
    """The left-semi restriction is pushed below the pre-aggregation only where
    the id side can be broadcast (no key is shuffled then); otherwise it stays
    above and joins rows that are already one per key."""
    from cohortlens.operators import audits as AU
    t = fixture_tables(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        for df in (TK.withdrawal_reasons(t.drop_withdrawals, CO.cohort_ids(t.studies)),
                   AU.sponsor_distribution(t.studies, t.sponsors)):
            lines = _optimized(df).splitlines()
            semi = next(i for i, x in enumerate(lines) if "LeftSemi" in x)
            below = [x for x in lines[semi + 1:] if "Aggregate" in x]
            if threshold == "-1":
                assert below, lines
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _scans(df, column):
    # reads of a driver table, told apart by a column only it has
    return sum("Relation [" in x and column in x for x in _optimized(df).splitlines())


def test_audits_scan_each_child_once(spark):
    """One scan per child table: eight children, five of them over lineitem
    rows plus the two that join it, and no second pass for the cohort counts."""
    from cohortlens.operators import audits as AU
    t = fixture_tables(spark, SF_SMALL)
    children = [df for _, df in t.children()]
    once = sum(_scans(df, "l_orderkey") for df in children)
    ids = _scans(CO.cohort_ids(t.studies), "l_orderkey")
    assert _scans(CO.semi_child_counts(t), "l_orderkey") <= once + ids
    studies = _scans(t.studies, "l_orderkey")
    assert _scans(AU.row_count_audit(t), "l_orderkey") <= once + ids + studies


def test_insights_and_cross_filter_compute_their_input_once(spark):
    for name in ("key_insights", "dash_cross_filter"):
        txt = _optimized(E.queries()[name](spark, SF_SMALL))
        assert "Relation [" not in txt, name      # everything reads the checkpoint


def test_replaced_table_gives_the_new_answer(spark, tmp_path):
    import shutil
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        shutil.copy(f"{SF_SMALL}/{name}.parquet", tmp_path / f"{name}.parquet")
    before = E.queries()["cohort"](spark, str(tmp_path)).count()
    fewer = spark.read.parquet(f"{SF_SMALL}/orders.parquet").where("o_orderkey % 2 = 0")
    fewer.write.parquet(str(tmp_path / "new"))
    (tmp_path / "orders.parquet").unlink()
    (tmp_path / "new").rename(tmp_path / "orders.parquet")
    spark.catalog.clearCache()
    after = E.queries()["cohort"](spark, str(tmp_path)).count()
    assert 0 < after < before


@pytest.mark.parametrize("name", ["key_insights", "enrollment_stats", "median_fill", "metric_auc", "roc_points"])
def test_no_single_reducer_sketch_or_map_merge(spark, name):
    """Medians and metric cut points avoid global percentile/sketch buffers,
    which merge every task's map in one reducer."""
    df = E.queries()[name](spark, SF_SMALL)
    p = df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "percentile" not in p and "median(" not in p


def test_library_has_no_local_checkpoint_or_local_paths():
    import pathlib
    root = pathlib.Path(__file__).resolve().parents[1] / "cohortlens"
    for f in root.rglob("*.py"):
        src = f.read_text()
        assert "localCheckpoint" not in src, f
        assert "/tmp/" not in src, f
