
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import audits as AU
from cohortlens.operators import bands as BA
from cohortlens.operators import cohort as CO
from cohortlens.operators import funnel as FU
from cohortlens.operators import master as MA
from cohortlens.operators import metrics as ME
from cohortlens.operators import rollups as RO
from cohortlens.operators import segments as SE
from cohortlens.operators import topk as TK
from micro import make_tables


@pytest.fixture(scope="module")
def t(spark):
    return make_tables(spark)


def by_id(df, key="nct_id"):
    return {r[key]: r for r in df.collect()}


def test_cohort_filter(t):
    ids = sorted(r.nct_id for r in CO.base_cohort(t.studies).collect())
    assert ids == ["T1", "T2", "T3", "T4"]   # RECRUITING, PHASE1, OBSERVATIONAL, NULL status out


def test_flags_and_phase_code(t):
    m = by_id(CO.base_cohort(t.studies))
    assert m["T2"].is_terminated == 1 and m["T1"].is_terminated == 0
    assert m["T3"].phase_numeric == 2.5 and m["T2"].phase_numeric == 3.0


def test_lead_sponsor_is_smallest_name(t):
    ls = by_id(RO.lead_sponsor(t.sponsors))
    assert ls["T1"].sponsor_name == "Alpha" and ls["T1"].agency_class == "NIH"
    assert "T2" not in ls                                   # collaborator only
    assert ls["T3"].agency_class is None                    # lead with NULL class


def test_site_summary_counts(t):
    s = by_id(RO.site_summary(t.facilities))
    assert (s["T1"].site_rows, s["T1"].site_count, s["T1"].country_count, s["T1"].is_multinational) == (2, 0, 0, 0)
    assert (s["T2"].country_count, s["T2"].is_multinational) == (1, 0)
    assert (s["T4"].country_count, s["T4"].is_multinational) == (2, 1)


def test_master_fills_sql_vs_pandas(t):
    sql = by_id(MA.master_trial(t, fill="sql"))
    pd_ = by_id(MA.master_trial(t, fill="pandas"))
    assert sql["T3"].site_count == 1 and sql["T3"].is_multinational == 0      # no facilities: SQL fill
    assert pd_["T3"].site_count is None and pd_["T3"].is_multinational is None  # pandas keeps NULL
    assert sql["T1"].site_count == 2 and pd_["T1"].site_count == 0            # rows vs non-null country
    assert sql["T2"].total_withdrawals == 3.0                                 # NULL counts skipped
    assert sql["T3"].total_withdrawals == 0.0                                 # no rows -> 0
    assert sql["T2"].duration_days == -31                                     # negative kept
    assert sql["T2"].duration_months == -1.0
    assert sql["T1"].enrollment_actual == 100.0 and sql["T2"].enrollment_actual is None
    assert sql["T1"].num_primary_outcomes == 1 and sql["T1"].has_outcomes_posted == 1
    assert pd_["T2"].num_outcomes_posted == 0 and sql["T2"].has_outcomes_posted == 1


def test_withdrawal_reasons_normalised_and_cohort_only(t):
    r = {x.withdrawal_reason: x for x in
         TK.withdrawal_reasons(t.drop_withdrawals, CO.cohort_ids(t.studies)).collect()}
    assert r["X"].total_count == 12.0 and r["X"].trials_affected == 1        # T9 excluded
    assert r["ADVERSE EVENT"].total_count == 200.0 and r["ADVERSE EVENT"].trials_affected == 2


def test_topk_tie_break_is_total(spark):
    rows = [(f"T{i:02d}", "W", float(i % 3)) for i in range(30)]
    wd = spark.createDataFrame(rows, "nct_id string, reason string, count double")
    wd = wd.withColumn("reason", F.concat(F.lit("R"), F.substring("nct_id", 2, 2)))
    ids = wd.select("nct_id")
    top = [r.withdrawal_reason for r in TK.withdrawal_reasons(wd, ids, k=15).collect()]
    assert len(top) == 15
    # all 2.0 rows first (10 of them), then 1.0 rows by name
    assert top[:10] == sorted(top[:10])


def test_funnel_independent_vs_nested(t):
    m = MA.master_trial(t)
    ind = FU.funnel_stages(m).first()
    nest = FU.funnel_stages(m, nested=True).first()
    assert ind.stage1_registered == 4 and ind.stage4_completed == 2
    vals = list(nest)
    assert all(a >= b for a, b in zip(vals, vals[1:]))


def test_empty_cohort_rates_are_null(t, spark):
    empty = t.replace(studies=t.studies.where(F.lit(False)))
    r = FU.funnel_with_rates(MA.master_trial(empty)).first()
    assert r.stage1_registered == 0 and r.stage2_pct_of_total is None
    k = SE.key_insights(MA.master_trial(empty)).first()
    assert k.n_trials == 0 and k.termination_rate_pct is None
    long = FU.funnel_long(MA.master_trial(empty)).collect()
    assert [x.conversion_pct for x in long][1:] == [0.0, 0.0, 0.0, 0.0]


def test_crosstab_and_class_balance(t):
    c = CO.filter_cohort(t.studies)
    ct = {r.phase: r for r in AU.phase_status_crosstab(c).collect()}
    assert ct["PHASE2"]["TERMINATED"] == 1 and ct["PHASE2"]["COMPLETED"] == 1
    assert ct["PHASE3"]["COMPLETED"] == 0 and ct["PHASE3"].termination_rate_pct == 100.0
    cb = {r.overall_status: r for r in AU.class_balance(c).collect()}
    assert cb["TERMINATED"].n == 2 and cb["TERMINATED"].pct == 50.0


def test_sponsor_distribution_keeps_duplicate_leads(t):
    d = {r.agency_class: r.n_trials for r in AU.sponsor_distribution(t.studies, t.sponsors).collect()}
    assert d == {"INDUSTRY": 1, "NIH": 1, "INDIV": 2}


def test_bands_right_closed(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.25, 0.5, 0.75, 1.0, 1.2, None, 0.2500001)],
                               "risk_score double")
    got = [(r.risk_score, r.risk_band) for r in BA.with_bands(df).collect()]
    assert got == [(0.0, None), (0.25, "Low"), (0.5, "Medium"), (0.75, "High"), (1.0, "Very High"),
                   (1.2, None), (None, None), (0.2500001, "Medium")]


def test_metrics_single_class_and_ties(spark):
    one = spark.createDataFrame([(0.1, 1, 0), (0.9, 1, 1)], "score double, label int, prediction int")
    assert ME.auc(one).first().auc is None
    ties = spark.createDataFrame([(0.5, 1, 1), (0.5, 0, 1)], "score double, label int, prediction int")
    assert ME.auc(ties).first().auc == 0.5
    assert ME.average_precision(ties).first().average_precision == 0.5


def test_median_fill(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0), (4, 10.0)], "id int, x double")
    got = {r.id: r.x for r in AU.median_fill(df, ["x"]).collect()}
    assert got[2] == 3.0


def test_high_risk_score(t):
    h = by_id(TK.high_risk_trials(MA.master_trial(t)))
    assert h["T4"].risk_flag_score == 3 + 0 + 1        # terminated, posted, >100 withdrawals
    assert h["T2"].risk_flag_score == 3 + 2 + 0
    assert h["T1"].risk_flag_score == 0


def test_reported_events_rollup_null_sum_is_zero(t):
    r = {(x.nct_id, x.event_type): x for x in RO.reported_events_rollup(t.reported_events).collect()}
    assert r[("T1", "serious")].total_affected == 1.0 and r[("T1", "other")].total_at_risk == 3.0


def test_metrics_on_empty_input(spark):
    empty = spark.createDataFrame([], "score double, label int, prediction int")
    assert ME.auc(empty).first().auc is None
    assert ME.average_precision(empty).first().average_precision is None
    assert ME.roc_points(empty).count() == 0
    assert ME.f1_macro(empty).first().f1_macro == 0.0


def test_exact_split_on_empty_and_tiny(spark):
    from cohortlens.operators import features as FE
    empty = spark.createDataFrame([], "nct_id long, is_terminated int")
    assert FE.with_exact_split(empty).count() == 0
    tiny = spark.createDataFrame([(i, i % 2) for i in range(7)], "nct_id long, is_terminated int")
    got = FE.with_exact_split(tiny).collect()
    assert sum(r.is_test for r in got) == 2          # ceil(0.2 * 7)


def test_attach_row_refuses_multi_row_frames(spark):
    from cohortlens.functions.frames import attach_row
    df = spark.range(5)
    one = df.agg(F.count(F.lit(1)).alias("n"))
    assert attach_row(df, one).count() == 5
    with pytest.raises(ValueError):
        attach_row(df, df.groupBy((F.col("id") % 2).alias("k")).count())
