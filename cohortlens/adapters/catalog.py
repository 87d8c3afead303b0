"""Query registry over the fixture tables: key -> (spark, sf_dir) -> DataFrame.

Each callable builds its plan from the whole driver tables in ``sf_dir``.
The matching DuckDB SQL lives in ``oracle.QUERIES`` under the same key.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions import columns as C
from ..operators import audits as AU
from ..operators import bands as BA
from ..operators import cells as CE
from ..operators import cohort as CO
from ..operators import dashboard as DB
from ..operators import distributions as DI
from ..operators import features as FE
from ..operators import funnel as FU
from ..operators import master as MA
from ..operators import metrics as ME
from ..operators import quantiles as QU
from ..operators import rollups as RO
from ..operators import segments as SE
from ..operators import topk as TK
from ..session import checkpoint_dir
from ..sources.delimited import parse_delimited, read_delimited
from ..sources.sinks import read_scored_csv, write_csv
from . import oracle
from .fixtures import fixture_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _t(spark, d):
    return fixture_tables(spark, d)


def _m(spark, d, fill="sql"):
    return MA.master_trial(_t(spark, d), fill=fill)


def _scratch(spark, name):
    """A new folder that driver and executors share."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- cohort, rollups, master -------------------------------------------------
register("cohort")(lambda s, d: CO.base_cohort(_t(s, d).studies))
register("lead_sponsor")(lambda s, d: RO.lead_sponsor(_t(s, d).sponsors))
register("site_summary")(lambda s, d: RO.site_summary(_t(s, d).facilities))
register("reported_events_rollup")(lambda s, d: RO.reported_events_rollup(_t(s, d).reported_events))
register("withdrawal_summary")(lambda s, d: RO.withdrawal_summary(_t(s, d).drop_withdrawals))
register("outcome_summary")(lambda s, d: RO.outcome_summary(_t(s, d).outcomes))
register("semi_child_counts")(lambda s, d: CO.semi_child_counts(_t(s, d)))
register("master_trial")(lambda s, d: MA.master_trial_sql(_t(s, d)))
register("master_funnel")(lambda s, d: MA.master_funnel(_t(s, d)))
register("trial_duration")(lambda s, d: _m(s, d).select(
    "nct_id", "start_date", "completion_date", "duration_days", "duration_months"))

# --- funnel, segments, top-k --------------------------------------------------
register("funnel_stages")(lambda s, d: FU.funnel_stages(_m(s, d)))
register("funnel_stages_nested")(lambda s, d: FU.funnel_stages(_m(s, d), nested=True))
register("funnel_with_rates")(lambda s, d: FU.funnel_with_rates(_m(s, d)))
register("funnel_long")(lambda s, d: FU.funnel_long(_m(s, d)))
register("phase_segmentation")(lambda s, d: SE.phase_segmentation(_m(s, d)))
register("sponsor_segmentation")(lambda s, d: SE.sponsor_segmentation(_m(s, d)))
register("sponsor_segmentation_min50")(lambda s, d: SE.sponsor_segmentation(_m(s, d), min_trials=50))
register("results_compliance")(lambda s, d: SE.results_compliance(_m(s, d)))
register("key_insights")(lambda s, d: SE.key_insights(_m(s, d)))
for _name, _report in CE.CELL_REPORTS.items():     # the same reports from one scan of the master
    register(f"{_name}_one_scan")(lambda s, d, f=_report: f(CE.report_cells(_m(s, d))))
register("withdrawal_reasons")(lambda s, d: (lambda t: TK.withdrawal_reasons(
    t.drop_withdrawals, CO.cohort_ids(t.studies)))(_t(s, d)))
register("high_risk_trials")(lambda s, d: TK.high_risk_trials(_m(s, d)))


# --- audits, distributions, coercions ---------------------------------------
register("class_balance")(lambda s, d: AU.class_balance(CO.filter_cohort(_t(s, d).studies)))
register("class_balance_target")(lambda s, d: AU.class_balance(_m(s, d, "pandas"), by=K.TARGET))
register("null_audit")(lambda s, d: AU.null_audit(CO.filter_cohort(_t(s, d).studies)))
register("phase_status_crosstab")(lambda s, d: AU.phase_status_crosstab(CO.filter_cohort(_t(s, d).studies)))
register("sponsor_distribution")(lambda s, d: (lambda t: AU.sponsor_distribution(t.studies, t.sponsors))(_t(s, d)))
register("enrollment_stats")(lambda s, d: AU.enrollment_stats(CO.filter_cohort(_t(s, d).studies)))
register("row_count_audit")(lambda s, d: AU.row_count_audit(_t(s, d)))
register("median_fill")(lambda s, d: AU.median_fill(
    _m(s, d).select("nct_id", "number_of_arms", "duration_months"), ["number_of_arms", "duration_months"]))
register("enrollment_histogram")(lambda s, d: DI.enrollment_histogram(_m(s, d)))
register("duration_scatter_sample")(lambda s, d: DI.duration_scatter_sample(_m(s, d)))
TEXT_COLUMNS = ("overall_status", "phase", "enrollment_type", "study_type", "why_stopped", "has_expanded_access")


@register("na_tokens")
def _na_tokens(s, d):
    """A2 over the studies with a missing-value token planted in one column
    after the other, in every 7th trial."""
    st = _t(s, d).studies
    tokens = F.lit(list(K.NA_TOKENS))
    planted = [F.when(F.pmod("nct_id", F.lit(7)) == i, F.element_at(
        tokens, (F.pmod("nct_id", F.lit(len(K.NA_TOKENS))) + 1).cast("int"))).otherwise(F.col(c)).alias(c)
        for i, c in enumerate(TEXT_COLUMNS)]
    return AU.na_token_audit(st.select("nct_id", *planted), columns=list(TEXT_COLUMNS))


DELIMITED_SCHEMA = T.StructType([
    T.StructField("nct_id", T.LongType()), T.StructField("start_date", T.DateType()),
    T.StructField("enrollment", T.DoubleType()), T.StructField("brief_title", T.StringType()),
    T.StructField("why_stopped", T.StringType()), T.StructField("phase", T.StringType())])


@register("delimited_by_name")
def _delimited_by_name(s, d):
    """A1: the studies rendered as delimited records, columns reordered, with
    an extra column of quoted pipes, quotes and line breaks and with planted
    missing tokens, then parsed by the reader's own code."""
    st = _t(s, d).studies
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    fields = {
        "id": F.monotonically_increasing_id().cast("string"),
        "brief_title": quoted(F.concat_ws("", F.lit('a|"b"'), F.lit("\n"), F.col("nct_id").cast("string"))),
        "why_stopped": F.when(F.col("nct_id") % 5 == 0, F.lit("N/A")).otherwise(
            quoted(F.concat(F.lit("x|"), F.col("why_stopped")))),
        "phase": F.col("phase"), "nct_id": F.col("nct_id").cast("string"),
        "enrollment": F.when(F.col("nct_id") % 6 == 0, F.lit("many")).otherwise(F.col("enrollment").cast("string")),
        "start_date": F.col("start_date").cast("string")}
    lines = st.select(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in fields.values()]).alias("line"))
    return parse_delimited(lines, list(fields), DELIMITED_SCHEMA)


@register("delimited_files")
def _delimited_files(s, d):
    """A1 from files: the same columns written as a pipe-delimited export, the
    quoted ones with pipes, quotes and line breaks, then read by the file
    reader, which has to find where records begin in every split."""
    st = _t(s, d).studies
    folder = _scratch(s, "export")
    st.select(
        F.col("nct_id").cast("string").alias("id"),
        F.concat_ws("", F.lit('a|"b"'), F.lit("\n"), F.col("nct_id").cast("string")).alias("brief_title"),
        F.when(F.col("nct_id") % 5 == 0, F.lit("N/A")).otherwise(F.concat(F.lit("x|"), F.col("why_stopped")))
        .alias("why_stopped"),
        "phase", "nct_id",
        F.when(F.col("nct_id") % 6 == 0, F.lit("many")).otherwise(F.col("enrollment").cast("string")).alias("enrollment"),
        F.col("start_date").cast("string").alias("start_date"),
    ).write.option("header", True).option("sep", "|").option("quote", '"').option("escape", '"').csv(folder)
    return read_delimited(s, folder, DELIMITED_SCHEMA)


@register("date_coerce")
def _date_coerce(s, d):
    """B4 over text dates: the start date rendered as text, with an invalid
    month planted in every 29th trial, coerced back (bad text -> NULL)."""
    st = _t(s, d).studies
    txt = F.when(F.col("nct_id") % 29 == 0, F.lit("2020-13-01")).otherwise(
        F.date_format("start_date", "yyyy-MM-dd"))
    return (st.select("nct_id", txt.alias("start_date_text"))
            .select("nct_id", "start_date_text", C.coerce_date("start_date_text").alias("start_date")))


# --- features, split, weights ------------------------------------------------
def _features(s, d):
    return FE.with_split(FE.ml_features(_m(s, d, "pandas")))


LOG_FEATURES = ("log_enrollment", "log_site_count", "log_withdrawals")


@register("ml_features")
def _ml_features(s, d):
    f = FE.ml_features(_m(s, d, "pandas"))
    return f.select(*[F.round(c, 9).alias(c) if c in LOG_FEATURES else F.col(c) for c in f.columns])


register("split_counts")(lambda s, d: FE.split_counts(_features(s, d)))
register("split_counts_exact")(lambda s, d: FE.split_counts(
    FE.with_exact_split(FE.ml_features(_m(s, d, "pandas")))))
register("class_weights")(lambda s, d: FE.class_weights(_features(s, d).where(F.col("is_test") == 0)).select(
    K.TARGET, "n", F.round("balanced_weight", 9).alias("balanced_weight"),
    F.round("boost_weight", 9).alias("boost_weight")))


# --- deterministic pseudo-score: metrics, bands, dashboard -----------------
SCORED_COLUMNS = ("nct_id", "overall_status", "is_terminated", "phase", "agency_class", "enrollment",
                  "duration_months", "site_count", "total_withdrawals", "risk_score", "risk_band")


def pseudo_score(id_col: str = "nct_id", label: str = "is_terminated"):
    """Deterministic test score: ``s = (id*7919 % 1000)/1000``; positives -> (s+1)/2."""
    s = (F.col(id_col).cast("long") * F.lit(7919) % F.lit(1000)).cast("double") / F.lit(1000.0)
    return F.when(F.col(label) == F.lit(1), (s + F.lit(1.0)) / F.lit(2.0)).otherwise(s)


def pseudo_scored(s, d):
    """The scored table with the deterministic pseudo-score in place of a
    model's probability (FIXTURES.md §4), plus ``is_test`` and ``prediction``."""
    m = _m(s, d, "pandas")
    sc = m.select("nct_id", "overall_status", "is_terminated", "phase", "agency_class", "enrollment",
                  "duration_months", F.col("site_count").cast("double").alias("site_count"),
                  "total_withdrawals", pseudo_score().alias("risk_score"))
    sc = BA.with_bands(sc)
    return FE.with_split(sc).withColumn("prediction", (F.col("risk_score") >= 0.5).cast("int"))


def _lab(s, d):
    return pseudo_scored(s, d).select(F.col("risk_score").alias("score"),
                                      F.col("is_terminated").alias("label"), "prediction")


register("metric_auc")(lambda s, d: ME.auc(_lab(s, d)))
register("metric_avg_precision")(lambda s, d: ME.average_precision(_lab(s, d)))


def _lab_by_phase(s, d):
    return pseudo_scored(s, d).select("phase", F.col("risk_score").alias("score"),
                                      F.col("is_terminated").alias("label"), "prediction")


register("metrics_by_phase")(lambda s, d: ME.ranking_metrics(_lab_by_phase(s, d), by=["phase"]))
register("roc_points_by_phase")(lambda s, d: ME.roc_points(_lab_by_phase(s, d), by=["phase"]))
register("metric_f1_macro")(lambda s, d: ME.f1_macro(_lab(s, d)))
register("roc_points")(lambda s, d: ME.roc_points(_lab(s, d)))
register("roc_points_thinned")(lambda s, d: ME.roc_points(_lab(s, d), thin=True))
register("classification_report")(lambda s, d: ME.classification_report(_lab(s, d)))
register("risk_bands")(lambda s, d: pseudo_scored(s, d).select("nct_id", "risk_score", "risk_band",
                                                               "risk_band_ord"))
register("risk_band_summary")(lambda s, d: BA.band_summary(
    BA.with_bands(pseudo_scored(s, d).drop("risk_band", "risk_band_ord"), labels=K.BAND_LABELS_LONG),
    by=["is_test"]))
register("risk_score_histogram")(lambda s, d: DI.risk_score_histogram(pseudo_scored(s, d)))


def _cube(s, d):
    return DB.cube(pseudo_scored(s, d).select(*SCORED_COLUMNS))


register("pivot_phase")(lambda s, d: DB.pivot(_cube(s, d), "phase"))
register("pivot_sponsor")(lambda s, d: DB.pivot(_cube(s, d), "agency_class"))
register("pivot_risk_band")(lambda s, d: DB.pivot(_cube(s, d), "risk_band"))
register("dash_score_bins")(lambda s, d: DB.view(_cube(s, d), "score_bins"))
register("dash_phase")(lambda s, d: DB.view(_cube(s, d), "phase"))
register("dash_sponsor")(lambda s, d: DB.view(_cube(s, d), "sponsor"))
register("dash_bands")(lambda s, d: DB.view(_cube(s, d), "bands"))
register("dash_cross_filter")(lambda s, d: DB.views_long(DB.dashboard_views(
    DB.materialized(_cube(s, d)), {"sponsor": F.col("agency_class") == "OTHER"})))


@register("cube_from_batches")
def _cube_from_batches(s, d):
    """E18-E20 kept up to date: the scored trials in three batches, the second
    delivered twice and the first two compacted before the third comes."""
    from ..plans.cube_store import CubeStore
    store = CubeStore(s, _scratch(s, "cube"))
    scored = pseudo_scored(s, d).select(*SCORED_COLUMNS)
    batch = lambda k: scored.where(F.pmod("nct_id", F.lit(3)) == k)
    for k in (0, 1, 1):
        store.add(k, batch(k))
    store.compact()
    store.add(2, batch(2))
    return store.cube()


@register("null_audit_written")
def _null_audit_written(s, d):
    """E11 of the written cohort, from the footers of its files."""
    path = _scratch(s, "cohort")
    CO.filter_cohort(_t(s, d).studies).write.parquet(path)
    return AU.null_audit_written(s, path)


# --- tables and reports through files ----------------------------------------
@register("bucketed_master")
def _bucketed_master(s, d):
    """A4: the master over bucketed tables and the side tables of hot trials,
    read by their manifest."""
    from ..plans.ingest import ingest_bucketed, read_bucketed
    folder = _scratch(s, "bucketed")
    ingest_bucketed(_t(s, d), folder, buckets=8, prefix=f"k{uuid.uuid4().hex[:8]}_")
    return read_bucketed(s, folder).per_trial(MA.master_trial_sql)


@register("scored_csv")
def _scored_csv(s, d):
    """The scored table written as CSV and read back with its types."""
    folder = _scratch(s, "scored")
    write_csv(pseudo_scored(s, d).select(*SCORED_COLUMNS), folder)
    return read_scored_csv(s, folder, id_type=T.LongType())


@register("report_files")
def _report_files(s, d):
    """Every report of the runner, one of them broken, written and counted
    from its files."""
    from ..plans.reports import REPORTS, run_reports, write_reports
    reports = {**REPORTS, "broken": lambda t, m: m.select("no_such_column")}
    run = write_reports(run_reports(_t(s, d), reports=reports), _scratch(s, "reports"), fmt="parquet")
    rows = [(n, s.read.parquet(run.written[n]).count() if n in run.written else None, n in run.errors) for n in reports]
    return s.createDataFrame(rows, "report string, n_rows long, failed boolean")


register("tolerant_projection")(lambda s, d: MA.pick_columns(
    _m(s, d), ["phase", "no_such_column", "nct_id", "agency_class", "minimum_age"]))


# --- model training and scoring (rows-only checks: learners are not SQL) ----
# The library's default settings, on all rows.
def _prepared(s, d):
    from ..plans import models as MO
    return MO.prepare(_m(s, d, "pandas"))


@register("model_comparison")
def _model_comparison(s, d):
    from ..plans import models as MO
    res = MO.train_and_compare(_prepared(s, d))
    return res.comparison.withColumn("is_best", (F.col("model") == F.lit(res.best)).cast("int"))


@register("boost_root_splits")
def _boost_root_splits(s, d):
    """M6, first round: the best split of every feature over the training rows.
    Weights are whole numbers here, so that sums are exact in any engine."""
    from ..plans import boosting as BO
    train = (_features(s, d).where(F.col("is_test") == 0)
             .withColumn("w", F.when(F.col(K.TARGET) == 1, F.lit(3.0)).otherwise(F.lit(1.0))))
    rounded = [F.round(c, 9).alias(c) if c in LOG_FEATURES else F.col(c) for c in K.FEATURES]
    return BO.root_splits(train.select(K.TARGET, "w", *rounded), K.FEATURES, K.TARGET, "w")


@register("feature_importance")
def _feature_importance(s, d):
    from ..plans import models as MO
    return MO.feature_importance(MO.fit_one(_prepared(s, d)))


@register("risk_scores")
def _risk_scores(s, d):
    from ..plans import models as MO
    prep = _prepared(s, d)
    return MO.score_all(MO.fit_one(prep), prep)


@register("model_checks")
def _model_checks(s, d):
    """What must hold of every trained model (M4, M5, A9, M10, M13), a row per
    check: see ``plans.model_checks``."""
    from ..plans.model_checks import model_checks
    return model_checks(_prepared(s, d), _scratch(s, "model"))


@register("imputer_medians")
def _imputer_medians(s, d):
    """M2: the medians that the imputer takes from the training rows."""
    train = _features(s, d).where(F.col("is_test") == 0)
    return QU.exact_medians(train, list(FE.IMPUTED))


@register("risk_scores_columns")
def _risk_scores_columns(s, d):
    """M14 without its learned values: the deterministic columns of the scored
    cohort, and whether the score is a probability and agrees with its band."""
    scored = QUERIES["risk_scores"](s, d)
    fits = F.col("risk_score").between(0, 1) & C.band("risk_score").eqNullSafe(F.col("risk_band"))
    return scored.select("nct_id", "overall_status", "is_terminated", "phase", "agency_class", "enrollment",
                         "duration_months", "site_count", "total_withdrawals",
                         C.band("risk_score").isNotNull().alias("has_band"), fits.alias("score_fits"))


ORACLE_SQL: dict[str, str] = oracle.QUERIES
