"""Sources and sinks: delimited parsing, round trips, JDBC options, report runner."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortlens import schemas
from cohortlens.adapters.fixtures import fixture_tables
from cohortlens.operators import master as MA
from cohortlens.plans.reports import REPORTS, run_reports, write_reports
from cohortlens.sources import (jdbc_options, normalize_na, read_delimited, read_scored_csv,
                                write_bucketed, write_csv, write_parquet)
from conftest import SF_SMALL

TEXT = (
    'nct_id|overall_status|phase|enrollment|enrollment_type|study_type|start_date|completion_date|'
    'primary_completion_date|study_first_submitted_date|results_first_submitted_date|number_of_arms|'
    'number_of_groups|why_stopped|has_expanded_access\n'
    'N1|COMPLETED|PHASE2|120|ACTUAL|INTERVENTIONAL|2020-01-05|2021-02-01||||2|||\n'
    'N2|TERMINATED|NA|abc|ACTUAL|INTERVENTIONAL|2020-13-01|2021-02-01||||||"funding | pipe"|\n'
    'N3|COMPLETED|PHASE3|5|ACTUAL|INTERVENTIONAL|2019-05-01|2019-06-01|||||'
    '|"line one\nline ""two"""|N/A\n'
)


def test_delimited_edge_cases(spark, tmp_path):
    p = tmp_path / "studies.txt"
    p.write_text(TEXT)
    df = read_delimited(spark, str(p), schemas.studies(), multiline=True)
    r = {x.nct_id: x for x in df.collect()}
    assert r["N1"].enrollment == 120.0 and r["N1"].start_date == dt.date(2020, 1, 5)
    assert r["N2"].phase is None            # literal NA -> missing
    assert r["N2"].enrollment is None       # bad number -> NULL, row kept
    assert r["N2"].start_date is None       # bad date -> NULL
    assert r["N1"].primary_completion_date is None   # empty field -> NULL
    assert r["N3"].why_stopped == 'line one\nline "two"'   # quoted newline + doubled quote
    assert r["N3"].has_expanded_access is None       # N/A token
    assert r["N2"].why_stopped == "funding | pipe"           # pipe inside quotes


def test_normalize_na_only_exact_tokens(spark):
    df = spark.createDataFrame([("NA",), (" NA",), ("None",), ("ok",)], "x string")
    assert [r.x for r in normalize_na(df).collect()] == [None, " NA", None, "ok"]


def test_parquet_and_csv_round_trip(spark, tmp_path):
    m = MA.master_trial(fixture_tables(spark, SF_SMALL)).select(*MA.MASTER_TRIAL_COLUMNS)
    write_parquet(m, str(tmp_path / "m"))
    back = spark.read.parquet(str(tmp_path / "m"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, m.collect()))
    scored = m.select("nct_id", "overall_status", "is_terminated", "phase", "agency_class", "enrollment",
                      "duration_months", F.col("site_count").cast("double").alias("site_count"),
                      "total_withdrawals", F.lit(0.5).alias("risk_score"), F.lit("Medium").alias("risk_band"))
    write_csv(scored, str(tmp_path / "csv"))
    typed = read_scored_csv(spark, str(tmp_path / "csv"), id_type=schemas.L)
    assert typed.schema == schemas.risk_scores(schemas.L)
    assert typed.count() == scored.count()


def test_bucketed_table(spark, tmp_path):
    m = MA.master_trial(fixture_tables(spark, SF_SMALL)).select("nct_id", "is_terminated")
    write_bucketed(m, "master_b", buckets=4, path=str(tmp_path / "mb"))
    t = spark.table("master_b")
    agg = t.groupBy("nct_id").count()
    assert "Exchange" not in agg._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE master_b")


def test_jdbc_options():
    o = jdbc_options("jdbc:postgresql://h/db", "registry.studies", "id", 0, 1000, 8, user="u")
    assert o["numPartitions"] == "8" and o["partitionColumn"] == "id" and o["user"] == "u"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="id")


def test_report_runner_isolates_failures(spark, tmp_path):
    t = fixture_tables(spark, SF_SMALL)
    reports = dict(REPORTS)
    reports["broken"] = lambda tb, m: m.select("no_such_column")
    run = run_reports(t, names=list(REPORTS) + ["broken"], reports=reports)
    assert set(run.frames) == set(REPORTS) and "broken" in run.errors
    write_reports(run, str(tmp_path / "out"))
    assert set(run.written) == set(REPORTS)


def test_pick_columns_tolerates_missing(spark):
    df = spark.createDataFrame([(1, "a")], "nct_id int, phase string")
    out = MA.pick_columns(df, ["phase", "no_such", "nct_id"])
    assert out.columns == ["phase", "nct_id"]


def test_registry_export_end_to_end(spark, tmp_path):
    """All nine tables written as pipe-delimited text with headers, read back
    through the typed reader: the master equals the one from Parquet."""
    from cohortlens.sources import read_registry_export
    t = fixture_tables(spark, SF_SMALL)
    root = tmp_path / "raw"
    for name, df in t.items():
        (df.write.option("header", True).option("sep", "|").option("quote", '"').option("escape", '"')
         .option("dateFormat", "yyyy-MM-dd").csv(str(root / f"{name}.txt")))
    back = read_registry_export(spark, str(root), id_type=schemas.L)
    a = MA.master_trial(t).select(*MA.MASTER_TRIAL_COLUMNS)
    b = MA.master_trial(back).select(*MA.MASTER_TRIAL_COLUMNS)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_register_views_for_sql(spark):
    t = fixture_tables(spark, SF_SMALL)
    t.register_views()
    n = spark.sql("SELECT COUNT(*) AS n FROM studies WHERE study_type = 'INTERVENTIONAL'").first().n
    assert n == t.studies.where("study_type = 'INTERVENTIONAL'").count()


def _export(root, name, schema, rows, extra=True, drop=None):
    """A pipe-delimited file with the schema's columns reversed and, with
    ``extra``, an unknown column between every two."""
    cols = [c for c in reversed(schema.fieldNames()) if c != drop]
    header, lines = [], []
    for c in cols:
        header += [c] + ([f"x_{c}"] if extra else [])
    for r in rows:
        lines.append("|".join(v for c in cols for v in ([r.get(c, "")] + (["junk"] if extra else []))))
    p = root / f"{name}.txt"
    p.write_text("\n".join(["|".join(header), *lines]) + "\n")
    return str(p)


@pytest.mark.parametrize("name", sorted(schemas.TABLES))
def test_columns_are_found_by_name(spark, tmp_path, name):
    schema = schemas.TABLES[name](schemas.S)
    texts = {f.name: {"string": f"v_{f.name}", "double": "2.5", "date": "2020-02-03"}[f.dataType.simpleString()]
             for f in schema.fields}
    want = {"string": lambda c: f"v_{c}", "double": lambda c: 2.5, "date": lambda c: dt.date(2020, 2, 3)}
    for extra in (True, False):
        path = _export(tmp_path, name, schema, [texts], extra)
        row = read_delimited(spark, path, schema).first()
        assert row.asDict() == {f.name: want[f.dataType.simpleString()](f.name) for f in schema.fields}
    one = read_delimited(spark, path, schema, columns=["nct_id"])
    assert one.columns == ["nct_id"] and one.first()[0] == "v_nct_id"
    gone = schema.fieldNames()[-1]
    path = _export(tmp_path, name, schema, [texts], drop=gone)
    with pytest.raises(ValueError, match=gone):
        read_delimited(spark, path, schema)


def test_single_line_reading_fails_on_a_cut_record(spark, tmp_path):
    p = tmp_path / "sponsors.txt"
    p.write_text('nct_id|agency_class|lead_or_collaborator|name\nT1|INDUSTRY|lead|"Ac\nme"\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_delimited(spark, str(p), schemas.sponsors(), multiline=False).collect()
    for multiline in (None, True):
        assert read_delimited(spark, str(p), schemas.sponsors(), multiline=multiline).first().name == "Ac\nme"


def test_key_predicates_are_disjoint_and_complete(spark):
    from cohortlens.sources.jdbc import key_predicates
    keys = spark.createDataFrame([("A",), ("B'1",), ("M",), ("Z",), (None,)], "k string")
    parts = [keys.where(p).count() for p in key_predicates("k", ["M", "B'1"])]
    assert parts == [2, 1, 2]


def test_bucketed_file_count_is_bounded(spark, tmp_path):
    df = spark.range(5000, numPartitions=16).withColumn("nct_id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")))
    write_bucketed(df, "many_b", buckets=8, path=str(tmp_path / "b"), spread=2)
    assert len(list((tmp_path / "b").glob("*.parquet"))) <= 16
    assert spark.table("many_b").count() == 5000
    spark.sql("DROP TABLE many_b")
