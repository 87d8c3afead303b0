"""Every registered key against its DuckDB oracle at sf0.001 (the driver runs
the same comparison at sf0.01); keys without an oracle must at least run."""

import pytest

import __spark_entry__ as E
from cohortlens.adapters.catalog import ORACLE_SQL, QUERIES
from harness import compare, duck
from conftest import SF_SMALL

ORACLES = {k: v for k, v in ORACLE_SQL.items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    ok, n, _, _, msg = compare(spark, con, name, QUERIES[name], ORACLES[name], SF_SMALL)
    assert ok, "\n".join(msg)


# risk_scores trains and scores inside the oracle key risk_scores_columns; the
# importances of the same model are covered in test_models
COVERED = {"risk_scores", "feature_importance"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - COVERED))
def test_rows_only_keys_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 3
    assert df.columns[0] == "phase"


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.queries())
