"""Cut points of a key found by the database, and the ranges made of them.

The queries run in DuckDB, the engine of the oracles; Spark's JDBC connection
itself is not exercised (no driver and no server here)."""

import random

import duckdb
import pytest

from cohortlens.sources import jdbc


def database(keys):
    c = duckdb.connect()
    c.execute("CREATE TABLE t (k VARCHAR, i INTEGER)")
    if keys:
        c.executemany("INSERT INTO t VALUES (?, ?)", [(k, i) for i, k in enumerate(keys)])
    return c


def ranges(c, found, key="k", table="t"):
    return [c.execute(f"SELECT i FROM {table} WHERE {p}").fetchall()
            for p in jdbc.key_predicates(key, found.cuts, found.single, keep_order=True)]


def checked(keys, n, kind=""):
    c = database(keys)
    found = jdbc.find_cuts(lambda q: c.execute(q).fetchall(), "t", "k", n, kind)
    parts = ranges(c, found)
    rows = sorted(i for p in parts for i, in p)
    assert rows == list(range(len(keys)))                  # disjoint and complete
    return found, [len(p) for p in parts]


def test_ranges_are_balanced():
    rng = random.Random(1)
    keys = [f"NCT{rng.randrange(10 ** 8):08d}" for _ in range(4000)] + [None] * 10
    found, sizes = checked(keys, 16)
    assert len(sizes) == 16 and max(sizes) <= 270 and not found.single


def test_a_clustered_key_is_cut_where_its_rows_are():
    rng = random.Random(2)
    keys = [f"NCT000{rng.randrange(3000):05d}" for _ in range(3000)] + ["A", "Z9", "O'Neil", "x\"y", ""]
    _, sizes = checked(keys, 10)
    assert max(sizes) < 2 * len(keys) / 10


def test_a_hot_key_has_a_query_of_its_own():
    rng = random.Random(3)
    keys = ["hot"] * 1500 + [f"k{rng.randrange(10 ** 6)}" for _ in range(3000)]
    rng.shuffle(keys)
    found, sizes = checked(keys, 12)
    assert found.single == ("hot",)
    assert sorted(sizes)[-1] == 1500 and sorted(sizes)[-2] <= 2 * 4500 / 12


@pytest.mark.parametrize("keys", ([], [None] * 5, ["a"], ["a"] * 50, ["b", None, "a"], ["it's", "it''s"]))
@pytest.mark.parametrize("n", (1, 2, 7))
def test_small_tables(keys, n):
    checked(keys, n)


def test_the_sample_cuts_like_the_table():
    rng = random.Random(4)
    keys = [f"{int(1e6 * rng.random() ** 3):07d}" for _ in range(60_000)]
    clause = jdbc.sample_clause("duckdb", len(keys), 8)
    assert "TABLESAMPLE" in clause and "13." in clause
    _, sizes = checked(keys, 8, "duckdb")
    assert len(sizes) == 8 and max(sizes) < 1.25 * len(keys) / 8


def test_the_order_of_the_database_is_kept():
    """Under a collation that is not that of Python's strings, cuts sorted
    anew would leave rows out."""
    c = duckdb.connect()
    c.execute("CREATE TABLE t (k VARCHAR COLLATE NOCASE, i INTEGER)")
    rng = random.Random(5)
    keys = ["".join(rng.choice("abcXYZ") for _ in range(4)) for _ in range(600)]
    c.executemany("INSERT INTO t VALUES (?, ?)", [(k, i) for i, k in enumerate(keys)])
    found = jdbc.find_cuts(lambda q: c.execute(q).fetchall(), "t", "k", 6)
    assert list(found.cuts) != sorted(found.cuts)
    parts = ranges(c, found)
    assert sorted(i for p in parts for i, in p) == list(range(600)) and max(map(len, parts)) < 200


def test_number_keys_and_subqueries():
    c = duckdb.connect()
    c.execute("CREATE TABLE t AS SELECT (x * x) % 1009 AS k, x AS i FROM range(500) r(x)")
    source = "(SELECT * FROM t WHERE i < 400) s"
    found = jdbc.find_cuts(lambda q: c.execute(q).fetchall(), source, "k", 5, "duckdb")
    parts = ranges(c, found, table=source)
    assert sorted(i for p in parts for i, in p) == list(range(400)) and max(map(len, parts)) < 130
    assert all("'" not in p for p in jdbc.key_predicates("k", found.cuts))


def test_sample_clauses_per_database():
    for kind in ("postgresql", "sqlserver", "oracle"):
        assert "1.000000" in jdbc.sample_clause(kind, 10 ** 6, 10) and "17" in jdbc.sample_clause(kind, 10 ** 6, 10)
    assert jdbc.sample_clause("mysql", 10 ** 6, 10) == "" == jdbc.sample_clause("postgresql", 5000, 10)


def test_reading_without_partitions_is_an_error(spark):
    with pytest.raises(ValueError, match="num_partitions"):
        jdbc.read_jdbc_by_key(spark, "jdbc:postgresql://h/d", "t", "k")
