"""A relational database table as a partitioned Spark source.

The read is split into range queries on a key, so no single connection pulls
the whole table: on a numeric or date column by its bounds (``read_jdbc``), on
a key of any type, text included, by equal-depth cut points that the database
itself finds (``read_jdbc_by_key``); the caller names the table, the key and the
number of partitions. Credentials come from the caller (options or
properties), never from files in this package.

Finding the cuts is two pushed-down queries: one counts the rows, one numbers
the tiles of a sample in key order and returns one row per tile. The database
compares the keys both there and in the range queries, so its collation holds
throughout; cuts are never sorted again on the Spark side.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, partition_column: str | None = None,
                 lower_bound=None, upper_bound=None, num_partitions: int | None = None,
                 fetch_size: int = 10_000, **extra) -> dict[str, str]:
    """The option map for ``spark.read.format('jdbc')``.

    ``table`` may be a table name or a parenthesised sub-query with an alias.
    Partitioned reads need all four partition options together."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    part = (partition_column, lower_bound, upper_bound, num_partitions)
    if any(p is not None for p in part):
        if not all(p is not None for p in part):
            raise ValueError("partition_column, lower_bound, upper_bound and num_partitions go together")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


SAMPLE_ROWS_PER_PARTITION = 1000

# The clause that samples a share (in percent) of a table's rows, by the name in the url.
SAMPLE_CLAUSES = {
    "postgresql": "TABLESAMPLE BERNOULLI ({percent}) REPEATABLE ({seed})",
    "sqlserver": "TABLESAMPLE ({percent} PERCENT) REPEATABLE ({seed})",
    "oracle": "SAMPLE ({percent}) SEED ({seed})",
    "duckdb": "TABLESAMPLE {percent}% (bernoulli, {seed})",
}


def sql_literal(value) -> str:
    """A number as it is, anything else as a quoted string."""
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return repr(value)
    return "'" + str(value).replace("'", "''") + "'"


@dataclass(frozen=True)
class KeyCuts:
    """Cut points in the database's order of the key; ``single`` are keys that
    alone fill a range or more."""
    cuts: tuple
    single: tuple = ()


def count_query(table: str) -> str:
    return f"SELECT COUNT(*) AS n FROM {table}"


def cut_query(table: str, key: str, num_partitions: int, sample: str = "") -> str:
    """One row per tile of the sampled keys in order: its number, and its
    smallest and largest key. ``table`` with a ``sample`` clause must be a
    plain name."""
    return (f"SELECT tile, MIN(k) AS low, MAX(k) AS high FROM (SELECT {key} AS k, NTILE({num_partitions}) "
            f"OVER (ORDER BY {key}) AS tile FROM {table} {sample} WHERE {key} IS NOT NULL) tiles GROUP BY tile")


def sample_clause(kind: str, rows: int, num_partitions: int, seed: int = 17) -> str:
    """The clause for about ``SAMPLE_ROWS_PER_PARTITION`` rows a partition;
    empty where that is the whole table or the database has no such clause
    (the key is then read whole, by the database)."""
    percent = 100.0 * SAMPLE_ROWS_PER_PARTITION * num_partitions / max(rows, 1)
    if percent >= 100 or kind not in SAMPLE_CLAUSES:
        return ""
    return SAMPLE_CLAUSES[kind].format(percent=f"{percent:.6f}", seed=seed)


def cuts_of_tiles(tiles: Sequence[tuple]) -> KeyCuts:
    """Cuts from (tile, low, high) rows: where each tile starts, without
    repeats. A key that fills a whole tile is read by a query of its own."""
    tiles = sorted(tiles, key=lambda t: t[0])
    cuts: list = []
    for _, low, _ in tiles[1:]:
        if low != tiles[0][1] and (not cuts or cuts[-1] != low):
            cuts.append(low)
    single = []
    for _, low, high in tiles:
        if low == high and (not single or single[-1] != low):
            single.append(low)
    return KeyCuts(tuple(cuts), tuple(single))


def find_cuts(run: Callable[[str], list[tuple]], table: str, key: str, num_partitions: int, kind: str = "",
              seed: int = 17) -> KeyCuts:
    """Equal-depth cuts of ``key``, found by the database; ``run`` executes a
    query there and returns its rows. At most ``num_partitions`` rows come
    back. An empty table, or one without keys, has no cuts."""
    if num_partitions < 2:
        return KeyCuts(())
    rows = int(run(count_query(table))[0][0])
    plain = " " not in table.strip()
    sample = sample_clause(kind, rows, num_partitions, seed) if plain else ""
    return cuts_of_tiles(run(cut_query(table, key, num_partitions, sample)))


def key_predicates(key: str, boundaries: Sequence, single: Sequence = (), keep_order: bool = False) -> list[str]:
    """Disjoint, complete WHERE clauses: one per range between the boundaries,
    the first also taking NULL keys, and one per ``single`` key, which the
    ranges leave out. With ``keep_order`` the boundaries are already in the
    database's order; otherwise they are sorted here."""
    cuts = list(boundaries) if keep_order else sorted(set(boundaries))
    lits = [sql_literal(c) for c in cuts]
    alone = [sql_literal(c) for c in single]
    apart = f" AND {key} NOT IN ({', '.join(alone)})" if alone else ""
    own = [f"{key} = {v}" for v in alone]
    if not lits:
        return [f"({key} IS NULL OR ({key} IS NOT NULL{apart}))", *own] if own else ["1 = 1"]
    out = [f"{key} IS NULL OR ({key} < {lits[0]}{apart})"]
    out += [f"{key} >= {a} AND {key} < {b}{apart}" for a, b in zip(lits, lits[1:])]
    return out + [f"{key} >= {lits[-1]}{apart}", *own]


def read_jdbc_by_key(spark: SparkSession, url: str, table: str, key: str, num_partitions: int | None = None,
                     boundaries: Sequence | None = None, properties: dict[str, str] | None = None,
                     seed: int = 17) -> DataFrame:
    """A6 for keys of any type: one query per range of the key. The ranges
    hold about equal numbers of rows, found by the database (``find_cuts``),
    unless the caller gives ``boundaries``."""
    properties = properties or {}
    if boundaries is not None:
        predicates = key_predicates(key, boundaries)
    else:
        if not num_partitions:
            raise ValueError("give num_partitions or boundaries")

        def run(query: str) -> list[tuple]:
            return [tuple(r) for r in spark.read.jdbc(url, f"({query}) pushed", properties=properties).collect()]
        found = find_cuts(run, table, key, num_partitions, url.split(":")[1] if url.count(":") else "", seed)
        predicates = key_predicates(key, found.cuts, found.single, keep_order=True)
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)


def read_jdbc(spark: SparkSession, url: str, table: str, **kw) -> DataFrame:
    """Lazy JDBC relation; filters and projections are pushed into the SQL."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **kw)).load()
