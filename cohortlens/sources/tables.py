"""The nine registry tables as one bundle of lazy DataFrames (A3)."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from .. import schemas


@dataclass
class TrialTables:
    studies: DataFrame
    sponsors: DataFrame
    eligibilities: DataFrame
    drop_withdrawals: DataFrame
    outcomes: DataFrame
    conditions: DataFrame
    facilities: DataFrame
    reported_events: DataFrame
    interventions: DataFrame

    def items(self):
        return [(f.name, getattr(self, f.name)) for f in fields(self)]

    def children(self):
        return [(n, df) for n, df in self.items() if n != "studies"]

    def replace(self, **kw) -> "TrialTables":
        d = dict(self.items())
        d.update(kw)
        return TrialTables(**d)

    def register_views(self, prefix: str = "") -> list[str]:
        """Register every table as a temp view (``<prefix><table>``) so SQL
        written against the registry schema runs unchanged on Spark."""
        names = []
        for name, df in self.items():
            df.createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        return names


def read_parquet_tables(spark: SparkSession, root: str, names=None) -> TrialTables:
    """A3: ``<root>/<table>.parquet`` for each of the nine tables.

    Parquet carries its own schema; the scan only reads the columns a plan
    selects and pushes filters into row-group skipping."""
    names = names or {n: n for n in schemas.TABLES}
    return TrialTables(**{n: spark.read.parquet(os.path.join(root, f"{names[n]}.parquet"))
                          for n in schemas.TABLES})
