"""Sources and sinks: delimited text, Parquet, CSV, JDBC."""

from .delimited import normalize_na, read_delimited, read_registry_export
from .jdbc import jdbc_options, read_jdbc, read_jdbc_by_key
from .sinks import read_scored_csv, write_bucketed, write_csv, write_parquet
from .tables import TrialTables, read_parquet_tables

__all__ = [
    "TrialTables", "normalize_na", "read_delimited", "read_registry_export",
    "read_parquet_tables", "jdbc_options", "read_jdbc", "read_jdbc_by_key", "read_scored_csv",
    "write_bucketed", "write_csv", "write_parquet",
]
