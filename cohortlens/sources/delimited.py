"""A1/A2: pipe-delimited registry export -> typed DataFrames.

The export is untyped text with a header. The header line names the columns of
the file; wanted columns are taken by name, wherever they stand and whatever
other columns the file has, and a missing one is an error. The text tokens
pandas treats as missing become NULL, and date text is coerced to DATE with
unparseable values as NULL.

Quoted fields may hold line breaks, in any table: ``records.whole_records``
finds where records begin in every split of a file, so such files are still
read by many tasks. A record that does not have the header's number of fields
fails the read instead of passing as a broken row.
"""

from __future__ import annotations

import csv
import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from .. import schemas
from ..functions.columns import coerce_date, na_to_null
from .records import quoted_splits, whole_records
from .tables import TrialTables


def normalize_na(df: DataFrame, tokens: Iterable[str] = K.NA_TOKENS,
                 columns: Iterable[str] | None = None) -> DataFrame:
    """A2: every string column (or ``columns``): missing tokens -> NULL.

    One projection; numeric columns were already parsed to NULL by the reader."""
    tokens = list(tokens)
    cols = set(columns) if columns is not None else {
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select([na_to_null(F.col(c), tokens).alias(c) if c in cols else F.col(c)
                      for c in df.columns])


def header_of(spark: SparkSession, path: str, sep: str = "|") -> list[str]:
    """Column names of a delimited file: its first line, read alone."""
    first = spark.read.text(path).first()
    if first is None:
        raise ValueError(f"{path} has no header line")
    return next(csv.reader([first[0].lstrip("\ufeff")], delimiter=sep, quotechar='"'))


def _text_schema(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def _named(header: list[str], schema: T.StructType, columns: Iterable[str] | None, where: str) -> list[T.StructField]:
    wanted = list(columns) if columns is not None else schema.fieldNames()
    missing = [c for c in wanted if c not in header]
    if missing:
        raise ValueError(f"{where} has no column {', '.join(missing)}")
    return [schema[c] for c in wanted]


def typed_text(df: DataFrame, fields: list[T.StructField], na_tokens: Iterable[str] | None = K.NA_TOKENS) -> DataFrame:
    """The named text columns of ``df`` as their types: missing tokens, bad
    numbers and bad dates become NULL."""
    df = df.select(*[f"`{f.name}`" for f in fields])
    if na_tokens is not None:
        df = normalize_na(df, na_tokens)
    out = []
    for f in fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            out.append(c.alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            out.append(coerce_date(c).alias(f.name))
        else:
            out.append(F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})").alias(f.name))
    return df.select(out)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType,
                   columns: Iterable[str] | None = None, sep: str = "|",
                   multiline: bool | None = None, mode: str = "FAILFAST",
                   na_tokens: Iterable[str] | None = K.NA_TOKENS) -> DataFrame:
    """A1: header-bearing delimited text; ``schema`` gives the wanted columns
    and their types, found in the file by name, upper and lower case apart.

    Quote and escape are ``"`` so doubled quotes inside quoted fields parse as
    one quote; a pipe or a line break inside quotes stays in the field. Files
    of one folder must share the header of the first. One job looks for quotes
    first; ``multiline=False`` spares it for files whose records are single
    lines (others then fail), ``multiline=True`` reads each file in one task."""
    header = header_of(spark, path, sep)
    fields = _named(header, schema, columns, path)
    alike = len({h.lower() for h in header}) < len(header)
    if multiline is None:
        ends = quoted_splits(spark, path, sep)
        if ends or alike:
            return parse_delimited(whole_records(spark, path, ends, header, sep), header, schema, "record",
                                   columns, sep, na_tokens, mode)
    elif alike:
        raise ValueError(f"{path} has columns whose names differ in case only; leave multiline out")
    # all fields are read as text first, so a bad number never drops the row
    df = (spark.read.schema(_text_schema(header))
          .option("header", True).option("enforceSchema", False).option("sep", sep)
          .option("quote", '"').option("escape", '"')
          .option("multiLine", bool(multiline)).option("mode", mode).option("columnPruning", False)
          .csv(path))
    return typed_text(df, fields, na_tokens)


def parse_delimited(lines: DataFrame, header: list[str], schema: T.StructType, line: str = "line",
                    columns: Iterable[str] | None = None, sep: str = "|",
                    na_tokens: Iterable[str] | None = K.NA_TOKENS, mode: str = "FAILFAST") -> DataFrame:
    """A1 over records that are already a text column, one record a row; a
    record may hold line breaks inside quotes."""
    fields = _named(header, schema, columns, "the header")
    # columns by place, as names may differ in case only
    record = F.from_csv(F.col(line), ", ".join(f"_{i} string" for i in range(len(header))),
                        {"sep": sep, "quote": '"', "escape": '"', "mode": mode, "multiLine": "true"})
    named = lines.select(record.alias("_r")).select(
        *[F.col(f"_r._{header.index(f.name)}").alias(f.name) for f in fields])
    return typed_text(named, fields, na_tokens)


def read_registry_export(spark: SparkSession, root: str, id_type: T.DataType = T.StringType(),
                         ext: str = "txt", sep: str = "|", multiline: bool | None = None) -> TrialTables:
    """The nine tables of a pipe-delimited export under ``root``."""
    return TrialTables(**{
        name: read_delimited(spark, os.path.join(root, f"{name}.{ext}"), fn(id_type), sep=sep, multiline=multiline)
        for name, fn in schemas.TABLES.items()
    })
