"""Whole records of delimited text with quoted newlines, read in parallel.

A line break inside a quoted field does not end a record, so a task that starts
somewhere in a file cannot tell by itself whether its first line starts a
record. Its lines still say what they do in either case: a line takes the
reader from one of two states, between records or inside a quoted field, to
one of the two. So

1. each split of a file composes its lines and returns what it does to both
   states, one row per split; lines without a quote change nothing and are
   left out by the scan;
2. a prefix composition over the splits of each file gives the state in which
   every split ends, and the next one starts;
3. every split is cut into records. A record that crosses splits leaves a
   fragment in each, and the fragments of one record are joined.

Splits are the ones Spark's text scan makes, so a file of any size is read by
as many tasks as its size asks for. Lines are shuffled only for records that
cross a split.
"""

from __future__ import annotations

import csv
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WHOLE, HEAD, MIDDLE, TAIL = 0, 1, 2, 3       # a record, or its last, an inner, its first fragment
SPLIT_SCHEMA = "file string, split long, from_record boolean, from_quotes boolean"
PIECE_SCHEMA = "file string, split long, piece int, record string"
Ends = dict[str, tuple[list[int], list[bool]]]


class LineStates:
    """What a line does to the reader: ``after(inside, line)`` is True where
    the line ends inside a quoted field. A field is quoted if it starts with a
    quote; doubled quotes are content, and what follows the closing quote is
    content up to the separator."""

    def __init__(self, sep: str):
        s = re.escape(sep)
        fields = rf'(?:"(?:[^"]|"")*+"[^{s}]*+|(?!")[^{s}]*+)'
        rest = rf"(?:{s}{fields})*+"
        self._closed = re.compile(fields + rest, re.S).fullmatch
        self._closes = re.compile(rf'(?:[^"]|"")*+"[^{s}]*+' + rest, re.S).fullmatch

    def after(self, inside: bool, line: str) -> bool:
        return not (self._closes if inside else self._closed)(line)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, file, split): lines between newline characters, in the order of
    the file within each split."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"))


def _by_split(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """Stretches of rows of one split."""
    files, splits = batch.column("file"), batch.column("split")
    a = 0
    while a < batch.num_rows:
        here = pc.and_(pc.equal(files, files[a]), pc.equal(splits, splits[a])).slice(a)
        stop = pc.index(here, False).as_py()
        b = batch.num_rows if stop < 0 else a + stop
        yield files[a].as_py(), splits[a].as_py(), batch.slice(a, b - a)
        a = b


def split_effects(lines: DataFrame, sep: str = "|") -> DataFrame:
    """Per split that holds a quote: the state it ends in (True: inside a
    quoted field), started between records and started inside quotes."""
    def compose(batches):
        states, key, effect = LineStates(sep), None, None

        def row():
            return pa.RecordBatch.from_pylist(
                [{"file": key[0], "split": key[1], "from_record": effect[0], "from_quotes": effect[1]}])
        for batch in batches:
            for file, split, part in _by_split(batch):
                if key != (file, split):
                    if key:
                        yield row()
                    key, effect = (file, split), (False, True)
                for line in part.column("line").to_pylist():
                    a = states.after(effect[0], line)
                    effect = (a, a if effect[1] == effect[0] else states.after(effect[1], line))
        if key:
            yield row()

    return lines.where(F.contains("line", F.lit('"'))).mapInArrow(compose, SPLIT_SCHEMA)


def split_ends(effects: DataFrame) -> DataFrame:
    """(file, split, inside): the state each split ends in, by composing the
    effects of all splits of its file up to it. A split whose effect does not
    depend on its start settles the state; after it only swaps count."""
    w = Window.partitionBy("file").orderBy("split")
    settled = F.col("from_record") == F.col("from_quotes")
    swaps = F.sum((F.col("from_record") & ~F.col("from_quotes")).cast("long")).over(w)
    last = F.last(F.when(F.col("_settled"), F.struct(F.col("from_record").cast("long").alias("state"), "_swaps")),
                  ignorenulls=True).over(w)
    state = F.coalesce(F.col("_last.state"), F.lit(0)) + F.col("_swaps") - F.coalesce(F.col("_last._swaps"), F.lit(0))
    return (effects.withColumn("_settled", settled).withColumn("_swaps", swaps).withColumn("_last", last)
            .select("file", "split", (state % 2 == 1).alias("inside")))


def split_pieces(lines: DataFrame, ends: Ends, header: list[str], sep: str = "|") -> DataFrame:
    """(file, split, piece, record): whole records, and fragments of records
    that cross a split. ``ends`` has the splits with quotes of each file, in
    order, and the states they end in. The first record of each file must be
    ``header``; it is left out."""
    shared = lines.sparkSession.sparkContext.broadcast(ends)

    def cut(batches):
        states, key, inside, head, part = LineStates(sep), None, False, False, []
        at_header = False

        def check(file, record):
            found = next(csv.reader([record.lstrip("\ufeff").rstrip("\r")], delimiter=sep, quotechar='"'), [])
            if found != header:
                raise ValueError(f"{file} has the header {found}, expected {header}")

        def pieces(key, closed, rest, head, ended):
            """Arrow rows of closed records and, at the end of a split, its rest."""
            kinds = [WHOLE] * len(closed)
            if closed and head:
                kinds[0] = HEAD
            if ended and rest:
                closed = closed + ["\n".join(rest)]
                kinds.append(MIDDLE if head and not kinds else TAIL)
            n = len(closed)
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.int64()),
                 pa.array(kinds, pa.int32()), pa.array(closed, pa.string())], ["file", "split", "piece", "record"])
        for batch in batches:
            for file, split, rows in _by_split(batch):
                if key != (file, split):
                    if key and part:
                        yield pieces(key, [], part, head, True)
                    key, part = (file, split), []
                    splits, after = shared.value.get(file, ([], []))
                    k = bisect_left(splits, split)
                    inside = head = bool(k and after[k - 1])
                    at_header = split == 0
                closed = []
                text = rows.column("line")
                quoted = pc.match_substring(text, '"').to_pylist()
                for line, q in zip(text.to_pylist(), quoted):
                    if q:
                        inside = states.after(inside, line)
                    if inside:
                        part.append(line)
                    elif part:
                        closed.append("\n".join([*part, line]))
                        part = []
                    else:
                        closed.append(line)
                if closed and at_header:
                    check(file, closed.pop(0))
                    at_header = False
                if closed:
                    yield pieces(key, closed, [], head, False)
                    head = False
        if key and part:
            yield pieces(key, [], part, head, True)

    return lines.mapInArrow(cut, PIECE_SCHEMA)


def joined_fragments(pieces: DataFrame) -> DataFrame:
    """(file, split, record): records that cross splits, under the split they
    start in. Fragments of one record meet; there are at most two per split."""
    w = Window.partitionBy("file").orderBy("split", "piece")
    owner = F.last(F.when(F.col("piece") == TAIL, F.col("split")), ignorenulls=True).over(w)
    parts = F.array_sort(F.collect_list(F.struct("split", "piece", "record")))
    return (pieces.where(F.col("piece") != WHOLE).withColumn("owner", owner)
            .groupBy("file", "owner").agg(F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record"))
            .select("file", F.col("owner").alias("split"), "record"))


def quoted_splits(spark: SparkSession, path: str, sep: str = "|") -> Ends:
    """Per file the splits that hold a quote, in order, and for each whether it
    ends inside a quoted field. One job; one row per split comes to the
    driver, which holds the list of splits of every scan anyway."""
    ends: Ends = {}
    for r in split_ends(split_effects(text_lines(spark, path), sep)).orderBy("file", "split").collect():
        splits, after = ends.setdefault(r.file, ([], []))
        splits.append(r.split)
        after.append(r.inside)
    return ends


def whole_records(spark: SparkSession, path: str, ends: Ends, header: list[str], sep: str = "|") -> DataFrame:
    """(file, split, record): every record of the files under ``path`` but the
    headers, without the line break that ends it. Empty lines between records
    are no records."""
    lines = text_lines(spark, path)
    pieces = split_pieces(lines, ends, header, sep)
    records = pieces.where(F.col("piece") == WHOLE).select("file", "split", "record")
    near = [(f, a, b) for f, (splits, after) in ends.items() for a, b in _near(splits, after)]
    if near:                             # only splits next to a crossing record are cut again for their fragments
        near = spark.createDataFrame(near, "file string, low long, high long")
        again = lines.join(F.broadcast(near), (lines["file"] == near["file"]) & (lines["split"] >= near["low"])
                           & (lines["split"] <= near["high"]), "left_semi")
        records = records.unionByName(joined_fragments(split_pieces(again, ends, header, sep)))
    record = F.regexp_replace("record", r"\r$", "")
    return records.select("file", "split", record.alias("record")).where(F.col("record") != "")


def _near(splits: list[int], after: list[bool]) -> list[tuple[int, int]]:
    """Ranges of splits from one that ends inside quotes to the next that does
    not (fragments lie on these splits and those without quotes between)."""
    out, start = [], None
    for s, inside in zip(splits, after):
        if inside and start is None:
            start = s
        elif not inside and start is not None:
            out.append((start, s))
            start = None
    if start is not None:
        out.append((start, 2 ** 63 - 1))
    return out
