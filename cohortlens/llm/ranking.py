"""Ranked lexical search: the k best documents of every query, TAAT and DAAT.

1. Index. The queries' terms are numbered. Map tasks tokenise the documents
   once and write index shards of bounded size: per document its id and number
   of terms, per queried term its postings (document number, occurrences). No
   text is shuffled. The number of documents, the total of terms and the
   document frequencies are sums over the shards.
2. Search, shard by shard. The short lists of a query are taken term at a time
   (TAAT): their contributions are summed into accumulators, sorted by
   document. These then are one bounded iterator among the long lists: for
   windows of consecutive documents each iterator knows its largest value, and
   a window whose sum of bounds is below the k-th best score so far is skipped
   in all lists. Inside a window documents are taken together (DAAT): the
   iterators follow in falling order of their bounds, and documents that can no
   longer reach the k-th score are dropped before the next list is probed. The
   k-th score is kept from shard to shard of a task.
3. Merge. Each task returns at most k documents per query; they are ranked per
   (query, salt) and then per query.

Queries are taken in blocks of bounded size (``QUERY_BYTES`` of text), so what
is broadcast does not grow; each block makes its own index of its terms.

Defined results: an item is a distinct (id, text) row of the queries, so
repeated rows give one ranking; null or empty queries, and queries whose terms
no document holds, give no rows; null and empty documents have no terms and
count nowhere; repeated documents are ranked each; equal scores are in
ascending order of id, null ids last; empty tables give no rows. Extra columns
are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import text_batches, text_or_empty

TOP = 20
QUERY_BYTES = 8_000_000      # text of one block of queries
SHARD_TERMS = 2_000_000      # terms of one index shard, about
WINDOW = 512                 # documents of one window
SHORT = 8                    # a list is short when it has at most 1 / SHORT of a shard's documents
SALTS = 1000
SCALE = 10 ** 9
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))
SHARD_SCHEMA = ("doc_ids array<bigint>, no_id array<boolean>, lengths array<bigint>, terms array<int>, starts array<int>, "
                "numbers array<int>, counts array<int>")


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits, lower-cased, and non-ASCII characters."""
    return text.translate(_TABLE).split()


def _bodies(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"),
                     text_or_empty(F.col(text_col)).cast("binary").alias("body"))


def _blocks(queries: DataFrame) -> Iterator[list[tuple]]:
    """Distinct queries as lists of (id, body), each of about QUERY_BYTES."""
    queries = queries.distinct()
    size = queries.agg(F.sum(F.length("body"))).first()[0] or 0
    n = max(1, math.ceil(2 * size / QUERY_BYTES))
    for k in range(n):
        part = queries.where(F.pmod(F.xxhash64("id", "body"), F.lit(n)) == k) if n > 1 else queries
        rows = [(r.id, bytes(r.body)) for r in part.collect()]
        if rows:
            yield rows


# -- index -------------------------------------------------------------------

def build_shards(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Index shards of (id, body) rows over the terms of ``vocabulary``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def shard(ids, lengths, found) -> pd.DataFrame:
        n = len(ids)
        keys, counts = np.unique(np.concatenate(found), return_counts=True)
        terms, starts = np.unique(keys // n, return_index=True)
        return pd.DataFrame({
            "doc_ids": [[i or 0 for i in ids]], "no_id": [[i is None for i in ids]],
            "lengths": [lengths], "terms": [terms.astype(np.int32)],
            "starts": [np.append(starts, len(keys)).astype(np.int32)],
            "numbers": [(keys % n).astype(np.int32)], "counts": [counts.astype(np.int32)]})

    def build(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = shared.value.get
        ids, lengths, found, size = [], [], [], 0

        def flush():
            n = len(ids)
            return shard(ids, lengths, [t[t >= 0] * n + k for k, t in enumerate(found)])
        for pdf in parts:
            for i, body in zip(pdf["id"], pdf["body"]):
                words = terms_of(bytes(body))
                if not words:
                    continue
                ids.append(None if i is None else int(i))
                lengths.append(len(words))
                found.append(np.fromiter((get(w, -1) for w in words), np.int64, len(words)))
                size += len(words)
                if size >= SHARD_TERMS:
                    yield flush()
                    ids, lengths, found, size = [], [], [], 0
        if ids:
            yield flush()

    rows = docs.select(F.col("id").cast("string").alias("id"), "body")       # nulls stay apart from numbers
    return rows.mapInPandas(build, SHARD_SCHEMA)


def statistics(shards: DataFrame) -> tuple[int, int, dict[int, int]]:
    """Documents with a term, all their terms, document frequency by term.
    The result has one entry per queried term."""
    total = shards.agg(F.sum(F.size("lengths").cast("long")).alias("n"),
                       F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b)).alias("l")).first()
    sizes = F.zip_with("terms", F.zip_with(F.expr("slice(starts, 1, size(terms))"), F.expr("slice(starts, 2, size(terms))"),
                                           lambda a, b: b - a), lambda t, n: F.struct(t.alias("term"), n.alias("n")))
    frequency = shards.select(F.inline(sizes)).groupBy("term").agg(F.sum("n").alias("df")).collect()
    return total.n or 0, total.l or 0, {r.term: r.df for r in frequency}


# -- search ------------------------------------------------------------------

def weight(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


class Shard:
    """One index shard with the contribution of every posting and, per term
    and window, the largest contribution."""

    def __init__(self, row, documents: int, total: int, weights: dict[int, int]):
        lengths = [int(x) for x in row.lengths]
        m = np.array([75 + 25 * x * documents // total for x in lengths], np.int64)
        self.numbers = np.asarray(row.numbers, np.int64)
        counts = np.asarray(row.counts, np.int64)
        self.terms = {int(t): k for k, t in enumerate(row.terms)}
        self.starts = np.asarray(row.starts, np.int64)
        w = np.array([weights[int(t)] for t in row.terms], np.int64)
        self.values = (SCALE * counts) // (1000 * counts + 12 * m[self.numbers])
        self.values *= np.repeat(w, np.diff(self.starts))
        self.n = len(lengths)
        self.windows = -(-self.n // WINDOW)
        self.known = {}

    def iterator(self, term: int, repeats: int):
        """(documents, contributions, window starts, window maxima)."""
        k = self.terms[term]
        if k not in self.known:
            a, b = self.starts[k], self.starts[k + 1]
            self.known[k] = bounded(self.numbers[a:b], self.values[a:b], self.windows)
        numbers, values, cuts, top = self.known[k]
        return numbers, values * repeats if repeats > 1 else values, cuts, top * repeats

    def size(self, term: int) -> int:
        k = self.terms.get(term)
        return 0 if k is None else int(self.starts[k + 1] - self.starts[k])


def bounded(numbers: np.ndarray, values: np.ndarray, windows: int):
    """An iterator over sorted documents with its largest value per window."""
    cuts = np.searchsorted(numbers, np.arange(windows + 1) * WINDOW)
    top = np.zeros(windows, np.int64)
    some = cuts[1:] > cuts[:-1]
    if some.any():
        top[some] = np.maximum.reduceat(values, cuts[:-1][some])
    return numbers, values, cuts, top


def search_shard(shard: Shard, query: dict[int, int], least: int):
    """Yields (document numbers, scores) window by window, all documents whose
    score is at least ``least`` among them; send back a higher bound."""
    lists = [(shard.size(t), t, r) for t, r in query.items() if t in shard.terms]
    short = [(t, r) for n, t, r in lists if n * SHORT <= shard.n]
    iterators = [shard.iterator(t, r) for n, t, r in lists if n * SHORT > shard.n]
    if short:                                                      # term at a time
        parts = [shard.iterator(t, r) for t, r in short]
        numbers, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        sums = np.zeros(len(numbers), np.int64)
        np.add.at(sums, inverse, np.concatenate([p[1] for p in parts]))
        iterators.append(bounded(numbers, sums, shard.windows))
    if not iterators:
        return
    bounds = np.stack([it[3] for it in iterators])
    total = bounds.sum(axis=0)
    for w in np.flatnonzero(total >= max(least, 1)).tolist():
        if total[w] < least:
            continue
        score = np.zeros(WINDOW, np.int64)
        alive = None
        rest = int(total[w])
        for k in np.argsort(-bounds[:, w], kind="stable").tolist():   # document at a time, best bounds first
            top = int(bounds[k, w])
            if not top:
                break
            numbers, values, cuts, _ = iterators[k]
            a, b = cuts[w], cuts[w + 1]
            if alive is None and rest >= max(least, 1):              # a new document could still get in
                score[numbers[a:b] - w * WINDOW] += values[a:b]
            else:
                if alive is None:
                    alive = np.flatnonzero(score)
                alive = alive[score[alive] + rest >= least]
                if not len(alive):
                    break
                here = numbers[a:b] - w * WINDOW
                at = np.minimum(np.searchsorted(here, alive), len(here) - 1)
                hit = here[at] == alive
                score[alive[hit]] += values[a:b][at[hit]]
            rest -= top
        good = np.flatnonzero(score >= max(least, 1))
        if len(good):
            higher = yield good + w * WINDOW, score[good]
            least = max(least, higher or 0)


def search_shards(shards: DataFrame, queries: list[dict[int, int]], documents: int, total: int,
                  weights: dict[int, int], top: int) -> DataFrame:
    """At most ``top`` (query, doc_id, score) per query and task."""
    shared = shards.sparkSession.sparkContext.broadcast((queries, weights))

    def order(doc_id):                       # ascending ids, null ids last, as one number that sorts falling
        return (0, 0) if doc_id is None else (1, -doc_id)

    def find(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries, weights = shared.value
        best: list[list] = [[] for _ in queries]                      # heaps of (score, order)
        for pdf in parts:
            for row in pdf.itertuples():
                shard = Shard(row, documents, total, weights)
                for heap, query in zip(best, queries):
                    steps = search_shard(shard, query, heap[0][0] if len(heap) == top else 0)
                    try:
                        numbers, scores = next(steps)
                        while True:
                            for number, score in zip(numbers.tolist(), scores.tolist()):
                                entry = (score, order(None if row.no_id[number] else int(row.doc_ids[number])))
                                if len(heap) < top:
                                    heapq.heappush(heap, entry)
                                elif entry > heap[0]:
                                    heapq.heapreplace(heap, entry)
                            numbers, scores = steps.send(heap[0][0] if len(heap) == top else 0)
                    except StopIteration:
                        pass
        rows = [(q, str(-o[1]) if o[0] else None, score) for q, heap in enumerate(best) for score, o in heap]
        yield pd.DataFrame(rows, columns=["query", "doc_id", "score"])

    return shards.mapInPandas(find, "query int, doc_id string, score long")


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id",
                   text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item, rank, document, score): the ``top`` best documents of each item
    with a score above 0. Runs jobs: index shards are checkpointed."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    text_batches(spark)
    bodies = _bodies(docs, id_col, text_col)
    out = spark.createDataFrame([], "item long, rank int, doc long, score long")
    for rows in _blocks(_bodies(items, item_col, item_text_col)):
        counted = [Counter(terms_of(body)) for _, body in rows]
        vocabulary = {t: k for k, t in enumerate(sorted(set().union(*counted)))}
        shards = build_shards(bodies, vocabulary).checkpoint()
        documents, total, frequency = statistics(shards)
        weights = {t: weight(documents, n) for t, n in frequency.items()}
        queries = [{vocabulary[t]: n for t, n in c.items() if vocabulary[t] in weights} for c in counted]
        found = search_shards(shards, queries, documents, total, weights, top)
        found = found.select("query", F.col("doc_id").cast("long").alias("doc"), "score")
        best = [F.desc("score"), F.asc_nulls_last("doc")]
        found = found.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        found = (found.withColumn("place", F.row_number().over(Window.partitionBy("query", "salt").orderBy(*best)))
                 .where(F.col("place") <= top))
        found = (found.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*best)))
                 .where(F.col("rank") <= top))
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(rows)], "query int, item long")
        out = out.unionByName(found.join(F.broadcast(names), "query").select("item", "rank", "doc", "score"))
    return out.select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score")
