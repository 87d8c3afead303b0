"""Packing by optimal length buckets.

Every document becomes token sequences of at most ``MAX_LEN`` tokens (its
end-of-text id included), which carry their ids, raw and little-endian in 32
bits, into the batches. The histogram of their lengths (at most ``MAX_LEN``
rows) goes to the driver, where dynamic programming chooses the bucket lengths
that minimise the padding. Inside a bucket, sequences are numbered without
gaps, whatever the number of tasks, and every ``budget // bucket_len`` of them
form a batch, so only the last batch of a bucket can be short.
``padded_batches`` gives the batches themselves.

Defined results: tokens are the tokenizers library's with
``add_special_tokens=False``, so the string of an added token in a text is one
token; a null or empty text is one sequence of its end id; longer
texts are cut into consecutive sequences, nothing is dropped; repeated rows are
packed each on its own; ties in length share a bucket and are ordered by a hash
of id and sequence number; an empty table gives no rows. Only id and text are
read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .bpe import slices, text_encoder
from .common import shuffle_partitions, text_batches
from .token_files import END_ID

MAX_LEN = 2048
BUCKETS = 16
BUDGET = 16_384          # tokens of a batch, padding included
SEQUENCE_SCHEMA = "id long, seq int, len int, ids binary"


def optimal_buckets(histogram: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Ascending bucket lengths, at most ``buckets``, that minimise the padding
    when each length goes to the smallest bucket that holds it."""
    lengths = np.array(sorted(k for k, n in histogram.items() if n), np.int64)
    if not len(lengths):
        return []
    count = np.array([histogram[int(k)] for k in lengths], float)
    c = np.concatenate([[0], np.cumsum(count)])
    w = np.concatenate([[0], np.cumsum(count * lengths)])
    m = len(lengths)
    best = np.full(m + 1, np.inf)
    best[0] = 0.0
    cuts = []
    # cost[i, j]: padding of one bucket over lengths i to j, ending at lengths[j]
    cost = lengths[None, :] * (c[None, 1:] - c[:-1, None])
    cost -= w[None, 1:] - w[:-1, None]
    cost[np.tril_indices(m, -1)] = np.inf
    for _ in range(min(buckets, m)):
        total = cost + best[:-1, None]
        cuts.append(total.argmin(axis=0))
        best[1:] = total.min(axis=0)
        best[0] = 0.0
    out, j = [], m
    for cut in reversed(cuts):
        if j == 0:
            break
        out.append(int(lengths[j - 1]))
        j = int(cut[j - 1])
    return out[::-1]


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of each text by the tokenizers library, plus one end id."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = text_encoder(vocabulary)
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            n = [encoder.encode(texts[s])[1] for s in slices(texts)]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_tokens": np.concatenate(n) + 1})

    text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInPandas(count, "doc_id long, n_tokens long")


def token_sequences(docs: DataFrame, vocabulary: str, max_len: int = MAX_LEN, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, seq, len, ids): each text's ids and one end id, cut into
    consecutive sequences of at most ``max_len``."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = text_encoder(vocabulary)
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            for part in slices(texts):
                ids, counts = encoder.encode(texts[part])
                ends = np.cumsum(counts)
                body = np.insert(ids, ends, END_ID).astype("<u4", copy=False)
                n = counts + 1
                pieces = -(-n // max_len)
                row = np.repeat(np.arange(len(n)), pieces)
                seq = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                size = np.minimum(n[row] - seq * max_len, max_len)
                raw, last = memoryview(body.tobytes()), 4 * np.cumsum(size)
                yield pd.DataFrame({
                    "id": pdf["id"].iloc[part].array.take(row), "seq": seq.astype(np.int32),
                    "len": size.astype(np.int32),
                    "ids": [bytes(raw[x:y]) for x, y in zip((last - 4 * size).tolist(), last.tolist())]})

    text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInPandas(cut, SEQUENCE_SCHEMA)


def pack(counts: DataFrame, max_len: int = MAX_LEN, buckets: int = BUCKETS, budget: int = BUDGET,
         id_col: str = "doc_id", count_col: str = "n_tokens") -> DataFrame:
    """The places of sequences of which only the counts are known: a row per
    sequence with id, sequence number, its tokens, bucket length, batch number
    within the bucket, slot within the batch, and padding. Runs jobs for the
    histogram; the counts are checkpointed."""
    checkpoint_dir(counts.sparkSession)
    counts = counts.select(F.col(id_col).alias("id"), F.col(count_col).cast("long").alias("n")).checkpoint()
    pieces = F.greatest(F.ceil(F.col("n") / max_len), F.lit(1)).cast("int")
    sequences = (counts.select("id", "n", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("seq"))
                 .select("id", "seq", F.least(F.col("n") - F.col("seq").cast("long") * max_len,
                                              F.lit(max_len).cast("long")).cast("int").alias("len")))
    return place(sequences, max_len, buckets, budget, id_col)


def place(sequences: DataFrame, max_len: int = MAX_LEN, buckets: int = BUCKETS, budget: int = BUDGET,
          id_col: str = "doc_id") -> DataFrame:
    """``pack`` for sequences (id, seq, len); their ids, if there, come along
    as the last column."""
    if budget < max_len:
        raise ValueError("a batch must hold at least one sequence of max_len tokens")
    spark = sequences.sparkSession
    carried = [c for c in sequences.columns if c == "ids"]
    histogram = {r.len: r["count"] for r in sequences.groupBy("len").count().collect()}   # <= max_len rows
    ends = optimal_buckets(histogram, buckets)
    if not ends:
        ends = [max_len]
    bucket_of = np.asarray(ends)[np.minimum(np.searchsorted(ends, np.arange(max_len + 1)), len(ends) - 1)]
    shards = min(4096, shuffle_partitions(spark))
    placed = (sequences.withColumn("bucket", F.get(F.lit(bucket_of.tolist()), F.col("len")).cast("int"))
              .withColumn("shard", F.pmod(F.xxhash64("id", "seq"), F.lit(shards)).cast("int")))
    # rows of the shards before, per bucket: buckets x shards rows at most
    sizes = placed.groupBy("bucket", "shard").count()
    before = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("bucket", "shard", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    # rows that are alike in all of this may change places
    inside = Window.partitionBy("bucket", "shard").orderBy(
        F.xxhash64("id", "seq"), "id", "seq", "len", *[F.xxhash64(c) for c in carried])
    ranked = (placed.withColumn("row", F.row_number().over(inside))
              .join(F.broadcast(offsets), ["bucket", "shard"])
              .withColumn("rank", F.col("offset") + F.col("row") - 1)
              .withColumn("cap", F.floor(F.lit(budget) / F.col("bucket"))))
    return ranked.select(F.col("id").alias(id_col), F.col("seq").alias("sequence"), F.col("len").alias("n_tokens"),
                         F.col("bucket").alias("bucket_len"), F.floor(F.col("rank") / F.col("cap")).alias("batch"),
                         F.pmod("rank", "cap").cast("int").alias("slot"),
                         (F.col("bucket") - F.col("len")).alias("padding"), *carried)


def pack_documents(docs: DataFrame, vocabulary: str, max_len: int = MAX_LEN, buckets: int = BUCKETS,
                   budget: int = BUDGET) -> DataFrame:
    """The packed sequences with their ids. Runs jobs; the sequences are kept
    as compressed Parquet in the checkpoint folder."""
    spark = docs.sparkSession
    folder = f"{checkpoint_dir(spark)}/sequences-{uuid.uuid4().hex}"
    token_sequences(docs, vocabulary, max_len).write.option("compression", "zstd").parquet(folder)
    return place(spark.read.schema(SEQUENCE_SCHEMA).parquet(folder), max_len, buckets, budget)


def padded_batches(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A row per batch: bucket length, batch number, and its rows in order of
    their slots, each with id, sequence number, tokens and the ids filled up to
    the bucket length with ``END_ID``. A batch holds at most ``budget`` ids."""
    filled = F.rpad("ids", 4 * F.col("bucket_len"), F.lit(END_ID.to_bytes(4, "little")))
    return (packed.groupBy("bucket_len", "batch")
            .agg(F.sort_array(F.collect_list(F.struct(
                "slot", F.col(id_col).alias("doc_id"), "sequence", "n_tokens", filled.alias("ids")))).alias("rows")))
