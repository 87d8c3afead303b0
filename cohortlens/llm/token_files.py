"""Token-id files with a minimal perfect hash index.

Files. Documents are range-partitioned and sorted by id; shard k holds the
k-th range. A shard is a run of blocks, each a Parquet row with the raw
little-endian 32-bit ids of its documents, their ids and lengths in order.

Index. Keys are (id, occurrence), so repeated ids stay apart. A hash deals
them to parts of bounded size; each part gets a minimal perfect hash (levels of
bit arrays in which a key owns the first bit it does not share), and under the
slot it yields, a 32-bit fingerprint of the key and the place of its payload:
shard, block, offset, length. A lookup costs a few bit tests whatever the
number of documents; the fingerprint turns unknown keys away.

Defined results: ids are the tokenizers library's with
``add_special_tokens=False``, so the string of an added token in a text is that
token's id; a null or empty text is its end id alone; null ids sort
first; repeated ids are ordered by text and numbered; an empty table gives
empty files, an empty index and no rows. Extra columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .bpe import slices, text_encoder
from .common import shuffle_partitions, text_batches, text_or_empty

END_ID = 2
BLOCK_IDS = 1_000_000
PART_KEYS = 50_000        # keys of one part of the index, about
GAMMA = 2                 # bits per key of a level
MAX_LEVELS = 64
_U = np.uint64
BLOCK_SCHEMA = ("shard int, block int, n_ids long, doc_ids array<bigint>, has_id array<boolean>, "
                "occurrences array<bigint>, lengths array<bigint>, ids binary")


# -- writing ----------------------------------------------------------------

def _block(shard: int, block: int, rows: list) -> pd.DataFrame:
    ids = np.concatenate([r[3] for r in rows])
    return pd.DataFrame({
        "shard": [shard], "block": [block], "n_ids": [len(ids)],
        "doc_ids": [np.array([r[0] for r in rows], np.int64)], "has_id": [np.array([r[1] for r in rows], bool)],
        "occurrences": [np.array([r[2] for r in rows], np.int64)],
        "lengths": [np.array([len(r[3]) for r in rows], np.int64)], "ids": [ids.astype("<u4").tobytes()]})


def _encode_shard(vocabulary: str):
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = text_encoder(vocabulary)
        shard, block, last, seen = TaskContext.get().partitionId(), 0, None, 0
        rows, size = [], 0
        for pdf in batches:
            texts = pdf["text"].tolist()
            has = pdf["doc_id"].notna().to_numpy()
            keys = pdf["doc_id"].fillna(0).astype("int64").to_numpy()
            for cut in slices(texts):
                ids, counts = encoder.encode(texts[cut])
                ends = np.cumsum(counts)
                for k, (a, b) in enumerate(zip((ends - counts).tolist(), ends.tolist()), cut.start):
                    key = (int(keys[k]), bool(has[k]))
                    seen = seen + 1 if key == last else 0
                    last = key
                    rows.append((*key, seen, np.append(ids[a:b], np.uint32(END_ID))))
                    size += b - a + 1
                    if size >= BLOCK_IDS:
                        yield _block(shard, block, rows)
                        rows, size, block = [], 0, block + 1
        if rows:
            yield _block(shard, block, rows)
    return encode


def write_token_files(docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id",
                      text_col: str = "text") -> None:
    """Write every document's ids, in ascending id order, under ``path``."""
    shards = shuffle_partitions(docs.sparkSession)
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(F.col(text_col)).alias("text"))
    (rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")
     .mapInPandas(_encode_shard(vocabulary), BLOCK_SCHEMA)
     .write.option("compression", "zstd").parquet(path))


def read_directory(spark: SparkSession, path: str) -> DataFrame:
    """A row per document as found in the files: key, place, and the crc32 of
    its ids; the payload itself stays in the task that reads it."""
    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                ends = np.cumsum(r.lengths)
                starts = ends - r.lengths
                body = memoryview(r.ids)
                yield pd.DataFrame({
                    "shard": r.shard, "block": r.block, "offset": starts,
                    "doc_id": pd.array(np.where(r.has_id, r.doc_ids, 0), "Int64"), "has_id": r.has_id,
                    "occurrence": r.occurrences, "n_tokens": r.lengths,
                    "crc": [zlib.crc32(body[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]})
    return spark.read.schema(BLOCK_SCHEMA).parquet(path).mapInPandas(
        digest, "shard int, block int, offset long, doc_id long, has_id boolean, occurrence long, "
                "n_tokens long, crc long")


def block_starts(spark: SparkSession, path: str) -> DataFrame:
    """(shard, block, start): ids in all blocks before. Running sums inside a
    shard, plus one row per shard for the shards before it."""
    sizes = spark.read.schema(BLOCK_SCHEMA).parquet(path).select("shard", "block", "n_ids")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    inside = sizes.withColumn("inside", F.coalesce(
        F.sum("n_ids").over(before(Window.partitionBy("shard").orderBy("block"))), F.lit(0)))
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n"))       # one row per shard
    shards = shards.select("shard", F.coalesce(
        F.sum("n").over(before(Window.orderBy("shard"))), F.lit(0)).alias("base"))
    return inside.join(F.broadcast(shards), "shard").select(
        "shard", "block", (F.col("base") + F.col("inside")).alias("start"))


# -- minimal perfect hash ---------------------------------------------------

def _hash(h: np.ndarray, seed: int) -> np.ndarray:
    h = h ^ _U(((seed + 1) * 0x9E3779B97F4A7C15) & (2 ** 64 - 1))
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def key_hashes(ids: np.ndarray, has_id: np.ndarray, occurrence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits per key: two hashes that only equal keys share."""
    x = _hash(ids.astype(np.int64).view(_U), 1) + occurrence.astype(_U) * _U(2) + has_id.astype(_U)
    return _hash(x, 2), _hash(_hash(ids.astype(np.int64).view(_U), 3) ^ _hash(x, 4), 5)


def build_levels(h: np.ndarray) -> list[np.ndarray]:
    """Boolean levels of a minimal perfect hash over distinct hashes."""
    levels = []
    left = h
    while len(left):
        if len(levels) == MAX_LEVELS:
            raise ValueError("two keys share all 64 hash bits; use another seed")
        m = GAMMA * len(left)
        at = (_hash(left, 100 + len(levels)) % _U(m)).astype(np.int64)
        bits = np.bincount(at, minlength=m) == 1
        levels.append(bits)
        left = left[~bits[at]]
    return levels


def slots_of(h: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Slot of each hash, 0 to n - 1 for the n built keys, any slot or -1 for
    others."""
    out = np.full(len(h), -1, np.int64)
    base, open_ = 0, np.arange(len(h))
    for k, bits in enumerate(levels):
        at = (_hash(h[open_], 100 + k) % _U(len(bits))).astype(np.int64)
        hit = bits[at]
        rank = np.cumsum(bits) - 1
        out[open_[hit]] = base + rank[at[hit]]
        base += int(bits.sum())
        open_ = open_[~hit]
    return out


def _pack(levels: list[np.ndarray]) -> tuple[list[int], bytes]:
    return [len(b) for b in levels], b"".join(np.packbits(b).tobytes() for b in levels)


def _unpack(sizes, body: bytes) -> list[np.ndarray]:
    out, at = [], 0
    for n in sizes:
        step = (int(n) + 7) // 8
        out.append(np.unpackbits(np.frombuffer(body, np.uint8, step, at), count=int(n)).astype(bool))
        at += step
    return out


INDEX_SCHEMA = ("part long, level_sizes array<bigint>, levels binary, prints binary, shards binary, "
                "blocks binary, offsets binary, lengths binary")


def _part_of(parts: int):
    return F.pmod(F.xxhash64("doc_id", "occurrence"), F.lit(parts))


def build_index(directory: DataFrame, path: str) -> int:
    """Write the index of a directory under ``path``; returns its number of
    parts. One task per part, of about ``PART_KEYS`` keys."""
    parts = max(1, -(-directory.count() // PART_KEYS))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = key_hashes(pdf["doc_id"].fillna(0).to_numpy(), pdf["has_id"].to_numpy(bool), pdf["occurrence"].to_numpy())
        levels = build_levels(a)
        order = np.argsort(slots_of(a, levels))
        sizes, body = _pack(levels)
        column = lambda c, kind: pdf[c].to_numpy().astype(kind)[order].tobytes()
        return pd.DataFrame({
            "part": [pdf["part"].iloc[0]], "level_sizes": [np.array(sizes, np.int64)], "levels": [body],
            "prints": [(b & _U(0xFFFFFFFF)).astype("<u4")[order].tobytes()], "shards": [column("shard", "<i4")],
            "blocks": [column("block", "<i4")], "offsets": [column("offset", "<i8")],
            "lengths": [column("n_tokens", "<i8")]})

    (directory.select("doc_id", "has_id", "occurrence", "shard", "block", "offset", "n_tokens")
     .withColumn("part", _part_of(parts)).groupBy("part").applyInPandas(build, INDEX_SCHEMA).write.parquet(path))
    return parts


def look_up(keys: DataFrame, index: DataFrame, parts: int) -> DataFrame:
    """Places of (doc_id, occurrence) keys: shard, block, offset, length.
    Keys that were never written are left out, but for one in 2 ** 32."""
    def find(keys: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({c: [] for c in ("doc_id", "occurrence", "shard", "block", "offset", "length")})
        if not len(index) or not len(keys):
            return empty
        r = index.iloc[0]
        has = keys["doc_id"].notna().to_numpy()
        a, b = key_hashes(keys["doc_id"].fillna(0).to_numpy(), has, keys["occurrence"].to_numpy())
        slot = slots_of(a, _unpack(r.level_sizes, r.levels))
        prints = np.frombuffer(r.prints, "<u4")
        good = (slot >= 0) & (prints[slot] == (b & _U(0xFFFFFFFF)).astype("<u4"))
        slot = slot[good]
        return pd.DataFrame({
            "doc_id": keys["doc_id"][good].astype("Int64"), "occurrence": keys["occurrence"][good],
            "shard": np.frombuffer(r.shards, "<i4")[slot], "block": np.frombuffer(r.blocks, "<i4")[slot],
            "offset": np.frombuffer(r.offsets, "<i8")[slot], "length": np.frombuffer(r.lengths, "<i8")[slot]})

    placed = keys.select("doc_id", "occurrence").withColumn("part", _part_of(parts))
    return (placed.groupBy("part").cogroup(index.groupBy("part")).applyInPandas(
        find, "doc_id long, occurrence long, shard int, block int, offset long, length long"))


def token_ids_by_key(docs: DataFrame, vocabulary: str, folder: str | None = None, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Write the files and the index, then look every document up and return
    its place and the crc32 of the ids read from there. Runs jobs."""
    spark = docs.sparkSession
    folder = folder or f"{checkpoint_dir(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(docs, f"{folder}/ids", vocabulary, id_col, text_col)
    directory = read_directory(spark, f"{folder}/ids").checkpoint()
    parts = build_index(directory, f"{folder}/index")
    keys = (docs.groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.count(F.lit(1)).alias("n"))
            .select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("occurrence")))
    places = look_up(keys, spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index"), parts)
    found = places.join(directory.select("shard", "block", "offset", "n_tokens", "crc"), ["shard", "block", "offset"])
    return (found.join(block_starts(spark, f"{folder}/ids"), ["shard", "block"])
            .select(F.col("doc_id").alias(id_col), (F.col("start") + F.col("offset")).alias("start"),
                    "n_tokens", F.col("crc").alias("ids_crc32")))
