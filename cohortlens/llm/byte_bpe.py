"""Byte-level BPE by a global shuffle of distinct words.

Encoding. Blocks of texts are cut by the pre-token pattern into words with
their positions; a block keeps its positions as a compressed sequence of word
numbers and sends each distinct word once, packed by hash bucket. In a bucket
all blocks' packs meet, every distinct word is encoded once by the ranks, and
the ids go back to the blocks that asked, which put them together by position.
Decoding joins ids to the token-byte table (as many rows as the vocabulary) by
array index.

Defined results: null and empty texts have no ids and decode to no bytes;
special-token strings are ordinary text; very long words are encoded whole;
repeated rows are encoded each on its own; an empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .bpe import PieceEncoder, slices
from .common import settled, shuffle_partitions, text_batches, text_or_empty

BLOCK_CHARS = 32_000_000
BLOCK_SCHEMA = "block long, ids array<bigint>, has_id array<boolean>, counts array<bigint>, sequence binary, words binary"


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}


@lru_cache(maxsize=4)
def word_encoder(path: str) -> tiktoken.Encoding:
    """The ranks applied to a whole word, which is not cut any further."""
    return tiktoken.Encoding("words", pat_str=r"(?s:.+)", mergeable_ranks=load_ranks(path), special_tokens={})


@lru_cache(maxsize=4)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table: start, length and all bytes, by id."""
    ranks = load_ranks(path)
    size = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
    for t, r in ranks.items():
        size[r] = len(t)
    by_id = sorted(ranks.items(), key=lambda x: x[1])
    return np.cumsum(size) - size, size, np.frombuffer(b"".join(t for t, _ in by_id), np.uint8)


def _gather(start: np.ndarray, size: np.ndarray, values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The value runs of ``rows``, one after the other."""
    n = size[rows]
    first = np.cumsum(n) - n
    return values[np.repeat(start[rows] - first, n) + np.arange(int(n.sum()))]


def decode(ids: np.ndarray, path: str) -> bytes:
    return _gather(*token_bytes(path), ids).tobytes() if len(ids) else b""


# -- packs of words and of ids ----------------------------------------------

def _pack(sizes: np.ndarray, body: bytes) -> bytes:
    head = np.array([len(sizes)], "<i8").tobytes() + sizes.astype("<i8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + body)


def _unpack(blob: bytes) -> tuple[np.ndarray, bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    return np.frombuffer(raw, "<i8", n, 8), raw[8 + 8 * n:]


def _pack_words(words: list[str]) -> bytes:
    data = [w.encode() for w in words]
    return _pack(np.array([len(d) for d in data], np.int64), b"".join(data))


def _unpack_words(blob: bytes) -> list[str]:
    sizes, body = _unpack(blob)
    ends = np.cumsum(sizes)
    return [body[e - n:e].decode() for e, n in zip(ends.tolist(), sizes.tolist())]


# -- the three steps --------------------------------------------------------

class _Block:
    """A block being made: word numbers in order of first use, the sequence of
    word numbers of its texts so far, and their ids and counts."""

    def __init__(self, rx):
        self.number: dict[str, int] = {}
        number = self.number
        self.cutter = PieceEncoder(lambda pieces: [
            np.array([number.setdefault(w, len(number)) for w in rx.findall(p)], "<u4") for p in pieces])
        self.ids, self.has_id, self.counts, self.sequence, self.chars = [], [], [], [], 0

    def add(self, ids: pd.Series, texts: list[str]) -> None:
        found, n = self.cutter.encode(texts)
        self.sequence.append(found.astype("<u4"))
        self.counts.append(n)
        self.ids.append(ids.fillna(0).astype("int64").to_numpy())
        self.has_id.append(ids.notna().to_numpy())
        self.chars += sum(map(len, texts))

    def frame(self, block: int) -> pd.DataFrame:
        return pd.DataFrame({
            "block": [block], "ids": [np.concatenate(self.ids)], "has_id": [np.concatenate(self.has_id)],
            "counts": [np.concatenate(self.counts)],
            "sequence": [zstandard.ZstdCompressor(level=3).compress(np.concatenate(self.sequence).tobytes())],
            "words": [_pack_words(list(self.number))]})


def _block_maker(pattern: str):
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rx = regex.compile(pattern)
        part, k, block = TaskContext.get().partitionId(), 0, _Block(rx)
        for pdf in batches:
            texts = pdf["text"].tolist()
            for cut in slices(texts, 2_000_000):
                if block.chars >= BLOCK_CHARS:
                    yield block.frame((part << 32) | k)
                    k, block = k + 1, _Block(rx)
                block.add(pdf["doc_id"].iloc[cut], texts[cut])
        if block.ids:
            yield block.frame((part << 32) | k)
    return make


def _word_dealer(buckets: int):
    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                words = _unpack_words(r.words)
                if not words:
                    continue
                array = np.empty(len(words), object)
                array[:] = words
                bucket = (pd.util.hash_array(array, categorize=False) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                    yield pd.DataFrame({
                        "bucket": [int(bucket[part[0]])], "block": [r.block],
                        "numbers": [_pack(np.diff(part, prepend=0), b"")],
                        "words": [_pack_words([words[i] for i in part])]})
    return deal


def _bucket_encoder(path: str):
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = word_encoder(path)
        known: dict[str, bytes] = {}
        bucket = None
        for pdf in batches:
            for r in pdf.itertuples():
                if r.bucket != bucket:          # sorted: the words of a bucket come together
                    bucket, known = r.bucket, {}
                words = _unpack_words(r.words)
                for w in words:
                    if w not in known:
                        known[w] = np.array(encoder.encode_ordinary(w), "<u4").tobytes()
                found = [known[w] for w in words]
                yield pd.DataFrame({"block": [r.block], "numbers": [r.numbers], "found": [_pack(
                    np.array([len(b) // 4 for b in found], np.int64), b"".join(found))]})
    return encode


def _assembler(finish: Callable[[np.ndarray], dict]):
    def assemble(blocks: pd.DataFrame, packs: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in blocks.itertuples():
            numbers, sizes, bodies = [np.empty(0, np.int64)], [np.empty(0, np.int64)], []
            for p in packs.itertuples():
                numbers.append(np.cumsum(_unpack(p.numbers)[0]))
                n, body = _unpack(p.found)
                sizes.append(n)
                bodies.append(body)
            number, size = np.concatenate(numbers), np.concatenate(sizes)
            values = np.frombuffer(b"".join(bodies), "<u4")
            at = np.empty(len(number), np.int64)
            at[number] = np.arange(len(number))
            start = (np.cumsum(size) - size)[at]
            size = size[at]
            sequence = np.frombuffer(zstandard.ZstdDecompressor().decompress(r.sequence), "<u4") \
                if sum(r.counts) else np.empty(0, "<u4")
            ends = np.cumsum(r.counts)
            docs = [finish(_gather(start, size, values, sequence[e - n:e])) for e, n in zip(ends, r.counts)]
            rows = pd.DataFrame(docs)
            rows.insert(0, "doc_id", pd.array(np.asarray(r.ids), "Int64"))
            rows.loc[~np.asarray(r.has_id, bool), "doc_id"] = pd.NA
            out.append(rows)
        return pd.concat(out)
    return assemble


def _encoded(docs: DataFrame, path: str, pattern: str, finish, schema: str, id_col: str, text_col: str) -> DataFrame:
    partitions = shuffle_partitions(docs.sparkSession)
    text_batches(docs.sparkSession)
    checkpoint_dir(docs.sparkSession)
    # words are numbered as they come, so a repeated task must see the same rows in the same order
    rows = settled(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(F.col(text_col)).alias("text")))
    blocks = rows.mapInPandas(_block_maker(pattern), BLOCK_SCHEMA).repartition(partitions, "block")
    packs = (blocks.mapInPandas(_word_dealer(2 * partitions), "bucket long, block long, numbers binary, words binary")
             .repartition(partitions, "bucket").sortWithinPartitions("bucket")
             .mapInPandas(_bucket_encoder(path), "block long, numbers binary, found binary"))
    return (blocks.groupBy("block").cogroup(packs.groupBy("block"))
            .applyInPandas(_assembler(finish), f"doc_id long, {schema}").withColumnRenamed("doc_id", id_col))


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """id and ``ids``, the document's token ids as an array."""
    return _encoded(docs, path, pattern, lambda ids: {"ids": ids.astype(np.int64)}, "ids array<bigint>",
                    id_col, text_col)


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and the decoded ``bytes`` of every row of ids; null ids give none."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "bytes": [
                decode(np.asarray(x, np.int64), path) if x is not None else b"" for x in pdf["ids"]]})
    rows = encoded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInPandas(run, "id long, bytes binary").withColumnRenamed("id", id_col)


def token_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Per document the number of ids, the digest of the ids in decimal, and
    the digest of the bytes that they decode to."""
    def finish(ids: np.ndarray) -> dict:
        return {"n_tokens": len(ids),
                "ids_sha256": hashlib.sha256(" ".join(map(str, ids.tolist())).encode()).hexdigest(),
                "decoded_sha256": hashlib.sha256(decode(ids, path)).hexdigest()}
    return _encoded(docs, path, pattern, finish, "n_tokens long, ids_sha256 string, decoded_sha256 string",
                    id_col, text_col)
