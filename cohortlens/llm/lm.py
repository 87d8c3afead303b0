"""Language-model scores by prediction by partial matching over bytes.

The model is a byte-context trie of order ``ORDER`` learned from the training
documents: a context of up to five bytes predicts the next byte, escaping to
the next shorter context with probability d / 2t (t occurrences of d distinct
symbols, method D: every symbol gives half an occurrence to the escape); symbols seen in the longer context are excluded
from the shorter one, and below order 0 the unseen bytes are equally likely.
Texts are lower-cased (A-Z), opened by five zero bytes and closed by the byte
0xFF, which UTF-8 never uses, so a text's score is the log10 probability of
exactly that text.

A text's score is a sum over its six-byte windows, so only distinct windows
travel: each block of texts (about ``BLOCK_CHARS``) lists its windows and words
once, packed and compressed by hash bucket. In a bucket the counts of all
blocks are added up; one grouped pass per suffix bucket turns window counts
into code lengths; back in the hash buckets these answer the blocks' packs one
after the other. No task holds the trie, or more of a bucket than its distinct
windows. Words take the same way for the base score.

Defined results: null and empty texts are scored as '' (one end token);
repeated rows are scored alike, each on its own; a null id counts as ''
for the fold; without training rows every byte costs log10(256); an empty
table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.frames import attach_row
from ..session import checkpoint_dir
from .common import crc_bucket, shuffle_partitions, text_batches, text_or_empty

ORDER = 5
END = b"\xff"
BLOCK_CHARS = 32_000_000      # text of one block
SLICE_BYTES = 2_000_000       # text worked on at once inside a block
ALPHABET = 256
SUFFIX_BYTES = 2              # contexts of at least this order meet in a bucket


# -- windows and words of a block -------------------------------------------

def window_codes(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The window ending at each byte (and at the end mark) of each text as an
    integer, and the index of its text."""
    data = np.frombuffer(b"".join(b"\0" * order + t + END for t in texts), np.uint8)
    n = len(data) - order
    codes = np.zeros(n, np.int64)
    for k in range(order + 1):
        codes = (codes << 8) | data[k:n + k]
    sizes = np.array([len(t) + 1 for t in texts])
    starts = np.cumsum(sizes + order) - (sizes + order)
    inside = np.ones(n, bool)
    for k in range(1, order + 1):
        inside[starts[1:] - k] = False
    return codes[inside], np.repeat(np.arange(len(texts)), sizes)


def words_of(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Words of each text and, as b'', its end; the index of each one's text.
    Splitting bytes uses just the six ASCII separators."""
    words, sizes = [], []
    for t in texts:
        part = t.split()
        part.append(b"")
        words += part
        sizes.append(len(part))
    return words, np.repeat(np.arange(len(texts)), sizes)


def _objects(values: list) -> np.ndarray:
    out = np.empty(len(values), object)
    out[:] = values
    return out


def _cuts(sizes: np.ndarray, most: int) -> Iterator[slice]:
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def _make_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    part, k = TaskContext.get().partitionId(), 0
    ids, has_id, held, sizes, body, chars = [], [], [], [], [], 0

    def block() -> pd.DataFrame:
        return pd.DataFrame({
            "block": [(part << 32) | k], "ids": [np.array(ids, np.int64)], "has_id": [np.array(has_id, bool)],
            "held": [np.array(held, bool)], "sizes": [np.array(sizes, np.int64)], "body": [_squeeze(b"".join(body))]})

    for pdf in batches:
        for i, ok, h, text in zip(pdf["doc_id"].fillna(0).astype("int64").tolist(), pdf["doc_id"].notna().tolist(),
                                  pdf["held"].tolist(), pdf["text"].tolist()):
            if chars and chars + len(text) > BLOCK_CHARS:
                yield block()
                k += 1
                ids, has_id, held, sizes, body, chars = [], [], [], [], [], 0
            data = text.encode("utf-8", "surrogatepass").lower()
            ids.append(i)
            has_id.append(ok)
            held.append(h)
            sizes.append(len(data))
            body.append(data)
            chars += len(text)
    if ids:
        yield block()


BLOCK_SCHEMA = ("block long, ids array<bigint>, has_id array<boolean>, held array<boolean>, "
                "sizes array<bigint>, body binary")


def text_blocks(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The texts in compressed blocks, checkpointed: block numbers and what is
    in a block are fixed from here on."""
    checkpoint_dir(docs.sparkSession)
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(F.col(text_col)).alias("text"),
                       held.alias("held"))
    return rows.mapInPandas(_make_blocks, BLOCK_SCHEMA).checkpoint()


def _texts(row) -> tuple[list[bytes], np.ndarray]:
    body = _unsqueeze(row.body) if row.sizes.sum() else b""
    ends = np.cumsum(row.sizes)
    return [body[e - n:e] for e, n in zip(ends.tolist(), row.sizes.tolist())], ends


def _distinct(row, cut_up, factorize) -> tuple[np.ndarray, np.ndarray]:
    """Distinct items of a block and their counts in its training texts."""
    texts, _ = _texts(row)
    trains = ~np.asarray(row.held, bool)
    found, counts = [], []
    for cut in _cuts(row.sizes, SLICE_BYTES):
        items, owner = cut_up(texts[cut])
        place, distinct = pd.factorize(factorize(items))
        found.append(distinct)
        counts.append(np.bincount(place[trains[cut][owner]], minlength=len(distinct)))
    place, distinct = pd.factorize(np.concatenate(found))
    return distinct, np.bincount(place, np.concatenate(counts)).astype(np.int64)


# -- packs: the items of one block (or of the answer) in one hash bucket ------

PACK_SCHEMA = "bucket long, answer boolean, block long, keys binary, amounts binary"


@lru_cache(maxsize=1)
def _zstd() -> tuple:
    """A worker's compressor and decompressor; making them costs more than a
    small pack."""
    return zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def _squeeze(data: bytes) -> bytes:
    return _zstd()[0].compress(data)


def _unsqueeze(data: bytes) -> bytes:
    return _zstd()[1].decompress(data)


def _pack_windows(windows: np.ndarray) -> bytes:
    return _squeeze(np.diff(windows, prepend=0).astype("<i8").tobytes())


def _unpack_windows(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(_unsqueeze(data), "<i8"))


def _pack_words(words) -> bytes:
    sizes = np.array([len(w) for w in words], "<i4")
    return _squeeze(np.array([len(sizes)], "<i4").tobytes() + sizes.tobytes() + b"".join(words))


def _unpack_words(data: bytes) -> list[bytes]:
    raw = _unsqueeze(data)
    n = int(np.frombuffer(raw, "<i4", 1)[0])
    ends = 4 + 4 * n + np.cumsum(np.frombuffer(raw, "<i4", n, 4))
    starts = np.concatenate([[4 + 4 * n], ends[:-1]]) if n else ends
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def _dealt(bucket: np.ndarray, key: np.ndarray, amounts: np.ndarray, pack, answer: bool, block: int) -> pd.DataFrame:
    """One pack per bucket; within a bucket the items are in the order given."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    parts = np.split(order, cuts) if len(order) else []
    return pd.DataFrame({
        "bucket": [int(bucket[p[0]]) for p in parts], "answer": answer, "block": block,
        "keys": [pack(key[p]) for p in parts], "amounts": [_squeeze(amounts[p].tobytes()) for p in parts]})


def _window_dealer(buckets: int):
    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples():
                windows, n = _distinct(row, window_codes, lambda x: x)
                order = np.argsort(windows)
                windows, n = windows[order], n[order]
                yield _dealt((_mix(windows) % np.uint64(buckets)).astype(np.int64), windows, n.astype("<i8"),
                             _pack_windows, False, row.block)
    return deal


def _word_dealer(buckets: int):
    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples():
                words, n = _distinct(row, words_of, _objects)
                bucket = np.array([zlib.crc32(w) for w in words], np.int64) % buckets
                yield _dealt(bucket, words, n.astype("<i8"), _pack_words, False, row.block)
    return deal


def _by_bucket(packs: DataFrame) -> DataFrame:
    """Packs of a bucket together, the answer before the blocks' packs."""
    return (packs.repartition(shuffle_partitions(packs.sparkSession), "bucket")
            .sortWithinPartitions("bucket", F.desc("answer")))


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """The packs of sorted batches one by one, each with whether its bucket is
    new."""
    last = None
    for pdf in batches:
        for row in pdf.itertuples():
            yield row, row.bucket != last
            last = row.bucket


def _count_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    keys, amounts, held = [], [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        return distinct, np.bincount(at, np.concatenate(amounts)).astype(np.int64)

    for row, new in _runs(batches):
        if new and keys:
            distinct, n = merged()
            yield pd.DataFrame({"window": distinct, "n": n})
            keys, amounts, held = [], [], 0
        keys.append(_unpack_windows(row.keys))
        amounts.append(np.frombuffer(_unsqueeze(row.amounts), "<i8"))
        held += len(keys[-1])
        if held > 1_000_000 and len(keys) > 1:      # fold what repeats
            distinct, n = merged()
            keys, amounts, held = [distinct], [n], 0
    if keys:
        distinct, n = merged()
        yield pd.DataFrame({"window": distinct, "n": n})


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def answer(bucket: int, total: dict[bytes, int]) -> pd.DataFrame:
        n = np.fromiter(total.values(), "<i8", len(total))
        return pd.DataFrame({"bucket": [bucket], "answer": [True], "block": [-1], "keys": [_pack_words(list(total))],
                             "amounts": [_squeeze(n.tobytes())], "tokens": [int(n.sum())],
                             "known": [int((n > 0).sum())]})
    total: dict[bytes, int] = {}
    bucket = None
    for row, new in _runs(batches):
        if new:
            if bucket is not None:
                yield answer(bucket, total)
            bucket, total = row.bucket, {}
        for w, n in zip(_unpack_words(row.keys), np.frombuffer(_unsqueeze(row.amounts), "<i8").tolist()):
            total[w] = total.get(w, 0) + n
    if bucket is not None:
        yield answer(bucket, total)


def _answer_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    keys, values, table = [], [], None
    for row, new in _runs(batches):
        if new:
            keys, values, table = [], [], None
        if row.answer:
            keys.append(_unpack_windows(row.keys))
            values.append(np.frombuffer(_unsqueeze(row.amounts), "<f8"))
            continue
        if table is None:
            known = np.concatenate(keys)
            order = np.argsort(known)
            table = known[order], np.concatenate(values)[order]
        found = table[1][np.searchsorted(table[0], _unpack_windows(row.keys))]
        yield pd.DataFrame({"block": [row.block], "is_word": [False], "keys": [row.keys],
                            "amounts": [_squeeze(found.astype("<f8").tobytes())]})


def _answer_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    table: dict[bytes, int] = {}
    for row, _ in _runs(batches):
        if row.answer:
            table = dict(zip(_unpack_words(row.keys), np.frombuffer(_unsqueeze(row.amounts), "<i8").tolist()))
            continue
        found = np.array([table[w] for w in _unpack_words(row.keys)], "<i8")
        yield pd.DataFrame({"block": [row.block], "is_word": [True], "keys": [row.keys],
                            "amounts": [_squeeze(found.tobytes())]})


REPLY_SCHEMA = "block long, is_word boolean, keys binary, amounts binary"


# -- the trie ---------------------------------------------------------------

def code_lengths(windows: np.ndarray, counts: np.ndarray, pairs: np.ndarray, order: int = ORDER) -> np.ndarray:
    """log10 probability of each window's last byte after the others.

    ``windows`` must be distinct and hold every window of their two-byte
    suffix contexts (a bucket); ``pairs[a, b]`` counts byte b after byte a over
    the whole training text and serves the contexts of order 1 and 0."""
    symbol = windows & 0xFF
    count, total, kinds, excluded = {}, {}, {}, {}
    for j in range(order, SUFFIX_BYTES - 1, -1):
        key = windows & ((1 << 8 * (j + 1)) - 1)
        distinct, at = np.unique(key, return_inverse=True)
        c = np.bincount(at, counts)
        context, of_key = np.unique(distinct >> 8, return_inverse=True)
        count[j] = c[at]
        total[j] = np.bincount(of_key, c)[of_key][at]
        kinds[j] = np.bincount(of_key, c > 0)[of_key][at]
        # what a context's symbols weigh in the next shorter context
        short = windows & ((1 << 8 * j) - 1)
        if j > SUFFIX_BYTES:
            s_distinct, s_at = np.unique(short, return_inverse=True)
            weight = np.bincount(s_at, counts)[s_at]
        else:
            weight = pairs[(windows >> 8) & 0xFF, symbol]
        first = np.zeros(len(distinct))
        first[at] = weight
        excluded[j - 1] = np.bincount(of_key, first * (c > 0))[of_key][at]
    last = (windows >> 8) & 0xFF
    single = pairs.sum(axis=0)
    count[1], total[1], kinds[1] = pairs[last, symbol], pairs.sum(axis=1)[last], (pairs > 0).sum(axis=1)[last]
    count[0], total[0], kinds[0] = single[symbol], np.full(len(windows), single.sum()), \
        np.full(len(windows), (single > 0).sum())
    excluded[0] = ((pairs > 0) * single[None, :]).sum(axis=1)[last]

    out = np.zeros(len(windows))
    open_ = np.ones(len(windows), bool)
    for j in range(order, -1, -1):
        t, d = total[j].astype(float), kinds[j].astype(float)
        if j < order:
            t, d = t - excluded[j], d - kinds[j + 1]
        act = open_ & (t > 0)
        half = np.where(kinds[j] < ALPHABET, 0.5, 0.0)       # nothing to escape to: no escape
        seen = act & (count[j] > 0)
        out[seen] += np.log10((count[j] - half)[seen] / t[seen])
        miss = act & ~seen
        out[miss] += np.log10(d[miss] / (2 * t)[miss])
        open_ &= ~seen
    out[open_] -= np.log10(ALPHABET - kinds[0][open_])
    return out


def _buckets(spark) -> int:
    return 2 * shuffle_partitions(spark)


def window_packs(blocks: DataFrame) -> DataFrame:
    return blocks.mapInPandas(_window_dealer(_buckets(blocks.sparkSession)), PACK_SCHEMA)


def window_scores(packs: DataFrame) -> DataFrame:
    """Packs of the scores of all windows of the blocks' packs; counts come
    from the training texts only. Runs jobs; the counts are checkpointed."""
    spark = packs.sparkSession
    counts = _by_bucket(packs).mapInPandas(_count_windows, "window long, n long").checkpoint()
    pairs = np.zeros((ALPHABET, ALPHABET))
    for r in (counts.where("n > 0").groupBy(F.col("window").bitwiseAND(F.lit(0xFFFF)).alias("pair"))
              .agg(F.sum("n").alias("n")).collect()):           # 65,536 rows at most
        pairs[r.pair >> 8, r.pair & 0xFF] = r.n
    buckets = _buckets(spark)

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        windows, at = np.unique(pdf["window"].to_numpy(), return_index=True)
        value = code_lengths(windows, pdf["n"].to_numpy()[at], pairs)
        return _dealt((_mix(windows) % np.uint64(buckets)).astype(np.int64), windows, value.astype("<f8"),
                      _pack_windows, True, -1)

    suffix = F.shiftright("window", 8).bitwiseAND(F.lit((1 << 8 * SUFFIX_BYTES) - 1))
    return (counts.withColumn("suffixes", F.pmod(F.xxhash64(suffix), F.lit(2 * buckets)))
            .groupBy("suffixes").applyInPandas(score, PACK_SCHEMA))


# -- scores of documents ----------------------------------------------------

def _score_block(blocks: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
    out = []
    known, value, count = [np.empty(0, np.int64)], [np.empty(0)], {}
    for r in replies.itertuples():
        if r.is_word:
            count.update(zip(_unpack_words(r.keys), np.frombuffer(_unsqueeze(r.amounts), "<i8").tolist()))
        else:
            known.append(_unpack_windows(r.keys))
            value.append(np.frombuffer(_unsqueeze(r.amounts), "<f8"))
    known, value = np.concatenate(known), np.concatenate(value)
    order = np.argsort(known)
    known, value = known[order], value[order]
    for row in blocks.itertuples():
        texts, _ = _texts(row)
        for cut in _cuts(row.sizes, SLICE_BYTES):
            part = texts[cut]
            codes, owner = window_codes(part)
            place, distinct = pd.factorize(codes)
            score = np.bincount(owner, value[np.searchsorted(known, distinct)][place], minlength=len(part))
            words, owner = words_of(part)
            place, distinct = pd.factorize(_objects(words))
            c = np.array([count[w] for w in distinct])
            out.append(pd.DataFrame({
                "doc_id": pd.array(np.asarray(row.ids)[cut], "Int64"), "held_out": np.asarray(row.held, bool)[cut],
                "n_tokens": np.bincount(owner, minlength=len(part)),
                "n_known": np.bincount(owner, (c > 0)[place], minlength=len(part)).astype(np.int64),
                "log_counts": np.bincount(owner, np.log10(c + 0.1)[place], minlength=len(part)),
                "score": score}))
            out[-1].loc[~np.asarray(row.has_id, bool)[cut], "doc_id"] = pd.NA
    return pd.concat(out)


def document_scores(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: fold, token counts, the unigram base score and the
    model's log10 probability; rows where ``held`` is true are not learned."""
    blocks = text_blocks(docs, held, id_col, text_col)
    windows = window_packs(blocks).checkpoint()          # read for the counts and for the answers
    scores = _by_bucket(window_scores(windows).union(windows)).mapInPandas(_answer_windows, REPLY_SCHEMA)
    words = blocks.mapInPandas(_word_dealer(_buckets(docs.sparkSession)), PACK_SCHEMA).checkpoint()
    counts = _by_bucket(words).mapInPandas(_count_words, PACK_SCHEMA + ", tokens long, known long").checkpoint()
    totals = counts.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("train_tokens"),
                        F.coalesce(F.sum("known"), F.lit(0)).alias("train_words"))
    answers = _by_bucket(counts.drop("tokens", "known").union(words)).mapInPandas(_answer_words, REPLY_SCHEMA)
    table = scores.union(answers)
    rows = (blocks.groupBy("block").cogroup(table.groupBy("block")).applyInPandas(
        _score_block, "doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, score double"))
    base = F.col("log_counts") - F.col("n_tokens") * F.log10(F.col("train_tokens") + 0.1 * (F.col("train_words") + 1))
    return attach_row(rows, totals).select(
        F.col("doc_id").alias(id_col), "held_out", "n_tokens", "n_known", F.col("train_tokens").cast("long"),
        base.alias("base_score"), "score")


def held_out_fold(doc_id: Column, folds: int = 10) -> Column:
    return crc_bucket(doc_id, folds) == 0
