"""Removal of repeated 50-byte strings by merged Burrows-Wheeler transforms.

A byte goes when a 50-byte string that covers it also starts in a document with
a smaller id. The strings of a corpus do not fit one suffix array, so they are
dealt to buckets in which equal strings always meet, and each bucket is merged
from the transforms of its shards.

1. Blocks. Documents are written once, in blocks of about ``BLOCK_BYTES``.
2. Anchors. The anchor of a window (50 bytes) is the least hash of its 24-byte
   strings, so equal windows have equal anchors. Consecutive windows with one
   anchor form a context. An anchor that only one document holds rules its
   windows out: blocks send the prints of their distinct anchors, dealt to
   buckets by hash, and get back one bit for each. An anchor is there once per
   block, however often the block holds it.
3. Contexts. Blocks send each distinct context under a shared anchor once, with
   its places and the smallest and largest id that hold it. The anchor decides
   the bucket; contexts of an anchor with very many of them are cut into single
   windows that a hash of the window deals out, so that no anchor fills a
   bucket.
4. Merge, bucket by bucket. Contexts are dealt into shards of bounded size. A
   shard's rotations are sorted by their first 50 bytes, which gives its
   transform. The shards' transforms are then interleaved: in each round the
   rows are moved, stably, under the pair of bytes in front of them, so that
   after k rounds the rows of all shards stand in the order of their first 2 k
   bytes, without comparing or sorting suffixes again. (Rows that no whole
   window can come from, because too few or too many bytes follow, are left
   out.) Where two neighbours of one interval come apart in a round, their
   common prefix ends; intervals left whole after 25 rounds are the repeated
   50-byte strings. The smallest id in an interval decides for all its windows.
5. Removal. Answers go back to the blocks, which cut their documents.

No stage holds more than a block, or a bucket. What travels between blocks and
buckets is packed, one row per pair of them, because rows per anchor or
context would take more disk than the texts.

Defined results: null and empty texts have no bytes; ids are compared as
numbers, a null id counts as the greatest 64-bit number; documents with equal
ids, repeated rows included, do not remove each other's bytes; bytes that are
not UTF-8 are repaired by make_valid_utf8 first; an empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import text_batches, text_or_empty

WIDTH = 50                   # bytes of a string that counts as repeated
ANCHOR = 24                  # bytes of an anchor
MAX_WINDOWS = 64             # windows of one context
BLOCK_BYTES = 8_000_000
SLICE_BYTES = 1 << 17        # window starts hashed at once
ANCHORS_PER_BUCKET = 2_000_000
ANCHOR_DENSITY = 0.07        # anchors per byte, about
BUCKET_SHARE = 4_000_000     # corpus bytes for which there is one bucket of contexts
SHARD_BYTES = 256_000
HOT_CONTEXTS = 20_000        # contexts of an anchor beyond which its windows are dealt out singly
PRINT_BITS = 40
END = 255                    # ends a context; no byte of UTF-8
NO_ID = 2 ** 63 - 1
_U = np.uint64
_STEP = 0x9E3779B97F4A7C15   # odd, so it has an inverse modulo 2 ** 64
BLOCK_SCHEMA = "block long, ids array<bigint>, no_id array<boolean>, lengths array<bigint>, body binary"
PRINT_SCHEMA = "bucket long, block long, prints binary, loads binary"
FLAG_SCHEMA = "block long, bucket long, shared binary, hot binary"
CONTEXT_SCHEMA = ("bucket long, block long, sizes binary, texts binary, least binary, greatest binary, "
                  "counts binary, places binary")
ANSWER_SCHEMA = "block long, counts binary, places binary, least binary, windows binary, has_own binary, own binary"


def _pack(values: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(values).astype(kind).tobytes()


def _unpack(column, kind: str) -> np.ndarray:
    """One array of the packed arrays of a column, row after row."""
    return np.frombuffer(b"".join(column), kind).astype(np.int64)


# -- blocks ------------------------------------------------------------------

def cut_blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Blocks of whole documents: ids, lengths, and all bytes, compressed."""
    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base, number, rows, size = TaskContext.get().partitionId() << 32, 0, [], 0

        def block():
            return pd.DataFrame({
                "block": [base + number], "ids": [[NO_ID if i is None else int(i) for i, _ in rows]],
                "no_id": [[i is None for i, _ in rows]], "lengths": [[len(t) for _, t in rows]],
                "body": [pa.compress(b"".join(t for _, t in rows), "zstd", asbytes=True)]})
        for pdf in parts:
            for i, t in zip(pdf["id"], pdf["body"]):
                rows.append((i, bytes(t)))
                size += len(t)
                if size >= BLOCK_BYTES:
                    yield block()
                    number, rows, size = number + 1, [], 0
        if rows:
            yield block()

    text = F.expr("make_valid_utf8(t)").cast("binary")
    return (docs.select(F.col(id_col).cast("long").cast("string").alias("id"), text_or_empty(F.col(text_col)).alias("t"))
            .select("id", text.alias("body")).mapInPandas(cut, BLOCK_SCHEMA))


class Block:
    """A block row opened: bytes, and the first byte and end of each document."""

    def __init__(self, row):
        self.lengths = np.asarray(row.lengths, np.int64)
        self.ids = np.asarray(row.ids, np.int64)
        self.ends = np.cumsum(self.lengths)
        size = int(self.ends[-1])
        self.raw = pa.decompress(row.body, size, "zstd", asbytes=True) if size else b""
        self.bytes = np.frombuffer(self.raw, np.uint8)

    def segments(self):
        """(starts, windows, anchors, hashes of the contexts), slice by slice."""
        n = len(self.bytes)
        for a in range(0, max(0, n - WIDTH + 1), SLICE_BYTES):
            b = min(a + SLICE_BYTES, n - WIDTH + 1)
            yield self._slice(a, b)

    def _slice(self, a, b):
        prefix = Hashes(self.bytes[a:b + WIDTH - 1])
        least = _mix(prefix.of_width(ANCHOR))
        m, span = 1, WIDTH - ANCHOR + 1
        while 2 * m <= span:
            least = np.minimum(least[:-m], least[m:])
            m *= 2
        if m < span:
            least = np.minimum(least[:m - span], least[span - m:])
        doc = np.searchsorted(self.ends, np.arange(a, b, 1 << 12), side="right")   # few documents per step
        limit = np.empty(b - a, np.int64)
        for k, d in enumerate(doc.tolist()):
            lo, hi = k << 12, min((k + 1) << 12, b - a)
            last = int(doc[k + 1]) if k + 1 < len(doc) else len(self.ends) - 1
            if last == d:
                limit[lo:hi] = self.ends[d]
            else:
                limit[lo:hi] = self.ends[np.searchsorted(self.ends, np.arange(a + lo, a + hi), side="right")]
        whole = np.arange(a, b) + WIDTH <= limit
        change = np.empty(b - a, bool)
        change[:1] = True
        change[1:] = (least[1:] != least[:-1]) | (whole[1:] != whole[:-1])
        starts = np.flatnonzero(change)
        sizes = np.diff(np.append(starts, b - a))
        on = whole[starts]
        starts, sizes = starts[on], sizes[on]
        if len(sizes) and sizes.max() > MAX_WINDOWS:
            pieces = -(-sizes // MAX_WINDOWS)
            first = np.repeat(np.cumsum(pieces) - pieces, pieces)
            inside = np.arange(pieces.sum()) - first
            starts = np.repeat(starts, pieces) + inside * MAX_WINDOWS
            sizes = np.minimum(np.repeat(sizes, pieces) - inside * MAX_WINDOWS, MAX_WINDOWS)
        return a + starts, sizes, least[starts], prefix.between(starts, starts + sizes + WIDTH - 1)


def _powers(step: int, n: int) -> np.ndarray:
    out = np.full(n, step, _U)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Hashes:
    """Polynomial hashes of all substrings of a byte array, modulo 2 ** 64."""
    _cache: list = []

    def __init__(self, text: np.ndarray):
        n = len(text) + 1
        if not self._cache or len(self._cache[0]) < n:
            self._cache[:] = [_powers(_STEP, n), _powers(pow(_STEP, -1, 2 ** 64), n)]
        up, self.down = self._cache[0][:n], self._cache[1][:n]
        table = _mix(np.arange(1, 257, dtype=_U))
        self.sums = np.zeros(n, _U)
        np.cumsum(table[text] * up[:-1], out=self.sums[1:])

    def of_width(self, k: int) -> np.ndarray:
        return (self.sums[k:] - self.sums[:-k]) * self.down[:len(self.sums) - k]

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.sums[b] - self.sums[a]) * self.down[a]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


# -- anchors and contexts ----------------------------------------------------

def _keys(anchor: np.ndarray, buckets: int) -> np.ndarray:
    """(bucket, print) of anchors as one number, in order of the bucket."""
    m = _U(buckets)
    return (anchor % m) << _U(PRINT_BITS) | (anchor // m) & _U((1 << PRINT_BITS) - 1)


def _cuts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of sorted keys, and where each starts (and the last ends)."""
    bucket = (keys >> _U(PRINT_BITS)).astype(np.int64)
    at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(keys) else np.empty(0, np.int64)
    return bucket[at], np.append(at, len(keys))


def anchor_prints(blocks: DataFrame, buckets: int) -> DataFrame:
    """A row per block and bucket: the prints of the block's distinct anchors,
    in order; a load is twice an anchor's distinct contexts in the block, and
    one more if several documents of the block hold it."""
    def report(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for row in pdf.itertuples():
                block = Block(row)
                found = list(block.segments())
                if not found:
                    continue
                starts, _, anchor, context = (np.concatenate(x) for x in zip(*found))
                keys = _keys(anchor, buckets)
                order = np.argsort(keys)
                keys = keys[order]
                head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
                count = np.diff(np.append(head, len(keys)))
                load = np.full(len(head), 2, np.int64)
                more = np.repeat(count > 1, count)         # the few anchors with several places
                which, order = np.repeat(np.arange(len(head)), count)[more], order[more]
                if len(which):
                    same = np.lexsort((context[order], which))
                    which, order = which[same], order[same]
                    new = np.append(True, (which[1:] != which[:-1]) | (context[order][1:] != context[order][:-1]))
                    doc = np.searchsorted(block.ends, starts[order], side="right")
                    at = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
                    several = np.minimum.reduceat(doc, at) != np.maximum.reduceat(doc, at)
                    load[which[at]] = np.minimum(2 * np.add.reduceat(new.astype(np.int64), at), 65_000) + several
                keys = keys[head]
                names, cuts = _cuts(keys)
                prints = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :PRINT_BITS // 8]
                yield pd.DataFrame({
                    "bucket": names, "block": row.block,
                    "prints": [prints[a:b].tobytes() for a, b in zip(cuts, cuts[1:])],
                    "loads": [_pack(load[a:b], "<u2") for a, b in zip(cuts, cuts[1:])]})

    return blocks.mapInPandas(report, PRINT_SCHEMA)


def flag_anchors(pdf: pd.DataFrame, hot_contexts: int) -> pd.DataFrame:
    """A bucket's prints to bits: held by two documents or more, and hot."""
    prints = np.frombuffer(b"".join(pdf["prints"]), np.uint8).reshape(-1, PRINT_BITS // 8)
    wide = np.zeros((len(prints), 8), np.uint8)
    wide[:, :PRINT_BITS // 8] = prints
    key = wide.view("<u8").ravel()
    load = _unpack(pdf["loads"], "<u2")
    order = np.argsort(key)
    head = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
    size = np.diff(np.append(head, len(key)))
    holders = np.add.reduceat(1 + load[order] % 2, head)
    shared, hot = np.empty(len(key), bool), np.empty(len(key), bool)
    shared[order] = np.repeat(holders > 1, size)
    hot[order] = np.repeat(np.add.reduceat(load[order] // 2, head) > hot_contexts, size)
    ends = np.cumsum([len(x) // 2 for x in pdf["loads"]]).tolist()
    parts = list(zip([0, *ends], ends))
    return pd.DataFrame({
        "block": pdf["block"], "bucket": pdf["bucket"], "shared": [np.packbits(shared[a:b]).tobytes() for a, b in parts],
        "hot": [np.packbits(hot[a:b]).tobytes() if hot[a:b].any() else None for a, b in parts]})


def contexts(blocks: DataFrame, flags: DataFrame, anchor_buckets: int, buckets: int) -> DataFrame:
    """A row per block and bucket: the block's distinct contexts (or windows)
    of shared anchors that go there."""
    names = [c.split()[0] for c in CONTEXT_SCHEMA.split(", ")]

    def send(blocks: pd.DataFrame, flags: pd.DataFrame) -> pd.DataFrame:
        if not len(blocks) or not len(flags):
            return pd.DataFrame({c: [] for c in names})
        row = next(blocks.itertuples())
        block = Block(row)
        starts, sizes, anchor, _ = (np.concatenate(x) for x in zip(*block.segments()))
        keys, place = np.unique(_keys(anchor, anchor_buckets), return_inverse=True)
        shared, hot = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        flags = flags.set_index("bucket")
        for name, a, b in zip(*(lambda n, c: (n.tolist(), c, c[1:]))(*_cuts(keys))):
            shared[a:b] = np.unpackbits(np.frombuffer(flags.at[name, "shared"], np.uint8), count=b - a)
            if flags.at[name, "hot"] is not None:
                hot[a:b] = np.unpackbits(np.frombuffer(flags.at[name, "hot"], np.uint8), count=b - a)
        on = shared[place]
        starts, sizes, route, hot = starts[on], sizes[on], anchor[on], hot[place][on]
        if hot.any():                                    # windows of hot anchors travel alone
            n = sizes[hot]
            single = np.repeat(starts[hot], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            own = np.array([int.from_bytes(hashlib.blake2b(block.raw[s:s + WIDTH], digest_size=8).digest(), "little")
                            for s in single.tolist()], _U)
            starts = np.concatenate([starts[~hot], single])
            route = np.concatenate([route[~hot], own])
            sizes = np.concatenate([sizes[~hot], np.ones(len(single), np.int64)])
        if not len(starts):
            return pd.DataFrame({c: [] for c in names})
        number: dict[bytes, int] = {}
        raw = block.raw
        group = np.array([number.setdefault(raw[s:e], len(number))
                          for s, e in zip(starts.tolist(), (starts + sizes + WIDTH - 1).tolist())], np.int64)
        texts = list(number)
        order = np.argsort(group, kind="stable")
        at = np.searchsorted(group[order], np.arange(len(texts) + 1))
        ids = block.ids[np.searchsorted(block.ends, starts, side="right")][order]
        least, greatest = np.minimum.reduceat(ids, at[:-1]), np.maximum.reduceat(ids, at[:-1])
        bucket = (route[order][at[:-1]] % _U(buckets)).astype(np.int64)
        counts = np.diff(at)
        by = np.argsort(bucket, kind="stable")           # contexts in the order of their buckets
        cuts = np.flatnonzero(np.append(True, bucket[by][1:] != bucket[by][:-1]))
        # places follow their contexts
        first = at[:-1][by]
        run = np.repeat(first - np.append(0, np.cumsum(counts[by])[:-1]), counts[by]) + np.arange(len(order))
        places, ends = starts[order][run], np.append(0, np.cumsum(counts[by]))
        rows = []
        for a, b in zip(cuts, np.append(cuts[1:], len(by))):
            mine = by[a:b]
            part = [texts[k] for k in mine.tolist()]
            rows.append((bucket[mine[0]], row.block, _pack(np.array([len(t) for t in part]), "<u2"),
                         pa.compress(b"".join(part), "zstd", asbytes=True), _pack(least[mine], "<i8"),
                         _pack(greatest[mine], "<i8"), _pack(counts[mine], "<u4"),
                         _pack(places[ends[a]:ends[b]], "<u4")))
        return pd.DataFrame(rows, columns=names)

    return blocks.groupBy("block").cogroup(flags.groupBy("block")).applyInPandas(send, CONTEXT_SCHEMA)


# -- shard transforms and their merge ----------------------------------------

class ShardTransform:
    """Transform of a shard: its contexts, each closed by END and read as a
    ring, with all rotations sorted by their first ``WIDTH`` bytes."""

    def __init__(self, texts: list[bytes]):
        joined = np.frombuffer(bytes([END]).join(texts) + bytes([END]), np.uint8)
        n = len(joined)
        lengths = np.array([len(t) + 1 for t in texts])
        ends = np.cumsum(lengths)
        ahead = np.arange(1, n + 1)
        ahead[ends - 1] = ends - lengths
        behind = np.arange(-1, n - 1)
        behind[ends - lengths] = ends - 1
        self.rows = self._sort(joined, ahead)            # start of each row's rotation
        place = np.empty(n, np.int64)
        place[self.rows] = np.arange(n)
        pair = joined[behind[behind]].astype(np.uint16) << np.uint16(8) | joined[behind]
        self.pairs = pair[self.rows]                     # the two bytes in front of each row
        self.up = place[behind[behind][self.rows]]       # row of the rotation that starts with them

    @staticmethod
    def _sort(joined, ahead):
        key, width = joined.astype(_U), 1
        while width < 8:                                 # the first eight bytes as one number
            key = key << _U(8 * width) | key[ahead]
            ahead = ahead[ahead]
            width *= 2
        while True:
            order = np.argsort(key)
            sorted_ = key[order]
            rank = np.empty(len(key), _U)
            rank[order] = np.cumsum(np.append(False, sorted_[1:] != sorted_[:-1])).astype(_U)
            if width >= WIDTH:
                return order
            key = rank << _U(32) | rank[ahead]
            ahead = ahead[ahead]
            width *= 2


def merge_transforms(shards: list[ShardTransform], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of whole windows (texts one after the other, each with its
    END) in the order of the windows, and the interval of equal ones each
    stands in; windows that occur once may be left out. ``lengths`` are those
    of the texts, END included."""
    offsets = np.cumsum([0] + [len(s.rows) for s in shards[:-1]])
    pairs = np.concatenate([s.pairs for s in shards])
    up = np.concatenate([s.up + o for s, o in zip(shards, offsets)]).astype(np.int32)
    place = np.concatenate([s.rows + o for s, o in zip(shards, offsets)])
    inside = np.arange(len(pairs)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    rows = np.flatnonzero(inside[place] >= WIDTH).astype(np.int32)     # a whole window ends in front of these
    interval = np.zeros(len(rows), np.int32)
    for _ in range(WIDTH // 2):
        front = pairs[rows]
        order = np.argsort(front, kind="stable")         # radix sort of 16-bit numbers
        front, interval = front[order], interval[order]
        head = np.ones(len(rows) + 1, bool)              # where an interval starts
        np.not_equal(front[1:], front[:-1], out=head[1:-1])
        head[1:-1] |= interval[1:] != interval[:-1]
        interval = np.cumsum(head[:-1], dtype=np.int32)
        rows = up[rows[order]]
        alone = head[:-1] & head[1:]
        if 10 * np.count_nonzero(alone) > len(rows):     # an interval of one row is not repeated
            rows, interval = rows[~alone], interval[~alone]
    return place[rows], interval


def repeated_windows(texts: list[bytes], least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For distinct contexts with their smallest ids: a flag per byte, one
    context after the other, set where a window starts that a smaller id has;
    and the first byte of each context."""
    shards, starts, at, part, size = [], [], 0, [], 0
    for t in texts:
        starts.append(at)
        at += len(t) + 1
        part.append(t)
        size += len(t)
        if size >= SHARD_BYTES:
            shards.append(ShardTransform(part))
            part, size = [], 0
    if part:
        shards.append(ShardTransform(part))
    starts = np.array(starts)
    lengths = np.array([len(t) + 1 for t in texts])
    place, interval = merge_transforms(shards, lengths)
    flags = np.zeros(at, bool)
    if not len(place):
        return flags, starts
    owner = np.repeat(np.arange(len(texts)), lengths)[place]
    head = np.flatnonzero(np.append(True, interval[1:] != interval[:-1]))
    smallest = np.minimum.reduceat(least[owner], head)
    smallest = np.repeat(smallest, np.diff(np.append(head, len(owner))))
    flags[place] = smallest < least[owner]
    return flags, starts


def answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """A bucket's contexts to answers: the smallest id that holds the context,
    and the windows that this document itself loses (``own``, as bits)."""
    number: dict[bytes, int] = {}
    group, rows = [], []
    for sizes, body in zip(pdf["sizes"], pdf["texts"]):
        sizes = np.frombuffer(sizes, "<u2").astype(np.int64)
        ends = np.cumsum(sizes)
        raw = pa.decompress(body, int(ends[-1]), "zstd", asbytes=True)
        group += [number.setdefault(raw[a:b], len(number)) for a, b in zip((ends - sizes).tolist(), ends.tolist())]
        rows.append(len(sizes))
    group = np.array(group)
    texts = list(number)
    least = np.full(len(texts), NO_ID, np.int64)
    np.minimum.at(least, group, _unpack(pdf["least"], "<i8"))
    flags, starts = repeated_windows(texts, least)
    windows = np.array([len(t) - WIDTH + 1 for t in texts])
    total = np.append(0, np.cumsum(flags))
    has_own = total[starts + windows] > total[starts]
    bits = {g: np.packbits(flags[starts[g]:starts[g] + windows[g]]).tobytes() for g in np.flatnonzero(has_own).tolist()}
    useful = has_own[group] | (_unpack(pdf["greatest"], "<i8") > least[group])
    counts, places = _unpack(pdf["counts"], "<u4"), _unpack(pdf["places"], "<u4")
    ends = np.cumsum(rows)
    out = []
    stops = np.append(0, np.cumsum(counts))
    for block, a, b in zip(pdf["block"].tolist(), (ends - rows).tolist(), ends.tolist()):
        on = np.flatnonzero(useful[a:b]) + a
        if len(on):
            mine = group[on]
            kept = np.repeat(useful[a:b], counts[a:b])
            out.append((block, _pack(counts[on], "<u4"), _pack(places[stops[a]:stops[b]][kept], "<u4"),
                        _pack(least[mine], "<i8"), _pack(windows[mine], "<u2"), _pack(has_own[mine], "u1"),
                        b"".join(bits[g] for g in mine[has_own[mine]].tolist())))
    return pd.DataFrame(out, columns=[c.split()[0] for c in ANSWER_SCHEMA.split(", ")])


# -- removal -----------------------------------------------------------------

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def cut_documents(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """Result rows of one block."""
    row = next(blocks.itertuples())
    block = Block(row)
    n = len(block.bytes)
    edge = np.zeros(n + 1, np.int64)
    if len(answers):
        place = _unpack(answers["places"], "<u4")
        counts = _unpack(answers["counts"], "<u4")
        windows = _unpack(answers["windows"], "<u2")
        has_own = _unpack(answers["has_own"], "u1").astype(bool)
        bits = b"".join(answers["own"])
        width = np.where(has_own, (windows + 7) // 8, 0)
        first = np.cumsum(width) - width
        which = np.repeat(np.arange(len(counts)), counts)
        copy = block.ids[np.searchsorted(block.ends, place, side="right")] > _unpack(answers["least"], "<i8")[which]
        np.add.at(edge, place[copy], 1)
        np.add.at(edge, place[copy] + windows[which[copy]] + WIDTH - 1, -1)
        for k in np.flatnonzero(~copy & has_own[which]).tolist():
            w = which[k]
            flags = np.unpackbits(np.frombuffer(bits, np.uint8, width[w], first[w]), count=windows[w])
            at = np.flatnonzero(flags) + place[k]
            edge[at] += 1
            edge[at + WIDTH] -= 1
    gone = np.cumsum(edge[:n]) > 0
    starts = block.ends - block.lengths
    rise = gone.copy()
    rise[1:] &= ~gone[:-1]
    inner = starts[starts < n]
    rise[inner] = gone[inner]
    removed = np.append(0, np.cumsum(gone))
    spans = np.append(0, np.cumsum(rise))
    kept = block.bytes[~gone].tobytes()
    a, b = starts - removed[starts], block.ends - removed[block.ends]
    ids = pd.array(block.ids, "Int64")
    ids[np.asarray(row.no_id, bool)] = pd.NA
    return pd.DataFrame({
        "doc_id": ids, "n_bytes": block.lengths, "n_removed": removed[block.ends] - removed[starts],
        "n_spans": spans[block.ends] - spans[starts],
        "kept_sha256": [hashlib.sha256(kept[x:y]).hexdigest() for x, y in zip(a.tolist(), b.tolist())]})


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: its bytes, the bytes and spans removed, and the
    digest of what is left. Runs jobs: blocks are checkpointed."""
    checkpoint_dir(docs.sparkSession)
    text_batches(docs.sparkSession)
    blocks = cut_blocks(docs, id_col, text_col).checkpoint()
    total = blocks.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b))).first()[0] or 0
    anchor_buckets = 1 + int(total * ANCHOR_DENSITY) // ANCHORS_PER_BUCKET
    hot = HOT_CONTEXTS
    flags = (anchor_prints(blocks, anchor_buckets).groupBy("bucket")
             .applyInPandas(lambda pdf: flag_anchors(pdf, hot), FLAG_SCHEMA))
    found = contexts(blocks, flags, anchor_buckets, 1 + total // BUCKET_SHARE)
    answers = found.groupBy("bucket").applyInPandas(answer, ANSWER_SCHEMA)
    cut = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(cut_documents, RESULT)
    return cut.withColumnRenamed("doc_id", id_col)
