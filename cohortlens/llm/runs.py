"""Periodic runs of words by suffix-tree LCE, and texts with the repeats cut.

A run is a stretch of words with smallest period q and a length of at least
max(12, 2q) that no neighbour extends. Runs of a document are found as follows.

1. Stretches. A run of length l has l - q >= 6 positions whose word stands
   again q further on, and l - q >= q, so each of its words lies in a six-word
   window that the document holds twice. Maximal stretches of such words hold
   every run whole, so the trees are built on these stretches alone, joined by
   separators that occur once.
2. Trees. Ukkonen's suffix trees of the text and of its reversal; an Euler
   tour of each and range minima over its depths give the longest common
   extension of two positions, to the right and to the left, in constant time.
3. Candidates. For the order of the words' numbers and for its reverse, the
   longest Lyndon word at each position (the distance to the next smaller
   suffix) is a candidate root; the root of every run is among them. A
   candidate extended in both directions to twice its length or more is a run.

All of this is per document, in map tasks without a shuffle; arrays grow with
the longest document only.

Defined results: words are the stretches between the six ASCII white-space
characters; a null or empty text has none, so no run, four nulls and the
digests of the empty text; a null id leaves the words of its text as they are;
repeated rows give equal rows; an empty table gives no rows. Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches, text_or_empty

MIN_LENGTH = 12
WINDOW = MIN_LENGTH // 2     # see step 1
TREE_WORDS = 30_000          # stretches of about so many words share a tree
CELL = 16                    # Euler tour depths per cell of the range minima

RUN_SCHEMA = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, " \
             "collapsed_sha256 string"


# -- suffix tree -------------------------------------------------------------

class SuffixTree:
    """Suffix tree of a list of small numbers whose last one occurs once.

    ``rank`` is the lexicographic rank of each suffix; ``common(i, j)`` the
    length of the longest common prefix of suffixes i and j (arrays)."""

    def __init__(self, text: list[int]):
        self.n = len(text)
        self._tour(*self._grow(text))

    def _grow(self, text):
        """Ukkonen's construction: edges by (node, first symbol)."""
        n, width = self.n, max(text) + 1
        first, stop, link, child = [0], [0], [0], {}
        node = edge = along = waiting = 0
        for i, c in enumerate(text):
            waiting += 1
            fresh = 0                                   # inner node that waits for its suffix link
            while waiting:
                if not along:
                    edge = i
                key = node * width + text[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(first)
                    first.append(i)
                    stop.append(n)
                    link.append(0)
                    if fresh:
                        link[fresh] = node
                        fresh = 0
                else:
                    size = min(stop[below], i + 1) - first[below]
                    if along >= size:
                        edge += size
                        along -= size
                        node = below
                        continue
                    if text[first[below] + along] == c:
                        along += 1
                        if fresh:
                            link[fresh] = node
                        break
                    inner = len(first)
                    at = first[below]
                    first += [at, i]
                    stop += [at + along, n]
                    link += [0, 0]
                    child[key] = inner
                    child[inner * width + c] = inner + 1
                    first[below] = at + along
                    child[inner * width + text[at + along]] = below
                    if fresh:
                        link[fresh] = inner
                    fresh = inner
                waiting -= 1
                if node:
                    node = link[node]
                elif along:
                    along -= 1
                    edge = i - waiting + 1
        return first, stop, child, width

    def _tour(self, first, stop, child, width):
        """Euler tour, children in the order of their first symbols."""
        nodes = len(first)
        keys = np.fromiter(child.keys(), np.int64, len(child))
        below = np.fromiter(child.values(), np.int64, len(child))
        order = np.argsort(keys)
        heads = np.searchsorted(keys[order] // width, np.arange(nodes + 1)).tolist()
        below = below[order].tolist()
        size = (np.array(stop) - np.array(first)).tolist()
        depths, suffixes, places = [0], [], []
        path, depth, ahead = [0], [0], heads[:-1]
        while path:
            v = path[-1]
            k = ahead[v]
            if k < heads[v + 1]:
                ahead[v] = k + 1
                w = below[k]
                d = depth[-1] + size[w]
                if heads[w] == heads[w + 1]:            # a leaf: there and back
                    suffixes.append(self.n - d)
                    places.append(len(depths))
                    depths += (d, depth[-1])
                else:
                    path.append(w)
                    depth.append(d)
                    depths.append(d)
            else:
                path.pop()
                depth.pop()
                if path:
                    depths.append(depth[-1])
        self.rank = np.empty(self.n, np.int64)
        self.rank[suffixes] = np.arange(self.n)
        self.place = np.empty(self.n, np.int64)
        self.place[suffixes] = places
        self._minima(np.array(depths, np.int32))

    def _minima(self, depths):
        """Minima from both ends of each cell, and a sparse table of cells."""
        cells = -(-len(depths) // CELL)
        grid = np.full(cells * CELL, np.iinfo(np.int32).max, np.int32)
        grid[:len(depths)] = depths
        grid = grid.reshape(cells, CELL)
        self.depths = grid.ravel()
        self.up_to = np.minimum.accumulate(grid, axis=1).ravel()
        self.from_ = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [grid.min(axis=1)]
        step = 1
        while 2 * step <= cells:
            t = self.table[-1]
            self.table.append(np.minimum(t[:-step], t[step:]))
            step *= 2

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Depth of the lowest common ancestor of leaves i != j."""
        a, b = self.place[i], self.place[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        x, y = a // CELL, b // CELL
        out = np.minimum(self.from_[a], self.up_to[b])
        far = np.flatnonzero(y - x > 1)
        if len(far):
            lo, hi = x[far] + 1, y[far]                 # whole cells between
            level = np.frexp((hi - lo).astype(np.float64))[1] - 1
            inner = np.empty(len(far), np.int32)
            for k in np.unique(level).tolist():
                on = level == k
                inner[on] = np.minimum(self.table[k][lo[on]], self.table[k][hi[on] - (1 << k)])
            out[far] = np.minimum(out[far], inner)
        same = np.flatnonzero(x == y)
        if len(same):
            lo, hi = a[same], b[same]
            least = self.depths[lo].copy()
            for k in range(1, CELL):
                at = np.minimum(lo + k, hi)
                least = np.minimum(least, self.depths[at])
            out[same] = least
        return out


def lyndon_lengths(rank: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each position: the distance to the
    next suffix of smaller rank, or to the end."""
    n = len(rank)
    out = [0] * n
    stack: list[int] = []
    for i in range(n - 1, -1, -1):
        r = rank[i]
        while stack and rank[stack[-1]] > r:
            stack.pop()
        out[i] = (stack[-1] if stack else n) - i
        stack.append(i)
    return out


def maximal_runs(text: np.ndarray) -> np.ndarray:
    """All maximal repetitions (start, length, period) of numbers 0, 1, ...;
    length is at least twice the period. Sorted, without repeats."""
    n = len(text)
    symbols = [*text.tolist(), int(text.max(initial=-1)) + 1]     # with an end that occurs once
    right = SuffixTree(symbols)
    left = SuffixTree([*symbols[:n][::-1], symbols[n]])
    found = []
    for rank in (right.rank, n - right.rank):
        period = np.array(lyndon_lengths(rank.tolist()), np.int64)[:n]
        at = np.flatnonzero(np.arange(n) + period < n)
        p = period[at]
        ahead = right.common(at, at + p).astype(np.int64)
        behind = np.zeros(len(at), np.int64)
        inner = at > 0
        i = at[inner]
        behind[inner] = left.common(n - i, n - i - p[inner])      # positions i - 1 and i + p - 1, reversed
        length = behind + p + ahead
        ok = length >= 2 * p
        found.append(np.stack([at[ok] - behind[ok], length[ok], p[ok]], axis=1))
    return np.unique(np.concatenate(found), axis=0)


# -- documents ---------------------------------------------------------------

def covered(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Words of a six-word window that stands twice or more in its document.
    Windows are compared by hash; a collision only adds words to look at."""
    n = len(words) - WINDOW + 1
    out = np.zeros(len(words), bool)
    if n < 2:
        return out
    mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(31)
    h = doc[:n].astype(np.uint64)
    for k in range(WINDOW):
        h = h * np.uint64(0xD6E8FEB86659FD93) + mixed[k:k + n]
    h ^= h >> np.uint64(32)
    whole = np.flatnonzero(doc[:n] == doc[WINDOW - 1:])
    order = whole[np.argsort(h[whole], kind="stable")]
    same = h[order[1:]] == h[order[:-1]]
    start = np.zeros(n, bool)
    start[order[1:][same]] = True
    start[order[:-1][same]] = True
    for k in range(WINDOW):
        out[k:k + n] |= start
    return out


def batch_runs(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Runs (start, length, period) of at least MIN_LENGTH words in a batch of
    documents: ``words`` numbers their words one after the other, ``doc`` is
    the number of each word's document. Sorted by start, then period."""
    on = covered(words, doc)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], on, [False]]).astype(np.int8)))
    cuts = np.flatnonzero(on[1:] & on[:-1] & (doc[1:] != doc[:-1])) + 1
    starts = np.sort(np.concatenate([edge[::2], cuts]))
    stops = np.sort(np.concatenate([edge[1::2], cuts]))
    long = stops - starts >= MIN_LENGTH
    stretches = list(zip(starts[long].tolist(), stops[long].tolist()))
    found, k = [np.empty((0, 3), np.int64)], 0
    while k < len(stretches):
        group, size = [], 0
        while k < len(stretches) and (not group or size + stretches[k][1] - stretches[k][0] <= TREE_WORDS):
            group.append(stretches[k])
            size += stretches[k][1] - stretches[k][0]
            k += 1
        _, text = np.unique(np.concatenate([words[a:b] for a, b in group]), return_inverse=True)
        lengths = np.array([b - a for a, b in group])
        ends = np.cumsum(lengths)
        joined = np.insert(text, ends[:-1], text.max() + 1 + np.arange(len(group) - 1))
        runs = maximal_runs(joined)
        runs = runs[runs[:, 1] >= MIN_LENGTH]
        begin = ends - lengths + np.arange(len(group))            # of each stretch in the joined text
        which = np.searchsorted(begin, runs[:, 0], side="right") - 1
        runs[:, 0] += np.array([a for a, _ in group])[which] - begin[which]
        found.append(runs)
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _document(words: list[bytes], order: np.ndarray | None, runs: np.ndarray) -> tuple:
    """Digest columns of one document; runs start inside the document."""
    n = len(words) if order is None else len(order)
    if not len(runs):
        kept = words if order is None else [words[i] for i in order.tolist()]
        return (0, None, None, None, None, hashlib.sha256(b"").hexdigest(),
                hashlib.sha256(b" ".join(kept)).hexdigest())
    start, length, period = runs[np.lexsort((runs[:, 2], runs[:, 0], -runs[:, 1]))[0]].tolist()
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    left = np.flatnonzero(np.cumsum(steps[:n]) == 0)
    if order is not None:
        left = order[left]
    listing = "".join(f"{a},{b},{c}\n" for a, b, c in runs.tolist())
    return (len(runs), start, length, period, 1000 * length // period,
            hashlib.sha256(listing.encode()).hexdigest(),
            hashlib.sha256(b" ".join([words[i] for i in left.tolist()])).hexdigest())


def document_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  reorder: Callable[[str | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """A row per document: number of runs, the longest run, and digests of all
    runs and of the text without the repeats.

    ``reorder(id, n)`` may give the text's words anew, as an array of word
    numbers (None: as they are); the id comes as its decimal text."""
    text_batches(docs.sparkSession)

    def find(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            ids = pdf["id"].tolist()
            texts = [bytes(t).split() for t in pdf["body"]]       # splits at the six ASCII separators only
            orders = [reorder(i, len(t)) if reorder else None for i, t in zip(ids, texts)]
            number: dict[bytes, int] = {}
            numbers = []
            for words, order in zip(texts, orders):
                one = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
                numbers.append(one if order is None else one[order])
            lengths = np.array([len(x) for x in numbers], np.int64)
            starts = np.cumsum(lengths) - lengths
            runs = batch_runs(np.concatenate([np.empty(0, np.int64), *numbers]),
                              np.repeat(np.arange(len(lengths)), lengths))
            at = np.searchsorted(runs[:, 0], np.append(starts, lengths.sum()))
            rows = []
            for k, (words, order) in enumerate(zip(texts, orders)):
                own = runs[at[k]:at[k + 1]].copy()
                own[:, 0] -= starts[k]
                rows.append(_document(words, order, own))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in RUN_SCHEMA.split(", ")])
            for c in ("start", "length", "period", "exponent_milli"):
                out[c] = pd.array(out[c], "Int64")
            out.insert(0, id_col, ids)
            yield out

    texts = docs.select(F.col(id_col).cast("string").alias("id"),
                        text_or_empty(F.col(text_col)).cast("binary").alias("body"))
    found = texts.mapInPandas(find, f"{id_col} string, {RUN_SCHEMA}")
    return found.withColumn(id_col, F.col(id_col).cast(docs.schema[id_col].dataType))


def planted_period(doc_id: str | None, n: int) -> np.ndarray | None:
    """Word order of the registered query: the words of one document in ten
    (by the crc32 of its id) repeat with a period from some word on."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(doc_id.encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i >= a, a + (i - a) % p, i)
