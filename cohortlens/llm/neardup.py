"""N-gram Jaccard join: a MinHash LSH forest with exact verification.

1. Sketch. Each text becomes the set of its five-word shingles. Texts with
   equal sets form one entry (a grouped aggregation, so copies never pair up),
   which gets one label per tree: a sequence of min-hash symbols.
2. Forest. Ordered by label, a tree is a prefix trie. The matched prefix starts
   at the full label and is shortened one symbol at a time until a pair at the
   threshold is found in at least one tree with the target recall. On each
   level the entries under one trie node are linked to the node's smallest
   entry (a star, not all pairs), which alone goes on to the next level; the
   links' connected components are the candidate groups.
3. Verification. All pairs inside a candidate group are compared exactly. A
   large group is cut into blocks of bounded size and each pair of blocks is a
   task of its own that returns counts per entry, so neither the pairs nor the
   whole group ever stand in one place.

The result has a row per document: its class (smallest id connected by links)
and its number of links, copies included.

Defined results: a text of one to four words is one shingle; a text without
words (null, empty) has no links and is its own class; repeated rows count as
copies; rows with a null id take part and a class of only such rows has a null
class id; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import WORD, fresh, shuffle_partitions, text_batches, text_or_empty
from .components import components

SHINGLE = 5
THRESHOLD = 0.8
TREES, DEPTH = 20, 6
TARGET_RECALL = 0.999
SYMBOL_BYTES = 2
BLOCK_ENTRIES, BLOCK_SHINGLES = 512, 400_000   # bounds of one side of a task
SEED = 7

_WORD = re.compile(WORD)
_U = np.uint64


def matched_prefix(threshold: float, recall: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """Longest prefix, shortening from the full label, at which a pair of the
    given similarity shares a node of some tree with at least this recall; two
    symbols at least, for which ``forest_trees`` may then need more trees."""
    for k in range(depth, 2, -1):
        if 1 - (1 - threshold ** k) ** trees >= recall:
            return k
    return min(2, depth)


def forest_trees(threshold: float, recall: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """Trees that reach the recall at the matched prefix: ``trees``, or more."""
    k = matched_prefix(threshold, recall, trees, depth)
    if not 0 < threshold < 1 or not 0 < recall < 1:
        return trees
    return max(trees, math.ceil(math.log(1 - recall) / math.log1p(-threshold ** k)))


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(33))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    words = [_WORD.findall(t) for t in texts]
    sizes = np.array([len(w) for w in words])
    flat = np.array([x for w in words for x in w], dtype=object)
    if not len(flat):
        return [np.empty(0, _U)] * len(texts)
    codes, distinct = pd.factorize(flat)
    h = pd.util.hash_array(np.asarray(distinct, dtype=object), categorize=False)[codes]
    n = len(h)
    padded = np.concatenate([h, np.zeros(SHINGLE, _U)])
    acc = padded[:n].copy()
    for k in range(1, SHINGLE):
        acc = _mix(acc) + padded[k:n + k]
    acc = _mix(acc)
    out, at = [], 0
    for size in sizes:
        if size >= SHINGLE:
            out.append(np.unique(acc[at:at + size - SHINGLE + 1]))
        elif size:
            one = np.array([size], _U)
            for x in h[at:at + size]:
                one = _mix(one + x)
            out.append(one)
        else:
            out.append(np.empty(0, _U))
        at += size
    return out


def _slices(texts: list[str], most: int = 2_000_000) -> Iterator[slice]:
    start = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > most:
            yield slice(start, i)
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def _labels(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> list[bytes]:
    out = []
    for s in sets:
        low = np.full(len(a), ~_U(0))
        for k in range(0, len(s), 2048):
            low = np.minimum(low, (s[k:k + 2048, None] * a + b).min(axis=0))
        out.append(_mix(low).astype(">u8").view("u1").reshape(-1, 8)[:, :SYMBOL_BYTES].tobytes())
    return out


def _sketcher(trees: int, depth: int):
    rng = np.random.default_rng(SEED)
    a = rng.integers(0, 2 ** 63, trees * depth).astype(_U) * _U(2) + _U(1)
    b = rng.integers(0, 2 ** 63, trees * depth).astype(_U)

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for part in _slices(texts):
                sets = shingle_sets(texts[part])
                keys = [np.array([_mix(s).sum(dtype=_U), np.bitwise_xor.reduce(_mix(s + _U(1)))], _U).tobytes()
                        if len(s) else None for s in sets]
                yield pd.DataFrame({"doc_id": pdf["doc_id"].iloc[part], "hash": pdf["hash"].iloc[part],
                                    "key": keys, "n": [len(s) for s in sets], "labels": _labels(sets, a, b)})
    return sketch


def _groups_of(links: np.ndarray) -> np.ndarray:
    """Smallest member index of each row's component in a boolean matrix."""
    root = np.full(len(links), -1)
    for i in range(len(links)):
        if root[i] >= 0:
            continue
        frontier = np.zeros(len(links), bool)
        frontier[i] = True
        seen = frontier.copy()
        while frontier.any():
            frontier = links[frontier].any(axis=0) & ~seen
            seen |= frontier
        root[seen] = i
    return root


def similar_pairs(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Boolean matrix of the pairs whose Jaccard similarity reaches the
    threshold. Shared shingles are counted by products of 0/1 column blocks."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets], float)
    codes, _ = pd.factorize(np.concatenate(sets))
    rows = np.repeat(np.arange(m), sizes.astype(int))
    often = np.bincount(codes)
    shared = often[codes] > 1
    place = np.cumsum(often > 1) - 1
    rows, cols = rows[shared], place[codes[shared]]
    order = np.argsort(cols, kind="stable")
    rows, cols = rows[order], cols[order]
    both = np.zeros((m, m), np.float64)
    width = max(256, min(8192, 4_000_000 // m))
    for k in range(0, int(cols[-1]) + 1 if len(cols) else 0, width):
        lo, hi = np.searchsorted(cols, [k, k + width])
        x = np.zeros((m, width), np.float32)
        x[rows[lo:hi], cols[lo:hi] - k] = 1
        both += x @ x.T
    union = sizes[:, None] + sizes[None, :] - both
    linked = both >= threshold * union - 1e-9 * union
    np.fill_diagonal(linked, False)
    return linked


def _verifier(threshold: float):
    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, g in pdf.groupby(["root", "lo", "hi"], sort=False):
            texts = g["text"].tolist()
            sets = [s for part in _slices(texts) for s in shingle_sets(texts[part])]
            linked = similar_pairs(sets, threshold)
            side = g["block"].to_numpy() == g["lo"].to_numpy()
            if g["lo"].iloc[0] != g["hi"].iloc[0]:      # two blocks: only pairs across
                linked &= side[:, None] != side[None, :]
            copies, keys = g["copies"].to_numpy(), g["key"].tolist()
            root = _groups_of(linked)
            out.append(pd.DataFrame({"key": keys, "links": linked @ copies, "near": [keys[r] for r in root]}))
        return pd.concat(out) if out else pd.DataFrame({"key": [], "links": [], "near": []})
    return verify


def forest_edges(entries: DataFrame, trees: int, shortest: int) -> DataFrame:
    """(a, b): links of entries (key, labels) that share a trie node of at
    least ``shortest`` symbols in some tree. The tries are walked from the full
    labels up: entries under one node are linked to its least entry, which alone
    stands for the node one symbol further up, where only nodes that part there
    are linked. Every node of that depth ends up connected; the entries of a
    node meet once, however many levels it has."""
    width = DEPTH * SYMBOL_BYTES
    # a label with its tree in front
    leaf = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.concat(
        F.unhex(F.lpad(F.hex(t), 4, "0")), F.substring("labels", t * width + 1, F.lit(width))))
    level = entries.select(F.col("key").alias("entry"), F.explode(leaf).alias("label"))
    edges = None
    for depth in range(DEPTH, shortest - 1, -1):
        level = level.select("entry", F.substring("label", 1, 2 + depth * SYMBOL_BYTES).alias("label"))
        nodes = level.groupBy("label").agg(F.min("entry").alias("least"), F.max("entry").alias("last"))
        links = (level.join(nodes.where("least != last").select("label", "least"), "label")
                 .where("entry != least").select(F.col("entry").alias("a"), F.col("least").alias("b")))
        edges = links if edges is None else edges.union(links)
        level = nodes.select(F.col("least").alias("entry"), "label")
    return edges


def _joined(docs: DataFrame, threshold: float, recall: float, id_col: str,
            text_col: str) -> tuple[DataFrame, DataFrame, bool]:
    """Sketches (doc_id, hash, key, n) of all rows; per key its copies, links
    to other keys, first row, class id and the class's first row; whether some
    (id, text) comes up twice."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    text_batches(spark)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(F.col(text_col)).alias("text"))
    base = base.withColumn("hash", F.xxhash64("text"))
    trees = forest_trees(threshold, recall)
    sketches = base.mapInPandas(
        _sketcher(trees, DEPTH), "doc_id long, hash long, key binary, n int, labels binary").checkpoint()
    entries = (sketches.where("n > 0").groupBy("key")
               .agg(F.min(F.struct("doc_id", "hash")).alias("first"), F.count(F.lit(1)).alias("copies"),
                    F.max("n").alias("n"), F.max("labels").alias("labels"),
                    F.min("doc_id").alias("least_id")).checkpoint())

    groups = components(forest_edges(entries, trees, matched_prefix(threshold, recall)))

    # exact verification of each group, in pairs of bounded blocks
    members = groups.join(entries.drop("labels").withColumnRenamed("key", "vertex"), "vertex")
    sizes = (members.groupBy("root").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("shingles"))
             .select("root", F.greatest(F.ceil(F.col("m") / BLOCK_ENTRIES),
                                        F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks")))
    members = (members.join(sizes, "root")
               .select(F.col("vertex").alias("key"), "root", "copies", "blocks", F.col("first.doc_id").alias("doc_id"),
                       F.col("first.hash").alias("hash"),
                       F.pmod(F.xxhash64("vertex"), F.col("blocks")).cast("int").alias("block")))
    texts = (base.alias("d").join(members.alias("m"), F.col("d.doc_id").eqNullSafe(F.col("m.doc_id"))
                                  & (F.col("d.hash") == F.col("m.hash")))
             .select("m.key", "m.root", "m.copies", "m.blocks", "m.block", "d.text"))
    repeated = bool(sketches.groupBy("doc_id", "hash").count().where("count > 1").head(1))
    texts = texts.dropDuplicates(["key"]) if repeated else texts
    tasks = (texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", "root", "copies", "block", "text",
                     F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "blocks")
             .withColumn("task", F.when(F.col("blocks") > 1, F.xxhash64("root", "lo", "hi"))
                         .otherwise(F.pmod(F.xxhash64("root"), F.lit(4 * shuffle_partitions(spark))))))
    verified = (tasks.select("task", "key", "root", "copies", "block", "lo", "hi", "text")
                .groupBy("task").applyInPandas(_verifier(threshold), "key binary, links long, near binary")
                .checkpoint())
    classes = components(verified.select(F.col("key").alias("a"), F.col("near").alias("b")))
    links = verified.groupBy("key").agg(F.sum("links").alias("links"))

    per_entry = (entries.select("key", "copies", "first", "least_id").join(links, "key", "left")
                 .join(classes.withColumnRenamed("vertex", "key"), "key", "left")
                 .select("key", "copies", "first", "least_id", F.coalesce("links", F.lit(0)).alias("links"), "root"))
    least = (per_entry.where("root is not null").groupBy("root")
             .agg(F.min("least_id").alias("class_id"), F.min("first").alias("kept")))
    per_entry = (per_entry.join(least, "root", "left")
                 .select("key", "copies", "links", "first", F.coalesce("kept", "first").alias("kept"),
                         F.coalesce("class_id", "least_id").alias("class_id")))
    return sketches, per_entry, repeated


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id, n_copies (rows with the same shingles, itself
    included) and n_links (other rows with similarity of at least the
    threshold). Runs jobs; sketches and edges are checkpointed."""
    sketches, per_entry, _ = _joined(docs, threshold, recall, id_col, text_col)
    return (sketches.select("doc_id", "key").join(per_entry, "key", "left")
            .select(F.col("doc_id").alias(id_col),
                    F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
                    F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links")))


def keep_one_of_each(docs: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each class the row with the smallest id (null first), with its own
    columns; rows without words are all kept."""
    _, per_entry, repeated = _joined(docs, threshold, recall, id_col, text_col)
    own_id, own_hash = fresh(docs, "__id"), fresh(docs, "__hash")
    kept = per_entry.where("first = kept").select(
        F.col("kept.doc_id").alias(own_id), F.col("kept.hash").alias(own_hash))
    text = text_or_empty(F.col(text_col))
    worded = docs.where(text.rlike(WORD))
    if repeated:
        worded = worded.dropDuplicates([id_col, text_col])
    found = worded.join(kept, F.col(id_col).cast("long").eqNullSafe(F.col(own_id))
                        & (F.xxhash64(text) == F.col(own_hash)), "left_semi")
    return found.unionByName(docs.where(~text.rlike(WORD)))
