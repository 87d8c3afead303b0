"""Document fingerprints: one-permutation MinHash in packed low-order bits.

Every five-word shingle is hashed once. The top bits of the hash name one of
256 bins, each bin keeps its smallest hash, and an empty bin borrows from a
non-empty one by optimal densification (its own random probe sequence over the
bins, the same for every document). Of each bin the low 8 bits are kept, eight
bins to a 64-bit word, written as 512 hex digits. Two fingerprints agree by
chance in 1 of 256 bins, which the likeness corrects for.

Built-in functions only: hashes are one sorted array per document, in which
one sentinel per bin marks where the bin starts, so the bin minima are the
entries whose left neighbour lies in another bin.

Defined results: a text of one to four words is one shingle; a null or empty
text has no shingles, the fingerprint '' and likeness 1 to another empty text,
0 to any other. Equal texts have equal fingerprints. Repeated rows, also those
with equal or null ids, are separate rows: they are ordered by id (descending,
null last), then text. A table of one row is its own next document; an empty
table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bind, shuffle_partitions, text_or_empty, words_of

SHINGLE = 5
BINS = 256
BIN_SHIFT = 56          # the top 8 of 64 bits: the bin, signed
KEPT_BITS = 8
PROBES = 12             # random probes of an empty bin before its full order
SEED = 20_03
LOW = (1 << BIN_SHIFT) - 1
PER_WORD = 64 // KEPT_BITS
CUT_SAMPLE = 20_000     # ids sampled to place the range borders (balance only)


# Bin b of the sorted array is (b + 128) mod 256 of the hash's top byte, since
# longs sort by sign; the sentinel is the largest hash of its bin.
SENTINELS = [((b - BINS // 2) << BIN_SHIFT) | LOW for b in range(BINS)]


def _probe_table() -> list[list[int]]:
    rng = random.Random(SEED)
    return [[rng.randrange(BINS) for _ in range(BINS)] for _ in range(PROBES)]


def _shingle_hashes(words: Column) -> Column:
    n = F.greatest(F.size(words) - (SHINGLE - 1), F.lit(1))
    return F.when(F.size(words) > 0, F.transform(
        F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]))
    ).otherwise(F.array().cast("array<bigint>"))


def _bin_minima(hashes: Column) -> Column:
    """256 longs: the smallest hash of each bin, or the bin's sentinel."""
    def first_of_bins(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (
            F.shiftright(x, BIN_SHIFT) != F.shiftright(F.get(s, i - 1), BIN_SHIFT)))
    return bind(F.sort_array(F.concat(hashes, F.lit(SENTINELS).cast("array<bigint>"))), first_of_bins)


def _is_empty(x: Column) -> Column:
    return x.bitwiseAND(F.lit(LOW)) == LOW


def _low(x: Column) -> Column:
    return x.bitwiseAND(F.lit((1 << KEPT_BITS) - 1))


def _densified(minima: Column) -> Column:
    """Low bits of every bin, empty bins filled; all null without shingles."""
    table = F.array(*[F.lit(t).cast("array<int>") for t in _probe_table()])

    def fill(v: Column, probes: Column, filled: Column) -> Column:
        def borrow(i: Column) -> Column:
            def hit(p: int) -> Column:
                x = F.get(v, F.get(probes[p], i))
                return F.when(~_is_empty(x), _low(x))
            # a random order of the filled bins, each carrying its low bits
            order = F.array_min(F.transform(filled, lambda y: F.xxhash64(
                i, F.shiftright(y, BIN_SHIFT)).bitwiseAND(F.lit(-1 << KEPT_BITS)).bitwiseOR(_low(y))))
            return F.coalesce(*[hit(p) for p in range(PROBES)], _low(order))
        return F.transform(v, lambda x, i: F.when(_is_empty(x), borrow(i)).otherwise(_low(x)))

    return bind(minima, lambda v: bind(table, lambda t: bind(
        F.filter(v, lambda y: ~_is_empty(y)), lambda filled: fill(v, t, filled))))


def packed_fingerprint(text: Column) -> Column:
    """Array of 32 longs, eight bins each; null for a text without words."""
    def pack(d: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(BINS // PER_WORD - 1)), lambda g: F.aggregate(
            F.sequence(g * PER_WORD, g * PER_WORD + (PER_WORD - 1)), F.lit(0).cast("long"),
            lambda a, i: F.shiftleft(a, KEPT_BITS).bitwiseOR(F.get(d, i))))
    def of_words(w: Column) -> Column:
        return F.when(F.size(w) > 0, bind(_densified(_bin_minima(_shingle_hashes(w))), pack))
    return bind(words_of(text), of_words)


def as_hex(packed: Column) -> Column:
    return F.coalesce(F.array_join(F.transform(
        packed, lambda p: F.lower(F.lpad(F.hex(p), 16, "0"))), ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard estimate of two packed fingerprints, corrected for bins that
    agree by chance; between 0 and 1."""
    def differing(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)      # fold each byte's bits into its lowest one
        for k in (4, 2, 1):
            z = z.bitwiseOR(F.shiftrightunsigned(z, k))
        return F.bit_count(z.bitwiseAND(F.lit(int("01" * 8, 16))))
    apart = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda s, x: s + x)
    chance = 1.0 / (1 << KEPT_BITS)
    j = ((1 - apart / F.lit(float(BINS))) - chance) / (1 - chance)
    return (F.when(a.isNull() & b.isNull(), F.lit(1.0))
            .when(a.isNull() | b.isNull(), F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.0), j)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and hex ``fingerprint`` of every document."""
    return docs.select(id_col, as_hex(packed_fingerprint(F.col(text_col))).alias("fingerprint"))


def _id_ranges(docs: DataFrame, id_col: str, n_ranges: int) -> tuple[list, list[tuple]]:
    """Runs two small jobs over the id column: ascending cut points that split
    the ids into ranges of about equal size (from a bounded hash sample, which
    only balances the ranges), and the largest id of each non-empty range, both
    at most ``n_ranges`` values."""
    ids = docs.select(F.col(id_col).cast("long").alias("id"))
    n = ids.count()
    step = max(1, n // CUT_SAMPLE)
    sample = sorted(r.id for r in ids.where(F.pmod(F.xxhash64("id"), F.lit(step)) == 0)
                    .where(F.col("id").isNotNull()).distinct().collect())
    k = min(n_ranges, max(1, len(sample)))
    cuts = sorted({sample[len(sample) * i // k] for i in range(1, k)}) if sample else []
    heads = (ids.groupBy(range_of(F.col("id"), cuts).alias("r")).agg(F.max("id").alias("head")).collect())
    return cuts, sorted((r.r, r.head) for r in heads)


def range_of(id_col: Column, cuts: list) -> Column:
    """0 for ids of at least the last cut, growing as ids fall; null ids last."""
    if not cuts:
        return F.when(id_col.isNull(), F.lit(1)).otherwise(F.lit(0))
    def search(lo: int, hi: int) -> Column:   # number of cuts <= id, by halving
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(id_col >= F.lit(cuts[mid]), search(mid + 1, hi)).otherwise(search(lo, mid))
    return F.when(id_col.isNull(), F.lit(len(cuts) + 1)).otherwise(F.lit(len(cuts)) - search(0, len(cuts)))


def with_next_document(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       carried: dict[str, Column] | None = None) -> DataFrame:
    """Each document with its text, the next one's text (descending id, after
    the last the first) and the ``carried`` expressions of both.

    The ids are split into ranges; the first document of a range also travels,
    as a marked copy, to the range before it, so one window per range finds
    every successor and no range is larger than its share of the rows."""
    spark = docs.sparkSession
    cuts, heads = _id_ranges(docs, id_col, min(256, 2 * shuffle_partitions(spark)))
    targets = {}
    for k, (_, head) in enumerate(heads):
        targets[head] = heads[k - 1][0]        # of the first range: the last one
    base = docs.select(F.col(id_col).alias("__id"), F.col(id_col).cast("long").alias("__key"),
                       text_or_empty(F.col(text_col)).alias("__text"))
    own = range_of(F.col("__key"), cuts)
    copy_to = F.lit(None).cast("int")
    known = {h: t for h, t in targets.items() if h is not None}
    if known:
        ordered = sorted(known)
        def find(lo: int, hi: int) -> Column:
            if hi - lo == 1:
                return F.when(F.col("__key") == F.lit(ordered[lo]), F.lit(known[ordered[lo]]))
            mid = (lo + hi) // 2
            return F.when(F.col("__key") >= F.lit(ordered[mid]), find(mid, hi)).otherwise(find(lo, mid))
        copy_to = F.when(F.col("__key").isNotNull(), find(0, len(ordered)))
    if None in targets:
        copy_to = F.when(F.col("__key").isNull(), F.lit(targets[None])).otherwise(copy_to)
    places = F.array(F.struct(own.alias("range"), F.lit(False).alias("copy")),
                     F.struct(copy_to.alias("range"), F.lit(True).alias("copy")))
    carried = carried or {}
    rows = (base.select("__id", "__key", "__text", *[e.alias(c) for c, e in carried.items()],
                        F.explode(F.filter(places, lambda p: p["range"].isNotNull())).alias("__p"))
            .select("*", F.col("__p.range").alias("__range"), F.col("__p.copy").alias("__copy")).drop("__p"))
    order = Window.partitionBy("__range").orderBy(
        "__copy", F.col("__key").desc_nulls_last(), F.col("__text"))
    moved = ["__text", *carried]
    return (rows.select("*", *[F.lead(c).over(order).alias(f"next{c}" if c == "__text" else f"next_{c}")
                               for c in moved])
            .where(~F.col("__copy")))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text (the last third of
    its code points replaced by the first as many of the next document)."""
    spark_rows = with_next_document(docs, id_col, text_col, {"fp": packed_fingerprint(F.col("__text"))})
    n = F.char_length("__text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("__text"), F.lit(1), n - cut),
                      F.substring(F.col("next__text"), F.lit(1), cut))
    rows = (spark_rows.select(F.col("__id").alias(id_col), n.cast("long").alias("n_chars"), "fp", "next_fp",
                              edited.alias("__edited"))
            .select(id_col, "n_chars", "fp", "next_fp", F.sha2(F.col("__edited"), 256).alias("edited_sha256"),
                    packed_fingerprint(F.col("__edited")).alias("edited_fp")))
    return rows.select(id_col, "n_chars", "edited_sha256", as_hex(F.col("fp")).alias("fingerprint"),
                       as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
                       likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                       likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
