"""URL rules by a Bloom filter cascade.

A rule is a host and a path prefix with a verdict. A url's candidate keys are
its host and each parent domain, combined with the beginnings of its path that
are as long as some rule's path; the distinct candidates of all urls are the
complete key universe. Per verdict a cascade is built over it: level 1 encodes
the listed keys that occur, level 2 the other keys that level 1 lets through,
level 3 the listed keys that level 2 lets through, and so on until no key is
told wrongly. For keys of the universe, membership is then exact, and urls are
judged by bit tests alone, with no join: the
longest listed candidate (key, then host) decides.

A cascade is a few bits per listed key, and ``MAX_FILTER_BYTES`` bounds what is
sent to the tasks; beyond it the distinct (host, path) pairs are joined with the
rule list instead, with the same result.

Defined results: a null url, or one without '://', has an empty host and path
and matches no rule; urls that match no rule get the default verdict; of rules
with the same key the first one counts; repeated rows are judged alike, each on
its own; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir

MAX_FILTER_BYTES = 64 << 20
LATER_RATE = 0.5          # false positive rate of the levels after the first
MAX_LEVELS = 64
_U = np.uint64


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


def parse_rule(verdict: str, text: str) -> Rule:
    host, slash, rest = text.partition("/")
    return Rule(verdict, host.lower(), slash + rest)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url, '' where there is none."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def candidate_keys(host: Column, path: Column, path_lengths: list[int]) -> Column:
    """The keys under which a rule could fit, longest first; a host's parents
    start after its dots."""
    labels = F.split(host, r"\.")
    hosts = F.transform(F.sequence(F.lit(0), F.size(labels) - 1), lambda i: F.array_join(
        F.filter(labels, lambda x, k: k >= i), "."))
    beginnings = F.filter(F.array(*[F.when(F.char_length(path) >= n, F.substring(path, 1, n))
                                    for n in sorted(set(path_lengths))]), lambda x: x.isNotNull())
    both = F.flatten(F.transform(beginnings, lambda p: F.transform(hosts, lambda h: F.struct(
        (F.char_length(h) + F.char_length(p)).alias("n"), F.char_length(h).alias("m"),
        F.concat(h, p).alias("key")))))
    keys = F.transform(F.sort_array(both, asc=False), lambda x: x["key"])
    return F.when(F.char_length(host) > 0, keys).otherwise(F.array().cast("array<string>"))


# -- the cascade ------------------------------------------------------------

def _positions(h1: np.ndarray, h2: np.ndarray, level: int, bits: int, hashes: int) -> np.ndarray:
    """``hashes`` bit positions per key at a level, by double hashing."""
    with np.errstate(over="ignore"):
        a = (h1 ^ _U(level * 0x9E3779B97F4A7C15 & (2 ** 64 - 1))) * _U(0xFF51AFD7ED558CCD)
        a ^= a >> _U(29)
        b = (h2 + _U(level)) * _U(0xC4CEB9FE1A85EC53) | _U(1)
        steps = np.arange(hashes, dtype=np.uint64)
        return ((a[:, None] + steps[None, :] * b[:, None]) % _U(bits)).astype(np.int64)


@dataclass
class Level:
    bits: int
    hashes: int
    body: np.ndarray

    def holds(self, h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
        at = _positions(h1, h2, level, self.bits, self.hashes)
        return ((self.body[at >> 3] >> (at & 7)) & 1).all(axis=1)


@dataclass
class Cascade:
    """Bloom filters of alternate levels; exact on the universe it was built
    over."""
    levels: list[Level] = field(default_factory=list)

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        answer = np.zeros(len(h1), bool)
        open_ = np.arange(len(h1))
        for k, level in enumerate(self.levels):
            hit = level.holds(h1[open_], h2[open_], k)
            # turned away at level k: not of the kind that level k encodes
            answer[open_[~hit]] = k % 2 == 1
            open_ = open_[hit]
        answer[open_] = len(self.levels) % 2 == 1
        return answer


def hashes_of(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit("second"), key)


def filter_size(n: int, rate: float) -> tuple[int, int]:
    bits = max(64, math.ceil(-n * math.log(rate) / math.log(2) ** 2))
    return bits, max(1, round(bits / max(n, 1) * math.log(2)))


def _bloom(keys: DataFrame, n: int, rate: float, level: int) -> Level:
    """A filter of ``n`` keys: tasks emit bit positions by byte, bytes are
    or-ed before and after the shuffle, and the filter itself is collected."""
    bits, hashes = filter_size(n, rate)

    def set_bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at = _positions(pdf["h1"].to_numpy().view(_U), pdf["h2"].to_numpy().view(_U), level, bits, hashes).ravel()
            yield pd.DataFrame({"byte": at >> 3, "mask": (1 << (at & 7)).astype(np.int32)})

    body = np.zeros((bits + 7) // 8, np.uint8)
    rows = keys.select("h1", "h2").mapInPandas(set_bits, "byte long, mask int")
    for r in rows.groupBy("byte").agg(F.bit_or("mask").alias("mask")).toLocalIterator():
        body[r.byte] = r.mask
    return Level(bits, hashes, body)


def build_cascade(universe: DataFrame, max_bytes: int = MAX_FILTER_BYTES) -> Cascade:
    """Cascade over a universe (h1, h2, listed). Runs jobs; what each level
    gets wrong is checkpointed and is all that the next levels read."""
    checkpoint_dir(universe.sparkSession)
    counts = {r.listed: r["count"] for r in universe.groupBy("listed").count().collect()}
    n, others = counts.get(True, 0), counts.get(False, 0)
    cascade = Cascade()
    # the first level lets through about as many other keys as are listed
    rate = min(LATER_RATE, math.sqrt(LATER_RATE) * n / max(others, 1))
    ours, theirs = universe.where("listed"), universe.where(~F.col("listed"))
    while n:
        if len(cascade.levels) == MAX_LEVELS:
            raise ValueError("two keys share all 128 hash bits")
        if filter_size(n, rate)[0] > 8 * max_bytes:
            raise ValueError(f"a filter of {n} keys is larger than {max_bytes} bytes: use more shards")
        k = len(cascade.levels)
        level = _bloom(ours, n, rate, k)
        cascade.levels.append(level)
        passes = F.pandas_udf(lambda h1, h2, level=level, k=k: pd.Series(
            level.holds(h1.to_numpy().view(_U), h2.to_numpy().view(_U), k)), "boolean")
        # the other kind's keys that this level lets through come next
        ours, theirs = theirs.where(passes("h1", "h2")).checkpoint(), ours
        n, rate = ours.count(), LATER_RATE
    return cascade


# -- judging urls -----------------------------------------------------------

def _first_listed(cascades: dict[str, Cascade]):
    """Place and verdict of the first listed key in each row's keys."""
    @F.pandas_udf("place int, verdict string")
    def find(h1: pd.Series, h2: pd.Series) -> pd.DataFrame:
        sizes = h1.map(len).to_numpy()
        owner = np.repeat(np.arange(len(h1)), sizes)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        a, b = (np.concatenate([*x.tolist(), np.empty(0, np.int64)]).astype(np.int64).view(_U) for x in (h1, h2))
        best = np.full(len(h1), np.iinfo(np.int32).max)
        verdict = np.full(len(h1), None, object)
        for name, cascade in cascades.items():
            hit = cascade.contains(a, b)
            own = np.full(len(h1), np.iinfo(np.int32).max)
            np.minimum.at(own, owner[hit], place[hit])
            verdict[own < best] = name
            best = np.minimum(best, own)
        return pd.DataFrame({"place": best, "verdict": verdict})
    return find


def _rule_rows(spark, rules: dict[str, Rule]) -> DataFrame:
    return spark.createDataFrame([(k, r.verdict) for k, r in rules.items()], "key string, verdict string")


def _decided_by_join(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The way beyond the filter bound: distinct pairs meet the list."""
    pairs = urls.select("host", "path", "keys").dropDuplicates(["host", "path"])
    hits = (pairs.select("host", "path", F.posexplode("keys").alias("place", "key")).join(rules, "key")
            .groupBy("host", "path").agg(F.min(F.struct("place", "key", "verdict")).alias("hit")))
    return urls.join(hits, ["host", "path"], "left").select("*", "hit.key", "hit.verdict")


def judge_urls(pages: DataFrame, rules: list[Rule], default: str = "allow", id_col: str = "page_id",
               url_col: str = "url", max_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """id, host, path, rule (null without one) and verdict of every url. Runs
    jobs to build the cascades."""
    spark = pages.sparkSession
    checkpoint_dir(spark)
    first: dict[str, Rule] = {}
    for r in rules:
        first.setdefault(r.key, r)
    host, path = host_and_path(F.col(url_col).cast("string"))
    urls = pages.select(F.col(id_col).alias("__id"), host.alias("host"), path.alias("path"))
    urls = urls.select("*", candidate_keys(
        F.col("host"), F.col("path"), sorted({len(r.path) for r in first.values()})).alias("keys"))
    if len(first) * 8 > max_bytes:            # eight bytes a listed key at most
        found = _decided_by_join(urls, _rule_rows(spark, first))
    else:
        h1, h2 = hashes_of(F.col("key"))
        universe = urls.select(F.explode("keys").alias("key")).distinct().select(h1.alias("h1"), h2.alias("h2"))
        # the list is within max_bytes, so it may be broadcast
        listed = F.broadcast(_rule_rows(spark, first).select(h1.alias("h1"), h2.alias("h2"), "verdict"))
        marked = universe.join(listed, ["h1", "h2"], "left").checkpoint()
        cascades = {v: build_cascade(marked.select("h1", "h2", F.coalesce(
            F.col("verdict") == v, F.lit(False)).alias("listed")), max_bytes)
            for v in sorted({r.verdict for r in first.values()})}
        each = lambda k: F.transform("keys", lambda x: hashes_of(x)[k])
        found = (urls.withColumn("hit", _first_listed(cascades)(each(0), each(1)))
                 .select("*", F.when(F.col("hit.verdict").isNotNull(), F.get("keys", F.col("hit.place"))).alias("key"),
                         F.col("hit.verdict").alias("verdict")))
    return found.select(F.col("__id").alias(id_col), "host", "path", F.col("key").alias("rule"),
                        F.coalesce("verdict", F.lit(default)).alias("verdict"))
