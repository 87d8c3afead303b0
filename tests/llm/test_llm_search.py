"""Word runs, ranked search and repeated bytes against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from cohortlens.llm import bwt_dedup, ranking, runs
from cohortlens.llm.queries import QUERIES
from conftest import SF_SMALL
from test_llm_edges import LONG, ROWS, clashing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def edge(spark):
    return clashing(spark.createDataFrame(ROWS, "doc_id long, text string")).repartition(3)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


# -- runs --------------------------------------------------------------------

def repetitions(t):
    """All maximal (start, length, smallest period), by definition."""
    found = set()
    for p in range(1, len(t) // 2 + 1):
        i = 0
        while i + p < len(t):
            j = i
            while j + p < len(t) and t[j] == t[j + p]:
                j += 1
            if j - i >= p:
                found.add((i, j - i + p, p))
            i = max(j, i + 1)
    return sorted((i, n, p) for i, n, p in found
                  if not any(q < p and a <= i and a + m >= i + n for a, m, q in found))


def test_maximal_runs_equal_the_definition():
    rng = random.Random(1)
    for _ in range(1500):
        t = np.array([rng.randrange(rng.choice((1, 2, 3, 5))) for _ in range(rng.randrange(1, 40))])
        t = np.unique(t, return_inverse=True)[1]
        assert [tuple(x) for x in runs.maximal_runs(t).tolist()] == repetitions(t.tolist())


@pytest.mark.parametrize("tree_words", (20, 1000))
def test_runs_of_a_batch(monkeypatch, tree_words):
    monkeypatch.setattr(runs, "TREE_WORDS", tree_words)
    rng = random.Random(tree_words)
    for _ in range(150):
        docs = []
        for _ in range(5):
            docs.append([])
            while len(docs[-1]) < rng.randrange(120):
                docs[-1] += [rng.randrange(6) for _ in range(rng.randrange(1, 12))] * rng.randrange(1, 5)
        lengths = [len(d) for d in docs]
        got = runs.batch_runs(np.array(sum(docs, []), np.int64), np.repeat(np.arange(5), lengths))
        want = [(sum(lengths[:k]) + a, n, p) for k, d in enumerate(docs)
                for a, n, p in sorted(repetitions(d), key=lambda r: (r[0], r[2])) if n >= max(12, 2 * p)]
        assert [tuple(x) for x in got.tolist()] == want


def test_common_extension_of_a_long_text():
    rng = np.random.RandomState(3)
    text = np.concatenate([rng.randint(0, 3, 400), np.tile(rng.randint(0, 3, 37), 12), [3]])
    tree = runs.SuffixTree(text.tolist())
    i, j = rng.randint(0, len(text), 3000), rng.randint(0, len(text), 3000)
    i, j = i[i != j], j[i != j]
    def lce(a, b):
        k = 0
        while max(a, b) + k < len(text) and text[a + k] == text[b + k]:
            k += 1
        return k
    assert tree.common(i, j).tolist() == [lce(a, b) for a, b in zip(i.tolist(), j.tolist())]
    assert np.argsort(tree.rank).tolist() == sorted(range(len(text)), key=lambda a: text[a:].tolist())


def expected_runs(doc_id, text):
    w = WORD.findall(text or "")
    n, h = len(w), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if n and h is not None and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    found = set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                found.add((i, q, j - i + q))
            i = max(j, i + 1)
    found = sorted(r for r in found if not any(q < r[1] and a <= r[0] and a + m >= r[0] + r[2] for a, q, m in found))
    gone = {i for a, q, m in found for i in range(a + q, a + m)}
    a, q, m = max(found, key=lambda r: (r[2], -r[0], -r[1])) if found else (None,) * 3
    return (doc_id, len(found), a, m, q, 1000 * m // q if found else None,
            sha("".join(f"{a},{m},{q}\n" for a, q, m in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_word_runs_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    docs = {r.doc_id: r.text for r in docs}
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_word_runs"](spark, SF_SMALL).collect()}
    assert set(got) == set(docs) and sum(r[1] > 0 for r in got.values()) > 5
    short = [i for i, t in docs.items() if len(t or "") < 12_000]
    assert len(short) > 150
    assert all(got[i] == expected_runs(i, docs[i]) for i in short)


def test_word_runs_of_edge_rows(spark, edge):
    rows = [*ROWS, (10, "x " * 500), (11, ("a b c " * 5).strip()), (12, "a b " * 3 + "a b c"), (None, "z " * 30)]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    got = [tuple(r) for r in runs.document_runs(df, reorder=runs.planted_period).collect()]
    want = [expected_runs(i, t) for i, t in rows if t != LONG]
    assert sorted(map(str, want)) == sorted(str(r) for r in got if r[0] != 4 or r[-1] == sha(b""))
    assert {r[1] for r in got if r[0] == 1} == {0} and len(got) == len(rows)


# -- ranked search -----------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def expected_ranks(docs, items, top=20):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    docs = [(i, collections.Counter(TERM.findall(lower(t)))) for i, t in docs]
    docs = [(i, c) for i, c in docs if c]
    total = sum(sum(c.values()) for _, c in docs)
    df = collections.Counter(t for _, c in docs for t in c)
    out = []
    for item, text in set(items):
        terms = TERM.findall(lower(text))
        scored = []
        for i, c in docs:
            m = 75 + 25 * sum(c.values()) * len(docs) // total
            s = sum(math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[t] + 1)))
                    * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms if t in c)
            if s:
                scored.append((-s, i is None, i or 0))
        out += [(item, k + 1, None if no else i, -s) for k, (s, no, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("shard_terms", (10, 60, 2_000_000))
def test_ranks_equal_brute_force(spark, monkeypatch, shard_terms):
    monkeypatch.setattr(ranking, "SHARD_TERMS", shard_terms)
    rng = random.Random(shard_terms)
    words = [f"w{int(30 * rng.random() ** 2)}" for _ in range(4000)] + ["É", "é", "A_b", "x\x00y"]
    docs = [(rng.choice([None, *range(90)]), " ".join(rng.choices(words, k=rng.randrange(25)))) for _ in range(150)]
    docs += [(5, None), (6, ""), (7, "--- ..."), *docs[:30]]
    items = [(k, " ".join(rng.choices(words, k=rng.randrange(1, 9)))) for k in range(12)]
    items += [(0, "w0 W1 w1"), (0, "w0 W1 w1"), (None, "w2"), (20, None), (21, ""), (22, "nowhere"), (23, "A-B É")]
    d = clashing(spark.createDataFrame(docs, "doc_id long, text string")).repartition(3)
    q = clashing(spark.createDataFrame(items, "item_id long, text string"))
    for blocks in (ranking.QUERY_BYTES, 40):
        monkeypatch.setattr(ranking, "QUERY_BYTES", blocks)
        got = ranking.rank_documents(d, q, top=7).collect()
        assert sorted(map(tuple, got), key=str) == expected_ranks(docs, items, 7)
        if shard_terms < 2_000_000:
            break
    assert ranking.rank_documents(d.limit(0), q).count() == 0
    assert ranking.rank_documents(d, q.limit(0)).count() == 0


def test_windows_are_skipped_but_no_document_is_lost(monkeypatch):
    monkeypatch.setattr(ranking, "WINDOW", 16)
    rng = np.random.RandomState(7)
    n, terms = 1000, 12
    held = rng.random_sample((terms, n)) < np.array([.9, .7, .5, .4, .3, .2, .1, .05, .02, .01, .01, .005])[:, None]
    counts = rng.randint(1, 5, (terms, n)) * held
    at = np.nonzero(counts)
    row = collections.namedtuple("Row", "lengths terms starts numbers counts")(
        counts.sum(axis=0) + 10, np.arange(terms), np.append(0, np.cumsum(held.sum(axis=1))), at[1], counts[at])
    weights = {t: 50 * (t + 1) for t in range(terms)}
    shard = ranking.Shard(row, n, int(row.lengths.sum()), weights)
    query = {t: 1 + t % 2 for t in range(terms)}
    full = np.zeros(n, np.int64)
    for t in range(terms):
        numbers, values, _, _ = shard.iterator(t, query[t])
        full[numbers] += values
    for least in (0, int(np.sort(full)[-40]), int(full.max()), int(full.max()) + 1):
        found = {}
        for numbers, scores in ranking.search_shard(shard, query, least):
            found.update(zip(numbers.tolist(), scores.tolist()))
        assert found == {i: s for i, s in enumerate(full.tolist()) if s >= max(1, least)}
    steps, looked = ranking.search_shard(shard, query, 0), 0
    numbers, scores = next(steps)
    with pytest.raises(StopIteration):
        while True:                          # a bound that nothing reaches ends the search
            looked += 1
            numbers, scores = steps.send(10 ** 15)
    assert looked == 1


# -- repeated bytes ----------------------------------------------------------

def expected_cut(rows):
    rows = [(2 ** 63 - 1 if i is None else i, (t or "").encode(), i) for i, t in rows]
    first = {}
    for k, t, _ in rows:
        for i in range(len(t) - 49):
            first[t[i:i + 50]] = min(first.get(t[i:i + 50], k), k)
    out = []
    for k, t, i0 in rows:
        gone = bytearray(len(t))
        for i in range(len(t) - 49):
            if first[t[i:i + 50]] < k:
                gone[i:i + 50] = b"\1" * 50
        spans = sum(1 for i in range(len(t)) if gone[i] and not (i and gone[i - 1]))
        out.append((i0, len(t), sum(gone), spans, sha(bytes(b for b, x in zip(t, gone) if not x))))
    return sorted(out, key=str)


def odd_texts(rng, n):
    pool = ["".join(rng.choice("xyzuvw ñ") for _ in range(rng.randrange(20, 200))) for _ in range(12)]
    def text():
        parts = []
        for _ in range(rng.randrange(1, 12)):
            r = rng.random()
            parts.append(rng.choice(pool) if r < .4 else "ab" * rng.randrange(1, 300) if r < .5 else
                         "é" * rng.randrange(1, 100) if r < .6 else
                         "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(200))))
        return "".join(parts)
    return [(rng.choice([None, *range(60)]), rng.choice([None, "", text(), text(), text()])) for _ in range(n)]


@pytest.mark.parametrize("settings", ({}, {"BLOCK_BYTES": 3000, "BUCKET_SHARE": 5000, "ANCHORS_PER_BUCKET": 300},
                                      {"BLOCK_BYTES": 3000, "HOT_CONTEXTS": 2}))
def test_repeated_bytes_equal_brute_force(spark, monkeypatch, settings):
    for k, v in settings.items():
        monkeypatch.setattr(bwt_dedup, k, v)
    rows = odd_texts(random.Random(len(settings)), 100)
    rows += rows[:5]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string")).repartition(5)
    got = sorted(map(tuple, bwt_dedup.remove_repeats(df).collect()), key=str)
    assert got == expected_cut(rows) and sum(r[2] for r in got) > 10_000


def test_repeated_bytes_of_edge_rows(spark, edge):
    got = sorted(map(tuple, bwt_dedup.remove_repeats(edge).collect()), key=str)
    assert got == expected_cut(ROWS)
    assert bwt_dedup.remove_repeats(edge.limit(0)).count() == 0
    assert bwt_dedup.remove_repeats(edge.where("doc_id in (1, 2)")).count() == 2


def test_repeated_bytes_of_the_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, QUERIES["op13_repeated_bytes"](spark, SF_SMALL).collect()), key=str)
    assert got == expected_cut(rows) and sum(r[2] for r in got) > 1000


@pytest.mark.parametrize("shard_bytes", (1, 150, 10 ** 6))
def test_merged_transforms_equal_brute_force(monkeypatch, shard_bytes):
    monkeypatch.setattr(bwt_dedup, "SHARD_BYTES", shard_bytes)
    rng = random.Random(shard_bytes)
    for _ in range(60):
        base = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(50, 90))) for _ in range(6)]
        texts = {b[rng.randrange(4):][:rng.randrange(55, 90)] for b in base * 3} | {b"a" * 80, b"ba" * 30}
        texts = [t for t in texts if len(t) >= 50]
        least = np.array([rng.randrange(9) for _ in texts])
        flags, starts = bwt_dedup.repeated_windows(texts, least)
        for j, t in enumerate(texts):
            for i in range(len(t) - 49):
                want = any(t[i:i + 50] in u and d < least[j] for u, d in zip(texts, least))
                assert flags[starts[j] + i] == want


def test_segments_cut_by_slices_and_long_repeats(monkeypatch):
    body = ("abcdefghij" * 40 + "z" * 300 + "short").encode()
    row = collections.namedtuple("Row", "ids lengths body")([1, 2], [400, 305], bwt_dedup.pa.compress(body, "zstd", asbytes=True))
    whole = list(bwt_dedup.Block(row).segments())
    windows = {i for s, n, _, _ in whole for a, k in zip(s.tolist(), n.tolist()) for i in range(a, a + k)}
    assert windows == set(range(351)) | set(range(400, 656))
    assert max(n.max() for _, n, _, _ in whole) <= bwt_dedup.MAX_WINDOWS
    monkeypatch.setattr(bwt_dedup, "SLICE_BYTES", 97)
    parts = list(bwt_dedup.Block(row).segments())
    assert windows == {i for s, n, _, _ in parts for a, k in zip(s.tolist(), n.tolist()) for i in range(a, a + k)}
    of = lambda found: {i: h for s, n, x, _ in found for a, k, h in zip(s.tolist(), n.tolist(), x.tolist())
                        for i in range(a, a + k)}
    assert of(whole) == of(parts)
