"""Nulls, empty and very long texts, repeated rows, empty tables and clashing
extra columns: every operator has a defined result for each."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import (byte_bpe, fingerprints, lm, neardup, packing, quality, token_counts, token_files,
                            toxicity, url_filter)

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
LONG = " ".join(f"w{i % 977}x" for i in range(30_000))
BASE = " ".join(f"word{i}" for i in range(60))
ROWS = [(0, BASE), (1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, BASE), (None, "no id here"),
        (0, "another text under the same id"), (0, BASE), (6, "one"), (7, "\x1c odd  \r\n text  ")]
CLASHES = ("fp", "key", "block", "score", "n_words", "__m", "range", "window", "rank", "n", "hash", "kept", "id",
           "bucket", "edits", "held", "prediction", "features", "probability", "label", "count", "len",
           "__score", "__id", "__hash", "__row", "__raw", "__text", "body", "query", "context", "weight", "calibrates")


def clashing(df):
    return df.select("*", *[F.lit(1).alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def edge(spark):
    return clashing(spark.createDataFrame(ROWS, "doc_id long, text string")).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(0, None, 1), (1, 1, 0), (None, 1, 1), (4, 1, None)],
                                 "doc_id long, quality int, toxic int")


OPERATORS = {
    "fingerprints": lambda d, lab: fingerprints.edited_fingerprints(d),
    "packing": lambda d, lab: packing.pack_documents(d, VOCABULARY),
    "lm": lambda d, lab: lm.document_scores(d, lm.held_out_fold(F.col("doc_id"))),
    "token_counts": lambda d, lab: token_counts.count_edited(
        d, token_counts.sample_edits(F.col("text")), RANKS, PATTERN),
    "token_files": lambda d, lab: token_files.token_ids_by_key(d, VOCABULARY),
    "neardup": lambda d, lab: neardup.jaccard_join(d),
    "byte_bpe": lambda d, lab: byte_bpe.token_digests(d, RANKS, PATTERN),
    "quality": lambda d, lab: quality.verdicts(quality.quality_ledger(d)),
    "toxicity": lambda d, lab: toxicity.toxicity_scores(d, lab),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table_gives_no_rows(edge, labels, name):
    assert OPERATORS[name](edge.limit(0), labels.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(set(OPERATORS) - {"packing"}))
def test_a_row_for_every_row(edge, labels, name):
    rows = OPERATORS[name](edge, labels).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in ROWS)


def test_fingerprints(spark, edge):
    rows = fingerprints.edited_fingerprints(edge).collect()
    same = {r.fingerprint for r in rows if r.doc_id == 5} | {r.fingerprint for r in rows if r.n_chars == len(BASE)}
    assert len(same) == 1
    assert all(r.fingerprint == "" for r in rows if r.doc_id in (1, 2, 3))
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    order = sorted(ROWS, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    texts = [t or "" for _, t in order]
    want = sorted(hashlib.sha256((t[:len(t) - len(t) // 3] + n[:len(t) // 3]).encode()).hexdigest()
                  for t, n in zip(texts, texts[1:] + texts[:1]))
    assert sorted(r.edited_sha256 for r in rows) == want
    one = fingerprints.edited_fingerprints(spark.createDataFrame([(9, "a b c")], "doc_id long, text string")).first()
    assert one.near_next == 1.0


def test_packing_keeps_every_token(edge):
    counts = packing.token_counts(edge, VOCABULARY)
    total = counts.agg(F.sum("n_tokens")).first()[0]
    rows = packing.pack(counts, max_len=64, buckets=4, budget=256).collect()
    assert sum(r.n_tokens for r in rows) == total
    assert all(0 <= r.padding == r.bucket_len - r.n_tokens for r in rows)
    fill = {}
    for r in rows:
        fill.setdefault((r.bucket_len, r.batch), []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) and len(s) * b <= 256 for (b, _), s in fill.items())
    for b in {b for b, _ in fill}:                       # only the last batch of a bucket is short
        batches = sorted(k for x, k in fill if x == b)
        assert batches == list(range(len(batches)))
        assert all(len(fill[b, k]) == 256 // b for k in batches[:-1])


def test_near_duplicates(edge):
    rows = neardup.jaccard_join(edge).collect()
    copies = [r for r in rows if r.n_copies == 3]
    assert len(copies) == 3 and {r.class_id for r in copies} == {0} and {r.n_links for r in copies} == {2}
    assert all(r.class_id == r.doc_id and r.n_links == 0 for r in rows if r.doc_id in (1, 2, 3))
    kept = neardup.keep_one_of_each(edge)
    assert kept.columns == edge.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [0, 0, 1, 2, 3, 4, None, 6, 7]))


def test_quality(edge):
    rows = {(r.doc_id, r.n_words): r for r in quality.verdicts(quality.quality_ledger(edge)).collect()}
    assert rows[1, 0].failure_bits == 1 and not rows[1, 0].kept
    assert rows[0, 60].failure_bits == 0 and rows[0, 60].kept
    good = quality.keep_good(edge)
    assert good.columns == edge.columns


def test_toxicity_without_both_classes(edge, labels):
    one_class = labels.where("toxic = 1")
    scores = {r.score for r in toxicity.toxicity_scores(edge, one_class).collect()}
    assert scores in ({1.0}, {0.0})
    assert toxicity.drop_toxic(edge, labels.limit(0)).count() == len(ROWS)


def test_extra_columns_come_back(spark, edge):
    """Rows that are dropped or kept carry columns of any name unchanged, with
    trees and calibration learned."""
    rng = __import__("random").Random(4)
    words = [f"w{i}" for i in range(80)]
    bad = [f"bad{i}" for i in range(6)]
    rows = [(i, " ".join(rng.choices(words, k=40) + (rng.choices(bad, k=9) if i % 4 == 0 else []))) for i in range(400)]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    marks = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    kept = toxicity.drop_toxic(docs, marks)
    assert kept.columns == docs.columns
    found = {r.doc_id for r in kept.collect()}
    assert sum(i in found for i in range(0, 400, 4)) <= 5 and len(found) >= 290
    one = neardup.keep_one_of_each(docs)
    assert one.columns == docs.columns and one.count() == 400
    assert all(r["__id"] == r["__score"] == 1 for r in one.collect())


def test_any_share_of_labels_can_be_drawn(spark):
    """A share of 1e-7 draws what it should; weights are of the drawn rows."""
    n = 40_000
    labels = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"),
                                   (F.col("id") % 2).cast("int").alias("toxic"))
    docs = labels.select("doc_id", F.lit("some text").alias("text"))
    all_ids = lambda c: F.lit(True)
    sample = toxicity.labelled_sample(docs, labels, all_ids, bound=200).collect()
    by = {c: [r.weight for r in sample if r.label == c] for c in (0, 1)}
    assert all(60 < len(w) < 150 and abs(sum(w) - n / 2) < 1e-6 for w in by.values())
    wanted, rows = 5_000, 50_000_000_000
    limit = toxicity.hash_limit(wanted, rows)
    assert abs((limit + 2 ** 63 + 1) / 2 ** 64 - 1e-7) < 1e-12
    assert toxicity.hash_limit(5, 5) == 2 ** 63 - 1 and toxicity.hash_limit(9, 5) == 2 ** 63 - 1
    with pytest.raises(ValueError, match="none of"):
        toxicity.labelled_sample(docs, labels.where("doc_id = 3 or toxic = 0"), all_ids, bound=1)


def test_one_hot_id_does_not_break_the_bound(spark):
    docs = spark.range(3000).select((F.when(F.col("id") < 2900, 7).otherwise(F.col("id"))).cast("long").alias("doc_id"),
                                    F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 2).cast("int").alias("toxic"))
    sample = toxicity.labelled_sample(docs, labels, lambda c: F.lit(True), bound=100)
    rows = sample.collect()
    assert len(rows) <= 101 and len({r.doc_id for r in rows}) == len(rows)
    assert {r.text for r in rows if r.doc_id == 7} <= {f"text {i}" for i in range(2900)}


def test_urls(spark):
    rules = [url_filter.parse_rule("block", "bad.org/"), url_filter.parse_rule("allow", "ok.bad.org/x/"),
             url_filter.parse_rule("allow", "bad.org/")]
    urls = ["http://BAD.org/", "https://sub.bad.org/q?x#y", "https://ok.bad.org/x/1", "https://ok.bad.org/x",
            "notbad.org/", "http://notbad.org/", "http://bad.org", None, "", "://", "http://bad.org?u=/", "http://bad.org/"]
    pages = clashing(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"))
    rows = {r.page_id: r for r in url_filter.judge_urls(pages, rules).collect()}
    assert [rows[i].verdict for i in range(len(urls))] == [
        "block", "block", "allow", "block", "allow", "allow", "allow", "allow", "allow", "allow", "allow", "block"]
    assert rows[2].rule == "ok.bad.org/x/" and rows[0].host == "bad.org" and rows[6].path == "" and rows[7].host == ""
    again = {r.page_id: r for r in url_filter.judge_urls(pages, rules, max_bytes=1).collect()}   # by the join
    assert rows == again
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
