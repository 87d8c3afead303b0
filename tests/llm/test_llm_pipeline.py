"""The pipeline's stages on odd tables: nulls, empty texts, ties, repeated
rows, empty tables and clashing names."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_llm_edges import CLASHES, ROWS, clashing

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents of every kind, with labels for some."""
    root = tmp_path_factory.mktemp("sf")
    rng = random.Random(2)
    words = [f"word{i}" for i in range(300)]
    good = [(100 + i, " ".join(rng.choices(words, k=70))) for i in range(40)]
    toxic = [(200 + i, " ".join(rng.choices(words, k=50) + [f"vile{rng.randrange(4)}" for _ in range(12)])) for i in range(20)]
    copies = [(300 + i, good[0][1]) for i in range(3)] + [(304, good[1][1] + " tail")]
    rows = [*ROWS, *good, *toxic, *copies, good[5], good[5]]
    clashing(spark.createDataFrame(rows, "doc_id long, text string")).write.parquet(str(root / "documents.parquet"))
    labels = [(i, 1, 0) for i, _ in good] + [(i, 0, 1) for i, _ in toxic] + [(None, 1, 1), (1, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(root / "labels.parquet"))
    return str(root)


@pytest.mark.parametrize("name", list(STAGES)[:3])
def test_filters_keep_columns_and_empty_tables(spark, folder, name):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = STAGES[name](spark, docs, folder)
    assert out.columns == docs.columns
    assert {tuple(r[c] for c in CLASHES) for r in out.collect()} == {(1,) * len(CLASHES)}
    assert STAGES[name](spark, docs.limit(0), folder).columns == docs.columns
    assert STAGES[name](spark, docs.limit(0), folder).count() == 0


def test_packing_of_odd_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.length_packing(spark, docs, folder)
    assert out.where("doc_id = 1").first().n_tokens == 1 and out.where("doc_id is null").count() == 1
    assert out.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert corpus_pipeline.length_packing(spark, docs.limit(0), folder).count() == 0


def test_stages_in_order_drop_what_they_should(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    good = STAGES["quality_rules"](spark, docs, folder)
    ids = {r.doc_id for r in good.collect()}
    assert not ids & {1, 2, 3, 6, None} and {100, 104, 200, 300} <= ids
    clean = STAGES["toxicity"](spark, good, folder)
    ids = [r.doc_id for r in clean.collect()]
    assert sum(200 <= i < 220 for i in ids) <= 2 and sum(100 <= i < 140 for i in ids) >= 38
    single = STAGES["near_duplicates"](spark, clean, folder)
    ids = [r.doc_id for r in single.collect()]
    assert len(ids) == len(set(ids)) and not set(ids) & {300, 301, 302, 304, 5}
    assert {100, 101, 105} <= set(ids)
    run = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in run.collect()} == set(ids)


def test_documents_without_labels_all_pass_the_toxicity_stage(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.toxicity_filter(spark, docs, str(tmp_path)).count() == docs.count()
