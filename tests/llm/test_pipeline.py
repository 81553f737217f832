"""The pipeline's stages, each on its own input, against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from blotter.session import materialise
from helpers import classes, words


@pytest.fixture(scope="module")
def corpus(spark, make, prose, tmp_path_factory):
    rng = random.Random(9)
    rows = [(i, prose(i, 40 + i % 60)) for i in range(200)]
    rows += [(300 + i, rows[i][1]) for i in range(20)]
    rows += [(400 + i, rows[i][1].replace(rows[i][1].split()[30], "other", 1)) for i in range(20, 40)]
    rows += [(500 + i, rows[i][1] + rng.choice([" Grr", " uzz"])) for i in range(60, 100)]
    item = prose(5555, 30)
    rows += [(600 + i, prose(600 + i, 20) + " " + item + " " + prose(700 + i, 20)) for i in range(5)]
    folder = str(tmp_path_factory.mktemp("sf"))
    docs = make(rows).withColumn("source", F.concat(F.lit("src"), F.col("doc_id") % 3))
    docs.withColumn("Shard", F.lit("x")).withColumn("_key", F.lit(1)).withColumn("toxic", F.lit(0)).write.parquet(
        f"{folder}/documents.parquet"
    )
    labels = [(i, 1, int(500 <= i < 600)) for i, _ in rows]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, dict(rows), item


def test_stages(spark, corpus):
    folder, texts, item = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, set(texts)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, folder))
        kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert kept <= seen and docs.count() == len(kept)
        if name != "sharding":
            assert docs.columns == columns
            assert docs.select("Shard", "_key", "toxic").distinct().collect() == [("x", 1, 0)]
        if name == "toxicity":
            assert seen - kept == {i for i in texts if 500 <= i < 600}
        if name == "near_dedup":
            assert kept == set(classes([(i, texts[i]) for i in sorted(seen)]).values())
        if name == "decontamination":
            wanted = {i for i in seen if " ".join(words(item)) in " ".join(words(texts[i]))}
            assert seen - kept == wanted and len(wanted) == 5
        if name == "mixing":
            assert 0.7 < len(kept) / len(seen) < 0.9
        if name == "sharding":
            assert kept == seen and {r["shard"] for r in docs.collect()} == set(range(8))
        seen = kept
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()} == seen


def test_an_empty_corpus(spark, corpus, tmp_path):
    folder, _, _ = corpus
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
