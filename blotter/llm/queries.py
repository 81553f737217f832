"""One registered query per operator, thin layers over the operators of this package."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from blotter.llm.near_dedup import near_duplicates
from blotter.llm.oracles import build
from blotter.llm.chat import rotate_perspectives
from blotter.llm.context_tree import score_texts
from blotter.llm.decontamination import find_leaks
from blotter.llm.hard_negatives import mine_negatives
from blotter.llm.lexical import build_index, search
from blotter.llm.mixing import Mix, mix_sources
from blotter.llm.sharding import shard
from blotter.llm.simhash import fingerprint, within_radius
from blotter.llm.suffix_dedup import repeated_passages
from blotter.llm.token_store import lookup, write_store
from blotter.llm.toxicity import learn, score_toxicity
from blotter.llm.url_filters import filter_urls
from blotter.llm.url_rules import RULES
from blotter.session import materialise

MIX = Mix(
    budget_pct=100,
    epochs=2,
    seed=42,
    weights={"domain": {"web": 5, "books": 3, "forum": 2}, "lang": {"en": 4, "de": 2, "fr": 2}},
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs)[0].drop("chunk", "pos")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), keep=("doc_id",)
    )
    digest = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated"
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(_table(spark, sf_dir, "documents"), 8)


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate_perspectives(_table(spark, sf_dir, "conversations"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Likeness of every document, and for the queries (doc_id divisible by 100) how many
    other documents lie within the radius."""
    marks = materialise(fingerprint(_table(spark, sf_dir, "documents")))
    stored = materialise(marks.groupBy("_fp").agg(F.count(F.lit(1)).alias("_copies")))
    asked = marks.where(F.col("doc_id") % 100 == 0).select("_fp").distinct()
    near = (
        within_radius(asked, stored.select("_fp"))
        .join(stored.withColumnRenamed("_fp", "_found"), "_found")
        .groupBy(F.col("_query").alias("_fp"))
        .agg((F.sum("_copies") - 1).alias("n_near"))
        .withColumn("_asks", F.lit(True))
    )
    asks = F.coalesce(F.col("doc_id") % 100 == 0, F.lit(False)).alias("_asks")
    return marks.select("*", asks).join(near, ["_fp", "_asks"], "left").drop("_fp", "_asks")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_table(spark, sf_dir, "documents"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, RULES).drop("url")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"), MIX, keep=("doc_id",))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    links = learn(docs, _table(spark, sf_dir, "labels"))
    return score_toxicity(docs, links, keep=("doc_id",))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_table(spark, sf_dir, "documents"))


def op11_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of the store, found by its key."""
    docs = _table(spark, sf_dir, "documents")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    store = write_store(docs, tokenizer, end_id=2, apart=True)
    copies = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    keys = copies.select("doc_id", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("copy"))
    return lookup(store, keys).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"), "copy"
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(_table(spark, sf_dir, "documents"))
    return search(index, _table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_near_dedup, op2_decontamination, op3_sharding, op4_chat_formatting, op5_fingerprints,
        op6_suffix_dedup, op7_url_filters, op8_mixing, op9_toxicity, op10_lm_scoring,
        op11_token_store, op12_hard_negatives, op13_lexical_search,
    )
}
ORACLES = build(MIX)
