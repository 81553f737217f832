"""From raw documents to shards of a training corpus, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and
read again by the next. All but the last return the columns of ``docs``. Columns beyond
doc_id, text, lang and source may have any names; they are set aside under names of their
own while a stage works and come back unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from blotter.llm.decontamination import find_leaks
from blotter.llm.mixing import Mix, mix_sources
from blotter.llm.near_dedup import keep_one
from blotter.llm.sharding import shard
from blotter.llm.toxicity import learn, score_toxicity
from blotter.session import materialise

SHARDS = 8
#: 80 % of all tokens, no document twice: sources with more than their share give way.
MIX = Mix(
    budget_pct=80,
    epochs=1,
    seed=42,
    weights={"domain": {"web": 4, "books": 3, "forum": 3}, "lang": {"en": 4, "de": 2, "fr": 2}},
)
_OWN = ("doc_id", "text", "lang", "source")


def _apart(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame, tuple[str, ...]], DataFrame]]:
    """``docs`` with its other columns renamed, and what names and orders them back."""
    names = {c: c if c in _OWN else f"other_{i}" for i, c in enumerate(docs.columns)}

    def back(found: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
        return found.select(*(found[n].alias(c) for c, n in names.items()), *more)

    return docs.toDF(*names.values()), back


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not call toxic."""
    plain, back = _apart(docs)
    links = learn(plain, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return back(score_toxicity(plain, links).where("not toxic"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    plain, back = _apart(docs)
    return back(keep_one(plain))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    plain, back = _apart(docs)
    found = find_leaks(plain, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return back(found.where("not contaminated"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The share of each source that the target weights leave it."""
    plain, back = _apart(docs)
    return back(mix_sources(plain, MIX))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and their place in it.

    Where documents have columns named size, shard or slot, these are replaced.
    """
    return shard(docs, SHARDS, carry=tuple(docs.columns)).drop("law", "grown_shard", "text_crc32")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]
#: The classifier, the verified classes and the differencing are beyond SQL; see tests/llm.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, from the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
