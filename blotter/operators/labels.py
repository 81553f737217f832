"""Label frequencies and the rows whose label is kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from blotter import schemas
from blotter.operators.joins import lookup


def label_counts(df: DataFrame, label: str = schemas.LABEL) -> DataFrame:
    """Rows per label."""
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def top_k_labels(
    df: DataFrame, k: int = schemas.TOP_LABELS, label: str = schemas.LABEL
) -> DataFrame:
    """The k most frequent labels; equal counts fall by label."""
    return label_counts(df, label).orderBy(F.desc("n"), F.asc(label)).limit(k)


def keep_top_labels(
    df: DataFrame, k: int = schemas.TOP_LABELS, label: str = schemas.LABEL
) -> DataFrame:
    """Rows whose label is among the k most frequent."""
    # k rows at most, so the plan's own size estimate makes this a broadcast.
    return keep_labels(df, top_k_labels(df, k, label), label)


def keep_labels(df: DataFrame, kept: DataFrame, label: str = schemas.LABEL) -> DataFrame:
    """Rows whose label is in ``kept``."""
    return df.join(kept.select(label), label, "left_semi").select(df.columns)


def known_label(df: DataFrame, vocabulary: DataFrame, label: str = schemas.LABEL) -> DataFrame:
    """Rows whose label is in the vocabulary (value, code)."""
    known = vocabulary.select(F.col("value").alias(label))
    return lookup(df, known, [label], "left_semi").select(df.columns)
