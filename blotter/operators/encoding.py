"""Vocabularies and the codes they assign."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from blotter import schemas
from blotter.operators.joins import lookup
from blotter.operators.ordering import SINGLE_TASK_ROWS, global_index
from blotter.session import materialise


def vocabulary(df: DataFrame, column: str, limit: int = SINGLE_TASK_ROWS) -> DataFrame:
    """Sorted distinct values of ``column`` as text with codes 0..n-1: (value, code)."""
    values = materialise(
        df.select(F.col(column).cast("string").alias("value")).where("value is not null").distinct()
    )
    if values.limit(limit + 1).count() <= limit:
        place = F.row_number().over(Window.orderBy("value")) - 1
        coded = values.withColumn("code", place.cast("bigint"))
    else:
        coded = global_index(values, ["value"], "code")
    return materialise(coded.select("value", "code"))


def encode_with_vocab(
    df: DataFrame,
    vocab: DataFrame,
    column: str,
    name: str,
    unknown: int | None = schemas.UNKNOWN_CODE,
) -> DataFrame:
    """Add the code of ``column`` as ``name``; a value outside the vocabulary gets ``unknown``."""
    codes = vocab.select(F.col("value").alias("_value"), F.col("code").alias(name))
    coded = lookup(df.withColumn("_value", F.col(column).cast("string")), codes, ["_value"])
    filled = F.col(name) if unknown is None else F.coalesce(F.col(name), F.lit(unknown))
    return coded.select(*df.columns, filled.cast("bigint").alias(name))


def label_encode(df: DataFrame, vocab: DataFrame, column: str = schemas.LABEL, name: str = "y") -> DataFrame:
    """Add the label code; a label outside the vocabulary has none."""
    return encode_with_vocab(df, vocab, column, name, unknown=None)


def label_decode(df: DataFrame, vocab: DataFrame, code: str, name: str) -> DataFrame:
    """Add the label of a code."""
    labels = vocab.select(F.col("code").alias("_code"), F.col("value").alias(name))
    decoded = lookup(df.withColumn("_code", F.col(code).cast("bigint")), labels, ["_code"])
    return decoded.select(*df.columns, name)


def ordinal_encode(df: DataFrame, vocabs: dict[str, DataFrame], names: dict[str, str]) -> DataFrame:
    """Add a code column per category column; unseen values get -1."""
    return reduce(
        lambda out, column: encode_with_vocab(out, vocabs[column], column, names[column]),
        vocabs,
        df,
    )
