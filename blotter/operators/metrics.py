"""Counts, the release gate and model quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from blotter import schemas
from blotter.operators.joins import stored_keys


def release_gate(df: DataFrame, min_rows: int = schemas.RELEASE_ROWS) -> DataFrame:
    """All rows if there are at least ``min_rows``, else none; one plan."""
    enough = df.agg(F.count(F.lit(1)) >= F.lit(min_rows)).scalar()
    return df.where(enough)


def batch_metrics(df: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """One row: rows received, distinct keys, keys already stored, keys to insert."""
    keys = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    known = stored_keys(df.select(key).distinct(), target, key).withColumn("_known", F.lit(1))
    return keys.join(known, key, "left").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("received"),
        F.count(F.lit(1)).alias("keys"),
        F.count("_known").alias("existing"),
        (F.count(F.lit(1)) - F.count("_known")).alias("inserted"),
    )


def release_metrics(pending: DataFrame, min_rows: int = schemas.RELEASE_ROWS) -> DataFrame:
    """One row: rows pending and rows the gate lets through."""
    rows = F.count(F.lit(1))
    return pending.agg(
        rows.alias("pending"),
        F.when(rows >= min_rows, rows).otherwise(F.lit(0)).cast("bigint").alias("sent"),
    )


def token_counts(df: DataFrame, column: str = "value") -> DataFrame:
    """Occurrences of each token; lines are cut at single blanks, empty tokens count."""
    return (
        df.select(F.explode(F.split(column, " ")).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def accuracy(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Share of right predictions."""
    return df.agg(F.avg((F.col(actual) == F.col(predicted)).cast("int")).alias("accuracy"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def classification_report(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted"
) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted means.

    An undefined ratio is 0. The data are reduced to a confusion table first; everything
    after that handles one row per class.
    """
    confusion = df.groupBy(actual, predicted).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("bigint")
    right = F.when(F.col(actual) == F.col(predicted), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col(actual).alias("label"), right.alias("hit"), F.col("n").alias("support"), zero.alias("called")),
        F.struct(F.col(predicted).alias("label"), zero.alias("hit"), zero.alias("support"), F.col("n").alias("called")),
    )
    precision = _ratio(F.col("hit"), F.col("called"))
    recall = _ratio(F.col("hit"), F.col("support"))
    classes = (
        confusion.select(F.inline(sides))
        .groupBy("label")
        .agg(*(F.sum(c).alias(c) for c in ("hit", "support", "called")))
        .select("label", "support", precision.alias("precision"), recall.alias("recall"))
        .withColumn(
            "f1",
            _ratio(
                2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")
            ),
        )
    )
    scores = ["precision", "recall", "f1"]
    rolled = classes.rollup("label").agg(
        F.grouping("label").alias("_total"),
        F.sum("support").alias("support"),
        *(F.avg(c).alias(c) for c in scores),
        *(_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"_{c}") for c in scores),
    )
    own = F.struct("label", *scores, "support")
    macro = F.struct(F.lit("macro avg").alias("label"), *scores, "support")
    weighted = F.struct(
        F.lit("weighted avg").alias("label"), *(F.col(f"_{c}").alias(c) for c in scores), "support"
    )
    rows = F.when(F.col("_total") == 1, F.array(macro, weighted)).otherwise(F.array(own))
    return rolled.select(F.inline(rows))
