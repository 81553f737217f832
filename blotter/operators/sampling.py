"""Reproducible train/test split that keeps the share of every label."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from blotter import schemas
from blotter.operators.joins import lookup
from blotter.session import materialise

_HEX = 5  # 16**5 hash buckets per label


def stratified_split(
    df: DataFrame,
    label: str = schemas.LABEL,
    key: str = schemas.INCIDENT_KEY,
    test: float = schemas.TEST_SHARE,
    seed: int = schemas.SEED,
) -> DataFrame:
    """Add ``is_test``, true for ceil(test * n) of the n rows of each label.

    Rows are taken in order of md5(seed, key); keys are unique. No label is ever sorted
    as a whole: a histogram of hash buckets finds the bucket in which each label's cut
    falls, and only the rows of that bucket are ranked to find the last test row.
    """
    digest = F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string")))
    bucket = F.conv(F.substring("_digest", 1, _HEX), 16, 10).cast("int")
    hashed = df.where(F.col(label).isNotNull()).withColumn("_digest", digest)
    narrow = hashed.select(label, F.col(key).alias("_key"), "_digest").withColumn("_bucket", bucket)

    by_label = Window.partitionBy(label)
    upto = by_label.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = (
        narrow.groupBy(label, "_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_upto", F.sum("_rows").over(upto))
        .withColumn("_need", F.ceil(F.sum("_rows").over(by_label) * F.lit(test)))
        .where((F.col("_upto") >= F.col("_need")) & (F.col("_upto") - F.col("_rows") < F.col("_need")))
        .select(label, "_bucket", (F.col("_need") - F.col("_upto") + F.col("_rows")).alias("_take"))
    )
    edge = lookup(narrow, materialise(cuts), [label, "_bucket"], "inner")
    place = F.row_number().over(by_label.orderBy("_digest", "_key"))
    last = (
        edge.withColumn("_place", place)
        .where(F.col("_place") == F.col("_take"))
        .select(label, F.col("_digest").alias("_cut"), F.col("_key").alias("_cut_key"))
    )
    flagged = lookup(hashed, materialise(last), [label], "left")
    is_test = (F.col("_digest") < F.col("_cut")) | (
        (F.col("_digest") == F.col("_cut")) & (F.col(key) <= F.col("_cut_key"))
    )
    return flagged.select(*df.columns, F.coalesce(is_test, F.lit(False)).alias("is_test"))
