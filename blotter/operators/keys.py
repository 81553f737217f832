"""Keyed operators: one row per key, stored and new keys, acknowledgements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from blotter import schemas
from blotter.operators.joins import BROADCAST_BYTES, lookup, stored_keys, without_stored
from blotter.session import materialise


def _first_by(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    # The rank filter lets Spark keep one row per key and task before the shuffle, so a
    # key with very many rows does not gather in one task.
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def keep_last(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key: the last in arrival order."""
    return _first_by(df, key, [F.col(c).desc() for c in order])


def keep_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key: the first in arrival order."""
    return _first_by(df, key, [F.col(c).asc() for c in order])


def latest_per_key(df: DataFrame, key: str, ts: str, tiebreak: list[str] = ()) -> DataFrame:
    """One row per key with the greatest ``ts``; an unknown ``ts`` counts as greatest."""
    ties = [F.col(c).desc_nulls_first() for c in tiebreak]
    return _first_by(df, key, [F.col(ts).desc_nulls_first(), *ties])


def existing_keys(
    df: DataFrame, target: DataFrame, key: str, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Keys of the batch that are already stored."""
    return stored_keys(materialise(df.select(key).distinct()), target, key, limit)


def new_keys(
    df: DataFrame, target: DataFrame, key: str, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Keys of the batch that are not stored yet."""
    return without_stored(materialise(df.select(key).distinct()), target, key, limit)


def insert_if_absent(
    df: DataFrame, target: DataFrame, key: str, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows to append: those of ``df``, unique on ``key``, that the target lacks.

    Replaying a batch therefore adds nothing, provided the target has one writer. The
    batch is read more than once, so pass a table or a materialised frame.
    """
    return without_stored(df, target, key, limit).select(df.columns)


def pending(
    df: DataFrame,
    acks: DataFrame,
    key: str = schemas.INCIDENT_KEY,
    ack_key: str = schemas.ACK_KEY,
) -> DataFrame:
    """Rows that no acknowledgement names.

    The acknowledged keys are reduced to a table first. Both sides then come to the join
    straight from a shuffle, which lets adaptive execution split a key that holds many
    rows; an aggregate in between would prevent that.
    """
    acked = materialise(acks.select(F.col(ack_key).alias(key)).distinct())
    return df.join(acked, key, "left_anti").select(df.columns)


def to_ack(
    df: DataFrame, key: str = schemas.INCIDENT_KEY, status: str = schemas.SENT
) -> DataFrame:
    """Acknowledgement rows for the keys of ``df``."""
    return df.select(F.col(key).alias(schemas.ACK_KEY), F.lit(status).alias("status"))


def already_done(target: DataFrame, column: str, value) -> bool:
    """Whether the target holds any row with this value."""
    return not target.where(F.col(column) == F.lit(value)).limit(1).isEmpty()


def not_yet_done(df: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """``already_done`` as a plan: rows whose value the target does not hold at all."""
    done = materialise(target.select(column).distinct())
    return lookup(df, done, [column], "left_anti").select(df.columns)
