"""Joins whose strategy follows a measured size.

A side is broadcast only after its payload has been measured. Beyond the bound the same
join runs as a shuffle, salted where one key may hold a large share of the rows.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F, types as T

BROADCAST_BYTES = 32 * 1024 * 1024
SALTS = 32
_TEXT = (T.StringType, T.BinaryType)
_ATOMIC = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def _payload(df: DataFrame) -> Column:
    """Sum of the bytes the rows need in memory: 16 per row and value, plus all text."""
    widths = [F.lit(16)]
    for field in df.schema.fields:
        if isinstance(field.dataType, _TEXT):
            widths.append(F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + 16)
        elif isinstance(field.dataType, _ATOMIC):
            widths.append(F.lit(16))
        else:
            raise TypeError(f"no size rule for column {field.name}: {field.dataType}")
    return F.coalesce(F.sum(reduce(add, widths).cast("bigint")), F.lit(0))


def payload_bytes(df: DataFrame) -> int:
    """Bytes a copy of ``df`` needs in memory."""
    return df.agg(_payload(df)).first()[0]


def lookup(
    df: DataFrame, small: DataFrame, on: list[str], how: str = "left", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Join ``df`` with ``small``, which holds each value of ``on`` once.

    ``small`` is read twice here, so pass a table or a materialised frame.
    """
    if payload_bytes(small) <= limit:
        return df.join(F.broadcast(small), on, how)
    hashable = [
        f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    left = df.withColumn("_salt", F.pmod(F.xxhash64(*hashable), F.lit(SALTS)).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def _within_reach(
    keys: DataFrame, target: DataFrame, key: str, limit: int
) -> tuple[DataFrame, bool]:
    """Stored keys between the smallest and greatest of ``keys``, and whether these fit.

    Keys that grow with time let the scan skip the files of older ones; the range never
    changes the result.
    """
    size, low, high = keys.agg(_payload(keys), F.min(key), F.max(key)).first()
    held = target.select(key).where(F.col(key).between(F.lit(low), F.lit(high)))
    return held, size <= limit


def stored_keys(
    keys: DataFrame, target: DataFrame, key: str, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Distinct ``keys`` (one column) that occur in ``target``.

    A batch of bounded size is sent to the target, which is then scanned without a
    shuffle. Otherwise both key sets are reduced to distinct values before they meet, so
    a key stored many times weighs no more than any other.
    """
    held, fits = _within_reach(keys, target, key, limit)
    if fits:
        return held.join(F.broadcast(keys), key, "left_semi").distinct()
    return held.distinct().join(keys, key, "left_semi")


def without_stored(
    df: DataFrame, target: DataFrame, key: str, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Rows of ``df``, unique on ``key``, whose key is not in ``target``."""
    keys = df.select(key)
    held, fits = _within_reach(keys, target, key, limit)
    if fits:
        # The stored keys are a subset of a key set that fits, so they fit as well.
        known = held.join(F.broadcast(keys), key, "left_semi").distinct()
        return df.join(F.broadcast(known), key, "left_anti")
    return df.join(held.distinct(), key, "left_anti")
