"""Global positions and page slices without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from blotter.session import materialise

SINGLE_TASK_ROWS = 100_000
#: Keys that a range is cut at in one round of narrowing.
CUTS = 64


def global_index(df: DataFrame, order: list[str | Column], name: str = "_index") -> DataFrame:
    """Number the rows 0..n-1 in ``order``, which must be total.

    The rows are range-partitioned and sorted once into the shared folder; a row's number
    is its place in its partition plus the rows of the partitions before it. Only one row
    per partition meets in one task.
    """
    placed = materialise(
        df.orderBy(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    return (
        # One row per sort partition: bounded by spark.sql.shuffle.partitions.
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_part", "_place", "_start")
    )


def _key(order: list[str], values: list, types: dict[str, T.DataType]) -> Column:
    return F.struct(*(F.lit(v).cast(types[c]).alias(c) for c, v in zip(order, values)))


def _between(df: DataFrame, order: list[str], low: list | None, high: list | None) -> DataFrame:
    """Rows from the key ``low`` up to, but not including, the key ``high``."""
    types = {c: df.schema[c].dataType for c in order}
    key = F.struct(*order)
    if low is not None:
        df = df.where(key >= _key(order, low, types))
        if low[0] is not None:  # nulls come first, so this lets the scan skip files
            df = df.where(F.col(order[0]) >= F.lit(low[0]).cast(types[order[0]]))
    if high is not None:
        df = df.where(key < _key(order, high, types))
        if high[0] is not None:
            first = F.col(order[0])
            df = df.where(first.isNull() | (first <= F.lit(high[0]).cast(types[order[0]])))
    return df


def _place(key: Column, cuts: list[Column], low: int = 0) -> Column:
    """How many of the ascending ``cuts`` are no greater than ``key``, plus ``low``.

    Halving compares a row with a few cuts instead of all, in compiled code.
    """
    if not cuts:
        return F.lit(low)
    middle = len(cuts) // 2
    below, above = _place(key, cuts[:middle], low), _place(key, cuts[middle + 1 :], low + middle + 1)
    return F.when(key < cuts[middle], below).otherwise(above)


def narrowed(
    df: DataFrame, order: list[str], offset: int, limit: int, fit: int
) -> tuple[DataFrame, int]:
    """The rows between two keys that hold ``offset`` to ``offset + limit``, and how many
    rows come before them.

    Each round takes ``CUTS`` keys of the range, counts the rows between them in one pass
    without a shuffle of rows, and keeps the stretch with the page, until it is at most
    ``fit`` rows or the page and no more keys lie inside.
    """
    types = {c: df.schema[c].dataType for c in order}
    low, high, before, rows = None, None, 0, None
    while True:
        inside = _between(df, order, low, high)
        if rows is not None and rows <= fit:
            return inside, before
        # Any keys will do; those with the lowest hashes are spread like the rows.
        mixed = inside.select(*order).orderBy(F.xxhash64(*order), *order).limit(CUTS)
        cuts = [list(r) for r in mixed.distinct().orderBy(*order).collect()]
        place = _place(F.struct(*order), [_key(order, c, types) for c in cuts])
        counts = dict(
            (r[0], r[1]) for r in inside.groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("n")).collect()
        )
        ends, total = [], before
        for i in range(len(cuts) + 1):
            ends.append((total, total + counts.get(i, 0)))
            total += counts.get(i, 0)
        held = [i for i, (a, b) in enumerate(ends) if a < offset + limit and b > offset]
        if not held:  # beyond the last row
            return inside.limit(0), before
        first, last = held[0], held[-1]
        narrower = ends[last][1] - ends[first][0]
        if rows is not None and narrower == rows:
            return inside, before
        low = cuts[first - 1] if first else low
        high = cuts[last] if last < len(cuts) else high
        before, rows = ends[first][0], narrower


def page_slice(
    df: DataFrame, limit: int, offset: int, order: list[str | Column], fit: int | None = None
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in ``order``, which must be total.

    Near pages are a plain top-k. A deep page would pull everything before it into one
    task; by ascending columns it is a top-k of the stretch of ``fit`` rows that holds it,
    found by counting, so nothing is sorted but that stretch. By other orders, and for
    pages of more than ``fit`` rows, it is cut from the global index.
    """
    fit = fit or SINGLE_TASK_ROWS
    if offset + limit <= fit:
        return df.orderBy(*order).offset(offset).limit(limit)
    if limit <= fit and all(isinstance(c, str) for c in order):
        inside, before = narrowed(df, order, offset, limit, fit)
        return inside.orderBy(*order).offset(offset - before).limit(limit)
    indexed = global_index(df, order)
    inside = (F.col("_index") >= offset) & (F.col("_index") < offset + limit)
    return indexed.where(inside).orderBy("_index").drop("_index")
