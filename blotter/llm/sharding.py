"""Shards of near equal bytes by Karmarkar-Karp differencing of indivisible groups."""

from __future__ import annotations

import heapq
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from blotter.llm.columns import others
from blotter.session import materialise

BUNDLES = 16_384
CELL_ROWS = 2_000
_MADE = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def karmarkar_karp(sizes: list[int], shards: int) -> list[int]:
    """The shard of each size.

    Every size starts as a partial partition of its own. The two with the largest spread
    are combined again and again, the fullest part of one with the emptiest of the other.
    Only sums and the order of their parts are kept; the parts are named from the top
    down at the end. Ties go to the earlier partial partition.
    """
    if not sizes:
        return []
    ticket = count()
    heap = []
    for item, size in enumerate(sizes):
        sums = (size, *[0] * (shards - 1))
        heap.append((-(sums[0] - sums[-1]), next(ticket), sums, item))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, a, left = heapq.heappop(heap)
        _, _, b, right = heapq.heappop(heap)
        joined = [x + y for x, y in zip(a, reversed(b))]
        order = sorted(range(shards), key=lambda i: -joined[i])
        sums = tuple(joined[i] for i in order)
        # Part i of the result is part order[i] of the left and its mirror of the right.
        heapq.heappush(heap, (sums[-1] - sums[0], next(ticket), sums, (left, right, order)))
    result = [0] * len(sizes)
    stack = [(heap[0][3], list(range(shards)))]
    while stack:
        node, names = stack.pop()
        if isinstance(node, int):
            result[node] = names[0]
            continue
        left, right, order = node
        mine = [0] * shards
        for place, part in enumerate(order):
            mine[part] = names[place]
        stack += [(left, mine), (right, mine[::-1])]
    return result


def shard(
    docs: DataFrame,
    shards: int = 8,
    bundles: int = BUNDLES,
    cell_rows: int = CELL_ROWS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Put every row of ``docs`` (doc_id, text) into one of ``shards`` of near equal bytes.

    Rows with equal texts form a group that stays in one shard; null counts as the empty
    text here. A row's size is the UTF-8 bytes of its text plus 1. Groups above the mean
    bundle size (all bytes / ``bundles``; there are fewer than ``bundles`` of them) are
    items of their own; the others are bundled by a hash of their text. So at most twice
    ``bundles`` sums, whatever the input, meet in the one task that does the differencing.

    Returns doc_id, the columns of ``carry``, size, text_crc32, law ('bytes'), shard,
    slot (0, 1, ... without gaps in each shard) and grown_shard (null). Columns of the
    input with one of these names are replaced. Repeated rows get a slot each; a null
    doc_id sorts first; no rows in, no rows out.
    """
    carry = others(carry, (*_MADE, "doc_id"))
    carried = [F.struct(*carry).alias("_carried")] if carry else []
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = materialise(
        docs.select(
            "doc_id",
            *carried,
            (F.octet_length(text).cast("bigint") + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.md5(text.cast("binary")).alias("_key"),
        )
    )
    groups = rows.groupBy("_key").agg(F.sum("size").alias("_bytes"))
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    # Fewer than ``bundles`` rows of 32 characters: a proven bound for the broadcast.
    large = groups.where(F.col("_bytes") * bundles > F.lit(total)).select(
        "_key", F.lit(True).alias("_large")
    )
    spread = F.format_string("%08d", F.pmod(F.xxhash64("_key"), F.lit(bundles)))
    bundled = rows.join(F.broadcast(large), "_key", "left").withColumn(
        "_bundle", F.when(F.col("_large"), F.col("_key")).otherwise(spread)
    )
    sums = bundled.groupBy("_bundle").agg(
        F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows")
    )

    def divide(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["_bytes", "_bundle"], ascending=[False, True])
        return pd.DataFrame(
            {
                "_bundle": frame["_bundle"],
                "shard": np.array(karmarkar_karp(frame["_bytes"].tolist(), shards), np.int32),
                "_cells": -(-frame["_rows"] // cell_rows),
            }
        )

    placed = materialise(
        sums.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(divide, "_bundle string, shard int, _cells long")
    )
    # At most 2 * bundles rows: bounded, too.
    rows = bundled.join(F.broadcast(placed), "_bundle").withColumn(
        "_cell", F.pmod(F.xxhash64("doc_id", "_key"), F.col("_cells"))
    )
    counts = rows.groupBy("shard", "_bundle", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bundle", "_cell")
    starts = counts.select(
        "_bundle",
        "_cell",
        (F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias(
            "_start"
        ),
    )
    within = Window.partitionBy("_bundle", "_cell").orderBy("doc_id", "_key")
    return (
        rows.join(starts, ["_bundle", "_cell"])
        .withColumn("slot", F.col("_start") + F.row_number().over(within) - 1)
        .select(
            "doc_id", *(["_carried.*"] if carry else []), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            F.col("slot").cast("bigint").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
