"""Hard negatives by exact integer scores from float32 matrix products.

Scores are inner products of whole-numbered vectors. Each vector is kept as its remainders
by several primes under 1024. A product of remainder matrices in float32 is exact, as its
sums stay below 2^24; the Chinese remainder theorem gives the signed score back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from blotter.llm.chunks import rows_of
from blotter.session import materialise

#: Remainders lie between -(p - 1) / 2 and (p - 1) / 2: 64 products of two are below 2^24.
LARGEST_PRIME = 1024
WIDTH = 64
BLOCK_ROWS = 4096
#: Anchors that are sent to all tasks at once, by the bytes of their remainders, and the
#: anchors of one matrix product.
ANCHOR_BYTES = 8 << 20
ANCHOR_ROWS = 256
_LEAST = np.iinfo(np.int64).min


def primes_for(bound: int) -> np.ndarray:
    """The largest primes under ``LARGEST_PRIME`` whose product tells -bound to bound apart."""
    if bound >= 1 << 62:
        raise ValueError("scores beyond 62 bits do not fit the result")
    found, product = [], 1
    for p in range(LARGEST_PRIME - 1, 2, -2):
        if all(p % q for q in range(3, int(p**0.5) + 1, 2)):
            found.append(p)
            product *= p
            if product > 2 * bound:
                return np.array(found, np.int64)
    raise AssertionError("unreachable: the primes multiply to far more than 2^63")


def remainders(values: np.ndarray, primes: np.ndarray) -> np.ndarray:
    """(prime, row, column) of the balanced remainders of whole float64 numbers of any size."""
    left = np.fmod(values[None], primes[:, None, None].astype(np.float64))
    return _balanced(left, primes[:, None, None].astype(np.float64)).astype(np.int16)


def _balanced(values: np.ndarray, p) -> np.ndarray:
    return values - p * np.rint(values / p)


def scores(a: np.ndarray, b: np.ndarray, primes: np.ndarray) -> np.ndarray:
    """Signed inner products of all rows of ``a`` with all rows of ``b``, given as remainders.

    The columns are multiplied ``WIDTH`` at a time. Digits in the mixed radix of the primes,
    each balanced, add up to the score itself, without a last subtraction.
    """
    total = np.zeros((a.shape[1], b.shape[1]), np.int64)
    digits: list[np.ndarray] = []
    weight = 1
    for k, p in enumerate(primes.tolist()):
        left = np.zeros(total.shape, np.float64)
        for low in range(0, a.shape[2], WIDTH):
            x = a[k, :, low : low + WIDTH].astype(np.float32)
            y = b[k, :, low : low + WIDTH].astype(np.float32)
            left += x @ y.T
        left = _balanced(left, p)
        # The digits before, by Horner's rule modulo p.
        known = np.zeros(total.shape, np.float64)
        for digit, q in zip(reversed(digits), reversed(primes[:k].tolist())):
            known = _balanced(known * q + digit, p)
        inverse = pow(weight, -1, p) if k else 1
        digit = _balanced(_balanced(left - known, p) * inverse, p)
        digits.append(digit)
        total += digit.astype(np.int64) * weight
        weight *= p
    return total


def _first(values: np.ndarray, allowed: np.ndarray, count: int) -> Iterator[np.ndarray]:
    """Per row, the place of the greatest allowed value, then of the next; -1 if none is left.

    Of equal values the first comes first.
    """
    left = np.where(allowed, values, _LEAST)
    every = np.arange(len(left))
    for _ in range(min(count, values.shape[1])):
        at = left.argmax(axis=1)
        some = left[every, at] > _LEAST
        yield np.where(some, at, -1)
        left[every, at] = _LEAST


class _Best:
    """The best ``count`` rows so far for each of ``n`` lists: score descending, then id."""

    def __init__(self, n: int, count: int):
        self.count = count
        self.score = np.full((n, count), _LEAST, np.int64)
        self.id = np.full((n, count), np.iinfo(np.int64).max, np.int64)

    def add(self, low: int, score: np.ndarray, ids: np.ndarray) -> None:
        """Candidates (list, number) for the lists from ``low`` on."""
        own = slice(low, low + len(score))
        score = np.concatenate([self.score[own], score], axis=1)
        ids = np.concatenate([self.id[own], ids], axis=1)
        order = np.lexsort((ids, ~score))[:, : self.count]
        self.score[own] = np.take_along_axis(score, order, axis=1)
        self.id[own] = np.take_along_axis(ids, order, axis=1)

    def batch(self) -> pa.RecordBatch:
        which, place = np.nonzero(self.score > _LEAST)
        columns = which, self.id[which, place], self.score[which, place]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["list", "vec_id", "score"]
        )


def _pack(primes: np.ndarray, width: int):
    """Rows (vec_id, label, embedding) in blocks of remainders, sorted by vec_id."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK_ROWS):
                part = pa.Table.from_batches([batch.slice(low, BLOCK_ROWS)]).sort_by("vec_id")
                lists = part["embedding"].combine_chunks()
                sizes = np.diff(lists.offsets.to_numpy())
                values = np.zeros((len(lists), width))
                inside = np.arange(width) < sizes[:, None]
                values[inside] = lists.flatten().to_numpy(zero_copy_only=False)
                found = remainders(np.floor(256 * values), primes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x], pa.binary())
                        for x in (
                            part["vec_id"].to_numpy().astype("<i8").tobytes(),
                            part["label"].to_numpy().astype("<i8").tobytes(), found.tobytes(),
                        )
                    ],
                    names=["ids", "labels", "values"],
                )

    return pack


_PACKED = "ids binary, labels binary, values binary"


def _unpack(row: dict, primes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels"))
    return ids, labels, np.frombuffer(row["values"], np.int16).reshape(len(primes), len(ids), width)


def _search(asked, primes: np.ndarray, width: int, count: int, windows):
    """The best ``count`` rows for each list. Without ``windows`` a list is an anchor with the
    rows of its label but its own id; else it is a window (anchor, least, most) of scores of
    rows of other labels. ``asked`` and ``windows`` are broadcasts."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_ids, a_labels, a_values = asked.value
        whose, least, most = windows.value if windows else (np.arange(len(a_ids)), None, None)
        best = _Best(len(whose), count)
        for row in rows_of(batches):
            ids, labels, values = _unpack(row, primes, width)
            for low in range(0, len(a_ids), ANCHOR_ROWS):
                high = min(low + ANCHOR_ROWS, len(a_ids))
                first, last = np.searchsorted(whose, [low, high])
                if first == last:
                    continue
                found = scores(a_values[:, low:high], values, primes)
                same = a_labels[low:high, None] == labels
                if windows:
                    mine = whose[first:last] - low
                    lists = found[mine]
                    allowed = ~same[mine] & (lists >= least[first:last, None]) & (lists <= most[first:last, None])
                else:
                    lists, allowed = found, same & (a_ids[low:high, None] != ids)
                places = np.stack(list(_first(lists, allowed, count)), axis=1)
                none = places < 0
                best.add(
                    int(first),
                    np.where(none, _LEAST, np.take_along_axis(lists, places, axis=1)),
                    np.where(none, np.iinfo(np.int64).max, ids[places]),
                )
        yield best.batch()

    return search


def _merged(found: DataFrame, count: int) -> DataFrame:
    """The best of all tasks, with their rank in each list."""
    place = Window.partitionBy("list").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= count)


def usable(rows: DataFrame) -> DataFrame:
    """Rows (vec_id, label, embedding) with all three and finite components only."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    doubles = F.col("embedding").cast("array<double>")
    return (
        rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), doubles.alias("embedding"))
        .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull())
        .where(~F.exists("embedding", bad))
    )


def mine_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    least_pct: int = 50,
    most_pct: int = 95,
) -> DataFrame:
    """Hard negatives of the anchors among ``rows`` (vec_id, label, embedding).

    Components x count as floor(256 x). An anchor's positives are the ``positives`` rows of
    its label with the highest scores; a positive's negatives are the ``negatives`` rows of
    other labels with the highest scores between ``least_pct`` and ``most_pct`` per cent of
    the positive's. Equal scores go by vec_id. Returns anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score; a positive without negatives has no row.

    Rows without vec_id, label or vector, or with a component that is null or not finite,
    take no part. Shorter vectors are filled with zeros. A row repeated in full is asked
    once as an anchor and else counts as often as it comes; rows with the anchor's vec_id are
    not its positives. Other columns are ignored. Scores that need more than 62 bits
    raise an error.

    Every row is compared with every anchor, which is the job. Anchors are sent to the tasks
    ``ANCHOR_BYTES`` at a time, one block after another; a task keeps the best few rows of
    each list, so what it returns does not grow with its rows.
    """
    spark = rows.sparkSession
    kept = materialise(usable(rows))
    largest = F.array_max(F.transform("embedding", lambda x: F.abs(x)))
    most, width = kept.agg(F.max(largest), F.max(F.size("embedding"))).first()
    width = max(1, width or 0)
    primes = primes_for(width * (int(256 * (most or 0.0)) + 1) ** 2)
    blocks = materialise(kept.mapInArrow(_pack(primes, width), _PACKED))
    anchors = materialise(kept.where(is_anchor).distinct())
    groups = max(1, -(-anchors.count() * width * 2 * len(primes) // ANCHOR_BYTES))
    found = [
        _mine_block(spark, blocks, anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == g),
                    primes, width, (positives, negatives, least_pct, most_pct))
        for g in range(groups)
    ]
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def _mine_block(
    spark: SparkSession, blocks: DataFrame, anchors: DataFrame, primes: np.ndarray, width: int, how: tuple
) -> DataFrame:
    """The result for one block of anchors, whose size is bounded."""
    positives, negatives, least_pct, most_pct = how
    parts = [_unpack(r.asDict(), primes, width) for r in anchors.mapInArrow(_pack(primes, width), _PACKED).collect()]
    parts = parts or [(np.empty(0, np.int64),) * 2 + (np.empty((len(primes), 0, width), np.int16),)]
    ids, labels, values = (np.concatenate(x, axis=i) for x, i in zip(zip(*parts), (0, 0, 1)))
    lists = "list long, vec_id long, score long"
    asked = spark.sparkContext.broadcast((ids, labels, values))
    best = _merged(blocks.mapInArrow(_search(asked, primes, width, positives, None), lists), positives)
    # At most ``positives`` rows for each anchor of the block.
    best = best.orderBy("list", "rank").collect()
    whose = np.array([r["list"] for r in best], np.int64)
    score = np.array([r["score"] for r in best], np.int64)
    # Whole-numbered bounds, rounded towards the window and without overflow.
    least = [-(-least_pct * int(s) // 100) for s in score]
    most = [most_pct * int(s) // 100 for s in score]
    windows = spark.sparkContext.broadcast((whose, np.array(least, np.int64), np.array(most, np.int64)))
    pairs = F.broadcast(
        spark.createDataFrame(
            [(i, int(ids[r["list"]]), r["vec_id"], r["score"]) for i, r in enumerate(best)],
            "list long, anchor_id long, positive_id long, positive_score long",
        )
    )
    result = materialise(
        _merged(blocks.mapInArrow(_search(asked, primes, width, negatives, windows), lists), negatives)
        .join(pairs, "list")
        .select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
    asked.unpersist()
    windows.unpersist()
    return result
