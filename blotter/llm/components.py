"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from blotter.session import materialise

#: Links looked at together inside a task.
BATCH_LINKS = 1 << 16
#: So few links are left to one task, whatever the graph was at first.
LAST_LINKS = 1 << 14


def spanning(a: np.ndarray, b: np.ndarray, nodes: int) -> np.ndarray:
    """Places of links (pairs of numbers below ``nodes``) that form a spanning forest."""
    root = list(range(nodes))
    kept = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append(i)
    return np.array(kept, np.int64)


def forest(links: DataFrame) -> DataFrame:
    """``links`` (a, b) with the same components: of every ``BATCH_LINKS`` that a task reads
    together, those of a spanning forest, so fewer than the nodes among them."""

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= BATCH_LINKS:
                held = [_thinned(held)]
                if held[0].num_rows >= BATCH_LINKS // 2:
                    yield held.pop()
        if held:
            yield _thinned(held)

    return links.select("a", "b").mapInArrow(thin, links.select("a", "b").schema)


def _thinned(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(held).combine_chunks()
    ends = pa.concat_arrays([c for x in "ab" for c in table[x].chunks]).dictionary_encode()
    code = ends.indices.to_numpy()
    kept = spanning(code[: len(table)], code[len(table) :], len(ends.dictionary))
    return table.take(pa.array(kept)).combine_chunks().to_batches()[0] if len(kept) else held[0].slice(0, 0)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The components of all links of a task: its nodes with one node of their component."""
    held = list(batches)
    if not sum(x.num_rows for x in held):
        return
    table = pa.Table.from_batches(held).combine_chunks()
    ends = pa.concat_arrays([c for x in "ab" for c in table[x].chunks]).dictionary_encode()
    code = ends.indices.to_numpy()
    root = np.arange(len(ends.dictionary))
    low, high = code[: len(table)], code[len(table) :]
    while True:
        least = np.minimum(root[low], root[high])
        before = root.copy()
        for end in (low, high):
            np.minimum.at(root, root[end], least)
            np.minimum.at(root, end, least)
        root = root[root]
        if (root == before).all():
            break
    labels = ends.dictionary.take(pa.array(root))
    yield pa.RecordBatch.from_arrays([ends.dictionary, labels], names=["node", "label"])


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) -> (node, label): the smallest node of each node's component.

    Links are thinned to forests inside the tasks first. Every round ranks the nodes by a
    hash of its own, hooks each to the lowest of its neighbours and then to that one's,
    where these are lower, and puts these names in place of the nodes. Links inside one
    name are dropped, so the graph shrinks by a share from round to round, whatever its
    shape, until ``LAST_LINKS`` are left, which one task resolves; the rounds' tables are then
    read backwards. A node with very
    many neighbours weighs one value a task, as minima are taken before the shuffle, and
    its links can be split in the joins. Nodes without links, and links to itself, are not
    in the result.
    """
    edges = materialise(forest(links.where("a != b")))
    steps: list[DataFrame] = []
    while edges.count() > LAST_LINKS:
        rank = lambda c, n=len(steps): F.xxhash64(c, F.lit(n))
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooked = materialise(
            both.groupBy(F.col("a").alias("node"))
            .agg(F.min(F.struct(rank("b").alias("rank"), F.col("b").alias("low"))).alias("_low"))
            .select("node", F.when(F.col("_low.rank") < rank("node"), F.col("_low.low")).otherwise(F.col("node")).alias("label"))
        )
        above = hooked.select(F.col("node").alias("up"), F.col("label").alias("higher"))
        step = materialise(
            hooked.join(above, hooked["label"] == above["up"]).select("node", F.col("higher").alias("label"))
        )
        steps.append(step)
        for end in ("a", "b"):
            edges = edges.join(step.withColumnRenamed("node", end), end).drop(end).withColumnRenamed("label", end)
        edges = materialise(forest(edges.where("a != b").distinct()))
    kind = edges.schema["a"].dataType.simpleString()
    labels = materialise(edges.coalesce(1).mapInArrow(_solve, f"node {kind}, label {kind}"))
    for step in reversed(steps):
        last = labels.select(F.col("node").alias("label"), F.col("label").alias("_last"))
        labels = materialise(
            step.join(last, "label", "left").select("node", F.coalesce("_last", "label").alias("label"))
        )
    least = labels.groupBy("label").agg(F.min("node").alias("_least"))
    return labels.join(least, "label").select("node", F.col("_least").alias("label"))
