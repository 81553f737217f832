"""Benchmark passages in documents, found by winnowed fingerprints and extended."""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T

from blotter.llm.columns import others
from blotter.llm.words import as_bytes, grams, hash_words, letters, runs, sliced
from blotter.operators.joins import lookup
from blotter.session import materialise

WINDOW = 10
GRAM = 5
BLOCK_BYTES = 32 * 1024 * 1024
RUN_BYTES = 1 << 20


def winnow(hashes: np.ndarray, size: int) -> np.ndarray:
    """Positions of the rightmost smallest hash of every ``size`` in a row."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.int64)
    best, at = hashes[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, size):
        now = hashes[j : j + n]
        smaller = now <= best
        best[smaller] = now[smaller]
        at[smaller] = j
    return np.unique(at + np.arange(n))


class Fingerprints:
    """Fingerprints of one block of benchmark items, as sorted arrays."""

    def __init__(self, items: list[tuple[str, bytes]], window: int, gram: int):
        self.window, self.gram = window, gram
        self.names = [name for name, _ in items]
        self.words, _, _, _, self.bounds = hash_words([text for _, text in items], letters())
        picked: list[np.ndarray] = [np.empty(0, np.int64)]
        short: dict[int, list[int]] = defaultdict(list)
        for i, (low, high) in enumerate(zip(self.bounds, self.bounds[1:])):
            if high - low >= window:
                own = grams(self.words[low:high], gram)
                picked.append(winnow(own, window - gram + 1) + low)
            elif high > low:
                short[int(high - low)].append(i)
        places = np.concatenate(picked)
        keys = grams(self.words, gram)[places] if len(places) else np.empty(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.places = keys[order], places[order]
        self.short = {}
        for size, which in short.items():
            keys = np.array([grams(self.words[self.bounds[i] :][:size], size)[0] for i in which])
            order = np.argsort(keys, kind="stable")
            self.short[size] = keys[order], np.array(which)[order]

    @classmethod
    def of(cls, arrays: dict) -> Fingerprints:
        """The index with these attributes, as sent to a task."""
        index = cls.__new__(cls)
        vars(index).update(arrays)
        return index

    def hits(self, words: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(text, first word, word after the last, item) of passages that occur in texts.

        Equal windows have an equal winnowed fingerprint at the same place in them, so the
        join on fingerprints misses none; each hit is extended in both directions.
        """
        own = grams(words, self.gram)
        spots = winnow(own, self.window - self.gram + 1)
        low = np.searchsorted(self.keys, own[spots], "left")
        high = np.searchsorted(self.keys, own[spots], "right")
        ended: dict[tuple[int, int], int] = {}
        for k in np.flatnonzero(high > low):
            p = int(spots[k])
            text = int(np.searchsorted(bounds, p, "right")) - 1
            for q in map(int, self.places[low[k] : high[k]]):
                item = int(np.searchsorted(self.bounds, q, "right")) - 1
                if ended.get((item, q - p), -1) > p:
                    continue
                back = min(p - int(bounds[text]), q - int(self.bounds[item]))
                ahead = min(int(bounds[text + 1]) - p, int(self.bounds[item + 1]) - q)
                other = words[p - back : p + ahead] != self.words[q - back : q + ahead]
                before = np.flatnonzero(other[:back])
                after = np.flatnonzero(other[back:])
                first = p - back + (int(before[-1]) + 1 if len(before) else 0)
                last = p + (int(after[0]) if len(after) else ahead)
                ended[item, q - p] = last
                if last - first >= self.window:
                    yield text, first - int(bounds[text]), last - int(bounds[text]), item
        for size, (keys, which) in self.short.items():
            own = grams(words, size)
            low, high = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
            for p in map(int, np.flatnonzero(high > low)):
                text = int(np.searchsorted(bounds, p, "right")) - 1
                if p + size > bounds[text + 1]:
                    continue
                for item in map(int, which[low[p] : high[p]]):
                    start = int(self.bounds[item])
                    if np.array_equal(words[p : p + size], self.words[start : start + size]):
                        yield text, p - int(bounds[text]), p + size - int(bounds[text]), item


class Blocks:
    """The items of a benchmark, once each, in ``number`` blocks of about ``block_bytes``."""

    def __init__(self, benchmark: DataFrame, block_bytes: int, window: int, gram: int):
        self.window, self.gram = window, gram
        items = benchmark.select(
            F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"),
            F.coalesce("text", F.lit("")).alias("text"),
        ).distinct()
        size = items.agg(F.sum(F.octet_length("text") + 16).cast("bigint")).first()[0] or 0
        self.number = -(-size // block_bytes) or 1
        self.items = items.withColumn(
            "block", F.pmod(F.xxhash64("name", "text"), F.lit(self.number))
        )
        if self.number > 1:  # sorted, so that a block is read from few files
            self.items = materialise(self.items.repartitionByRange("block").sortWithinPartitions("block"))

    def send(self, block: int) -> Broadcast:
        """The fingerprints of one block, to every executor; only this block is held."""
        rows = self.items.where(F.col("block") == block).collect()
        items = sorted((r["name"], r["text"].encode()) for r in rows)
        index = Fingerprints(items, self.window, self.gram)
        return self.items.sparkSession.sparkContext.broadcast(vars(index))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    block_bytes: int = BLOCK_BYTES,
    keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """Which documents (text) hold passages of ``benchmark`` (item_id, text).

    Winnowing: of every ``window - gram + 1`` word ``gram``-grams in a row the smallest
    hash is kept, on both sides; fingerprints of documents and items are joined and every
    hit is extended. This finds every shared run of ``window`` words or more. An item
    with fewer words, but not none, must occur whole; winnowing cannot promise that, so
    these are looked up by the hash of the whole item.

    The benchmark, a stated query set, meets all documents in blocks of about
    ``block_bytes``. One block is one pass without a shuffle. Of more, each is sent, passed
    over all texts and dropped before the next one is built, so the driver and the tasks
    hold one whatever their number; what a pass finds is written by the text's SHA-256, and
    the passes' finds of a text are joined with the documents at the end, by measured size.

    Words are runs of ASCII letters and digits and of anything beyond ASCII, A-Z
    lower-cased. Returns the columns of ``docs`` (or ``keep``), then n_words, n_hit (words
    inside a passage), spans (array of first word and word after the last, merged),
    n_items, item_ids (as strings, sorted), contaminated. Input columns with these names
    are replaced. A null text has no words; a null item_id counts as the empty id;
    repeated items count once; no items, no hits.
    """
    made = T.StructType.fromDDL(
        "n_words bigint, n_hit bigint, spans array<struct<first:int,last:int>>, "
        "n_items bigint, item_ids array<string>, contaminated boolean"
    )
    kept = others(keep or docs.columns, made.names)
    frame = docs.select(*dict.fromkeys([*kept, "text"]))
    schema = T.StructType([*(f for f in frame.schema.fields if f.name in kept), *made])
    blocks = Blocks(benchmark, block_bytes, window, gram)
    if blocks.number == 1:
        held = blocks.send(0)
        frame = frame.withColumn("_leaks", F.lit(None).cast("string"))
    else:
        held = None
        digest = F.sha2(F.col("text").cast("binary"), 256)
        found = [_pass(docs.select("text"), blocks, i) for i in range(blocks.number)]
        leaks = materialise(
            reduce(DataFrame.unionAll, found).groupBy("_digest")
            .agg(F.array_join(F.collect_list("_leaks"), "\n").alias("_leaks"))
        )
        frame = lookup(frame.withColumn("_digest", digest), leaks, ["_digest"]).drop("_digest")
    order = [f.name for f in schema.fields[: len(kept)]]
    return frame.mapInArrow(_judge(held, order, made.names), schema)


def _pass(texts: DataFrame, blocks: Blocks, block: int) -> DataFrame:
    """Finds of one block in all texts, once for each different text, written."""
    held = blocks.send(block)
    found = texts.mapInArrow(_note(held), "_digest string, _leaks string").distinct()
    written = materialise(found)
    held.destroy()
    return written


def _search(texts: list[bytes], held: Broadcast | None):
    """For each text: how many words, spans of hits and names of items."""
    index = Fingerprints.of(held.value) if held else None
    sizes = np.zeros(len(texts), np.int64)
    spans: list[list[tuple[int, int]]] = [[] for _ in texts]
    items: list[set[str]] = [set() for _ in texts]
    for low, high in runs(texts, RUN_BYTES):
        words, _, _, _, bounds = hash_words(texts[low:high], letters())
        sizes[low:high] = np.diff(bounds)
        for text, first, last, item in index.hits(words, bounds) if index else ():
            spans[low + text].append((first, last))
            items[low + text].add(index.names[item])
    return sizes, spans, items


def _note(held: Broadcast):
    """Batches of texts to the finds of those that have any, as JSON."""

    def note(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = as_bytes(batch["text"])
            _, spans, items = _search(texts, held)
            hit = [i for i, x in enumerate(items) if x]
            digests = [hashlib.sha256(texts[i]).hexdigest() for i in hit]
            leaks = [json.dumps([_merge(spans[i]), sorted(items[i])]) for i in hit]
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.string()), pa.array(leaks, pa.string())],
                names=["_digest", "_leaks"],
            )

    return note


def _judge(held: Broadcast | None, kept: list[str], made: list[str]):
    """Batches of documents to their verdicts, by the block held and by finds written before."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            sizes, spans, items = _search(as_bytes(batch["text"]), held)
            for i, leaks in enumerate(batch["_leaks"].to_pylist()):
                for line in leaks.split("\n") if leaks else ():
                    more, names = json.loads(line)
                    spans[i] += map(tuple, more)
                    items[i].update(names)
            merged = [_merge(x) for x in spans]
            ids = [sorted(x) for x in items]
            hit = [sum(b - a for a, b in x) for x in merged]
            columns = [
                pa.array(sizes, pa.int64()),
                pa.array(hit, pa.int64()),
                pa.array(
                    [[{"first": a, "last": b} for a, b in x] for x in merged],
                    pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])),
                ),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array(ids, pa.list_(pa.string())),
                pa.array([x > 0 for x in hit], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in kept), *columns], names=[*kept, *made]
            )

    return judge


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans, in order; spans that touch become one."""
    merged: list[list[int]] = []
    for first, last in sorted((int(a), int(b)) for a, b in spans):
        if merged and first <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], last)
        else:
            merged.append([first, last])
    return [(a, b) for a, b in merged]


