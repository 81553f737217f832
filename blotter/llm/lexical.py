"""Ranked lexical search over an index stratified by document length.

The index is a table of segments. A segment holds some thousand documents in order of
their length normaliser m, so that a stratum, the documents of one m, is a run of them. The
postings of a term lie by stratum and, within it, by falling term frequency: what a term
adds to a document depends on m and the frequency alone, so it is computed once for each
run of equal ones, and the first of a stratum bounds what the term adds there.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from blotter.llm.chunks import expand, rows_of, squeeze
from blotter.llm.words import as_bytes, hash_words, letters, owners, runs
from blotter.session import materialise

#: Text and documents of a segment.
SEGMENT_BYTES = 4 << 20
SEGMENT_DOCS = 1 << 16
#: Text hashed at once, and the queries' text that is sent to all tasks at once.
RUN_BYTES = 1 << 20
QUERY_BYTES = 2 << 20
#: Documents scored before the bounds of the strata are compared with the k-th score.
FIRST_DOCS = 256
_NO_ID = np.iinfo(np.int64).max


class Index(NamedTuple):
    """Segments, the number of documents with a term, and that of all their terms."""

    segments: DataFrame
    documents: int
    terms: int


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    documents = total = 0
    for batch in batches:
        texts = as_bytes(batch["text"])
        for low, high in runs(texts, RUN_BYTES):
            n = _count_words(texts[low:high])
            documents, total = documents + int((n > 0).sum()), total + int(n.sum())
    yield pa.RecordBatch.from_arrays([pa.array([documents]), pa.array([total])], names=["documents", "terms"])


def _count_words(texts: list[bytes]) -> np.ndarray:
    buffer = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    inside = np.zeros(len(buffer) + 1, bool)
    inside[1:] = letters()[buffer]
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return np.diff(np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)])))


def _segments(documents: int, total: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = docs = 0
        for batch in batches:
            ids = pc.fill_null(batch["doc_id"].cast(pa.int64()), _NO_ID).to_numpy()
            texts = as_bytes(batch["text"])
            for low, high in runs(texts, RUN_BYTES):
                found = _postings(texts[low:high])
                held.append((ids[low:high], *found))
                size, docs = size + sum(map(len, texts[low:high])), docs + high - low
                if size >= SEGMENT_BYTES or docs >= SEGMENT_DOCS:
                    yield _segment(held, documents, total)
                    held, size, docs = [], 0, 0
        if held:
            yield _segment(held, documents, total)

    return write


def _postings(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text, and (term, text, frequency) of all."""
    hashes, _, _, _, bounds = hash_words(texts, letters())
    n, whose = np.diff(bounds), owners(bounds)
    order = np.lexsort((whose, hashes))
    hashes, whose = hashes[order], whose[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (whose[1:] != whose[:-1])
    at = np.flatnonzero(fresh)
    return n, hashes[at], whose[at], np.diff(np.append(at, len(hashes)))


def _segment(held: list[tuple], documents: int, total: int) -> pa.RecordBatch:
    sizes = np.cumsum([0, *(len(x[0]) for x in held)])
    ids, n, terms = (np.concatenate([x[i] for x in held]) for i in range(3))
    whose = np.concatenate([x[3] + a for x, a in zip(held, sizes)])
    times = np.concatenate([x[4] for x in held])
    # Python's whole numbers, as 25 n N may need more than 64 bits.
    lengths, which = np.unique(n, return_inverse=True)
    m = np.array([75 + 25 * x * documents // max(total, 1) for x in lengths.tolist()], np.int64)[which]
    order = np.lexsort((ids, m))
    ids, m = ids[order], m[order]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    whose = place[whose]
    by = np.lexsort((whose, -times, m[whose], terms))
    terms, whose, times = terms[by], whose[by], times[by]
    keys, first = np.unique(terms, return_index=True)
    counts = np.diff(np.append(first, len(terms)))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([x], pa.binary())
            for x in (
                keys.tobytes(), squeeze(counts), ids.astype("<i8").tobytes(), m.astype("<i8").tobytes(),
                squeeze(whose), squeeze(times),
            )
        ],
        names=["terms", "counts", "ids", "m", "docs", "times"],
    )


def build_index(docs: DataFrame) -> Index:
    """The index of all rows of ``docs`` (doc_id, text), in the shared folder.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased, of
    the whole text; null has none. They are kept as 64-bit hashes. The first pass counts
    documents and terms, from which m = 75 + 25 n N div L follows; the second writes the
    segments, each by the task that reads its documents, without a shuffle.
    """
    docs = docs.select("doc_id", "text")
    found = docs.select("text").mapInArrow(_lengths, "documents long, terms long")
    documents, total = found.agg(F.coalesce(F.sum("documents"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()
    names = ("terms", "counts", "ids", "m", "docs", "times")
    segments = docs.mapInArrow(_segments(documents, total), ", ".join(f"{x} binary" for x in names))
    return Index(materialise(segments), documents, total)


def _frequencies(asked: np.ndarray):
    """In how many documents of the task's segments each of the (sorted) terms occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(asked), np.int64)
        for row in rows_of(batches):
            keys = np.frombuffer(row["terms"], np.uint64)
            at, there = _at(keys, asked)
            df[there] += expand(row["counts"])[at[there]].astype(np.int64)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["term", "df"])

    return count


def _at(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``asked`` in the sorted ``keys``, and which of them are there."""
    at = np.searchsorted(keys, asked)
    at[at == len(keys)] = 0
    return at, keys[at] == asked if len(keys) else np.zeros(len(asked), bool)


def impact(times: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * times // (1000 * times + 12 * m)


class _Segment:
    """One segment's answer to queries: strata by falling bound, until none can matter."""

    def __init__(self, row: dict, asked: np.ndarray):
        self.ids, m = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["m"], "<i8")
        fresh = np.flatnonzero(np.diff(m, prepend=-1))
        self.bounds = np.append(fresh, len(m))
        self.stratum = np.repeat(np.arange(len(fresh)), np.diff(self.bounds))
        keys = np.frombuffer(row["terms"], np.uint64)
        at, there = _at(keys, asked)
        ends = np.cumsum(expand(row["counts"]).astype(np.int64))
        docs, times = expand(row["docs"]), expand(row["times"])
        self.lists: dict[int, tuple] = {}
        for term in np.flatnonzero(there).tolist():
            high = int(ends[at[term]])
            low = int(ends[at[term] - 1]) if at[term] else 0
            whose, often = docs[low:high].astype(np.int64), times[low:high].astype(np.int64)
            stratum = self.stratum[whose]
            run = np.flatnonzero(np.append(True, (np.diff(stratum) != 0) | (np.diff(often) != 0)))
            # Once for each stratum and frequency.
            adds = impact(often[run], m[whose[run]])
            top = np.flatnonzero(np.append(True, np.diff(stratum[run]) != 0))
            self.lists[term] = whose, np.repeat(adds, np.diff(np.append(run, len(whose)))), stratum[run[top]], adds[top]

    def best(self, query: list[tuple[int, int]], k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the best ``k`` and their scores. ``query`` has terms
        with their weights; ``least`` is the k-th score known so far."""
        here = [(self.lists[t], w) for t, w in query if t in self.lists and w]
        if not here:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        bound = np.zeros(len(self.bounds) - 1, np.int64)
        for (_, _, stratum, most), weight in here:
            bound[stratum] += weight * most
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        upto = np.cumsum(np.diff(self.bounds)[order])
        docs = np.concatenate([x[0] for x, _ in here])
        adds = np.concatenate([x[1] * w for x, w in here])
        found, scored = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        first, want = 0, FIRST_DOCS
        while first < len(order) and bound[order[first]] >= least:
            last = max(first + 1, int(np.searchsorted(upto, want)))
            fit = bound[order[first:last]] >= least
            visited = np.zeros(len(bound), bool)
            visited[order[first:last][fit]] = True
            inside = visited[self.stratum[docs]]
            which, code = np.unique(docs[inside], return_inverse=True)
            score = np.zeros(len(which), np.int64)
            np.add.at(score, code, adds[inside])
            found.append(which)
            scored.append(score)
            every = np.concatenate(scored)
            if len(every) >= k:
                least = max(least, int(np.partition(every, len(every) - k)[len(every) - k]))
            first, want = last, want * 4
        found, every = np.concatenate(found), np.concatenate(scored)
        keep = (every >= least) & (every > 0)
        return self.ids[found[keep]], every[keep]


def _search(asked, k: int):
    """The best ``k`` documents of a task's segments for every query of a broadcast."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, queries = asked.value
        best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(queries)
        for row in rows_of(batches):
            segment = _Segment(row, terms)
            for i, query in enumerate(queries):
                ids, scored = best[i]
                new, more = segment.best(query, k, int(scored[-1]) if len(scored) == k else 1)
                if len(new):
                    ids, scored = np.concatenate([ids, new]), np.concatenate([scored, more])
                    order = np.lexsort((ids, -scored))[:k]
                    best[i] = ids[order], scored[order]
        which = np.repeat(np.arange(len(best)), [len(x[0]) for x in best])
        ids, scored = (np.concatenate([x[j] for x in best] or [which]) for j in range(2))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(which, pa.int64()),
                pa.array(ids, pa.int64(), mask=ids == _NO_ID), pa.array(scored, pa.int64()),
            ],
            names=["query", "doc_id", "score"],
        )

    return search


def search(index: Index, items: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` documents with the highest scores for each row of ``items`` (item_id, text).

    Returns item_id, rank (from 1), doc_id and score; equal scores go by doc_id, null last,
    and documents without a score above 0 have no row. Items repeated in full are asked once;
    items without terms have no rows. A document that the index holds twice is ranked twice.

    The items are a query set against all rows: they are sent to the tasks in blocks of
    about ``QUERY_BYTES`` of text, one block after another, each of which reads the index twice,
    first the dictionaries alone. A task keeps ``k`` documents for each item, so what it
    returns does not grow with its rows, and visits a stratum only if its bound reaches the
    k-th score it has.
    """
    items = materialise(items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct())
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks = max(1, -(-size // QUERY_BYTES))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = [_search_block(index, items.where(block == i), k) for i in range(blocks)]
    result = found[0]
    for more in found[1:]:
        result = result.unionByName(more)
    return result


def _search_block(index: Index, items: DataFrame, k: int) -> DataFrame:
    """The result for one block of items, whose size is bounded."""
    spark = items.sparkSession
    names = dict(items.dtypes)
    rows = items.collect()
    hashes, _, _, _, bounds = hash_words([r["text"].encode() for r in rows], letters())
    terms = np.unique(hashes)
    df = np.zeros(len(terms), np.int64)
    for r in (
        index.segments.select("terms", "counts").mapInArrow(_frequencies(terms), "term long, df long")
        .groupBy("term").agg(F.sum("df").alias("df")).collect()
    ):
        df[r["term"]] = r["df"]
    weights = [math.floor(1000 * math.log((2 * index.documents + 2) / (2 * x + 1))) for x in df.tolist()]
    code = np.searchsorted(terms, hashes).tolist()
    queries = [
        [(t, n * weights[t]) for t, n in Counter(code[a:b]).items()] for a, b in zip(bounds, bounds[1:])
    ]
    asked = spark.sparkContext.broadcast((terms, queries))
    place = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    # One row for each item of the block.
    named = F.broadcast(spark.createDataFrame(list(enumerate(r["item_id"] for r in rows)), f"query long, item_id {names['item_id']}"))
    result = materialise(
        index.segments.mapInArrow(_search(asked, k), "query long, doc_id long, score long")
        .withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
        .join(named, "query").select("item_id", "rank", "doc_id", "score")
    )
    asked.unpersist()
    return result
