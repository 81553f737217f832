"""Passages that repeat across documents, by a sparse suffix array."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from blotter.llm.chunks import attach, joined, pack, packed, rows_of, totals, unpack
from blotter.llm.decontamination import winnow
from blotter.llm.near_dedup import text_keys
from blotter.llm.words import _FACTOR, as_bytes, grams, hash_words, letters, mix, owners, runs
from blotter.session import materialise

LEAST = 50
GRAM = 10
SPACING = 31
#: Neighbours on either side that a suffix is compared with. First words that come more
#: often are settled by the hashes of all windows around them instead.
REACH = 64
RUN_BYTES = 1 << 20
_KEY = np.uint64(0xFFFFFFFFFFFF0000)


def anchors(words: np.ndarray, bounds: np.ndarray, gram: int, spacing: int):
    """Where the retained suffixes of some texts start, and the key of their first words.

    Of every ``spacing`` runs of ``gram`` words in a row the one with the smallest hash,
    so equal passages of ``spacing + gram - 1`` words retain suffixes at equal places.
    """
    every = grams(words, gram)
    at = winnow(every, spacing)
    owner = owners(bounds)
    # Choices at the seam of two texts are extra ones; those that cross it are dropped.
    at = at[owner[at] == owner[at + gram - 1]]
    return at, every[at] & _KEY, owner[at]


def contexts(words: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, reach: int):
    """Words after each place and before it (nearest first) as 32-bit symbols; 0 beyond
    the text."""
    symbols = (words >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    step = np.arange(reach)
    ahead = at[:, None] + step
    right = np.where(ahead < high[:, None], symbols[np.minimum(ahead, len(words) - 1)], 0)
    back = at[:, None] - 1 - step
    left = np.where(back >= low[:, None], symbols[np.maximum(back, 0)], 0)
    return right.astype(np.uint32), left.astype(np.uint32)


def _count(gram: int, spacing: int):
    def count(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        texts = as_bytes(table["text"].combine_chunks())
        found = [np.empty(0, np.uint64)]
        for low, high in runs(texts, RUN_BYTES):
            words, _, _, _, bounds = hash_words(texts[low:high], letters())
            found.append(anchors(words, bounds, gram, spacing)[1])
        return np.unique(np.concatenate(found), return_counts=True)

    return count


def _anchored(texts: list[bytes], gram: int, spacing: int):
    """For runs of texts: the first text's number, words, bounds and anchors; and the
    sorted distinct keys of all anchors, in whose order the sums of a chunk come."""
    found = []
    for low, high in runs(texts, RUN_BYTES):
        words, _, _, _, bounds = hash_words(texts[low:high], letters())
        found.append((low, words, bounds, *anchors(words, bounds, gram, spacing)))
    return found, np.unique(np.concatenate([x[4] for x in found] or [np.empty(0, np.uint64)]))


def _suffixes(least: int, gram: int, spacing: int, reach: int):
    """The suffixes whose first words come again, but no more than ``reach`` times."""

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            texts = as_bytes(unpack(row["data"])["text"].combine_chunks())
            found, keys = _anchored(texts, gram, spacing)
            sums = joined(row["sums"] or [])
            seen: set[bytes] = set()
            for low, words, bounds, at, key, owner in found:
                own = text_keys(texts[low : low + len(bounds) - 1], words, bounds)
                new = np.array([not (k in seen or seen.add(k)) for k in own], bool)
                times = sums[np.searchsorted(keys, key)]
                chosen = new[owner] & (times > 1) & (times <= reach)
                at, owner = at[chosen], owner[chosen]
                for a in range(0, len(at), 8192):
                    part, who = at[a : a + 8192], owner[a : a + 8192]
                    right, left = contexts(words, part, bounds[who], bounds[who + 1], least)
                    yield pa.RecordBatch.from_arrays(
                        [
                            _binary(right), _binary(left),
                            pa.array(np.full(len(part), row["chunk"]), pa.int64()),
                            pa.array(low + who, pa.int32()),
                            pa.array(part - bounds[who], pa.int32()),
                        ],
                        names=["right", "left", "chunk", "pos", "at"],
                    )

    return suffixes


def windows(words: np.ndarray, bounds: np.ndarray, at: np.ndarray, least: int, gram: int):
    """The windows of ``least`` words inside a text that hold the whole first ``gram`` words
    of one of the suffixes ``at``: where they start, and their hashes."""
    every = grams(words, gram)
    n = len(words) - least + 1
    if n <= 0 or not len(at):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    before = np.zeros(len(every) + 1, np.int64)
    before[at + 1] = 1
    before = np.cumsum(before)
    owner = owners(bounds)
    holds = before[least - gram + 1 :][:n] > before[:n]
    start = np.flatnonzero(holds & (owner[:n] == owner[least - 1 :]))
    total = np.zeros(len(start), np.uint64)
    for j in (*range(0, least - gram, gram), least - gram):
        total = total * np.uint64(_FACTOR) + every[start + j]
    return start, mix(total)


def _windows(least: int, gram: int, spacing: int, reach: int):
    """For each chunk the windows around suffixes whose first words come more than
    ``reach`` times: hash, text and place of each, in the order of the text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            sums = joined(row["sums"] or [])
            if not (sums > reach).any():
                continue
            texts = as_bytes(unpack(row["data"])["text"].combine_chunks())
            found, keys = _anchored(texts, gram, spacing)
            hashes, who, gaps = [], [], []
            for low, words, bounds, at, key, _ in found:
                hot = at[sums[np.searchsorted(keys, key)] > reach]
                start, own = windows(words, bounds, hot, least, gram)
                owner = np.searchsorted(bounds, start, "right") - 1
                hashes.append(own)
                who.append(low + owner)
                # Differences, mostly 1, take next to no space when compressed.
                gaps.append(np.diff(start - bounds[owner], prepend=0))
            table = pa.table(
                {
                    "hash": np.concatenate(hashes),
                    "pos": np.concatenate(who).astype(np.int32),
                    "gap": np.concatenate(gaps).astype(np.int32),
                    "fresh": np.concatenate([np.arange(len(x)) == 0 for x in gaps]),
                }
            )
            if table.num_rows:
                # Six bytes of text stand for a key of eight.
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["chunk"]], pa.int64()),
                        pa.array([6 * table.num_rows], pa.int64()),
                        pa.array([packed(table)], pa.binary()),
                    ],
                    names=["chunk", "size", "data"],
                )

    return find


def _holders(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """How many texts of a chunk hold a window, however often each."""
    hashes, pos = table["hash"].to_numpy(), table["pos"].to_numpy()
    order = np.lexsort((pos, hashes))
    hashes, pos = hashes[order], pos[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (pos[1:] != pos[:-1])
    return np.unique(hashes[fresh], return_counts=True)


def _shared(least: int):
    """The passages made of windows that more than one text holds."""

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            table = unpack(row["data"])
            _, code = np.unique(table["hash"].to_numpy(), return_inverse=True)
            pos, gap = table["pos"].to_numpy().astype(np.int64), table["gap"].to_numpy()
            # Differences start anew with each run of texts.
            sums = np.cumsum(gap, dtype=np.int64)
            runs_ = np.flatnonzero(table["fresh"].to_numpy(zero_copy_only=False))
            start = sums - np.repeat((sums - gap)[runs_], np.diff(np.append(runs_, len(gap))))
            hit = np.flatnonzero(joined(row["sums"])[code] > 1)
            pos, start = pos[hit], start[hit]
            new = np.ones(len(hit), bool)
            new[1:] = (pos[1:] != pos[:-1]) | (start[1:] > start[:-1] + least)
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(hit))[: len(first)] - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(first), row["chunk"]), pa.int64()),
                    pa.array(pos[first], pa.int32()),
                    pa.array(start[first], pa.int32()),
                    pa.array(start[last] + least, pa.int32()),
                ],
                names=["chunk", "pos", "first", "last"],
            )

    return shared


def _binary(symbols: np.ndarray) -> pa.Array:
    data = symbols.astype(">u4")
    width = data.shape[1] * 4
    offsets = np.arange(len(data) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(
        pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())]
    )


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols rows of ``a`` and ``b`` have in common from the start."""
    apart = (a != b) | (a == 0)
    return np.where(apart.any(axis=1), apart.argmax(axis=1), a.shape[1])


def _neighbours(least: int, reach: int, edges: bool):
    """Compare the rows of a sorted partition with those up to ``reach`` before them.

    Yields the passage around each suffix that another document shares, and with ``edges``
    the first and last rows of the partition, to be compared across partitions.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in _sliced(batches):
            right = np.frombuffer(b"".join(batch["right"].to_pylist()), ">u4").reshape(-1, least)
            left = np.frombuffer(b"".join(batch["left"].to_pylist()), ">u4").reshape(-1, least)
            place = np.stack([batch[c].to_numpy().astype(np.int64) for c in ("chunk", "pos", "at")])
            right, left = right.astype(np.uint32), left.astype(np.uint32)
            if held is None:
                if edges:
                    yield _edge(right[:reach], left[:reach], place[:, :reach])
                old = 0
            else:
                old = len(held[0])
                right, left = np.concatenate([held[0], right]), np.concatenate([held[1], left])
                place = np.concatenate([held[2], place], axis=1)
            ahead = np.zeros(len(right), np.int64)
            back = np.zeros(len(right), np.int64)
            for lag in range(1, min(reach, len(right) - 1) + 1):
                # Only pairs with a row of this batch; those among held rows are done.
                first = max(0, old - lag)
                a, b = slice(first, len(right) - lag), slice(first + lag, len(right))
                r, l = common(right[a], right[b]), common(left[a], left[b])
                other = (place[0, a] != place[0, b]) | (place[1, a] != place[1, b])
                good = other & (r + l >= least)
                for side in (a, b):
                    ahead[side] = np.maximum(ahead[side], np.where(good, r, 0))
                    back[side] = np.maximum(back[side], np.where(good, l, 0))
            hit = np.flatnonzero(ahead + back)
            yield _passages(place[:, hit], back[hit], ahead[hit], least)
            held = right[-reach:], left[-reach:], place[:, -reach:]
        if edges and held is not None:
            yield _edge(*held)

    return compare


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, 4096):
            yield batch.slice(a, 4096)


_SPANS = "chunk long, pos int, first int, last int, at int, right binary, left binary"


def _passages(place: np.ndarray, back: np.ndarray, ahead: np.ndarray, least: int) -> pa.RecordBatch:
    none = pa.nulls(place.shape[1], pa.binary())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(place[0]), pa.array(place[1], pa.int32()),
            pa.array(place[2] - back, pa.int32()), pa.array(place[2] + ahead, pa.int32()),
            pa.array(place[2], pa.int32()), none, none,
        ],
        names=["chunk", "pos", "first", "last", "at", "right", "left"],
    )


def _edge(right: np.ndarray, left: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    none = pa.nulls(len(right), pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(place[0]), pa.array(place[1], pa.int32()), none, none,
            pa.array(place[2], pa.int32()), _binary(right), _binary(left),
        ],
        names=["chunk", "pos", "first", "last", "at", "right", "left"],
    )


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in rows_of(batches):
        table = unpack(row["data"])
        texts = as_bytes(table["text"].combine_chunks())
        sizes, keys = [], []
        for low, high in runs(texts, RUN_BYTES):
            words, _, _, _, bounds = hash_words(texts[low:high], letters())
            sizes += np.diff(bounds).tolist()
            keys += text_keys(texts[low:high], words, bounds)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([row["chunk"]] * len(texts), pa.int64()),
                pa.array(range(len(texts)), pa.int32()),
                table["doc_id"].combine_chunks().cast(pa.int64()),
                pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
            ],
            names=["chunk", "pos", "doc_id", "n_words", "node"],
        )


def repeated_passages(
    docs: DataFrame,
    least: int = LEAST,
    gram: int = GRAM,
    spacing: int = SPACING,
    reach: int = REACH,
) -> DataFrame:
    """For every document of ``docs`` (doc_id, text) the passages of at least ``least``
    words that another document holds as well.

    A sparse suffix array: suffixes are retained where the hash of their first ``gram``
    words is the smallest of ``spacing`` in a row, so equal passages retain equal ones, at
    least one in every ``spacing + gram - 1`` words. Suffixes whose first words come once
    in the corpus (exact counts) can share no passage and go. Those whose first words come
    up to ``reach`` times are sorted by the words that follow and compared with ``reach``
    neighbours on either side, so with all that start alike; matches are extended to the
    right and to the left, and count from ``least`` words on. Partitions of the sort overlap
    by ``reach`` rows. Where the first words come more often, the windows of ``least`` words
    that hold them are counted instead, by 64-bit hashes and once for each text, and those
    that more than one text holds are repeated. Equal windows retain an equal suffix, so
    they meet in one of the two ways, however often a passage comes and whatever stands
    around it. Texts with the same words as another are repeated as a whole; of copies in a
    chunk only the first is sorted.

    Returns doc_id, n_words, n_repeated (words inside passages), passages (array of first
    word and word after the last, merged), copies (documents with the same words). Words
    are runs of ASCII letters and digits and of anything beyond ASCII, A-Z lower-cased.
    A null text is empty; repeated rows are copies; a text of fewer than ``least`` words
    has no passage; no rows in, no rows out. Other columns are ignored.
    """
    if spacing + gram - 1 > least:
        raise ValueError("a passage must hold at least one retained suffix")
    chunks = pack(docs.select("doc_id", "text"))
    plain = chunks.select("chunk", "data")
    sums = totals(chunks, _count(gram, spacing)).drop("total", "distinct")
    order = ["right", "left", "chunk", "pos", "at"]
    counted = attach(plain, sums)
    found = materialise(
        counted
        .mapInArrow(
            _suffixes(least, gram, spacing, reach), "right binary, left binary, chunk long, pos int, at int"
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_neighbours(least, reach, True), _SPANS)
    )
    hot = materialise(
        counted.mapInArrow(
            _windows(least, gram, spacing, reach), "chunk long, size long, data binary"
        )
    )
    holders = totals(hot, _holders, 64).drop("total", "distinct")
    shared = attach(hot.select("chunk", "data"), holders).mapInArrow(
        _shared(least), "chunk long, pos int, first int, last int"
    )
    # 2 * reach rows for each partition of the sort; those of a short one come twice.
    edges = (
        found.where(F.col("right").isNotNull()).select(*order).repartition(1)
        .sortWithinPartitions(*order).mapInArrow(_neighbours(least, 2 * reach, False), _SPANS)
    )
    texts = materialise(
        plain.mapInArrow(_sizes, "chunk long, pos int, doc_id long, n_words long, node binary")
    )
    copies = texts.groupBy("node").agg(F.count(F.lit(1)).alias("copies"))
    texts = texts.join(copies, "node").drop("node")
    spans = (
        found.where(F.col("right").isNull()).unionByName(edges).select("chunk", "pos", "first", "last")
        .unionByName(shared)
        .groupBy("chunk", "pos")
        .agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("_spans"))
    )
    return (
        texts.join(spans, ["chunk", "pos"], "left")
        .withColumn(
            "passages",
            F.when(
                (F.col("copies") > 1) & (F.col("n_words") >= least),
                F.array(F.struct(F.lit(0).alias("first"), F.col("n_words").cast("int").alias("last"))),
            ).otherwise(merged(F.coalesce("_spans", F.array().cast("array<struct<first:int,last:int>>")))),
        )
        .select(
            "doc_id",
            "n_words",
            F.aggregate(
                "passages", F.lit(0).cast("bigint"), lambda n, x: n + x["last"] - x["first"]
            ).alias("n_repeated"),
            "passages",
            "copies",
        )
    )


def merged(spans):
    """The union of sorted spans; those that touch become one."""
    none = F.array().cast("array<struct<first:int,last:int>>")

    def step(done, x):
        end = F.try_element_at(done, F.lit(-1))
        longer = F.struct(
            end["first"].alias("first"), F.greatest(end["last"], x["last"]).alias("last")
        )
        return F.when(
            (F.size(done) > 0) & (x["first"] <= end["last"]),
            F.array_append(F.slice(done, 1, F.size(done) - 1), longer)
        ).otherwise(F.array_append(done, x))

    return F.aggregate(spans, none, step)
