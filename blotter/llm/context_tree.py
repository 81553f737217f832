"""Code lengths of texts by context-tree weighting over bytes, with a unigram base line."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from blotter.llm.chunks import (
    expand, joined, lengthen, pack, rows_of, shorten, squeeze, totals, unpack,
)
from blotter.llm.words import as_bytes, hash_words, mix, no_space, runs
from blotter.session import materialise

DEPTH = 5
CHUNK_BYTES = 8 << 20
BUCKETS = 128
#: So many chunks of a bucket meet in one task.
SALT_CHUNKS = 256
RUN_BYTES = 1 << 20
#: Bytes that no UTF-8 text holds: before the text, and after it.
PAD, END = b"\xfe", b"\xff"
_END_TOKEN = np.uint64(0x9E3779B97F4A7C15)
HELD_OUT = 2


def held_out(names: list) -> np.ndarray:
    """Whether a document is kept from training: crc32 of its id as text, modulo 7, is 2."""
    texts = ["" if x is None else str(x) for x in names]
    return np.array([zlib.crc32(x.encode()) % 7 == HELD_OUT for x in texts], bool)


def byte_grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Per byte of each text and its end: the bytes before it, nearest first, and itself.

    As a number whose upper bytes are the context, so that shorter contexts are prefixes;
    and where each text's numbers start.
    """
    data = np.frombuffer(b"".join(PAD * depth + t + END for t in texts), np.uint8)
    total = np.zeros(max(len(data) - depth, 0), np.uint64)
    for d in range(1, depth + 1):
        total = (total << np.uint64(8)) | data[depth - d : len(data) - d]
    total = (total << np.uint64(8)) | data[depth:]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return total[data[depth:] != PAD[0]], np.concatenate([[0], np.cumsum(sizes)])


def _log_gamma(x: np.ndarray) -> np.ndarray:
    low = np.log(x)
    for i in range(1, 8):
        low = low + np.log(x + i)
    z = x + 8
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series - low


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return (
        _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0)
        - np.log(np.pi)
    )


def _group(ids: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    distinct, code = np.unique(ids, return_inverse=True)
    return distinct, *(np.bincount(code, v, len(distinct)) for v in values)


def _weigh(estimate: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log of a node's weighted probability and of the share of its own estimate in it."""
    whole = np.logaddexp(estimate, below) - np.log(2)
    return whole, estimate - np.log(2) - whole


def _paths(grams: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For the eight bits of each last byte: the bits before it, with a leading 1, and it."""
    byte = grams & np.uint64(255)
    for j in range(8):
        yield (
            np.uint64(1 << j) | (byte >> np.uint64(8 - j)),
            (byte >> np.uint64(7 - j)) & np.uint64(1),
        )


class Tree:
    """Nodes of the contexts of 2 to ``depth`` bytes that share a bucket, by depth.

    A node is a context and the bits of the next byte so far. It has sorted ids, counts of
    zeros and ones, and the log of the weight of its own estimate.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray, depth: int):
        self.depth, self.levels = depth, {}
        ids, zeros, ones = [], [], []
        for path, bit in _paths(grams):
            ids.append(((grams >> np.uint64(8)) << np.uint64(8)) | path)
            zeros.append(np.where(bit == 0, counts, 0))
            ones.append(np.where(bit == 1, counts, 0))
        node, zeros, ones = _group(*map(np.concatenate, (ids, zeros, ones)))
        log_p = log_kt(zeros, ones)
        self.levels[depth] = node, zeros, ones, np.zeros(len(node))
        for d in range(depth - 1, 0, -1):
            above = ((node >> np.uint64(16)) << np.uint64(8)) | (node & np.uint64(255))
            node, zeros, ones, below = _group(above, zeros, ones, log_p)
            if d == 1:  # other buckets hold more of it
                self.top = node, zeros, ones, below
                break
            log_p, share = _weigh(log_kt(zeros, ones), below)
            self.levels[d] = node, zeros, ones, share

    def log10(self, grams: np.ndarray, top: list[tuple]) -> np.ndarray:
        """Log10 of the probability of each gram's last byte after its context.

        Every bit mixes the estimates of all depths. A context without training data adds
        nothing: the mixture ends with the one above it.
        """
        total = np.zeros(len(grams))
        for path, bit in _paths(grams):
            found = []
            for d in range(self.depth + 1):
                context = grams >> np.uint64(8 * (self.depth + 1 - d))
                ids = (context << np.uint64(8)) | path
                if d < 2:
                    zeros, ones, share = (x[ids.astype(np.int64)] for x in top[d])
                    here = zeros + ones > 0
                else:
                    node, *values = self.levels[d]
                    at = np.minimum(np.searchsorted(node, ids), max(len(node) - 1, 0))
                    here = node[at] == ids if len(node) else np.zeros(len(ids), bool)
                    zeros, ones, share = (
                        x[at] if len(node) else np.zeros(len(ids)) for x in values
                    )
                chance = (np.where(bit == 0, zeros, ones) + 0.5) / (zeros + ones + 1)
                found.append((here, chance, np.exp(share)))
            mixture = np.full(len(grams), 0.5)
            for d in range(self.depth, -1, -1):
                here, chance, share = found[d]
                last = np.ones(len(grams), bool) if d == self.depth else ~found[d + 1][0]
                mixture = np.where(
                    here, np.where(last, chance, share * chance + (1 - share) * mixture), mixture
                )
            total += np.log10(mixture)
        return total


def _pairs(grams: np.ndarray, depth: int) -> np.ndarray:
    """The bucket of each gram: that of the two bytes before, so subtrees stay together."""
    pair = grams >> np.uint64(8 * (depth - 1))
    return (mix(pair + np.uint64(1)) % np.uint64(BUCKETS)).astype(np.int64)


def _counted(row: dict, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams of a chunk and how often each comes in training documents."""
    table = unpack(row["data"])
    texts = as_bytes(table["text"].combine_chunks())
    grams, starts = byte_grams(texts, depth)
    train = np.repeat(~held_out(table["doc_id"].to_pylist()), np.diff(starts))
    marked = np.sort((grams << np.uint64(1)) | train)
    grams = marked >> np.uint64(1)
    first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])) if len(grams) else []
    if not len(grams):
        return grams, np.empty(0, np.int64)
    return grams[first], np.add.reduceat((marked & np.uint64(1)).astype(np.int64), first)


def _asked(depth: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            grams, counts = _counted(row, depth)
            bucket = _pairs(grams, depth)
            order = np.argsort(bucket, kind="stable")
            which, first = np.unique(bucket[order], return_index=True)
            parts = np.split(order, first[1:]) if len(which) else []
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(which, pa.int64()),
                    pa.array([row["salt"]] * len(which), pa.int64()),
                    pa.array([row["chunk"]] * len(which), pa.int64()),
                    pa.array([shorten(grams[x]) for x in parts], pa.binary()),
                    pa.array([squeeze(counts[x]) for x in parts], pa.binary()),
                ],
                names=["bucket", "salt", "chunk", "keys", "counts"],
            )

    return ask


def _merge(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    grams = np.concatenate([lengthen(x) for x in frame["keys"]])
    counts = np.concatenate([np.frombuffer(zlib.decompress(x), np.float64) for x in frame["counts"]])
    return _group(grams, counts)


def _partial(frame: pd.DataFrame) -> pd.DataFrame:
    """Sums over the chunks of one salt; grams of held-out documents alone go."""
    grams = np.concatenate([lengthen(x) for x in frame["keys"]])
    counts = np.concatenate([expand(x) for x in frame["counts"]])
    grams, sums = _group(grams[counts > 0], counts[counts > 0])
    return pd.DataFrame(
        {
            "bucket": frame["bucket"].iloc[:1], "keys": [shorten(grams)],
            "counts": [zlib.compress(sums.tobytes(), 1)],
        }
    )


def _model(depth: int):
    def model(frame: pd.DataFrame) -> pd.DataFrame:
        grams, counts = _merge(frame)
        return pd.DataFrame(
            {
                "bucket": frame["bucket"].iloc[:1], "keys": [shorten(grams)],
                "counts": [zlib.compress(counts.tobytes(), 1)],
                "top": [np.stack([x.astype(np.float64) for x in Tree(grams, counts, depth).top]).tobytes()],
            }
        )

    return model


def _top_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in rows_of(batches):
        node, zeros, ones, below = np.frombuffer(row["top"]).reshape(4, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(node.astype(np.int64)), pa.array(zeros), pa.array(ones), pa.array(below)],
            names=["node", "zeros", "ones", "below"],
        )


def _top(model: DataFrame) -> list[tuple]:
    """Counts and shares of contexts of no and of one byte: 256 and 65 536 nodes at most."""
    rows = (
        model.select("top").mapInArrow(_top_rows, "node long, zeros double, ones double, below double")
        .groupBy("node").agg(F.sum("zeros"), F.sum("ones"), F.sum("below"))
        .orderBy("node").collect()
    )
    levels = []
    node = np.array([r[0] for r in rows], np.int64)
    zeros, ones, below = (np.array([r[i] for r in rows], np.float64) for i in (1, 2, 3))
    for size in (1 << 16, 1 << 8):
        log_p, share = _weigh(log_kt(zeros, ones), below)
        full = [np.zeros(size) for _ in range(3)]
        for target, values in zip(full, (zeros, ones, share)):
            target[node] = values
        levels.append(tuple(full))
        node, zeros, ones, below = _group(node & 255, zeros, ones, log_p)
    return levels[::-1]


def _answers(depth: int, top: list[tuple]):
    def answer(asked: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        if asked.empty:
            return pd.DataFrame({"chunk": [], "bucket": [], "logs": []})
        parts = [lengthen(x) for x in asked["keys"]]
        grams, code = np.unique(np.concatenate(parts), return_inverse=True)
        known = _merge(model) if len(model) else (np.empty(0, np.uint64), np.empty(0))
        logs = Tree(*known, depth).log10(grams, top).astype(np.float32)[code]
        ends = np.cumsum([len(x) for x in parts])[:-1]
        return pd.DataFrame(
            {
                "chunk": asked["chunk"], "bucket": asked["bucket"],
                "logs": [x.tobytes() for x in np.split(logs, ends)],
            }
        )

    return answer


def _tokens(texts: list[bytes]):
    """Hashes of the tokens of texts, an end token after each; where each text's start."""
    for low, high in runs(texts, RUN_BYTES):
        words, _, _, _, bounds = hash_words(texts[low:high], no_space())
        yield low, np.insert(words, bounds[1:], _END_TOKEN), bounds + np.arange(len(bounds))


def _count_tokens(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    texts = as_bytes(table["text"].combine_chunks())
    train = ~held_out(table["doc_id"].to_pylist())
    found, marks = [np.empty(0, np.uint64)], [np.empty(0)]
    for low, tokens, bounds in _tokens(texts):
        found.append(tokens)
        marks.append(np.repeat(train[low : low + len(bounds) - 1], np.diff(bounds)).astype(float))
    return _group(np.concatenate(found), np.concatenate(marks))


def _score(depth: int, total: int, distinct: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            table = unpack(row["data"])
            names = table["doc_id"].to_pylist()
            texts = as_bytes(table["text"].combine_chunks())
            grams, starts = byte_grams(texts, depth)
            keys = np.unique(grams)
            order = np.argsort(_pairs(keys, depth), kind="stable")
            logs = np.empty(len(keys))
            logs[order] = np.concatenate(
                [np.frombuffer(x["logs"], np.float32) for x in row["answers"]] or [np.empty(0)]
            )
            scores = np.add.reduceat(logs[np.searchsorted(keys, grams)], starts[:-1])
            tokens, sums = list(_tokens(texts)), joined(row["sums"] or [])
            words = np.unique(np.concatenate([t for _, t, _ in tokens]))
            sizes, known, base = (np.zeros(len(texts), k) for k in (np.int64, np.int64, float))
            for low, mine, bounds in tokens:
                own = slice(low, low + len(bounds) - 1)
                counts = sums[np.searchsorted(words, mine)]
                sizes[own] = np.diff(bounds)
                known[own] = np.add.reduceat((counts > 0).astype(np.int64), bounds[:-1])
                base[own] = np.add.reduceat(np.log10(counts + 1.0), bounds[:-1])
            base -= sizes * np.log10(total + distinct + 1.0)
            yield pa.RecordBatch.from_arrays(
                [
                    table["doc_id"].combine_chunks().cast(pa.int64()),
                    pa.array(held_out(names)),
                    pa.array(sizes), pa.array(known),
                    pa.array(np.full(len(texts), total, np.int64)),
                    pa.array(base), pa.array(scores),
                    pa.array([-s / np.log10(2) / (len(t) + 1) for s, t in zip(scores, texts)], pa.float64()),
                ],
                names=[
                    "doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                    "base_score", "score", "bits_per_byte",
                ],
            )

    return score


def score_texts(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The code length of every text of ``docs`` (doc_id, text).

    Context-tree weighting: a byte is eight binary decisions, each in the context of the
    up to ``depth`` bytes before it and of the bits already decided. Every context has a
    Krichevsky-Trofimov estimate from all training documents, and the estimates of all
    depths are mixed with the weights that the tree gives them on the training data. The
    text is followed by an end byte, so that its probabilities sum to 1; it starts in a
    context of ``depth`` pad bytes.

    Training documents are those whose crc32 of doc_id as text is not 2 modulo 7 (a null
    doc_id is the empty text). Counts come from all of them, in buckets by the two bytes
    before; only contexts of at most one byte, 65 792 nodes, go to every task.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one
    unigrams over lower-cased words and one end token a document), score (log10 of the
    probability of the text) and bits_per_byte. Null texts are empty and have the end
    only. Repeated rows are scored alike and train as often as they come; without
    training data every bit has probability 1/2. No rows in, no rows out.
    """
    chunks = pack(docs.select("doc_id", "text"), CHUNK_BYTES)
    salts = -(-chunks.count() // SALT_CHUNKS) or 1
    salt = F.pmod(F.xxhash64("chunk"), F.lit(salts)).alias("salt")
    asked = chunks.select("chunk", "data", salt).mapInArrow(
        _asked(depth), "bucket long, salt long, chunk long, keys binary, counts binary"
    )
    model = materialise(
        asked.groupBy("bucket", "salt")
        .applyInPandas(_partial, "bucket long, keys binary, counts binary")
        .groupBy("bucket")
        .applyInPandas(_model(depth), "bucket long, keys binary, counts binary, top binary")
    )
    everywhere = model.drop("top").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    answers = (
        asked.drop("counts").groupBy("bucket", "salt")
        .cogroup(everywhere.select("bucket", F.col("salt").cast("bigint"), "keys", "counts").groupBy("bucket", "salt"))
        .applyInPandas(_answers(depth, _top(model)), "chunk long, bucket long, logs binary")
        .groupBy("chunk")
        .agg(F.array_sort(F.collect_list(F.struct("bucket", "logs"))).alias("answers"))
    )
    counts = totals(chunks, _count_tokens, key_bits=64)
    total, distinct = counts.agg(
        F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))
    ).first()
    return (
        chunks.select("chunk", "data").join(answers, "chunk").join(counts.select("chunk", "sums"), "chunk")
        .mapInArrow(
            _score(depth, total, distinct),
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double, bits_per_byte double",
        )
    )
