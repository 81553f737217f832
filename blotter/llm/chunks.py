"""Documents packed into chunks, and exact global sums for the keys that occur in them.

A chunk is one row with some megabytes of documents. What is counted in a chunk travels as
a few sorted arrays, one for each bucket of keys, instead of a row for each key, and the
sums come back as arrays in the same order. So nothing that grows with the corpus is
broadcast or held whole, and no key is ever alone in a row.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from blotter.operators.joins import BROADCAST_BYTES
from blotter.session import materialise, scratch

#: Text in a chunk, and keys in a bucket: a worker holds some ten times as much. Larger ones
#: mean fewer and longer arrays; raise both with the memory of the executors.
CHUNK_BYTES = 2 << 20
BUCKET_BYTES = 8 << 20
#: Row groups of the table of chunks; a reader holds one of them.
GROUP_BYTES = 8 << 20


def pack(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows (chunk, n, size, data): ``n`` rows of ``docs`` with ``size`` bytes of text each.

    A chunk holds about ``chunk_bytes`` of text, or one longer document. It is written to
    the shared folder, so that its rows keep their places whatever is computed again.
    """

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            text = batch["text"].cast(pa.binary())
            lengths = pc.fill_null(pc.binary_length(text), 0).to_pylist()
            low = 0
            for i, length in enumerate(lengths):
                if size and size + length > chunk_bytes:
                    held.append(batch.slice(low, i - low))
                    yield _row(chunk, held, size)
                    chunk, held, size, low = chunk + 1, [], 0, i
                size += length
            held.append(batch.slice(low))
        if sum(b.num_rows for b in held):
            yield _row(chunk, held, size)

    path = scratch(docs.sparkSession, "chunks")
    schema = "chunk long, n long, size long, data binary"
    filled = docs.mapInArrow(fill, schema)
    filled.write.option("parquet.block.size", GROUP_BYTES).parquet(path)
    return docs.sparkSession.read.schema(filled.schema).parquet(path)


def _row(chunk: int, held: list[pa.RecordBatch], size: int) -> pa.RecordBatch:
    table = pa.Table.from_batches(held).combine_chunks()
    return pa.RecordBatch.from_arrays(
        [
            pa.array([chunk], pa.int64()), pa.array([table.num_rows], pa.int64()),
            pa.array([size], pa.int64()), pa.array([packed(table)], pa.binary()),
        ],
        names=["chunk", "n", "size", "data"],
    )


def packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of the batches one by one, as dictionaries."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch[name][i].as_py() for name in batch.schema.names}


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets by ranges of evenly spread 64-bit keys, so sorted keys stay sorted."""
    return (((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def squeeze(values: np.ndarray) -> bytes:
    """An array of non-negative whole numbers, mostly small, in few bytes: in four planes, or
    in eight if any is 2^32 or more. The first byte says which."""
    width = 8 if len(values) and values.max() > 0xFFFFFFFF else 4
    planes = np.ascontiguousarray(values, f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + zlib.compress(np.ascontiguousarray(planes).tobytes(), 1)


def expand(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(zlib.decompress(memoryview(data)[1:]), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel()


def shorten(keys: np.ndarray) -> bytes:
    """Sorted distinct 64-bit keys as differences of four bytes; a gap of 2^32 - 1 or more
    is written out in full after the others, with the mark of four full bytes in place."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    mark = np.uint64(0xFFFFFFFF)
    wide = np.flatnonzero(gaps >= mark)
    small = np.minimum(gaps, mark).astype("<u4")
    return len(keys).to_bytes(4, "little") + small.tobytes() + gaps[wide].astype("<u8").tobytes()


def lengthen(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    gaps = np.frombuffer(data, "<u4", n, 4).astype(np.uint64)
    gaps[gaps == 0xFFFFFFFF] = np.frombuffer(data, "<u8", offset=4 + 4 * n)
    return np.cumsum(gaps, dtype=np.uint64)


def totals(
    chunks: DataFrame,
    count: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]],
    key_bits: int = 48,
) -> DataFrame:
    """Global sums for all keys of every chunk: rows (chunk, bytes, sums, total, distinct).

    ``count`` gives the sorted distinct keys of a chunk (evenly spread in the upper
    ``key_bits`` of 64 bits, the others zero) and how often each counts there. ``sums``
    are pieces to be joined by ``joined``: the sum over all chunks for each of these keys,
    in their order; ``bytes`` is what they weigh. ``total`` and ``distinct`` are shares of
    the sum over all keys and of the number of keys with a sum, to be added up.
    """
    # Keys weigh up to 8 bytes for every 6 of text: buckets of bounded size.
    size = chunks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    buckets = max(1, -(-size * 4 // 3 // BUCKET_BYTES))
    shift = np.uint64(64 - key_bits)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            keys, counts = count(unpack(row["data"]))
            which, first = np.unique(bucket_of(keys, buckets), return_index=True)
            ends = [*first[1:], len(keys)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(which, pa.int64()),
                    pa.array([row["chunk"]] * len(which), pa.int64()),
                    pa.array([shorten(keys[a:b] >> shift) for a, b in zip(first, ends)], pa.binary()),
                    pa.array([squeeze(counts[a:b]) for a, b in zip(first, ends)], pa.binary()),
                ],
                names=["bucket", "chunk", "keys", "counts"],
            )

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [lengthen(x) for x in frame["keys"]]
        counts = np.concatenate([expand(x) for x in frame["counts"]])
        _, code = np.unique(np.concatenate(parts), return_inverse=True)
        by_key = np.bincount(code, weights=counts)
        sums = by_key[code]
        ends = np.cumsum([len(x) for x in parts])[:-1]
        first = np.arange(len(frame)) == 0
        return pd.DataFrame(
            {
                "chunk": frame["chunk"],
                "bucket": frame["bucket"],
                "sums": [squeeze(x) for x in np.split(sums, ends)],
                "total": first * int(by_key.sum()),
                "distinct": first * int((by_key > 0).sum()),
            }
        )

    asked = chunks.select("chunk", "data").mapInArrow(
        ask, "bucket long, chunk long, keys binary, counts binary"
    )
    added = asked.groupBy("bucket").applyInPandas(
        add, "chunk long, bucket long, sums binary, total long, distinct long"
    )
    # One row for each chunk and bucket; a chunk's sums are no larger than the chunk.
    return materialise(
        added.groupBy("chunk").agg(
            F.sum(F.octet_length("sums") + 64).alias("bytes"),
            F.array_sort(F.collect_list(F.struct("bucket", "sums"))).alias("sums"),
            F.sum("total").alias("total"),
            F.sum("distinct").alias("distinct"),
        )
    )


def joined(pieces: list[dict]) -> np.ndarray:
    """The sums of a chunk, in the order of its keys."""
    return np.concatenate([expand(x["sums"]) for x in pieces] or [np.empty(0, np.uint32)])


def attach(chunks: DataFrame, notes: DataFrame, how: str = "inner") -> DataFrame:
    """Join chunks with notes about them (chunk, bytes, and more; one row for a chunk).

    Notes that weigh at most the bound for broadcasts in all go to the chunks, where these
    lie; others meet them in a shuffle.
    """
    weight = notes.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    notes = notes.drop("bytes")
    return chunks.join(F.broadcast(notes) if weight <= BROADCAST_BYTES else notes, "chunk", how)
