"""Token ids as raw binary shards with a minimal perfect hash index over document keys.

A store is a folder. ``ids`` holds shards, files of unsigned little-endian ids of 16 bits, or
of 32 where the vocabulary needs them, one document after another, and nothing else. ``index`` holds a file for each bucket of keys:
a header, one pilot for each group of keys and one record for each key. ``shards`` and
``buckets`` are tables that name these files. A key is found by one pilot, one record and
one range of ids, whatever the size of the store.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from blotter.llm.words import mix, runs
from blotter.session import MOST_PARTITIONS, materialise, scratch

#: A shard ends at so many bytes of ids or documents; its readers hold one of them.
SHARD_BYTES = 32 << 20
SHARD_DOCS = 1 << 16
#: Keys of an index file, on average, and keys that share a pilot.
BUCKET_KEYS = 1 << 16
GROUP_KEYS = 2
#: Text that one task encodes; the more, the fewer words are encoded in several tasks.
TASK_BYTES = 64 << 20
#: Text encoded at once, and different words whose ids a task remembers.
SLICE_BYTES = 4 << 20
REMEMBERED = 1 << 20
_RECORD = np.dtype([("mark", "<u4"), ("shard", "<u4"), ("offset", "<u8"), ("n", "<u4")])
_HEADER = np.dtype([("keys", "<u8"), ("groups", "<u8")])


class TokenStore(NamedTuple):
    """``shards`` (shard, file, start, n_ids, n_docs, width), where ``width`` is the bytes of an
    id, and ``buckets`` (bucket, file, n_keys, buckets)."""

    path: str
    shards: DataFrame
    buckets: DataFrame


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, for tasks and the driver alike."""
    if re.match(r"file:/+", path) or "://" not in path:
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


class Encoder:
    """Ids of whole texts by a tokenizer file, an end id after each text.

    With ``apart`` the tokenizer is one that drops blanks and never looks across them, so
    that the ids of a text are those of its parts between blanks: each different part is
    encoded once, and the ids of up to ``REMEMBERED`` parts are kept for the next texts.
    """

    def __init__(self, path: str, end_id: int, apart: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._end, self._apart = end_id, apart
        self._forget()

    def _forget(self) -> None:
        self._known = pa.array([], pa.string())
        # The first part is the end of a text.
        self._ids = np.array([self._end], np.uint32)
        self._bounds = np.array([0, 1], np.int64)

    @property
    def width(self) -> int:
        """Bytes that hold any id."""
        return 2 if max(self._tokenizer.get_vocab_size() - 1, self._end) < 1 << 16 else 4

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has."""
        texts = pc.fill_null(texts, "")
        if self._apart:
            return self._by_parts(texts)
        found = self._tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)
        ids = [np.array([*x.ids, self._end], np.uint32) for x in found]
        return np.concatenate([np.empty(0, np.uint32), *ids]), np.array([len(x) for x in ids], np.int64)

    def _by_parts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.split_pattern(texts, " ")
        bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
        parts = split.flatten().dictionary_encode()
        at = pc.index_in(parts.dictionary, value_set=self._known)
        new = parts.dictionary.filter(at.is_null())
        at = at.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        if len(new):
            at[at == 0] = np.arange(len(self._known), len(self._known) + len(new)) + 1
            ids, counts = self._encode(new.to_pylist())
            self._known = pa.concat_arrays([self._known, new])
            self._ids = np.concatenate([self._ids, ids])
            self._bounds = np.concatenate([self._bounds, self._bounds[-1] + np.cumsum(counts)])
        code = np.insert(at[parts.indices.to_numpy()], bounds[1:], 0)
        first = self._bounds[code]
        lengths = self._bounds[code + 1] - first
        upto = np.concatenate([[0], np.cumsum(lengths)])
        shift = (first - upto[:-1]).astype(np.int32)
        ids = self._ids[np.arange(upto[-1], dtype=np.int32) + np.repeat(shift, lengths)]
        if len(self._known) > REMEMBERED:
            self._forget()
        return ids, np.diff(upto[bounds + np.arange(len(bounds))])

    def _encode(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts and how many each has: some hundred parts in one text at a time."""
        ids, counts = [], []
        sizes = np.array([len(x) + 1 for x in parts], np.int64)
        cut = np.cumsum(sizes) // (1 << 12)
        for low, high in zip(*(lambda x: (x, [*x[1:], len(parts)]))(np.unique(cut, return_index=True)[1])):
            found = self._tokenizer.encode(" ".join(parts[low:high]), add_special_tokens=False)
            starts = np.cumsum(sizes[low:high]) - sizes[low:high]
            first = np.fromiter(chain.from_iterable(found.offsets), np.int64, 2 * len(found))[::2]
            whose = np.searchsorted(starts, first, "right") - 1
            ids.append(np.array(found.ids, np.uint32))
            counts.append(np.bincount(whose, minlength=high - low))
        return np.concatenate(ids), np.concatenate(counts)


def _write_shards(folder: str, width: int, encoder: Callable[[], Encoder]):
    """Encode sorted documents into shards; a row for each shard with its documents."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        system, place = _place(folder)
        encode = None
        sink, name, rows, size, shard = None, "", [], 0, 0
        last, copies, seen = None, 0, False

        def row() -> pa.RecordBatch:
            columns = [np.concatenate(x) for x in list(zip(*rows))[1:]]
            keys = pa.concat_arrays([x[0] for x in rows])
            docs = pa.StructArray.from_arrays(
                [keys, *(pa.array(x, pa.int64()) for x in columns)], ["doc_id", "copy", "offset", "n"]
            )
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()), pa.array([part << 17 | shard], pa.int64()),
                    pa.array([name]), pa.array([size], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
                ],
                names=["part", "shard", "file", "n_ids", "docs"],
            )

        for batch in batches:
            texts, keys = batch["text"], batch["doc_id"].cast(pa.int64())
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
            for low, high in runs([range(int(x)) for x in sizes], SLICE_BYTES):
                encode = encode or encoder()
                ids, counts = encode(texts.slice(low, high - low))
                own = keys.slice(low, high - low)
                number = np.empty(len(own), np.int64)
                for i, key in enumerate(own.to_pylist()):
                    copies = copies + 1 if seen and key == last else 0
                    last, seen, number[i] = key, True, copies
                if sink is None:
                    # Named for this attempt: what a lost one leaves is never read.
                    name = f"{part:05d}-{shard:05d}-{uuid.uuid4().hex}.bin"
                    sink = system.open_output_stream(f"{place}/{name}")
                sink.write(memoryview(ids.astype(f"<u{width}")).cast("B"))
                rows.append((own, number, size + np.cumsum(counts) - counts, counts))
                size += len(ids)
                if size * width >= SHARD_BYTES or sum(len(x[0]) for x in rows) >= SHARD_DOCS:
                    sink.close()
                    yield row()
                    sink, rows, size, shard = None, [], 0, shard + 1
        if sink is not None:
            sink.close()
            yield row()

    return write


def minimal_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pilots and slots that place n distinct 64-bit keys on 0 to n - 1, one each.

    Keys fall into groups; the largest groups look for a pilot first, one that sends all
    their keys to free slots. All open groups of a size try a pilot together. A group of
    one key takes any slot left, which its pilot names as a negative number.
    """
    n = len(keys)
    groups = max(1, -(-n // GROUP_KEYS))
    pilots, slots = np.zeros(groups, np.int32), np.zeros(n, np.int64)
    group = _group(keys, groups)
    order = np.argsort(group, kind="stable")
    size = np.bincount(group, minlength=groups)
    first = np.cumsum(size) - size
    taken = np.zeros(n, bool)
    for many in range(int(size.max(initial=0)), 1, -1):
        open_ = np.flatnonzero(size == many)
        pilot = 0
        while len(open_):
            own = order[first[open_][:, None] + np.arange(many)]
            want = _slot(keys[own], np.full((1, 1), pilot, np.int32), n)
            ranked = np.sort(want, axis=1)
            free = np.flatnonzero(~taken[want].any(axis=1) & (np.diff(ranked, axis=1) > 0).all(axis=1))
            # Of the groups that want the same slot, the first takes it.
            flat = want[free].ravel()
            winner = np.zeros(len(flat), bool)
            winner[np.unique(flat, return_index=True)[1]] = True
            placed = free[winner.reshape(-1, many).all(axis=1)]
            taken[want[placed]] = True
            slots[own[placed]] = want[placed]
            pilots[open_[placed]] = pilot
            open_ = np.delete(open_, placed)
            pilot += 1
    alone = np.flatnonzero(size == 1)
    left = np.flatnonzero(~taken)
    slots[order[first[alone]]] = left
    pilots[alone] = -left - 1
    return pilots, slots


def _group(keys: np.ndarray, groups: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(groups)).astype(np.int64)


def _slot(keys: np.ndarray, pilots: np.ndarray, n: int) -> np.ndarray:
    """The slot of each key by its group's pilot."""
    salt = mix(pilots.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    hashed = (mix(keys ^ salt) % np.uint64(n)).astype(np.int64)
    return np.where(pilots < 0, -1 - pilots.astype(np.int64), hashed)


def _keys(name: np.ndarray, mark: np.ndarray) -> np.ndarray:
    return mix(name.view(np.uint64) ^ mix(mark.view(np.uint64)))


def _write_index(folder: str):
    def write(table: pa.Table) -> pa.Table:
        name, mark, shard, offset, n = (
            table[c].to_numpy() for c in ("name", "mark", "shard", "offset", "n")
        )
        pilots, slots = minimal_hash(_keys(name, mark))
        records = np.empty(len(name), _RECORD)
        for field, values in (("mark", mark.view(np.uint64)), ("shard", shard), ("offset", offset), ("n", n)):
            records[field][slots] = values.astype(_RECORD[field])
        bucket = int(table["bucket"][0].as_py())
        file = f"{bucket:07d}-{uuid.uuid4().hex}.mph"
        system, place = _place(folder)
        with system.open_output_stream(f"{place}/{file}") as sink:
            sink.write(np.array([(len(name), len(pilots))], _HEADER).tobytes())
            sink.write(pilots.astype("<i4").tobytes())
            sink.write(records.tobytes())
        return pa.table({"bucket": [bucket], "file": [file], "n_keys": [len(name)]})

    return write


def _take(file: pa.NativeFile, start: int, kind: np.dtype, n: int, which: np.ndarray) -> np.ndarray:
    """Entries of an array of n in a file: one by one if few, else of the whole array."""
    if len(which) * 256 < n:
        read = [file.read_at(kind.itemsize, start + int(i) * kind.itemsize) for i in which]
        return np.frombuffer(b"".join(read), kind)
    return np.frombuffer(file.read_at(n * kind.itemsize, start), kind)[which]


def _find(folder: str):
    """The places of asked keys, by pilot and record; keys whose mark differs are absent."""

    def find(table: pa.Table) -> pa.Table:
        name, mark = table["name"].to_numpy(), table["mark"].to_numpy()
        keys = _keys(name, mark)
        system, place = _place(folder)
        with system.open_input_file(f"{place}/{table['file'][0].as_py()}") as file:
            head = np.frombuffer(file.read_at(_HEADER.itemsize, 0), _HEADER)[0]
            n, groups = int(head["keys"]), int(head["groups"])
            pilot_kind = np.dtype("<i4")
            pilots = _take(file, _HEADER.itemsize, pilot_kind, groups, _group(keys, groups))
            start = _HEADER.itemsize + groups * pilot_kind.itemsize
            records = _take(file, start, _RECORD, n, _slot(keys, pilots, n))
        found = records["mark"] == mark.view(np.uint64).astype(np.uint32)
        records = records[found]
        return pa.table(
            [
                *(table[c].filter(pa.array(found)).combine_chunks() for c in ("doc_id", "copy")),
                *(pa.array(records[c].astype(np.int64)) for c in ("shard", "offset", "n")),
            ],
            names=["doc_id", "copy", "shard", "offset", "n"],
        )

    return find


def _read(folder: str):
    """The ids of the places asked of one shard, in the order they lie there."""

    def read(table: pa.Table) -> pa.Table:
        table = table.sort_by("offset")
        system, place = _place(folder)
        with system.open_input_file(f"{place}/{table['file'][0].as_py()}") as file:
            width = table["width"][0].as_py()
            raw = [
                file.read_at(width * n, width * at)
                for at, n in zip(table["offset"].to_pylist(), table["n"].to_pylist())
            ]
            ids = [np.frombuffer(x, f"<u{width}").astype("<u4").tobytes() for x in raw]
        return pa.table(
            {
                "doc_id": table["doc_id"], "copy": table["copy"],
                "start": pc.add(table["first"], table["offset"]),
                "n_tokens": table["n"], "ids": pa.array(ids, pa.binary()),
            }
        )

    return read


def _hashes(doc_id: str | Column = "doc_id", copy: str | Column = "copy") -> tuple[Column, Column]:
    """Two independent hashes of a key: its name, and its mark kept as a fingerprint."""
    return F.xxhash64(doc_id, copy).alias("name"), F.xxhash64(F.lit("mark"), copy, doc_id).alias("mark")


def write_store(
    docs: DataFrame, tokenizer: str, end_id: int, apart: bool = False, path: str | None = None
) -> TokenStore:
    """Encode ``docs`` (doc_id, text) into a store, in ascending order of doc_id.

    ``tokenizer`` is the path of a tokenizer file on all machines; ``apart`` says that it
    drops blanks and never looks across them. ``path`` is a new folder that all executors
    see, by default one below ``spark.checkpoint.dir``.

    A null text is empty and has the end id alone. Null doc_ids come first. Rows with the
    same doc_id are numbered as copies 0, 1, ... by hash of their text, then text, and each is
    found by (doc_id, copy). Other columns are ignored. An empty table gives an empty store.

    Texts are dealt by range of (doc_id, hash of text), about ``TASK_BYTES`` to a task, so a
    doc_id with very many rows is cut as well. What the driver sees is one row for each of these ranges.
    """
    spark = docs.sparkSession
    path = path or scratch(spark, "token-store")
    for folder in ("ids", "index"):
        system, place = _place(f"{path}/{folder}")
        system.create_dir(place, recursive=True)
    width = Encoder(tokenizer, end_id, apart).width
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    hashed = F.xxhash64("text")
    files = materialise(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(min(MOST_PARTITIONS, -(-size // TASK_BYTES) or 1), "doc_id", hashed)
        .sortWithinPartitions("doc_id", hashed, "text")
        .mapInArrow(
            _write_shards(f"{path}/ids", width, lambda: Encoder(tokenizer, end_id, apart)),
            "part int, shard long, file string, n_ids long, "
            "docs array<struct<doc_id long, copy long, offset long, n long>>",
        )
    )
    ends = files.select(
        "part", "shard", "n_ids", F.col("docs")[0]["doc_id"].alias("low"),
        F.element_at("docs", -1).alias("high"),
    )
    parts = (
        ends.groupBy("part").agg(
            F.min_by("low", "shard").alias("low"), F.max_by("high", "shard").alias("high"),
            F.sum("n_ids").alias("n_ids"),
        ).orderBy("part").collect()
    )
    # At most a row for each partition of the sort, here and in the broadcast.
    known, start, run, before = [], 0, None, 0
    for p in parts:
        carried = before if run == (p["low"],) else 0
        known.append((p["part"], start, p["low"], carried))
        before = p["high"]["copy"] + 1 + (carried if p["low"] == p["high"]["doc_id"] else 0)
        run, start = (p["high"]["doc_id"],), start + p["n_ids"]
    known = F.broadcast(spark.createDataFrame(known, "part int, _start long, _low long, _carried long"))
    inside = Window.partitionBy("part").orderBy("shard")
    files.select("part", "shard", "file", "n_ids", F.size("docs").cast("long").alias("n_docs")).join(
        known, "part"
    ).select(
        "shard", "file", (F.col("_start") + F.sum("n_ids").over(inside) - F.col("n_ids")).alias("start"),
        "n_ids", "n_docs", F.lit(width).alias("width"),
    ).write.parquet(f"{path}/shards")
    count = files.agg(F.coalesce(F.sum(F.size("docs")), F.lit(0))).first()[0]
    buckets = max(1, -(-count // BUCKET_KEYS))
    copy = F.col("copy") + F.when(F.col("doc_id").eqNullSafe(F.col("_low")), F.col("_carried")).otherwise(0)
    (
        files.select("part", "shard", F.explode("docs").alias("_d")).select("part", "shard", "_d.*")
        .join(known, "part")
        .select("shard", "offset", "n", *_hashes("doc_id", copy))
        .withColumn("bucket", F.pmod("name", F.lit(buckets)))
        .groupBy("bucket").applyInArrow(_write_index(f"{path}/index"), "bucket long, file string, n_keys long")
        .withColumn("buckets", F.lit(buckets).cast("long"))
        .write.parquet(f"{path}/buckets")
    )
    return open_store(spark, path)


def open_store(spark: SparkSession, path: str) -> TokenStore:
    return TokenStore(path, spark.read.parquet(f"{path}/shards"), spark.read.parquet(f"{path}/buckets"))


def lookup(store: TokenStore, keys: DataFrame) -> DataFrame:
    """Documents by key: (doc_id, copy, start, n_tokens, ids) for ``keys`` (doc_id[, copy]).

    Copy is 0 where there is no such column. ``start`` counts the ids of all documents
    before, ``ids`` are bytes, four for each id, little-endian. Repeated keys are asked once; keys that the store
    does not hold have no row, but for one in 2^32, which the fingerprint cannot tell.

    Keys go to the files of their buckets, at most ``BUCKET_KEYS`` or so at a time, and what
    is found to its shards.
    """
    if "copy" not in keys.columns:
        keys = keys.withColumn("copy", F.lit(0))
    keys = keys.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("copy").cast("long").alias("copy"))
    sizes = store.buckets.agg(F.max("buckets")).first()[0]
    if sizes is None:
        return keys.limit(0).selectExpr("doc_id", "copy", "0L start", "0L n_tokens", "cast('' as binary) ids")
    asked = keys.distinct()
    slices = max(1, -(-asked.count() // (sizes * BUCKET_KEYS)))
    found = (
        asked.select("doc_id", "copy", *_hashes())
        .withColumn("bucket", F.pmod("name", F.lit(sizes)))
        .withColumn("_slice", F.pmod("mark", F.lit(slices)))
        .join(store.buckets.select("bucket", "file"), "bucket")
        .groupBy("bucket", "_slice")
        .applyInArrow(_find(f"{store.path}/index"), "doc_id long, copy long, shard long, offset long, n long")
    )
    return (
        found.join(store.shards.select("shard", "file", "width", F.col("start").alias("first")), "shard")
        .groupBy("shard")
        .applyInArrow(
            _read(f"{store.path}/ids"), "doc_id long, copy long, start long, n_tokens long, ids binary"
        )
    )
