"""SimHash fingerprints and the search of all of them within a Hamming radius."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from blotter.llm.words import _FACTOR, hash_words, letters, mix, owners, runs
from blotter.session import materialise

BITS = 64
RUN_BYTES = 1 << 18
RADIUS = 3


def simhash(texts: list[bytes]) -> np.ndarray:
    """The 64-bit fingerprint of each text.

    Terms are words and pairs of neighbouring words; a term that comes n times weighs
    1 + ln n, in whole 256ths so that sums are exact. Each term's hash votes with its
    weight on every bit, for 1 or 0; more than half the votes set the bit. A text without
    words has one term, itself; the empty text has the fingerprint 0.
    """
    result = np.zeros(len(texts), np.uint64)
    for low, high in runs(texts, RUN_BYTES):
        words, _, _, _, bounds = hash_words(texts[low:high], letters())
        owner = owners(bounds)
        pairs = mix(words[:-1] * np.uint64(_FACTOR) + words[1:])
        inside = owner[:-1] == owner[1:] if len(owner) else np.empty(0, bool)
        bare = [i for i in range(high - low) if bounds[i] == bounds[i + 1] and texts[low + i]]
        whole = [int.from_bytes(sha256(texts[low + i]).digest()[:8], "little") for i in bare]
        terms = np.concatenate([words, pairs[inside], np.array(whole, np.uint64)])
        owner = np.concatenate([owner, owner[:-1][inside], np.array(bare, np.int64)])
        if not len(terms):
            continue
        order = np.lexsort((terms, owner))
        terms, owner = terms[order], owner[order]
        fresh = np.concatenate([[True], (terms[1:] != terms[:-1]) | (owner[1:] != owner[:-1])])
        at = np.flatnonzero(fresh)
        times = np.diff(np.concatenate([at, [len(terms)]]))
        weight = np.rint(256 * (1 + np.log(times))).astype(np.int32)
        terms, owner = terms[at], owner[at]
        bits = np.unpackbits(terms.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.concatenate([[0], np.flatnonzero(owner[1:] != owner[:-1]) + 1])
        votes = np.add.reduceat(bits * weight[:, None], first, axis=0, dtype=sums_in(len(terms)))
        every = np.add.reduceat(weight, first, dtype=np.int64)
        packed = np.packbits(2 * votes.astype(np.int64) > every[:, None], axis=1, bitorder="little")
        result[low + owner[first]] = np.ascontiguousarray(packed).view(np.uint64).ravel()
    return result


def sums_in(terms: int) -> type:
    """The whole numbers that sums of so many weights fit; a weight is below 2^13."""
    return np.int32 if terms < 1 << 18 else np.int64


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 less the share of bits that differ."""
    return 1 - np.bitwise_count(a ^ b) / BITS


def _edited(text: str, following: str) -> str:
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


_COLUMNS = {
    "doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(),
    "fingerprint": pa.string(), "edited_fingerprint": pa.string(),
    "near_edited": pa.float64(), "near_next": pa.float64(), "_fp": pa.int64(),
    "_edge": pa.string(), "_text": pa.string(),
}
_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, _fp long, "
    "_edge string, _text string"
)


def _judge(ids: list, texts: list[str], following: list[str]) -> dict[str, list]:
    """Judge texts that follow one another; ``following`` are the texts after each."""
    edited = [_edited(a, b).encode() for a, b in zip(texts, following)]
    # What follows a text is the next one, so all but the last come anyway.
    marks = simhash([x.encode() for x in [*texts, following[-1]]])
    own, after, changed = marks[:-1], marks[1:], simhash(edited)
    return {
        "doc_id": ids,
        "n_chars": list(map(len, texts)),
        "edited_sha256": [sha256(x).hexdigest() for x in edited],
        "fingerprint": [f"{x:016x}" for x in own.tolist()],
        "edited_fingerprint": [f"{x:016x}" for x in changed.tolist()],
        "near_edited": likeness(own, changed).tolist(),
        "near_next": likeness(own, after).tolist(),
        "_fp": own.view(np.int64).tolist(),
    }


def _batch(columns: dict[str, list]) -> pa.RecordBatch:
    n = len(columns["doc_id"])
    return pa.RecordBatch.from_arrays(
        [pa.array(columns.get(c, [None] * n), kind) for c, kind in _COLUMNS.items()],
        names=list(_COLUMNS),
    )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Judge each row of a sorted partition with the next; hand on its first and last row."""
    held: tuple | None = None
    for batch in batches:
        ids = batch["doc_id"].to_pylist()
        texts = ["" if x is None else x for x in batch["text"].to_pylist()]
        if not ids:
            continue
        if held is None:
            yield _batch({"doc_id": ids[:1], "_edge": ["first"], "_text": texts[:1]})
        else:
            ids, texts = [held[0], *ids], [held[1], *texts]
        held = ids[-1], texts[-1]
        for low, high in runs([x.encode() for x in texts[:-1]], 4 * RUN_BYTES):
            yield _batch(_judge(ids[low:high], texts[low:high], texts[low + 1 : high + 1]))
    if held is not None:
        yield _batch({"doc_id": [held[0]], "_edge": ["last"], "_text": [held[1]]})


def _last_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, text, following in zip(*(batch[c].to_pylist() for c in ("doc_id", "_text", "_next"))):
            yield _batch(_judge([name], [text], [following]))


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text of ``docs`` (doc_id, text) and of its edited text.

    The edited text is the text with its last quarter of code points (rounded down)
    replaced by as many of the next document's first, or all of them; documents follow by
    ascending doc_id (then text), after the last comes the first. Documents are
    range-partitioned by doc_id, so neighbours meet in a task; the first and last row of
    each partition, two rows whatever its size, meet in a second step.

    Returns doc_id, n_chars, edited_sha256, fingerprint and edited_fingerprint (16 hex
    digits), near_edited and near_next (share of equal bits) and ``_fp``, the fingerprint
    as a signed long. Null texts are empty; a null doc_id comes first; repeated rows keep
    a row each; a single document is its own next. Other columns are ignored.
    """
    done = materialise(
        docs.select("doc_id", "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(_neighbours, _SCHEMA)
        .withColumn("_part", F.spark_partition_id())
    )
    # Two rows for each partition; parts follow the order of doc_id.
    edges = done.where(F.col("_edge").isNotNull()).select("doc_id", "_part", "_edge", "_text")
    edges = edges.where("_edge = 'last'").join(
        edges.where("_edge = 'first'").select(
            F.col("_part").alias("_own"), F.col("_text").alias("_first")
        ),
        F.col("_part") == F.col("_own"),
    )
    order = Window.orderBy("_part")
    start = F.first("_first").over(order.rowsBetween(Window.unboundedPreceding, 0))
    last = edges.select(
        "doc_id", "_text", F.coalesce(F.lead("_first").over(order), start).alias("_next")
    ).mapInArrow(_last_rows, _SCHEMA)
    whole = done.where(F.col("_edge").isNull()).drop("_part").unionByName(last)
    return whole.drop("_edge", "_text")


def within_radius(queries: DataFrame, stored: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All pairs of fingerprints (``_fp``) of ``queries`` and ``stored`` that differ in at
    most ``radius`` bits.

    Permuted block tables: the 64 bits are cut into ``2 * radius`` blocks, and there is a
    table for every choice of ``radius`` of them, keyed by their bits. Fingerprints within
    the radius agree in all bits of at least one choice, so equal keys fetch all of them; a
    pair that meets in several tables counts in the one whose blocks come first.
    Both inputs hold distinct fingerprints, so copies weigh nothing.

    Returns ``_query``, ``_found`` and ``_distance``; null fingerprints have no partner.
    """
    blocks = 2 * radius
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    tables = list(combinations(range(blocks), radius))

    def keyed(frame: DataFrame, name: str) -> DataFrame:
        entries = []
        for number, chosen in enumerate(tables):
            mask = 0
            for block in chosen:
                mask |= masks[block]
            mask -= (1 << 64) if mask >> 63 else 0
            key = F.col("_fp").bitwiseAND(F.lit(mask))
            entries.append(F.struct(F.lit(number).alias("_t"), key.alias("_k")))
        return frame.select(F.col("_fp").alias(name), F.inline(F.array(*entries)))

    differ = F.col("_query").bitwiseXOR(F.col("_found"))
    agree = [differ.bitwiseAND(F.lit(m)) == 0 for m in signed]
    first = F.lit(False)
    for number, chosen in enumerate(tables):
        earlier = [i for i in range(chosen[-1]) if i not in chosen]
        none = F.lit(True)
        for block in earlier:
            none = none & ~agree[block]
        first = F.when(F.col("_t") == number, none).otherwise(first)
    left, right = keyed(queries, "_query"), keyed(stored, "_found")
    return (
        # Both grow with the corpus, and estimates before the tables unfold are far too low.
        left.hint("merge").join(right, ["_t", "_k"])
        .where((F.bit_count(differ) <= radius) & first)
        .select("_query", "_found", F.bit_count(differ).alias("_distance"))
    )
