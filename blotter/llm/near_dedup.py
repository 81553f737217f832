"""Near-duplicate classes: consistent weighted sampling over TF-IDF shingles."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from blotter.llm.chunks import attach, expand, joined, pack, rows_of, squeeze, totals, unpack
from blotter.llm.components import components
from blotter.llm.words import _FACTOR, as_bytes, grams, hash_words, letters, mix, owners, runs
from blotter.session import materialise

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 4
#: The weight of a shingle that one in 50 documents holds. Similarity also counts with
#: weights up to this one, so that a changed word weighs no more in a larger corpus.
BOUND = 1 + float(np.log10(50))
#: Texts whose shingles weigh less on average, as a share of what one document's alone does,
#: are sampled with bounded weights too. For others a bounded similarity of 0.8 is an
#: unbounded one of 0.75 at least, which the bands miss once in 400.
LIGHT = 0.8
#: Nodes that are compared in one task; larger groups are cut into blocks of so many, and
#: each block meets about as many other nodes of the group as PIVOTS.
BLOCK = 512
PIVOTS = 8
#: Nodes with the same first hub that one task thins links for.
DEALT = 4096
RUN_BYTES = 1 << 16
_KEY = np.uint64(0xFFFFFFFFFFFF0000)


def shingle_sets(texts: list[bytes], size: int):
    """Distinct shingles of every text: for runs of texts the first text's number, word
    hashes with bounds, and (shingle, times, owner) sorted by owner and shingle.

    A text of fewer than ``size`` words, but not none, has one shingle: all its words.
    """
    for low, high in runs(texts, RUN_BYTES):
        words, _, _, _, bounds = hash_words(texts[low:high], letters())
        owner = owners(bounds)
        every = grams(words, size)
        inside = owner[: len(every)] == owner[size - 1 :] if len(every) else np.empty(0, bool)
        hashes, whose = every[inside], owner[: len(every)][inside]
        lengths = np.diff(bounds)
        few = np.flatnonzero((lengths > 0) & (lengths < size))
        if len(few):
            short = [grams(words[bounds[i] : bounds[i + 1]], int(lengths[i]))[0] for i in few]
            hashes = np.concatenate([hashes, np.array(short, np.uint64)])
            whose = np.concatenate([whose, few])
        hashes = hashes & _KEY
        order = np.lexsort((hashes, whose))
        hashes, whose = hashes[order], whose[order]
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (whose[1:] != whose[:-1])
        at = np.flatnonzero(fresh)
        times = np.diff(np.append(at, len(hashes)))
        yield low, words, bounds, hashes[at], times, whose[at]


def text_keys(texts: list[bytes], words: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """128 bits for the sequence of words of each text, or for its bytes if it has none."""
    keys = []
    for text, a, b in zip(texts, bounds, bounds[1:]):
        content = words[a:b].tobytes() if b > a else b"\0" + text
        keys.append(blake2b(content, digest_size=16).digest())
    return keys


def idf_weights(times: np.ndarray, held: np.ndarray, documents: int) -> np.ndarray:
    """Times a shingle comes, by the smoothed decimal log of how rare it is among documents."""
    rare = np.log10((1 + documents) / (1 + held.astype(np.float64))) + 1
    return (times * rare).astype(np.float32)


class Sampler:
    """Improved consistent weighted sampling with variates from tables of quantiles."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows = bands, rows
        x = np.concatenate([np.geomspace(1e-6, 1, 20_000), np.linspace(1, 40, 60_000)[1:]])
        share = 1 - (1 + x) * np.exp(-x)
        share[x < 1e-2] = x[x < 1e-2] ** 2 / 2
        quantiles = lambda bits: np.interp((np.arange(1 << bits) + 0.5) / (1 << bits), share, x)
        self.r = quantiles(16).astype(np.float32)
        self.b = ((np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.float32)
        self.log_c = np.log(quantiles(18)).astype(np.float32)

    def bands_of(self, hashes: np.ndarray, weights: np.ndarray, owner: np.ndarray):
        """For each owner (sorted) in turn, the hash of every band of its samples.

        A sample is the element with the smallest a = c / (y e^r), y = e^(r (t - b)),
        t = floor(ln w / r + b), where r and c are Gamma(2, 1) and b is uniform, all taken
        from the element's hash: two weighted sets agree in a sample with a probability of
        their weighted Jaccard similarity. What is kept of it is a itself, which depends
        on the element and t alone.
        """
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        log_w = np.log(weights)
        z, field = np.empty_like(hashes), np.empty_like(hashes)
        r, b, t = (np.empty(len(hashes), np.float32) for _ in range(3))
        result = np.empty((len(first), self.bands), np.uint64)
        band = np.zeros(len(first), np.uint64)
        for k in range(self.bands * self.rows):
            seed = np.uint64(((k + 1) * _FACTOR * 2 + 1) & 0xFFFFFFFFFFFFFFFF)
            np.multiply(hashes, seed, out=z)
            np.right_shift(z, np.uint64(31), out=field)
            np.bitwise_xor(z, field, out=z)
            np.multiply(z, np.uint64(0xBF58476D1CE4E5B9), out=z)
            # Three fields from the upper, best mixed bits.
            np.right_shift(z, np.uint64(48), out=field)
            np.take(self.r, field.view(np.int64), out=r, mode="clip")
            np.right_shift(z, np.uint64(32), out=field)
            np.bitwise_and(field, np.uint64(0xFFFF), out=field)
            np.take(self.b, field.view(np.int64), out=b, mode="clip")
            np.divide(log_w, r, out=t)
            np.add(t, b, out=t)
            np.floor(t, out=t)
            np.subtract(t, b, out=t)
            np.add(t, np.float32(1), out=t)
            np.multiply(t, r, out=t)
            np.right_shift(z, np.uint64(14), out=field)
            np.bitwise_and(field, np.uint64(0x3FFFF), out=field)
            np.take(self.log_c, field.view(np.int64), out=b, mode="clip")
            np.subtract(b, t, out=t)
            sample = np.minimum.reduceat(t, first).view(np.uint32).astype(np.uint64)
            if k % self.rows == 0:
                band = np.full(len(first), k + 1, np.uint64)
            band = mix(band * np.uint64(_FACTOR) + sample)
            if k % self.rows == self.rows - 1:
                result[:, k // self.rows] = band
        return owner[first], result


def bounded(weights: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The weights as they are in a corpus of any size: no shingle is rarer than 1 in 50."""
    return np.minimum(weights, (times * BOUND).astype(np.float32))


def light(weights: np.ndarray, times: np.ndarray, owner: np.ndarray, documents: int) -> np.ndarray:
    """The owners whose bounded similarity to others may be far above the unbounded one."""
    most = float(idf_weights(np.ones(1), np.ones(1), documents)[0])
    if most <= BOUND or not len(owner):
        return np.empty(0, np.int64)
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    whole = np.add.reduceat(weights, first, dtype=np.float64)
    return owner[first][whole < LIGHT * most * np.add.reduceat(times, first)]


def weighted_jaccard(a: tuple, b: tuple) -> float:
    """Sum of the smaller weights over sum of the larger; (sorted hashes, weights) each."""
    at = np.searchsorted(a[0], b[0])
    at[at == len(a[0])] = 0
    both = a[0][at] == b[0] if len(a[0]) else np.zeros(len(b[0]), bool)
    shared = float(np.minimum(a[1][at[both]], b[1][both]).sum(dtype=np.float64))
    total = float(a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64)) - shared
    return shared / total if total else 0.0


def _count(size: int):
    def count(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        texts = as_bytes(table["text"].combine_chunks())
        found = [x[3] for x in shingle_sets(texts, size)]
        return np.unique(np.concatenate(found or [np.empty(0, np.uint64)]), return_counts=True)

    return count


def _sign(size: int, documents: int, bands: int, rows: int):
    """Row numbers and keys of all documents; bands and document counts of new texts."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(bands, rows)
        for row in rows_of(batches):
            table = unpack(row["data"])
            texts = as_bytes(table["text"].combine_chunks())
            sets = list(shingle_sets(texts, size))
            keys = np.unique(np.concatenate([x[3] for x in sets] or [np.empty(0, np.uint64)]))
            sums = joined(row["sums"] or [])
            names: list[bytes] = []
            marks: list[bytes | None] = [None] * len(texts)
            held: list[bytes | None] = [None] * len(texts)
            seen: set[bytes] = set()
            for low, words, bounds, hashes, times, owner in sets:
                own = text_keys(texts[low : low + len(bounds) - 1], words, bounds)
                names += own
                new = np.array([not (k in seen or seen.add(k)) for k in own], bool)
                mine = new[owner] if len(owner) else np.empty(0, bool)
                if not mine.any():
                    continue
                hashes, times, owner = hashes[mine], times[mine], owner[mine]
                counts = sums[np.searchsorted(keys, hashes)]
                weights = idf_weights(times, counts, documents)
                which, found = sampler.bands_of(hashes, weights, owner)
                edges = np.searchsorted(owner, which)
                for i, part, c in zip(which, found, np.split(counts, edges[1:])):
                    marks[low + i] = part.tobytes()
                    held[low + i] = squeeze(c)
                also = np.isin(owner, light(weights, times, owner, documents))
                if also.any():
                    soft = bounded(weights[also], times[also])
                    for i, part in zip(*sampler.bands_of(hashes[also], soft, owner[also])):
                        marks[low + i] += part.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["chunk"]] * len(texts), pa.int64()),
                    pa.array(range(len(texts)), pa.int32()),
                    table["doc_id"].combine_chunks().cast(pa.int64()),
                    pa.array(names, pa.binary()),
                    pa.array(
                        [None if m is None else np.frombuffer(m, np.int64) for m in marks],
                        pa.list_(pa.int64()),
                    ),
                    pa.array(held, pa.binary()),
                ],
                names=["chunk", "pos", "doc_id", "node", "bands", "held"],
            )

    return sign


def _vectors(size: int, documents: int):
    """A row for each text and group that is asked of a chunk: its bands and its vector."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            asked = row["asked"]
            texts = as_bytes(unpack(row["data"])["text"].take(pa.array([x["pos"] for x in asked])))
            out: list[tuple] = []
            weight = 0
            for low, _, _, hashes, times, owner in shingle_sets(texts, size):
                for i in np.unique(owner):
                    a, b = np.searchsorted(owner, [i, i + 1])
                    want = asked[low + i]
                    weights = idf_weights(times[a:b], expand(want["held"]), documents)
                    bands = np.array(want["bands"], np.int64).tobytes()
                    counts = squeeze(times[a:b])
                    own = want["node"], bands, hashes[a:b].tobytes(), weights.tobytes(), counts
                    out += [(g["name"], g["side"], g["band"], g["label"], *own) for g in want["groups"]]
                    weight += 12 * (b - a) * len(want["groups"])
                    if weight > 32 * RUN_BYTES:
                        yield _as_batch(out)
                        out, weight = [], 0
            yield _as_batch(out)

    return vectors


_VECTORS = (
    "name binary, side int, band int, label binary, node binary, bands binary, hashes binary, "
    "weights binary, times binary"
)


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 9
    kinds = [pa.binary(), pa.int32(), pa.int32(), *[pa.binary()] * 6]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)],
        names=["name", "side", "band", "label", "node", "bands", "hashes", "weights", "times"],
    )


def _link(least: float):
    """Links that join the nodes of a group: pairs with an equal band and the similarity,
    with weights as they are or bounded.

    Nodes of one label are joined from the start. A pair that is joined already is not
    compared again, nor are two visitors (side 1), and one that meets in several buckets is
    compared in the first of them. Each node is compared with all its open partners at once.
    """

    def link(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["side", "node"]).reset_index(drop=True)
        n, side = len(frame), frame["side"].to_numpy()
        bands = [np.frombuffer(x, np.int64) for x in frame["bands"]]
        # Texts without bounded bands have zeros there, which equal nothing.
        width = max(map(len, bands))
        bands = np.stack([np.pad(x, (0, width - len(x))) for x in bands])
        vectors = [
            (np.frombuffer(h, np.uint64), np.frombuffer(w, np.float32))
            for h, w in zip(frame["hashes"], frame["weights"])
        ]
        soft = [(h, bounded(w, expand(x))) for (h, w), x in zip(vectors, frame["times"])]
        sizes = np.array([len(h) for h, _ in vectors])
        starts = np.concatenate([[0], np.cumsum(sizes)])
        weights = np.concatenate([w for _, w in vectors])
        lower = np.concatenate([w for _, w in soft])
        elements, code = np.unique(np.concatenate([h for h, _ in vectors]), return_inverse=True)
        sums = np.add.reduceat(weights, starts[:-1], dtype=np.float64)
        lower_sums = np.add.reduceat(lower, starts[:-1], dtype=np.float64)
        ways = [(vectors, weights, sums), (soft, lower, lower_sums)][: 1 + (lower < weights).any()]
        mine = np.zeros(len(elements), np.float32)
        band = int(frame["band"].iloc[0])
        root = np.unique(frame["label"].to_numpy(), return_inverse=True)[1]
        found = []

        def similar(a: int, partners: np.ndarray, sets: list[tuple], values: np.ndarray, whole: np.ndarray):
            if len(partners) < n // 8:
                return np.array([weighted_jaccard(sets[a], sets[b]) for b in partners])
            own = code[starts[a] : starts[a + 1]]
            mine[own] = sets[a][1]
            shared = np.add.reduceat(np.minimum(mine[code], values), starts[:-1], dtype=np.float64)
            mine[own] = 0
            return (shared / (whole[a] + whole - shared))[partners]

        for a in range(n - 1):
            equal = (bands[a] == bands[a + 1 :]) & (bands[a] != 0)
            if band < 0:
                open_ = equal.any(axis=1)
            else:
                open_ = equal[:, band] & ~equal[:, :band].any(axis=1)
            if side[a]:
                break
            open_ &= root[a + 1 :] != root[a]
            alike = np.zeros(n)
            for sets, values, whole in ways:
                low, high = np.minimum(whole[a], whole[a + 1 :]), np.maximum(whole[a], whole[a + 1 :])
                fit = open_ & (low >= least * high) & (alike[a + 1 :] < least)
                if len(partners := np.flatnonzero(fit) + a + 1):
                    alike[partners] = similar(a, partners, sets, values, whole)
            partners = np.flatnonzero(alike >= least)
            alike = alike[partners]
            for b, similarity in zip(partners, alike):
                if root[a] != root[b]:
                    root[root == root[b]] = root[a]
                    found.append((frame["node"][a], frame["node"][b], float(similarity)))
        return pd.DataFrame(found, columns=["a", "b", "similarity"])

    return link


def _buckets(entries: DataFrame) -> DataFrame:
    """``entries`` (node, k, band) that share their band with others: size and hub of each."""
    hubs = (
        entries.groupBy("k", "band").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("hub"))
        .where("size > 1")
    )
    return materialise(entries.join(hubs, ["k", "band"]))


def _connected(buckets: DataFrame) -> DataFrame:
    """Nodes that equal bands connect: (node, label, n), n nodes in all to a label.

    A node's links to the hubs of its buckets, one for each band at most, lie together,
    and the links of nodes with the same first hub, ``DEALT`` nodes of them at most, meet in
    one task, which keeps a forest of them.
    """
    stars = materialise(
        buckets.groupBy("node").agg(F.collect_set("hub").alias("hubs"), F.min("hub").alias("first"))
    )
    sizes = stars.groupBy("first").agg(F.ceil(F.count(F.lit(1)) / DEALT).cast("int").alias("slices"))
    dealt = stars.join(sizes, "first").repartition(
        "first", F.pmod(F.xxhash64("node"), F.col("slices")).alias("slice")
    )
    labels = components(dealt.select(F.explode("hubs").alias("a"), F.col("node").alias("b")))
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return materialise(labels.join(sizes, "label"))


def _groups(connected: DataFrame, block: int) -> DataFrame:
    """The groups in which nodes are compared first: rows (node, name, side, band, label).

    Up to ``block`` connected nodes are one group. More are cut into blocks, which about
    ``PIVOTS`` nodes of them visit, so that most of a family is joined by links to these.
    """
    slices = F.ceil(F.col("n") / block).cast("int")
    pivot = (F.col("node") == F.col("label")) | (F.pmod(F.xxhash64("node"), F.col("n")) < PIVOTS - 1)
    own = F.pmod(F.xxhash64("label", "node"), slices).cast("int")
    every = F.sequence(F.lit(0), slices - 1)
    return (
        connected.withColumn("_own", own)
        .withColumn("_slice", F.explode(F.when(pivot, every).otherwise(F.array("_own"))))
        .select(
            "node", F.concat_ws(":", F.hex("label"), "_slice").cast("binary").alias("name"),
            (F.col("_slice") != F.col("_own")).cast("int").alias("side"), F.lit(-1).alias("band"),
            F.col("node").alias("label"),
        )
    )


def _open_groups(buckets: DataFrame, labels: DataFrame, block: int) -> DataFrame:
    """The groups in which what the first links left apart is compared, bucket by bucket.

    ``labels`` (node, label) are the nodes of large groups with the components they have
    so far. A bucket whose nodes are all of one component has nothing left to compare. In
    the others every two nodes of different components meet: the bucket is cut into blocks
    of ``block`` nodes, and those outside its largest component visit all its blocks.
    """
    members = buckets.select("node", "k", "band").join(labels, "node")
    parts = members.groupBy("k", "band", "label").agg(F.count(F.lit(1)).alias("rows"))
    several = (
        parts.groupBy("k", "band")
        .agg(
            F.count(F.lit(1)).alias("labels"), F.sum("rows").alias("size"),
            F.max_by("label", F.struct("rows", "label")).alias("largest"),
        )
        .where("labels > 1")
    )
    slices = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("band", "node"), slices).cast("int")
    every = F.sequence(F.lit(0), slices - 1)
    visits = F.when(F.col("label") != F.col("largest"), every).otherwise(F.array("_own"))
    return (
        members.join(several, ["k", "band"])
        .withColumn("_own", own)
        .withColumn("_slice", F.explode(visits))
        .select(
            "node", F.concat_ws(":", "k", "band", "_slice").cast("binary").alias("name"),
            (F.col("_slice") != F.col("_own")).cast("int").alias("side"), F.col("k").alias("band"),
            "label",
        )
    )


def _compared(
    groups: DataFrame, texts: DataFrame, chunks: DataFrame, shingle: int, documents: int, similarity: float
) -> DataFrame:
    """The links (a, b, similarity) that comparisons within the groups find."""
    asked = materialise(
        groups
        .groupBy("node").agg(F.collect_list(F.struct("name", "side", "band", "label")).alias("groups"))
        .join(texts, "node")
        .groupBy("chunk")
        .agg(
            F.sum(F.octet_length("held") + 256 + 96 * F.size("groups")).alias("bytes"),
            F.collect_list(F.struct("pos", "node", "bands", "groups", "held")).alias("asked"),
        )
    )
    return materialise(
        attach(chunks.select("chunk", "data"), asked)
        .select("asked", "data")
        .mapInArrow(_vectors(shingle, documents), _VECTORS)
        .groupBy("name")
        .applyInPandas(_link(similarity), "a binary, b binary, similarity double")
    )


def near_duplicates(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    shingle: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """Classes of ``docs`` (doc_id, text, and any others), and the packed documents.

    Texts with the same words in the same order are one node, however many copies there
    are. Shingles of ``shingle`` words weigh their times in the text by how rare they are
    among all documents, exactly counted. ``bands`` times ``rows`` weighted samples of a
    node make candidates: nodes with an equal band. As the weight of a changed word grows
    with the corpus, against that of words a large family shares, two texts are also alike
    if they are with no weight above that of a shingle in one of 50 documents, which is the
    same for fewer than 100 documents; texts of common shingles get as many samples by these
    bounded weights. Nodes that candidates connect meet in
    one task, where every two nodes with an equal band that other links do not join yet are
    compared on the exact weighted Jaccard similarity, both ways. More than ``block`` of them
    meet in blocks first, each with a few common nodes, which joins a family of near copies at
    the cost of one journey a text; then, bucket by bucket, those that still are in different
    components. So no candidate link between different texts is lost and no pairs are written
    out. What remains quadratic, in a bucket beyond ``block``, is a large number of texts that are
    not alike, as each of these visits all blocks of the bucket.

    The first frame has a row for each document: chunk, pos (its place in the second), doc_id,
    class_id (smallest doc_id of its component), class_size, copies (documents with the
    same words) and keeper (one row of each class). Null texts are empty; all texts
    without words and with equal bytes are one node; null doc_ids come last and give a
    null class_id only to a class of them alone. Repeated rows are copies.
    """
    chunks = pack(docs)
    documents = chunks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    sums = totals(chunks, _count(shingle)).drop("total", "distinct")
    marks = materialise(
        # The sums are a part of the corpus, so they meet the chunks in a shuffle at any size.
        chunks.select("chunk", "data").join(sums.drop("bytes").hint("merge"), "chunk", "left")
        .mapInArrow(
            _sign(shingle, documents, bands, rows),
            "chunk long, pos int, doc_id long, node binary, bands array<long>, held binary",
        )
    )
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "chunk", "pos")
    texts = materialise(
        marks.where(F.col("bands").isNotNull())
        .groupBy("node")
        .agg(F.min(F.struct("chunk", "pos", "bands", "held")).alias("_t"))
        .select("node", "_t.*")
    )
    buckets = _buckets(texts.select("node", F.posexplode("bands").alias("k", "band")))
    connected = _connected(buckets)
    links = _compared(_groups(connected, block), texts, chunks, shingle, documents, similarity)
    labels = components(links)
    large = connected.where(F.col("n") > block).select("node")
    if not large.isEmpty():
        so_far = materialise(
            large.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        )
        more = _open_groups(buckets, so_far, block)
        links = links.unionByName(_compared(more, texts, chunks, shingle, documents, similarity))
        labels = components(links)
    nodes = marks.groupBy("node").agg(
        F.min(first).alias("_first"), F.count(F.lit(1)).alias("copies")
    )
    named = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    classes = named.groupBy("label").agg(
        F.min("_first").alias("_keeper"), F.sum("copies").alias("class_size")
    )
    of_node = named.select("node", "label", "copies").join(classes, "label")
    return (
        marks.select("chunk", "pos", "doc_id", "node").join(of_node, "node").select(
            "chunk", "pos", "doc_id", F.col("_keeper.doc_id").alias("class_id"), "class_size",
            "copies",
            ((F.col("_keeper.chunk") == F.col("chunk")) & (F.col("_keeper.pos") == F.col("pos")))
            .alias("keeper"),
        ),
        chunks,
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each class of near duplicates, with all columns of ``docs``."""
    classes, chunks = near_duplicates(docs)
    kept = materialise(
        classes.where("keeper").groupBy("chunk").agg(
            (F.count(F.lit(1)) * 8 + 32).alias("bytes"), F.collect_list("pos").alias("kept")
        )
    )

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            table = unpack(row["data"]).take(pa.array(sorted(row["kept"])))
            yield from table.combine_chunks().to_batches()

    return attach(chunks.select("chunk", "data"), kept).select("data", "kept").mapInArrow(
        pick, docs.schema
    )
