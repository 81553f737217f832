"""Toxicity categories by a chain of linear classifiers over word features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from blotter.llm.columns import others
from blotter.llm.words import as_bytes, hash_words, letters, mix, owners, runs, sliced

#: Labelled documents that the chain is fitted on, at most; the smallest hashes of doc_id.
SAMPLE = 12_000
FOLDS = 3
#: What a word needs to weigh in a category: a place among the most telling, so many standard
#: deviations between its documents' labels and the average, so many documents.
FEATURES = 256
LEAST_Z = 4.5
LEAST_HELD = 3
RIDGE = 0.1
RUN_BYTES = 1 << 18
CATEGORIES = ("low_quality", "toxic", "unfit")


@dataclass
class Link:
    """One classifier: sorted word hashes with weights, weights of the probabilities of
    the categories before it, and the constant."""

    words: np.ndarray
    weights: np.ndarray
    chained: np.ndarray
    constant: float


def word_sets(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of texts: the first text's number, the distinct words, whose they are."""
    for low, high in runs(texts, RUN_BYTES):
        words, _, _, _, bounds = hash_words(texts[low:high], letters())
        owner = owners(bounds)
        order = np.lexsort((words, owner))
        words, owner = words[order], owner[order]
        fresh = np.ones(len(words), bool)
        fresh[1:] = (words[1:] != words[:-1]) | (owner[1:] != owner[:-1])
        yield low, words[fresh], owner[fresh]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _newton(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Ridge logistic regression; the last column is the constant and hardly held back."""
    hold = np.full(x.shape[1], ridge)
    hold[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(15):
        p = _sigmoid(x @ w)
        slope = x.T @ (p - y) + hold * w
        bend = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(hold)
        step = np.linalg.solve(bend, slope)
        w -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-3:
            break
    return w


def _fit_link(vocabulary, code, owner, n, y, chained) -> Link:
    """Fit on ``n`` documents, whose words are ``vocabulary[code]``: choose the words most
    tied to the label, then weigh them."""
    held = np.bincount(code, minlength=len(vocabulary)).astype(float)
    with_label = np.bincount(code, weights=y[owner], minlength=len(vocabulary))
    rate = y.mean() if n else 0.0
    expected = held * rate
    spread = np.sqrt(np.maximum(held * rate * (1 - rate) * (1 - held / max(n, 1)), 1e-9))
    z = np.where(held >= LEAST_HELD, np.abs(with_label - expected) / np.maximum(spread, 0.5), 0)
    chosen = np.argsort(-z, kind="stable")[:FEATURES]
    chosen = np.sort(chosen[z[chosen] >= LEAST_Z])
    place = np.full(len(vocabulary), -1)
    place[chosen] = np.arange(len(chosen))
    x = np.zeros((n, len(chosen) + chained.shape[1] + 1), np.float32)
    own = place[code]
    x[owner[own >= 0], own[own >= 0]] = 1
    x[:, len(chosen) : -1] = chained
    x[:, -1] = 1
    w = _newton(x, y, RIDGE)
    return Link(vocabulary[chosen], w[: len(chosen)], w[len(chosen) : -1], float(w[-1]))


def _predict(link: Link, words, owner, n, chained) -> np.ndarray:
    score = np.full(n, link.constant) + chained @ link.chained
    if len(link.words):
        at = np.minimum(np.searchsorted(link.words, words), len(link.words) - 1)
        hit = link.words[at] == words
        score += np.bincount(owner[hit], weights=link.weights[at[hit]], minlength=n)
    return _sigmoid(score)


def fit_chain(sets: list[np.ndarray], labels: np.ndarray, names: list[int]) -> list[Link]:
    """One link for each column of ``labels``, in order.

    Later links see the probabilities of earlier categories. In training these are
    out-of-fold: each document's comes from a link fitted on the other folds, as an unseen
    document's would. ``sets`` are the distinct words of each document; equal sets count once.
    """
    n = len(sets)
    words = np.concatenate([*sets, np.empty(0, np.uint64)])
    owner = np.repeat(np.arange(n), [len(x) for x in sets])
    sums = np.zeros(n, np.uint64)
    np.add.at(sums, owner, mix(words))
    _, kept = np.unique(sums, return_index=True)
    kept.sort()
    number = np.full(n, -1)
    number[kept] = np.arange(len(kept))
    mine = number[owner] >= 0
    vocabulary, code = np.unique(words[mine], return_inverse=True)
    owner, labels = number[owner[mine]].astype(np.int32), labels[kept]
    # No link chooses a word that too few documents hold.
    often = np.bincount(code, minlength=len(vocabulary)) >= LEAST_HELD
    mine = often[code]
    code = (np.cumsum(often) - 1)[code[mine]].astype(np.int32)
    vocabulary, owner = vocabulary[often], owner[mine]
    del words, mine
    fold = (mix(np.array(names, np.int64).view(np.uint64))[kept] % np.uint64(FOLDS)).astype(int)
    n = len(kept)
    chained = np.zeros((n, 0))
    links = []
    for category in range(labels.shape[1]):
        y = labels[:, category].astype(float)
        links.append(_fit_link(vocabulary, code, owner, n, y, chained))
        if category + 1 == labels.shape[1]:
            break  # nothing is fed from the last one
        unseen = np.zeros(n)
        for f in range(FOLDS):
            inside, outside = fold == f, fold != f
            renumber = np.cumsum(outside) - 1
            train = outside[owner]
            link = _fit_link(
                vocabulary, code[train], renumber[owner[train]], int(outside.sum()), y[outside],
                chained[outside],
            )
            unseen[inside] = _predict(link, vocabulary[code], owner, n, chained)[inside]
        chained = np.column_stack([chained, unseen])
    return links


def _as_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts' distinct words, so that what meets in the task of the fit is small."""
    for batch in sliced(batches):
        texts = as_bytes(batch["text"])
        sets = [b""] * len(texts)
        for low, words, owner in word_sets(texts):
            for i in np.unique(owner):
                a, b = np.searchsorted(owner, [i, i + 1])
                sets[low + i] = words[a:b].tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch["_id"].cast(pa.int64()), batch["_low"], batch["_toxic"], pa.array(sets, pa.binary())],
            names=["_id", "_low", "_toxic", "_words"],
        )


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Link]:
    """Fit the chain on at most ``sample`` labelled documents, in one task.

    ``labels`` has doc_id, quality and toxic (0 or 1). Several rows for a document count as
    one: toxic if any says so, of low quality likewise. Rows with a null are left out. The
    categories are low quality, toxic, and unfit (either). Without usable labels the chain
    finds nothing. Of several texts under one labelled doc_id the smallest is learned from,
    null only where there is no other.

    A category is weighed by its ``FEATURES`` most telling words at most, each held by
    ``LEAST_HELD`` documents of the sample and tied to the label by a z of ``LEAST_Z``: what a
    few labels show by chance is not learned, nor is a toxic word that fewer labels know.
    """
    known = (
        labels.dropna(subset=["doc_id", "quality", "toxic"])
        .groupBy(F.col("doc_id").alias("_id"))
        .agg(
            (1 - F.min("quality")).cast("double").alias("_low"),
            F.max("toxic").cast("double").alias("_toxic"),
        )
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(sample)
    )
    chosen = (
        docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("_id"))
        .groupBy("_id")
        .agg(F.max("_low").alias("_low"), F.max("_toxic").alias("_toxic"), F.min("text").alias("text"))
        .mapInArrow(_as_sets, "_id long, _low double, _toxic double, _words binary")
        .withColumn("_all", F.lit(0))
    )

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("_id")
        target = frame[["_low", "_toxic"]].to_numpy()
        target = np.column_stack([target, target.max(axis=1)])
        links = fit_chain(
            [np.frombuffer(x, np.uint64) for x in frame["_words"]], target, frame["_id"].tolist()
        )
        return pd.DataFrame(
            {
                "at": range(len(links)),
                "words": [x.words.tobytes() for x in links],
                "weights": [x.weights.tobytes() for x in links],
                "chained": [x.chained.tobytes() for x in links],
                "constant": [x.constant for x in links],
            }
        )

    schema = "at int, words binary, weights binary, chained binary, constant double"
    # At most FEATURES words for each category reach the driver.
    rows = chosen.groupBy("_all").applyInPandas(fit, schema).collect()
    rows.sort(key=lambda r: r["at"])
    if not rows:
        none = np.empty(0)
        return [
            Link(np.empty(0, np.uint64), none, np.zeros(i), -35.0) for i in range(len(CATEGORIES))
        ]
    return [
        Link(
            np.frombuffer(r["words"], np.uint64), np.frombuffer(r["weights"]),
            np.frombuffer(r["chained"]), r["constant"],
        )
        for r in rows
    ]


def score_toxicity(
    docs: DataFrame, links: list[Link], keep: tuple[str, ...] | None = None, threshold: float = 0.5
) -> DataFrame:
    """``docs`` (or columns ``keep``) with n_words (distinct), p_low_quality, p_toxic, p_unfit and
    toxic (p_toxic of at least ``threshold``), from whole texts.

    A document's word counts once however often it comes. Null and empty texts have no
    words and get the chain's constants. Rows are judged one by one, so repeated rows and
    ties are judged alike; input columns with these names are replaced.
    """
    made = T.StructType.fromDDL(
        "n_words bigint, " + ", ".join(f"p_{c} double" for c in CATEGORIES) + ", toxic boolean"
    )
    kept = others(keep or docs.columns, made.names)
    frame = docs.select(*dict.fromkeys([*kept, "text"]))
    fields = {f.name: f for f in frame.schema.fields}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = as_bytes(batch["text"])
            n = len(texts)
            sizes, found = np.zeros(n, np.int64), np.zeros((n, len(links)))
            for low, words, owner in word_sets(texts):
                own = np.bincount(owner)
                sizes[low : low + len(own)] = own
                part = np.zeros((len(own), 0))
                for link in links:
                    part = np.column_stack([part, _predict(link, words, owner, len(own), part)])
                found[low : low + len(own)] = part
            bare = sizes == 0
            part = np.zeros((1, 0))
            for link in links:
                nothing = np.empty(0, np.uint64), np.empty(0, np.int64)
                part = np.column_stack([part, _predict(link, *nothing, 1, part)])
            found[bare] = part
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch[c] for c in kept),
                    pa.array(sizes),
                    *(pa.array(found[:, i]) for i in range(len(links))),
                    pa.array(found[:, CATEGORIES.index("toxic")] >= threshold),
                ],
                names=[*kept, *made.names],
            )

    return frame.mapInArrow(score, T.StructType([*(fields[c] for c in kept), *made]))
