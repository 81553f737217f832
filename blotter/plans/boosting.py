"""Gradient boosting over all labels at once: softmax margins, one tree a label and round.

Trees grow level by level. A level is one pass over the rows: tasks add up histograms of
gradients for every open node, label and model, Spark sums them by node, and the task that
holds a node's sum picks its split. Several models grow side by side in the same passes,
each on the folds it may see, so a search reads the rows as often as its deepest model. Where the
bins of all rows are small, a search gives them to every task instead, which grows one whole
model; the trees are the same.

Gradients are rounded to whole multiples of 2^-20, so sums do not depend on how the rows
are dealt, and the same rows give the same trees.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from blotter import schemas
from blotter.session import materialise
from blotter.sources.tables import remove

BINS = 64
#: Histograms that a task holds; beyond it the models of a level take several passes.
HISTOGRAM_BYTES = 128 << 20
#: Packed rows that each task of a search may hold; beyond it its models grow in common passes.
HELD_BYTES = 32 << 20
_UNIT = float(1 << 20)
_TREE = "round int, label int, node int, feature int, cut double, value double"


@dataclass(frozen=True)
class Params:
    rounds: int = 100
    depth: int = 6
    rate: float = 0.1
    rows: float = 0.8
    columns: float = 1.0
    l2: float = 1.0
    weight: float = 1.0
    seed: int = schemas.SEED


# The search space, under the names of ``Params``.
SOFTMAX_GRID = {
    "rounds": [100, 200, 300, 500],
    "depth": [4, 6, 8, 10],
    "rate": [0.01, 0.05, 0.1],
    "rows": [0.6, 0.8, 1.0],
    "columns": [0.6, 0.8, 1.0],
}


@dataclass(frozen=True)
class Tree:
    """Nodes in heap order, the root first: left child 2 i + 1 where x <= cut, else 2 i + 2.

    A feature of -1 ends at the node's value.
    """

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def leaf(self, x: np.ndarray) -> np.ndarray:
        """The node each row ends in."""
        at = np.zeros(len(x), np.int64)
        while True:
            feature = self.feature[at]
            inner = np.flatnonzero(feature >= 0)
            if not len(inner):
                return at
            place = at[inner]
            right = ~(x[inner, feature[inner]] <= self.cut[place])
            at[inner] = 2 * place + 1 + right


@dataclass(frozen=True)
class Softmax:
    """A fitted ensemble: cuts of each feature, and the trees of each round by label."""

    labels: int
    cuts: list[np.ndarray]
    rounds: list[list[Tree]] = field(default_factory=list)

    def margins(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros((len(x), self.labels))
        for trees in self.rounds:
            for label, tree in enumerate(trees):
                total[:, label] += tree.value[tree.leaf(x)]
        return total


def _probabilities(margins: np.ndarray) -> np.ndarray:
    raised = np.exp(margins - margins.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def _codes(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """The bin of every value: how many cuts lie below it. No number is in the last one."""
    return np.stack([np.searchsorted(c, x[:, i], "left") for i, c in enumerate(cuts)], axis=1).astype(np.uint8)


def fit_cuts(rows: DataFrame, features: list[str], bins: int = BINS) -> list[np.ndarray]:
    """At most ``bins`` - 1 cuts for each feature, by approximate quantiles of all rows."""
    shares = [i / bins for i in range(1, bins)]
    found = rows.select(*(F.col(c).cast("double") for c in features)).approxQuantile(features, shares, 0.25 / bins)
    return [np.unique(np.array(x, np.float64)) for x in found]


@dataclass
class _Model:
    """A model that grows: its parameters, the fold it may not see, and its trees."""

    params: Params
    hidden: int
    rounds: list[list[Tree]] = field(default_factory=list)

    def features(self, label: int, number: int) -> list[int]:
        """The features a tree may use."""
        rng = random.Random(f"{self.params.seed}:columns:{label}:{len(self.rounds)}")
        return sorted(rng.sample(range(number), max(1, round(self.params.columns * number))))


def _drawn(name: np.ndarray, model: Params, number: int) -> np.ndarray:
    """The rows that a round may use, by a hash of their names."""
    salt = np.uint64((model.seed * 1_000_003 + number * 7919 + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (name ^ salt) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(11)).astype(np.float64) < model.rows * float(1 << 53)


def _named(rows: DataFrame, features: list[str], fold: Column) -> DataFrame:
    """Names, labels, folds and features of the rows."""
    return rows.select(
        F.xxhash64(schemas.INCIDENT_KEY).alias("name"), F.col("y").cast("int").alias("y"), fold.cast("int").alias("fold"),
        *(F.col(c).cast("double").alias(c) for c in features),
    )


def _features(batch: pa.RecordBatch, features: list[str]) -> np.ndarray:
    return np.column_stack([batch[c].to_numpy(zero_copy_only=False) for c in features]).astype(np.float64)


def _state(rows: DataFrame, base: Softmax, features: list[str], fold: Column, models: int) -> DataFrame:
    """Names, labels, folds, bins and margins of the rows; margins are those of ``base``."""

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _features(batch, features)
            margins = np.repeat(base.margins(x)[:, None, :], models, axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch["name"], batch["y"], batch["fold"], _binary(_codes(x, base.cuts)), _binary(margins)],
                names=["name", "y", "fold", "codes", "margins"],
            )

    named = _named(rows, features, fold)
    return materialise(named.mapInArrow(start, "name long, y int, fold int, codes binary, margins binary"))


def _binary(values: np.ndarray) -> pa.Array:
    """A row of fixed width for each first index."""
    raw = np.ascontiguousarray(values)
    width = raw.nbytes // max(1, len(raw))
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(max(1, width)), len(raw), [None, pa.py_buffer(raw)]).cast(pa.binary())


def _values(column: pa.Array, kind: type) -> np.ndarray:
    """What ``_binary`` packed, all rows behind one another; no row is copied by itself."""
    ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
    raw = column.buffers()[2]
    return np.frombuffer(raw, np.uint8, ends[-1] - ends[0], ends[0]).view(kind) if len(column) and raw else np.empty(0, kind)


def _arrays(batch: pa.RecordBatch, cuts: list[np.ndarray], shape: tuple[int, ...]):
    """Names, labels, folds, codes and margins of a batch as arrays."""
    name = batch["name"].to_numpy().view(np.uint64)
    codes = _values(batch["codes"], np.uint8).reshape(-1, len(cuts))
    margins = _values(batch["margins"], np.float64).reshape(-1, *shape).copy()
    return name, batch["y"].to_numpy(), batch["fold"].to_numpy(), codes, margins


def _as_codes(tree: Tree, cuts: list[np.ndarray]) -> Tree:
    """The same tree over bins: a bin goes left if its number is no higher than the cut's."""
    cut = [np.searchsorted(cuts[f], c) if f >= 0 else 0 for f, c in zip(tree.feature, tree.cut)]
    return replace(tree, cut=np.array(cut, np.float64))


def _advance(margins: np.ndarray, codes: np.ndarray, pending: list[tuple[int, list[Tree]]]) -> None:
    """Add what the trees of later rounds say, in place."""
    for model, trees in pending:
        for label, tree in enumerate(trees):
            margins[:, model, label] += tree.value[tree.leaf(codes)]


def _histograms(cuts, shape, growing, params, hidden, number):
    """Rows (model, label, node, sums): for each open node, the sums of gradients and of their
    slopes by feature and bin. ``growing`` has the open trees by (model, label)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, bins = len(cuts), BINS
        sums: dict[tuple[int, int, int], np.ndarray] = {}
        for batch in batches:
            name, y, fold, codes, margins = _arrays(batch, cuts, shape)
            place = codes + np.arange(features) * bins
            for model in sorted({m for m, _ in growing}):
                used = np.flatnonzero((fold != hidden[model]) & _drawn(name, params[model], number))
                if not len(used):
                    continue
                chance = _probabilities(margins[used, model])
                for (_, label), (tree, open_) in ((k, v) for k, v in growing.items() if k[0] == model):
                    p = chance[:, label]
                    slope = np.rint(np.maximum(p * (1 - p), 1e-6) * _UNIT)
                    pull = np.rint((p - (y[used] == label)) * _UNIT)
                    leaf = tree.leaf(codes[used])
                    which = np.searchsorted(open_, leaf)
                    which[which == len(open_)] = 0
                    inside = np.flatnonzero(open_[which] == leaf)
                    at = (which[inside, None] * (features * bins) + place[used[inside]]).ravel()
                    size = len(open_) * features * bins
                    found = [
                        np.bincount(at, np.repeat(v[inside], features), size).reshape(len(open_), 1, features, bins)
                        for v in (pull, slope)
                    ]
                    for node, own in zip(open_.tolist(), np.concatenate(found, axis=1)):
                        if own[1].any():
                            held = sums.setdefault((model, label, node), np.zeros_like(own))
                            held += own
        keys = list(sums)
        for low in range(0, len(keys), 512):
            some = keys[low : low + 512]
            columns = [pa.array(x, pa.int32()) for x in zip(*some)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([sums[k].tobytes() for k in some], pa.binary())],
                names=["model", "label", "node", "sums"],
            )

    return add


_SPLIT = "model int, label int, node int, feature int, bin int, gain double, left_pull double, left_slope double, pull double, slope double"


def _best(cuts, params, allowed):
    """The split of a node with the highest gain; ties go to the first feature and bin."""

    def best(table: pa.Table) -> pa.Table:
        total = np.zeros((2, len(cuts), BINS))
        for raw in table["sums"].to_pylist():
            total += np.frombuffer(raw, np.float64).reshape(total.shape)
        total /= _UNIT
        model, label, node = (table[c][0].as_py() for c in ("model", "label", "node"))
        how = params[model]
        whole = total[:, 0].sum(axis=1)
        left = np.cumsum(total, axis=2)
        right = whole[:, None, None] - left
        score = lambda x: x[0] ** 2 / (x[1] + how.l2)
        gain = score(left) + score(right) - score(whole)
        gain[(left[1] < how.weight) | (right[1] < how.weight)] = -np.inf
        for f, c in enumerate(cuts):
            gain[f, len(c) :] = -np.inf
            if f not in allowed[model, label]:
                gain[f] = -np.inf
        f, b = np.unravel_index(int(gain.argmax()), gain.shape)
        row = model, label, node, int(f), int(b), float(gain[f, b]), *left[:, f, b].tolist(), *whole.tolist()
        names = [x.split()[0] for x in _SPLIT.split(", ")]
        kinds = [pa.int32()] * 5 + [pa.float64()] * 5
        return pa.table([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

    return best


class _Growing:
    """A tree whose lowest nodes are still open, in bins."""

    def __init__(self, depth: int, how: Params):
        nodes = (2 << depth) - 1
        self.how, self.depth = how, depth
        self.tree = Tree(np.full(nodes, -1, np.int64), np.zeros(nodes), np.zeros(nodes))
        self.open = np.array([0])

    def _value(self, pull: float, slope: float) -> float:
        return -self.how.rate * pull / (slope + self.how.l2)

    def split(self, found: list) -> None:
        """Split the open nodes as found; the children are open next, unless at the bottom."""
        children = []
        for s in found:
            self.tree.value[s["node"]] = self._value(s["pull"], s["slope"])
            if s["gain"] > 1e-9:
                self.tree.feature[s["node"]], self.tree.cut[s["node"]] = s["feature"], s["bin"]
                left = 2 * s["node"] + 1
                self.tree.value[left] = self._value(s["left_pull"], s["left_slope"])
                self.tree.value[left + 1] = self._value(s["pull"] - s["left_pull"], s["slope"] - s["left_slope"])
                children += [left, left + 1]
        bottom = (1 << self.depth) - 1
        self.open = np.array(sorted(c for c in children if c < bottom), np.int64)

    def over_values(self, cuts: list[np.ndarray]) -> Tree:
        """The finished tree over raw values, without the empty end of its arrays."""
        used = np.flatnonzero((self.tree.feature >= 0) | (self.tree.value != 0))
        last = int(max(used, default=0)) + 1
        last += 1 - last % 2  # children come in pairs
        cut = [cuts[f][int(c)] if f >= 0 else 0.0 for f, c in zip(self.tree.feature[:last], self.tree.cut[:last])]
        return Tree(self.tree.feature[:last], np.array(cut), self.tree.value[:last])


def _grow(state: DataFrame, base: Softmax, models: list[_Model], keep: bool = True) -> DataFrame:
    """Grow all models to the number of their rounds; the rows with their last margins, or,
    unless these are to ``keep``, with those before the last round."""
    cuts, labels = base.cuts, base.labels
    shape, params, hidden = (len(models), labels), [m.params for m in models], [m.hidden for m in models]
    node_bytes = 2 * 8 * len(cuts) * BINS
    last = max(p.rounds for p in params)
    for number in range(last):
        pending: list[tuple[int, list[Tree]]] = []
        growing = {
            (m, label): _Growing(model.params.depth, model.params)
            for m, model in enumerate(models) if number < model.params.rounds for label in range(labels)
        }
        allowed = {(m, label): models[m].features(label, len(cuts)) for m, label in growing}
        while any(len(g.open) for g in growing.values()):
            todo = [k for k, g in growing.items() if len(g.open)]
            sizes = np.cumsum([len(growing[k].open) * node_bytes for k in todo]) // HISTOGRAM_BYTES
            for chunk in np.unique(sizes):
                some = {k: growing[k] for k, c in zip(todo, sizes) if c == chunk}
                add = _histograms(
                    cuts, shape, {k: (g.tree, g.open) for k, g in some.items()}, params, hidden, len(base.rounds) + number
                )
                found = (
                    state.mapInArrow(add, "model int, label int, node int, sums binary")
                    .groupBy("model", "label", "node").applyInArrow(_best(cuts, params, allowed), _SPLIT).collect()
                )
                for key, g in some.items():
                    g.split([s for s in found if (s["model"], s["label"]) == key])
        for m in {m for m, _ in growing}:
            trees = [growing[m, label] for label in range(labels)]
            models[m].rounds.append([g.over_values(cuts) for g in trees])
            pending.append((m, [g.tree for g in trees]))
        # Every level of the next round reads the rows, so the trees are applied once for all.
        if number + 1 < last or keep:
            state = _written(state, cuts, shape, pending)
    return state


def _written(state: DataFrame, cuts, shape, pending) -> DataFrame:
    """The rows with the trees of ``pending`` in their margins; the rows as they were written
    before are removed."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, _, codes, margins = _arrays(batch, cuts, shape)
            _advance(margins, codes, pending)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], _binary(margins)], names=batch.schema.names)

    made = materialise(state.mapInArrow(write, state.schema))
    for folder in {file.rpartition("/")[0] for file in state.inputFiles()}:
        remove(state.sparkSession, folder)
    return made


@dataclass(frozen=True)
class _Held:
    """All rows in memory: names, labels, folds, and bins by feature."""

    name: np.ndarray
    y: np.ndarray
    fold: np.ndarray
    codes: np.ndarray


def _held(rows: DataFrame, base: Softmax, features: list[str], fold: Column, depth: int) -> _Held | None:
    """The rows, packed in tasks and brought together, unless they or the histograms of a level
    of that depth take too much memory."""
    widest = 2 * 8 * len(features) * BINS << max(0, depth - 1)
    if rows.count() * (len(features) + 20) > HELD_BYTES or widest > HISTOGRAM_BYTES:
        return None

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = _binary(_codes(_features(batch, features), base.cuts))
            yield pa.RecordBatch.from_arrays([batch["name"], batch["y"], batch["fold"], codes], names=["name", "y", "fold", "codes"])

    packed = _named(rows, features, fold).mapInArrow(pack, "name long, y int, fold int, codes binary").toArrow()
    parts = [_values(chunk, np.uint8).reshape(-1, len(features)) for chunk in packed["codes"].chunks]
    codes = np.concatenate([np.empty((0, len(features)), np.uint8), *parts])
    name, y, fold_of = (packed[c].to_numpy() for c in ("name", "y", "fold"))
    return _Held(name.view(np.uint64), y, fold_of, np.ascontiguousarray(codes.T))


def _sums(codes, bins, allowed, rows, place, nodes, pull, slope) -> np.ndarray:
    """Sums (node, gradients or slopes, bins of the allowed features) of the rows at their places."""
    found, low = np.empty((nodes, 2, sum(bins[f] for f in allowed))), 0
    weights = pull[rows], slope[rows]
    for f in allowed:
        at = place * bins[f] + codes[f][rows]
        for i, w in enumerate(weights):
            found[:, i, low : low + bins[f]] = np.bincount(at, w, nodes * bins[f]).reshape(nodes, bins[f])
        low += bins[f]
    return found


def _grown(codes, bins, drawn, pull, slope, allowed, how: Params) -> tuple[_Growing, np.ndarray]:
    """A tree grown on the ``drawn`` ones of the rows held, and the node that every row ends in.

    Of the two children of a node the one with fewer rows is summed up; the other has what is
    left of their parent, exactly so, as the sums are whole numbers.
    """
    growing = _Growing(how.depth, how)
    tree, at = growing.tree, np.zeros(codes.shape[1], np.int64)
    live, slot, open_ = np.arange(len(at)), np.zeros(len(at), np.int64), np.array([0])
    sizes = np.array([bins[f] for f in allowed])
    before = np.repeat(np.arange(len(allowed)), sizes)  # how many features lie before a bin
    number = np.concatenate([np.arange(n) for n in sizes])
    no_cut = number == sizes[before] - 1
    of = np.array(allowed)[before]
    sums = _sums(codes, bins, allowed, np.flatnonzero(drawn), np.zeros(int(drawn.sum()), np.int64), 1, pull, slope)
    if not drawn.any():
        return growing, at
    score = lambda x: x[:, 0] ** 2 / (x[:, 1] + how.l2)
    value = lambda x: -how.rate * x[:, 0] / (x[:, 1] + how.l2)
    for level in range(how.depth):
        total = sums / _UNIT
        whole = total[:, :, : sizes[0]].sum(axis=2)
        tree.value[open_] = value(whole)
        left = np.cumsum(total, axis=2) - whole[:, :, None] * before
        right = whole[:, :, None] - left
        gain = score(left) + score(right) - score(whole)[:, None]
        gain[(left[:, 1] < how.weight) | (right[:, 1] < how.weight) | no_cut] = -np.inf
        best = gain.argmax(axis=1)
        split = np.flatnonzero(gain[np.arange(len(best)), best] > 1e-9)
        if not len(split):
            break
        cut = best[split]
        tree.feature[open_[split]], tree.cut[open_[split]] = of[cut], number[cut]
        children = (2 * open_[split, None] + [1, 2]).ravel()
        tree.value[children[::2]], tree.value[children[1::2]] = value(left[split, :, cut]), value(right[split, :, cut])
        # The rows of split nodes go on to the children, side by side in pairs.
        pair = np.full(len(open_), -1)
        pair[split] = np.arange(len(split))
        pair = pair[slot]
        stays = pair >= 0
        live, pair = live[stays], pair[stays]
        goes_right = codes[of[cut][pair], live] > number[cut][pair]
        slot, open_ = 2 * pair + goes_right, children
        at[live] = children[slot]
        if level + 1 < how.depth:
            counted = drawn[live]
            fewer = np.bincount(slot[counted], minlength=len(children)).reshape(-1, 2).argmin(axis=1)
            counted &= goes_right == fewer[pair]
            own = _sums(codes, bins, allowed, live[counted], pair[counted], len(split), pull, slope)
            sums = np.stack([own, sums[split] - own], axis=1)
            sums[fewer == 1] = sums[fewer == 1, ::-1]
            sums = sums.reshape(len(children), 2, -1)
    return growing, at


def _grow_held(held: _Held, base: Softmax, model: _Model) -> tuple[list[list[Tree]], np.ndarray]:
    """The trees of a new model that one task grows, and the margins of all rows."""
    cuts, how = base.cuts, model.params
    bins, rounds = [len(c) + 1 for c in cuts], _Model(how, model.hidden)
    margins, seen = np.zeros((len(held.y), base.labels)), held.fold != model.hidden
    for number in range(how.rounds):
        drawn = seen & _drawn(held.name, how, number)
        chance = _probabilities(margins)
        trees = []
        for label in range(base.labels):
            p = chance[:, label]
            slope = np.rint(np.maximum(p * (1 - p), 1e-6) * _UNIT)
            pull = np.rint((p - (held.y == label)) * _UNIT)
            growing, at = _grown(held.codes, bins, drawn, pull, slope, rounds.features(label, len(cuts)), how)
            margins[:, label] += growing.tree.value[at]
            trees.append(growing.over_values(cuts))
        rounds.rounds.append(trees)
    return rounds.rounds, margins


def _search_held(
    spark: SparkSession, held: _Held, base: Softmax, draws: list[Params], folds: int
) -> tuple[Softmax, list[float]]:
    """The best draw refitted on all rows, and the scores of all draws, a model by each task."""
    models = [_Model(p, hidden) for p in draws for hidden in range(folds)]
    # The dearest start first, so that none is left to run alone at the end.
    models_by_cost = sorted(range(len(models)), key=lambda m: -models[m].params.rounds * models[m].params.depth)
    shared = spark.sparkContext.broadcast((held.name, held.y, held.fold, held.codes))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Held(*shared.value)
        for task in (i for batch in batches for i in batch["id"].to_pylist()):
            m = models_by_cost[task]
            _, margins = _grow_held(rows, base, models[m])
            hidden = rows.fold == models[m].hidden
            right = int((hidden & (margins.argmax(axis=1) == rows.y)).sum())
            yield pa.RecordBatch.from_arrays([pa.array([m]), pa.array([right]), pa.array([int(hidden.sum())])], names=["model", "right", "seen"])

    def refit(best: Params):
        def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _ in (i for batch in batches for i in batch["id"].to_pylist()):
                rounds, _ = _grow_held(_Held(*shared.value), base, _Model(best, hidden=-1))
                for number, trees in enumerate(rounds):
                    places = [pa.array([number] * len(trees), pa.int32()), pa.array(range(len(trees)), pa.int32())]
                    packed = [pa.array([getattr(t, c).tobytes() for t in trees], pa.binary()) for c in ("feature", "cut", "value")]
                    yield pa.RecordBatch.from_arrays([*places, *packed], names=["round", "label", "feature", "cut", "value"])

        return grow

    try:
        # One task a model, whatever the number of cores.
        judged = spark.range(0, len(models), 1, len(models)).mapInArrow(judge, "model long, right long, seen long").collect()
        scores = _scores({r["model"]: r["right"] / max(1, r["seen"]) for r in judged}, len(draws), folds)
        best = draws[int(np.argmax(scores))]
        made = spark.range(0, 1, 1, 1).mapInArrow(refit(best), "round int, label int, feature binary, cut binary, value binary").toArrow()
    finally:
        shared.destroy()
    rounds: list[list[Tree]] = [[None] * base.labels for _ in range(best.rounds)]
    for batch in made.to_batches():
        for r in batch.to_pylist():
            kinds = zip(("feature", "cut", "value"), (np.int64, np.float64, np.float64))
            rounds[r["round"]][r["label"]] = Tree(*(np.frombuffer(r[c], kind) for c, kind in kinds))
    return replace(base, rounds=rounds), scores


def _scores(share: dict[int, float], draws: int, folds: int) -> list[float]:
    """The mean share of the folds of each draw."""
    return [float(np.mean([share.get(i * folds + f, 0.0) for f in range(folds)])) for i in range(draws)]


def fit(
    rows: DataFrame, labels: int, params: Params = Params(), features: list[str] = schemas.FEATURES
) -> Softmax:
    """An ensemble for rows (key, y, features), y being 0 to ``labels`` - 1."""
    return extend(Softmax(labels, fit_cuts(rows, features)), rows, params, features)


def extend(
    base: Softmax, rows: DataFrame, params: Params, features: list[str] = schemas.FEATURES
) -> Softmax:
    """``base`` with ``params.rounds`` more rounds, fitted to what it leaves open on ``rows``.

    The trees of ``base`` stay as they are; only ``rows`` are read, so the cost does not
    depend on the rows that it was fitted on.
    """
    model = _Model(params, hidden=-1, rounds=list(base.rounds))
    _grow(_state(rows, base, features, F.lit(0), 1), base, [model], keep=False)
    return replace(base, rounds=model.rounds)


def search(
    rows: DataFrame, labels: int, draws: list[Params], folds: int = 3, features: list[str] = schemas.FEATURES
) -> tuple[Softmax, list[tuple[Params, float]]]:
    """The best draw refitted on all rows, and the accuracy of each on the folds held out.

    All draws and folds grow side by side, each in a task of its own that holds all rows if these
    are small; the fold of a row is a column. Of equal draws the first wins.
    """
    base = Softmax(labels, fit_cuts(rows, features))
    fold = F.pmod(F.xxhash64(schemas.INCIDENT_KEY, F.lit(schemas.SEED)), F.lit(folds))
    if (held := _held(rows, base, features, fold, max(p.depth for p in draws))) is not None:
        found, scores = _search_held(rows.sparkSession, held, base, draws, folds)
        return found, list(zip(draws, scores))
    models = [_Model(p, hidden) for p in draws for hidden in range(folds)]
    state = _grow(_state(rows, base, features, fold, len(models)), base, models)
    shape, hides = (len(models), labels), np.array([m.hidden for m in models])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, seen = np.zeros(len(hides), np.int64), np.zeros(len(hides), np.int64)
        for batch in batches:
            _, y, fold, _, margins = _arrays(batch, base.cuts, shape)
            held = fold[:, None] == hides
            right += (held & (margins.argmax(axis=2) == y[:, None])).sum(axis=0)
            seen += held.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(hides))), pa.array(right), pa.array(seen)], names=["model", "right", "seen"])

    sums = state.mapInArrow(judge, "model long, right long, seen long").groupBy("model").agg(F.sum("right").alias("right"), F.sum("seen").alias("seen"))
    share = {r["model"]: r["right"] / max(1, r["seen"]) for r in sums.collect()}
    scores = _scores(share, len(draws), folds)
    best = draws[int(np.argmax(scores))]
    return extend(base, rows, best, features), list(zip(draws, scores))


def predict(model: Softmax, rows: DataFrame, features: list[str] = schemas.FEATURES) -> DataFrame:
    """Add ``code`` and ``probability`` of the likeliest label; of equal ones the first."""

    @F.pandas_udf("code double, probability double")
    def best(*columns: pd.Series) -> pd.DataFrame:
        chance = _probabilities(model.margins(np.column_stack([c.to_numpy(np.float64) for c in columns])))
        return pd.DataFrame({"code": chance.argmax(axis=1).astype(float), "probability": chance.max(axis=1)})

    scored = rows.withColumn("_best", best(*(F.col(c).cast("double") for c in features)))
    return scored.select(*rows.columns, "_best.code", "_best.probability")


def save_cuts(spark: SparkSession, model: Softmax, path: str) -> None:
    """The part of a model that never changes: its labels and cuts."""
    rows = [(i, c.tolist(), model.labels) for i, c in enumerate(model.cuts)]
    spark.createDataFrame(rows, "feature int, cuts array<double>, labels int").coalesce(1).write.mode("overwrite").parquet(f"{path}/cuts")


def save_rounds(spark: SparkSession, model: Softmax, first: int, path: str) -> None:
    """The trees from round ``first`` on, in a folder of their own."""
    rows = [
        (number, label, node, int(t.feature[node]), float(t.cut[node]), float(t.value[node]))
        for number, trees in enumerate(model.rounds) if number >= first
        for label, t in enumerate(trees) for node in range(len(t.feature))
    ]
    spark.createDataFrame(rows, _TREE).coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, cuts: str, trees: list[str]) -> Softmax:
    """The model of a folder of cuts and folders of rounds. Its size is set by its parameters."""
    stored = spark.read.parquet(f"{cuts}/cuts").orderBy("feature").collect()
    by_tree: dict[tuple[int, int], list] = {}
    for r in spark.read.schema(_TREE).parquet(*trees).orderBy("round", "label", "node").toLocalIterator():
        by_tree.setdefault((r["round"], r["label"]), []).append(r)
    rounds: list[list[Tree]] = []
    for (number, _), nodes in by_tree.items():
        if number == len(rounds):
            rounds.append([])
        rounds[number].append(Tree(*(np.array([n[c] for n in nodes]) for c in ("feature", "cut", "value"))))
    return Softmax(stored[0]["labels"], [np.array(r["cuts"], np.float64) for r in stored], rounds)
