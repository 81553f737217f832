"""The classifier on separable data, where it must beat the commonest label."""

from __future__ import annotations

import datetime
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter import schemas
from blotter.plans import boosting, forecast, model
from blotter.sources.tables import Table, append, read_table

LABELS = ["ARSON", "FRAUD", "THEFT"]


@pytest.fixture(scope="module")
def rows(spark):
    """The label follows from the latitude; some rows cannot be used."""
    label = F.element_at(F.array(*map(F.lit, LABELS)), (F.col("id") % 3 + 1).cast("int"))
    return spark.range(600).select(
        F.col("id").cast("string").alias("cmplnt_num"),
        (F.col("id") % 4 + 1).cast("int").alias("addr_pct_cd"),
        F.when(F.col("id") % 2 == 0, "BRONX").otherwise("QUEENS").alias("boro_nm"),
        F.when(F.col("id") == 5, "no date").otherwise("2024-05-06").alias("cmplnt_fr_dt"),
        F.when(F.col("id") == 7, "24:00:00").otherwise("12:30:00").alias("cmplnt_fr_tm"),
        F.when(F.col("id") == 9, None).when(F.col("id") < 3, "RARE").otherwise(label).alias("ofns_desc"),
        (40 + F.col("id") % 3 + F.rand(1) * 0.1).alias("latitude"),
        F.lit(-73.9).alias("longitude"),
    )


@pytest.fixture(scope="module", params=["forest", "boosted", "softmax"])
def fitted(request, rows):
    prepared, vocabularies = model.prepare(rows, ["cmplnt_num"], k=3)
    params = {
        "forest": {"numTrees": 5, "maxDepth": 4}, "boosted": {"maxIter": 2, "maxDepth": 3},
        "softmax": {"rounds": 3, "depth": 3, "rate": 0.5},
    }[request.param]
    trained = model.train(prepared.where("not is_test"), request.param, **params)
    return model.Classifier(trained, vocabularies), prepared


def test_unusable_rows_are_left_out(fitted):
    _, prepared = fitted
    assert prepared.count() == 600 - 6  # no date, no time, no label, three of a rare label


def test_it_learns(fitted):
    classifier, prepared = fitted
    accuracy, report = model.evaluate(classifier, prepared.where("is_test"))
    assert accuracy.first().accuracy > 0.9
    assert {r.label for r in report.collect()} == {*LABELS, "macro avg", "weighted avg"}


def test_scores_are_probabilities_and_survive_storage(spark, fitted, rows, tmp_path):
    classifier, _ = fitted
    scored = model.score_batch(classifier, rows)
    assert scored.count() == 598
    bad = scored.where(~F.col("prediction").isin(LABELS) | ~F.col("probability").between(1 / 3 - 1e-9, 1 + 1e-9))
    assert bad.isEmpty()
    model.save_model(classifier, str(tmp_path / "m"))
    again = model.score_batch(model.load_model(spark, str(tmp_path / "m")), rows)
    columns = ["cmplnt_num", "prediction", "probability"]
    assert sorted(map(tuple, again.select(columns).collect())) == sorted(map(tuple, scored.select(columns).collect()))


def test_unseen_categories_still_score(spark, fitted):
    classifier, _ = fitted
    asked = spark.createDataFrame(
        [("999", "NOWHERE", "2024-01-01", "01:00:00", 41.05, -73.9)],
        "addr_pct_cd string, boro_nm string, cmplnt_fr_dt string, cmplnt_fr_tm string, latitude double, longitude double",
    )
    assert model.score_batch(classifier, asked).first().prediction in LABELS


def test_forecast_once_a_day(spark, fitted, rows, tmp_path):
    classifier, _ = fitted
    stored, table = Table("parquet", str(tmp_path / "i")), Table("parquet", str(tmp_path / "f"))
    append(rows, stored)
    day = datetime.date(2024, 6, 1)
    assert forecast.forecast_and_store(spark, stored, classifier, table, day)
    assert not forecast.forecast_and_store(spark, stored, classifier, table, day)
    made = read_table(spark, table)
    assert made.columns == schemas.FORECASTS.names
    assert made.count() == made.select("id").distinct().count() == 4 * 144


def test_draws_differ_and_repeat():
    drawn = model.draw_params(model.FOREST_GRID)
    assert len(drawn) == 12 == len({str(d) for d in drawn})
    assert drawn == model.draw_params(model.FOREST_GRID)


def test_a_model_may_be_saved_where_it_was_loaded(spark, fitted, rows, tmp_path):
    path = str(tmp_path / "kept")
    model.save_model(fitted[0], path)
    loaded = model.load_model(spark, path)
    model.save_model(loaded, path)
    again = model.load_model(spark, path)
    assert model.score_batch(again, rows).count() == model.score_batch(loaded, rows).count() == 598


def test_rejected_requests_have_a_reason(rows):
    accepted, rejected = model.split_scorable(rows.drop("addr_pct_cd").withColumn("addr_pct_cd", F.lit("7")))
    assert accepted.count() == 598
    assert {(r.cmplnt_num, r.reason) for r in rejected.collect()} == {
        ("5", "bad cmplnt_fr_dt"), ("7", "bad cmplnt_fr_tm"),
    }


def test_a_stored_model_is_kept(rows, tmp_path, monkeypatch):
    path, grid = str(tmp_path / "kept"), {"numTrees": [2], "maxDepth": [2]}
    first, _, _ = model.train_all(rows, ["cmplnt_num"], path, 3, 1, 2, grid)
    monkeypatch.setattr(model, "search_params", None)
    again, right, _ = model.train_all(rows, ["cmplnt_num"], path, 3, 1, 2, grid, keep=True)
    assert again.model.stages[-1].getNumTrees == first.model.stages[-1].getNumTrees == 2
    assert right.first().accuracy > 0


def plain_tree(x, pull, slope, cuts, depth, how, node=0):
    """A tree grown by looking at every cut: {node: (feature, cut, value)}."""
    value = -how.rate * pull.sum() / (slope.sum() + how.l2)
    best = (1e-9, None, None)
    if depth:
        for f, own in enumerate(cuts):
            for cut in own:
                left = x[:, f] <= cut
                a, b = slope[left].sum(), slope[~left].sum()
                if a < how.weight or b < how.weight:
                    continue
                gain = pull[left].sum() ** 2 / (a + how.l2) + pull[~left].sum() ** 2 / (b + how.l2)
                gain -= pull.sum() ** 2 / (slope.sum() + how.l2)
                if gain > best[0] + 1e-9:
                    best = (gain, f, cut)
    _, f, cut = best
    if f is None:
        return {node: (-1, value)}
    left = x[:, f] <= cut
    grown = {node: (f, cut)}
    for side, child in ((left, 2 * node + 1), (~left, 2 * node + 2)):
        grown |= plain_tree(x[side], pull[side], slope[side], cuts, depth - 1, how, child)
    return grown


def test_softmax_trees_equal_a_plain_version(spark):
    rng = np.random.default_rng(4)
    x = np.round(rng.random((300, 2)), 2)
    y = (x[:, 0] > 0.6) + (x[:, 0] + x[:, 1] > 1.2) * 1
    rows = spark.createDataFrame(
        [(str(i), float(y[i]), *map(float, x[i])) for i in range(300)], "cmplnt_num string, y double, a double, b double"
    )
    how = boosting.Params(rounds=2, depth=3, rate=0.4, rows=1.0)
    cuts = [np.arange(0.1, 1, 0.1), np.array([0.25, 0.5, 0.75])]
    base = boosting.Softmax(3, cuts)
    fitted = boosting.extend(base, rows.repartition(3), how, ["a", "b"])
    margins = np.zeros((300, 3))
    for trees in fitted.rounds:
        chance = boosting._probabilities(margins)
        for label, tree in enumerate(trees):
            p = chance[:, label]
            unit = 1 << 20
            pull, slope = np.rint((p - (y == label)) * unit) / unit, np.rint(np.maximum(p * (1 - p), 1e-6) * unit) / unit
            plain = plain_tree(x, pull, slope, cuts, 3, how)
            leaf = tree.leaf(x)
            for node, (f, cut) in plain.items():
                assert tree.feature[node] == f
                assert (tree.cut if f >= 0 else tree.value)[node] == pytest.approx(cut)
            margins[:, label] += tree.value[leaf]
    again = boosting.extend(base, rows.repartition(7), how, ["a", "b"])
    assert all((s.value == t.value).all() for a, b in zip(fitted.rounds, again.rounds) for s, t in zip(a, b))


def test_a_search_hides_its_folds(spark, rows):
    """A label that follows from the key alone cannot be learned beyond chance on other rows."""
    prepared, _ = model.prepare(rows, ["cmplnt_num"], k=3)
    grid = {"rounds": [1, 3], "depth": [2], "rate": [0.3], "rows": [1.0], "columns": [1.0]}
    best, tried = model.search_softmax(prepared.where("not is_test"), 12, 3, grid)
    assert [p.rounds for p, _ in tried] == [d.rounds for d in model.hashed_draws(grid)] and len(tried) == 2
    assert all(0.9 < s <= 1 for _, s in tried) and len(best.rounds) in (1, 3)
    mixed = prepared.withColumn("y", F.pmod(F.xxhash64("cmplnt_num"), F.lit(3)).cast("double"))
    _, tried = model.search_softmax(mixed, 1, 3, {**grid, "rounds": [3], "depth": [6]})
    assert tried[0][1] < 0.5


def test_drawn_shares():
    names = np.random.default_rng(0).integers(0, 1 << 64, 20_000, dtype=np.uint64)
    how = boosting.Params(rows=0.6)
    first, second = boosting._drawn(names, how, 0), boosting._drawn(names, how, 1)
    assert abs(first.mean() - 0.6) < 0.02 and abs((first & second).mean() - 0.36) < 0.02


def test_a_model_goes_on_and_bears_crashes(spark, rows, tmp_path, monkeypatch):
    prepared, vocabularies = model.prepare(rows, ["cmplnt_num"], k=3)
    fitted = model.train(prepared, "softmax", rounds=2, depth=2, rate=0.3)
    model.save_model(model.Classifier(fitted, vocabularies), str(tmp_path / "m"))
    version = model.newest_version(spark, str(tmp_path / "m"))
    stored = {p: p.read_bytes() for p in (tmp_path / "m").rglob("*.parquet")}
    one = boosting.Params(rounds=1, depth=2, rate=0.3)

    with monkeypatch.context() as broken:  # the trees are written, the log is not
        broken.setattr(type(spark), "createDataFrame", _failing_on(type(spark).createDataFrame, "batch long"))
        with pytest.raises(RuntimeError, match="lost"):
            model.continue_model(version, prepared, 7, one)
    assert len(model.load_model(spark, str(tmp_path / "m")).model.rounds) == 2
    for batch in (7, 7, 8):
        model.continue_model(version, prepared, batch, one)
    after = model.load_model(spark, str(tmp_path / "m")).model
    assert len(after.rounds) == 4
    for old, new in zip(fitted.rounds, after.rounds):
        assert all((a.value == b.value).all() and (a.feature == b.feature).all() for a, b in zip(old, new))
    assert all(p.read_bytes() == content for p, content in stored.items())


def _failing_on(real, mark):
    def create(self, data, schema=None, *rest, **more):
        if isinstance(schema, str) and schema.startswith(mark):
            raise RuntimeError("lost")
        return real(self, data, schema, *rest, **more)

    return create


def test_packed_values_of_a_part_of_a_batch():
    packed = boosting._binary(np.arange(24, dtype=np.float64).reshape(6, 2, 2))
    part = packed.slice(2, 3)
    assert (boosting._values(part, np.float64) == np.arange(8, 20)).all()
    assert len(boosting._values(packed.slice(6, 0), np.float64)) == 0


def test_each_round_is_applied_to_the_rows_once(spark, rows, monkeypatch):
    prepared, _ = model.prepare(rows, ["cmplnt_num"], k=3)
    written, real = [], boosting._written

    def count(state, cuts, shape, pending):
        written.append(len(pending))
        made = real(state, cuts, shape, pending)
        assert made.count() == prepared.count()
        return made

    monkeypatch.setattr(boosting, "_written", count)
    boosting.fit(prepared, 3, boosting.Params(rounds=3, depth=2))
    assert written == [1, 1]  # nobody reads the margins after the last round


def test_a_forest_keeps_the_nodes_of_its_rows(spark, rows):
    prepared, _ = model.prepare(rows, ["cmplnt_num"], k=3)
    assert model._forest({}).getCacheNodeIds()
    kept, led = (model.train(prepared, numTrees=5, cacheNodeIds=c).stages[-1].toDebugString for c in (True, False))
    strip = lambda text: text.partition("\n")[2]
    assert strip(kept) == strip(led)


def test_boosted_models_of_labels_are_fitted_side_by_side(spark, rows, monkeypatch):
    prepared, _ = model.prepare(rows, ["cmplnt_num"], k=3)
    side = model.train(prepared, "boosted", maxIter=2, maxDepth=2)
    monkeypatch.setattr(model, "PARALLEL_FITS", 1)
    single = model.train(prepared, "boosted", maxIter=2, maxDepth=2)
    strip = lambda m: {c: one.toDebugString.partition("\n")[2] for c, one in m.items()}
    assert list(side) == list(single) and strip(side) == strip(single)


def test_the_forest_search_draws_from_the_whole_space(spark, rows, monkeypatch):
    from blotter.queries import models

    prepared = model.prepare(rows, ["cmplnt_num"], k=3)
    seen = {}

    class Search:
        def __init__(self, **given):
            seen.update(given)

        def fit(self, used):
            seen["rows"] = used.count()
            return SimpleNamespace(bestModel=None, avgMetrics=[0.5] * len(seen["estimatorParamMaps"]))

    monkeypatch.setattr(models, "incidents", lambda *_: None)
    monkeypatch.setattr(model, "prepare", lambda *_: prepared)
    monkeypatch.setattr(model, "CrossValidator", Search)
    assert models.param_search(spark, "").where("fresh and sound").count() == 12
    maps = [{param.name: value for param, value in one.items()} for one in seen["estimatorParamMaps"]]
    assert maps == model.draw_params(model.FOREST_GRID, 12) and seen["numFolds"] == 3
    assert seen["rows"] == prepared[0].where("not is_test").count()


def _same_trees(one, other):
    assert len(one.rounds) == len(other.rounds)
    for a, b in zip((t for r in one.rounds for t in r), (t for r in other.rounds for t in r)):
        assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and (a.value == b.value).all()


def test_a_search_finds_the_same_in_tasks_and_in_passes(spark, monkeypatch):
    """Small rows are held by each task, which grows a whole model; large ones are passed over."""
    rng = np.random.default_rng(7)
    x = np.round(rng.random((240, 3)) * [1, 8, 1], 2)
    y = (x[:, 0] > 0.6) + (x[:, 0] + x[:, 1] / 8 > 1.2) * 1
    lost = rng.random(240) < 0.1  # no number among the features
    data = [(str(i % 230), float(y[i]), x[i, 0], x[i, 1] if not lost[i] else None, 5.0) for i in range(240)]
    rows = spark.createDataFrame([tuple(v if v is None or isinstance(v, str) else float(v) for v in r) for r in data],
                                 "cmplnt_num string, y double, a double, b double, c double").repartition(3)
    draws = [
        boosting.Params(rounds=3, depth=4, rate=0.3, rows=0.6, columns=0.7),
        boosting.Params(rounds=2, depth=2, rate=0.1, rows=1.0, columns=1.0),
    ]
    held, scores = boosting.search(rows, 3, draws, 3, ["a", "b", "c"])
    base = boosting.Softmax(3, held.cuts)
    assert boosting._held(rows, base, ["a", "b", "c"], F.lit(0), 10).codes.shape == (3, 240)
    assert boosting._held(rows, base, ["a", "b", "c"], F.lit(0), 20) is None  # a level too wide for a task
    monkeypatch.setattr(boosting, "HELD_BYTES", 0)
    passed, other = boosting.search(rows, 3, draws, 3, ["a", "b", "c"])
    assert scores == other and [p for p, _ in scores] == draws
    _same_trees(held, passed)


def test_the_softmax_search_draws_from_the_whole_space(spark, rows, monkeypatch):
    from blotter.queries import models

    prepared = model.prepare(rows, ["cmplnt_num"], k=3)
    seen = []

    def search(used, labels, draws, folds):
        seen.append((used.count(), draws, folds))
        return boosting.Softmax(labels, [np.empty(0)] * 9), [(d, 0.5) for d in draws]

    monkeypatch.setattr(models, "incidents", lambda *_: rows.withColumn("event_id", F.col("cmplnt_num").cast("long")))
    monkeypatch.setattr(model, "prepare", lambda *_: prepared)
    monkeypatch.setattr(boosting, "search", search)
    assert models.search_softmax(spark, "").count() == 12
    combinations = len(model.hashed_draws(boosting.SOFTMAX_GRID, 1000))
    assert seen == [(prepared[0].where("not is_test").count(), model.hashed_draws(boosting.SOFTMAX_GRID, 12), 3)]
    assert combinations == 432 and max(d.rounds for d in seen[0][1]) == 500 and max(d.depth for d in seen[0][1]) == 10
