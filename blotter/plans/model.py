"""Features, training, search, scoring and persistence of the offence classifier."""

from __future__ import annotations

import random
import time
import uuid
from dataclasses import dataclass
from hashlib import md5
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession, functions as F

from blotter import schemas
from blotter.plans import boosting
from blotter.functions.clock import cyclic_features, hour_of, parse_date, time_features
from blotter.operators.encoding import label_decode, label_encode, ordinal_encode, vocabulary
from blotter.operators.filters import check_request, require
from blotter.operators.keys import keep_first
from blotter.operators.labels import keep_labels, known_label, top_k_labels
from blotter.operators.metrics import accuracy, classification_report
from blotter.operators.sampling import stratified_split
from blotter.session import materialise
from blotter.sources.tables import Table, exists

# Search space; the names are those of the forest's parameters.
FOREST_GRID = {
    "numTrees": [100, 200, 300, 500],
    "maxDepth": [4, 6, 8, 10],
    "subsamplingRate": [0.6, 0.8, 1.0],
    "featureSubsetStrategy": ["sqrt", "0.6", "0.8", "1.0"],
}
BOOSTED_DEFAULTS = {"maxIter": 100, "maxDepth": 6, "stepSize": 0.1, "subsamplingRate": 0.8}
FOREST_DEFAULTS = {"numTrees": 100, "maxDepth": 8}
#: Boosted models of labels that are fitted side by side.
PARALLEL_FITS = 3
Fitted = Model | dict[int, GBTClassificationModel] | boosting.Softmax


@dataclass(frozen=True)
class Vocabularies:
    """Codes of the labels and of the category columns, each (value, code)."""

    labels: DataFrame
    categories: dict[str, DataFrame]


@dataclass(frozen=True)
class Classifier:
    """A fitted model with the vocabularies it was fitted on."""

    model: Fitted
    vocabularies: Vocabularies


def clean(df: DataFrame) -> DataFrame:
    """Rows complete enough to train on, with time features; bad dates and times dropped."""
    timed = time_features(require(df, schemas.TRAINING_FIELDS))
    return cyclic_features(require(timed, ["month", "hour"]))


def fit_vocabularies(df: DataFrame) -> Vocabularies:
    """Vocabularies of the labels and categories that occur in ``df``."""
    return Vocabularies(
        vocabulary(df, schemas.LABEL),
        {column: vocabulary(df, column) for column in schemas.CATEGORIES},
    )


def feature_matrix(df: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """Add the nine model inputs to rows that carry time features."""
    placed = df.withColumns(
        {"lat": F.col("latitude").try_cast("double"), "lon": F.col("longitude").try_cast("double")}
    )
    return ordinal_encode(placed, vocabularies.categories, schemas.CATEGORIES)


def training_rows(df: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """Key, label, features and label code of cleaned rows whose label is known."""
    known = known_label(df, vocabularies.labels)
    coded = label_encode(feature_matrix(known, vocabularies), vocabularies.labels)
    # A coordinate that is no number cannot be a model input.
    return require(coded, ["lat", "lon"]).select(
        schemas.INCIDENT_KEY, schemas.LABEL, *schemas.FEATURES, F.col("y").cast("double").alias("y")
    )


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=schemas.FEATURES, outputCol="features")


def _forest(params: dict) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol="features", labelCol="y", predictionCol="code", seed=schemas.SEED,
        # Each row's node in every tree is kept, on disk where memory ends, so that a level
        # does not lead the rows through all levels above; the trees are the same.
        **{"cacheNodeIds": True, **params},
    )


def train(rows: DataFrame, kind: str = "forest", **params) -> Fitted:
    """A model giving a probability per label: one forest, one boosted model per label, or
    trees boosted for all labels together ("softmax", with the names of ``boosting.Params``)."""
    if kind == "softmax":
        return boosting.fit(rows, label_count(rows), boosting.Params(**params))
    if kind == "forest":
        return Pipeline(stages=[_assembler(), _forest({**FOREST_DEFAULTS, **params})]).fit(rows)
    ready = _assembler().transform(rows).select("features", "y").persist()
    try:
        codes = sorted(int(row.y) for row in ready.select("y").distinct().toLocalIterator())
        one = GBTClassifier(
            featuresCol="features", labelCol="hit", seed=schemas.SEED, **{**BOOSTED_DEFAULTS, **params}
        )

        def fit(code: int) -> GBTClassificationModel:
            return one.fit(ready.withColumn("hit", (F.col("y") == code).cast("double")))

        # The tasks of one model fill the cores that the short passes of another leave idle.
        with ThreadPool(PARALLEL_FITS) as pool:
            fitted = pool.map(inheritable_thread_target(rows.sparkSession)(fit), codes)
        return dict(zip(codes, fitted))
    finally:
        ready.unpersist()


def label_count(rows: DataFrame) -> int:
    """One more than the highest label code."""
    return int(rows.agg(F.max("y")).first()[0]) + 1


def hashed_draws(
    grid: dict[str, list] = boosting.SOFTMAX_GRID, n: int = 12, seed: int = schemas.SEED
) -> list[boosting.Params]:
    """``n`` different combinations of the grid: those with the lowest md5 of seed and values."""
    combinations = [dict(zip(grid, values)) for values in product(*grid.values())]
    digest = lambda c: md5("|".join(map(str, [seed, *c.values()])).encode()).hexdigest()
    return [boosting.Params(**c) for c in sorted(combinations, key=digest)[:n]]


def search_softmax(
    rows: DataFrame, n: int = 12, folds: int = 3, grid: dict[str, list] = boosting.SOFTMAX_GRID
) -> tuple[boosting.Softmax, list[tuple[boosting.Params, float]]]:
    """The best of ``n`` draws of jointly boosted trees, refitted on all rows, and every
    draw's accuracy on the folds held out; all draws and folds grow in the same passes."""
    return boosting.search(rows, label_count(rows), hashed_draws(grid, n), folds)


def draw_params(grid: dict[str, list], n: int = 12, seed: int = schemas.SEED) -> list[dict]:
    """``n`` different combinations of the grid, drawn with a seed."""
    combinations = [dict(zip(grid, values)) for values in product(*grid.values())]
    return random.Random(seed).sample(combinations, min(n, len(combinations)))


def search_params(
    rows: DataFrame,
    n: int = 12,
    folds: int = 3,
    grid: dict[str, list] = FOREST_GRID,
    parallelism: int = 4,
) -> tuple[PipelineModel, list[tuple[dict, float]]]:
    """The best model of a random search, refitted on all rows, and every draw's accuracy."""
    forest = _forest({})
    draws = draw_params(grid, n)
    maps = [{forest.getParam(name): value for name, value in draw.items()} for draw in draws]
    judge = MulticlassClassificationEvaluator(
        labelCol="y", predictionCol="code", metricName="accuracy"
    )
    search = CrossValidator(
        estimator=Pipeline(stages=[_assembler(), forest]),
        estimatorParamMaps=maps,
        evaluator=judge,
        numFolds=folds,
        parallelism=parallelism,
        seed=schemas.SEED,
    )
    fitted = search.fit(rows)
    return fitted.bestModel, list(zip(draws, fitted.avgMetrics))


def predict_codes(model: Fitted, rows: DataFrame) -> DataFrame:
    """Add ``code`` and ``probability`` of the likeliest label."""
    if isinstance(model, boosting.Softmax):
        return boosting.predict(model, rows)
    if not isinstance(model, dict):
        scored = model.transform(rows)
        best = F.array_max(vector_to_array("probability"))
        return scored.select(*rows.columns, F.col("code"), best.alias("probability"))
    scored = _assembler().transform(rows)
    for code, one in model.items():
        one = one.copy()
        one.setPredictionCol("_ignored").setRawPredictionCol("_raw").setProbabilityCol("_both")
        scored = one.transform(scored).withColumn(f"_p{code}", vector_to_array("_both")[1])
        scored = scored.drop("_ignored", "_raw", "_both")
    options = F.array(
        *(F.struct(F.col(f"_p{c}").alias("p"), F.lit(-float(c)).alias("order")) for c in model)
    )
    total = sum((F.col(f"_p{c}") for c in model), F.lit(0.0))
    best = F.array_max(options)
    return scored.select(
        *rows.columns,
        (-best["order"]).alias("code"),
        (best["p"] / total).alias("probability"),
    )


def split_scorable(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requests that can be scored, and the others with a ``reason``.

    The reason names the first required field that is missing, else the first of date,
    time and coordinates that is none.
    """
    faults = {
        "cmplnt_fr_dt": parse_date(F.col("cmplnt_fr_dt")),
        "cmplnt_fr_tm": hour_of(F.col("cmplnt_fr_tm").cast("string")),
        "latitude": F.col("latitude").try_cast("double"),
        "longitude": F.col("longitude").try_cast("double"),
    }
    bad = [F.when(value.isNull(), F.lit(f"bad {name}")) for name, value in faults.items()]
    checked = check_request(requests).withColumn("reason", F.coalesce("reason", *bad))
    accepted = checked.where(F.col("reason").isNull()).select(requests.columns)
    return accepted, checked.where(F.col("reason").isNotNull())


def score_batch(classifier: Classifier, requests: DataFrame) -> DataFrame:
    """Add ``prediction`` and ``probability`` to the rows that ``split_scorable`` accepts."""
    timed = cyclic_features(require(time_features(requests), ["month", "hour"]))
    rows = require(feature_matrix(timed, classifier.vocabularies), ["lat", "lon"])
    scored = predict_codes(classifier.model, rows)
    labelled = label_decode(scored, classifier.vocabularies.labels, "code", "prediction")
    return labelled.select(*requests.columns, "prediction", "probability")


def percent(probability: str = "probability"):
    """A probability as shown to people."""
    return F.col(probability) * 100


def save_model(classifier: Classifier, path: str) -> None:
    """Write model and vocabularies to a fresh folder below ``path`` and name it the newest.

    Earlier versions stay as they are, so a model may be saved where it was loaded from,
    and whoever reads ``path`` meanwhile gets a whole version.
    """
    at = time.time_ns()
    root, path = path, f"{path}/version-{at}-{uuid.uuid4().hex[:8]}"
    spark = classifier.vocabularies.labels.sparkSession
    codes: list[tuple[int]] = []
    if isinstance(classifier.model, boosting.Softmax):
        boosting.save_cuts(spark, classifier.model, f"{path}/softmax")
        boosting.save_rounds(spark, classifier.model, 0, f"{path}/softmax/rounds/first")
    elif isinstance(classifier.model, dict):
        for code, one in classifier.model.items():
            one.write().overwrite().save(f"{path}/boosted/{code}")
        codes = [(int(code),) for code in classifier.model]
    else:
        classifier.model.write().overwrite().save(f"{path}/forest")
    spark.createDataFrame(codes, "code int").write.mode("overwrite").parquet(f"{path}/codes")
    classifier.vocabularies.labels.write.mode("overwrite").parquet(f"{path}/labels")
    for column, vocab in classifier.vocabularies.categories.items():
        vocab.write.mode("overwrite").parquet(f"{path}/categories/{column}")
    named = spark.createDataFrame([(at, path.rpartition("/")[2])], "at long, folder string")
    named.coalesce(1).write.mode("append").parquet(f"{root}/versions")


def newest_version(spark: SparkSession, path: str) -> str:
    """The folder of the newest version that ``save_model`` wrote."""
    newest = spark.read.parquet(f"{path}/versions").agg(F.max_by("folder", "at")).first()[0]
    return f"{path}/{newest}"


def load_model(spark: SparkSession, path: str) -> Classifier:
    """The newest version that ``save_model`` wrote, with the rounds added to it since."""
    path = newest_version(spark, path)
    codes = sorted(row.code for row in spark.read.parquet(f"{path}/codes").collect())
    model: Fitted
    if exists(spark, Table("parquet", f"{path}/softmax/cuts")):
        folders = [f"{path}/softmax/rounds/first", *added_rounds(spark, path)]
        model = boosting.load(spark, f"{path}/softmax", folders)
    elif codes:
        model = {c: GBTClassificationModel.load(f"{path}/boosted/{c}") for c in codes}
    else:
        model = PipelineModel.load(f"{path}/forest")
    vocabularies = Vocabularies(
        spark.read.parquet(f"{path}/labels"),
        {c: spark.read.parquet(f"{path}/categories/{c}") for c in schemas.CATEGORIES},
    )
    return Classifier(model, vocabularies)


def added_rounds(spark: SparkSession, version: str) -> list[str]:
    """The folders of rounds that were added to a version and logged, in their order."""
    log = f"{version}/softmax/log"
    if not exists(spark, Table("parquet", log)):
        return []
    logged = spark.read.schema("batch long, folder string").parquet(log).orderBy("batch").collect()
    return [f"{version}/softmax/rounds/{r['folder']}" for r in logged]


def continue_model(
    version: str, rows: DataFrame, batch: int, params: boosting.Params
) -> boosting.Softmax:
    """Add ``params.rounds`` rounds, fitted to ``rows`` alone, to the stored version.

    The new trees go to a folder named for the batch, and only a log entry of the batch,
    written last and in one piece, makes them part of the model. A batch that comes again
    finds its entry and changes nothing, or, if the entry was never written, writes the same
    folder again. Stored trees are never rewritten. One writer may continue a version.
    """
    spark = rows.sparkSession
    known = added_rounds(spark, version)
    folder = f"batch-{batch:09d}"
    path = f"{version}/softmax"
    stored = boosting.load(spark, path, [f"{path}/rounds/first", *known])
    if f"{path}/rounds/{folder}" in known:
        return stored
    more = boosting.extend(stored, rows, params)
    boosting.save_rounds(spark, more, len(stored.rounds), f"{path}/rounds/{folder}")
    entry = spark.createDataFrame([(batch, folder)], "batch long, folder string").coalesce(1)
    entry.write.mode("append").parquet(f"{path}/log")
    return more


def evaluate(classifier: Classifier, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accuracy and report over labelled feature rows."""
    scored = label_decode(
        predict_codes(classifier.model, rows), classifier.vocabularies.labels, "code", "predicted"
    )
    judged = scored.select(F.col(schemas.LABEL).alias("actual"), "predicted")
    return accuracy(judged), classification_report(judged)


def prepare(
    incidents: DataFrame, order: list[str], k: int = schemas.TOP_LABELS
) -> tuple[DataFrame, Vocabularies]:
    """Training rows with ``is_test``, and the vocabularies of the kept labels."""
    used = dict.fromkeys([schemas.INCIDENT_KEY, *order, *schemas.TRAINING_FIELDS])
    cleaned = materialise(clean(keep_first(incidents.select(*used), schemas.INCIDENT_KEY, order)))
    kept = keep_labels(cleaned, materialise(top_k_labels(cleaned, k)))
    vocabularies = fit_vocabularies(kept)
    rows = materialise(training_rows(kept, vocabularies))
    return stratified_split(rows), vocabularies


def train_all(
    incidents: DataFrame,
    order: list[str],
    path: str,
    k: int = schemas.TOP_LABELS,
    draws: int = 12,
    folds: int = 3,
    grid: dict[str, list] = FOREST_GRID,
    keep: bool = False,
) -> tuple[Classifier, DataFrame, DataFrame]:
    """Clean, split, search, evaluate and save; the classifier, its accuracy and report.

    With ``keep`` a model that is stored below ``path`` is not trained again, only judged.
    """
    rows, vocabularies = prepare(incidents, order, k)
    spark = incidents.sparkSession
    if keep and exists(spark, Table("parquet", f"{path}/versions")):
        classifier = load_model(spark, path)
    else:
        best, _ = search_params(rows.where(~F.col("is_test")), draws, folds, grid)
        classifier = Classifier(best, vocabularies)
        save_model(classifier, path)
    right, report = evaluate(classifier, rows.where("is_test"))
    return classifier, right, report
