"""Model queries. Predictions have no SQL counterpart, so where one is given it checks
that every row is scored, with a known label and a probability a classifier can give."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, functions as F

from blotter import schemas
from blotter.bindings import (
    INCIDENTS_SQL, RECORDS_SQL, UNIQUE_SQL, incidents, message_stream, messages_of, with_sql,
)
from blotter.plans import forecast, model
from blotter.plans.boosting import SOFTMAX_GRID
from blotter.queries.features import CENTROIDS_SQL, DAY, POSITIONS_SQL, TOP, TOP_SQL
from blotter.queries.registry import query
from blotter.session import scratch
from blotter.sources.tables import Table, append, read_table
from blotter.streaming import jobs
from blotter.streaming.batches import ONCE, run_all

# Boosted models of the queries: a fifth of the library's rounds, one model for each label.
BOOSTED = {"maxIter": 20}
GRID = {
    "numTrees": [3, 5],
    "maxDepth": [2, 3],
    "subsamplingRate": [0.6, 0.8, 1.0],
    "featureSubsetStrategy": ["sqrt", "0.6"],
}
# Fewer rounds than the library's, each of which takes a pass over the rows for each level.
SOFTMAX = {"rounds": 10, "rate": 0.3}
CONTINUED = 4
ORDER = ["rpt_dt", "cmplnt_num"]
HELD_SQL = (
    with_sql(INCIDENTS_SQL, TOP_SQL)
    + """, held AS (
  SELECT ofns_desc AS label, cast(ceil(count(*) * cast(0.2 AS double)) AS bigint) AS support
  FROM incidents SEMI JOIN top USING (ofns_desc) GROUP BY ofns_desc
), report AS (
  SELECT label, support FROM held
  UNION ALL SELECT name, cast(sum(support) AS bigint)
  FROM held, (VALUES ('macro avg'), ('weighted avg')) t(name) GROUP BY name
) """
)


# Incidents whose label follows from the place in nine cases of ten, so that there is
# something to learn: the labels of the events are spread evenly.
PLACED_SQL = """incidents AS (
  SELECT * REPLACE (CASE WHEN event_id % 10 = 9 THEN ['ARSON', 'FRAUD', 'THEFT'][event_id % 3 + 1]
    WHEN longitude >= 60 THEN 'ARSON' WHEN latitude >= 40 THEN 'FRAUD' ELSE 'THEFT' END AS ofns_desc) FROM given
)"""
PLACED_HELD_SQL = HELD_SQL.replace("incidents AS", "given AS", 1).replace("top AS", PLACED_SQL + ",\ntop AS", 1)
MAJORITY_SQL = """, share AS (SELECT round(max(support) / sum(support), 9) AS majority FROM held) """


def placed(rows: DataFrame) -> DataFrame:
    """Incidents, or messages' rows of them, with a label that follows from the place."""
    noise = F.element_at(F.array(*map(F.lit, ["ARSON", "FRAUD", "THEFT"])), (F.col("event_id") % 3 + 1).cast("int"))
    label = (
        F.when(F.col("event_id") % 10 == 9, noise).when(F.col("longitude") >= 60, "ARSON")
        .when(F.col("latitude") >= 40, "FRAUD").otherwise("THEFT")
    )
    return rows.withColumn(schemas.LABEL, label)


def _placed_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, model.Vocabularies]:
    return model.prepare(placed(incidents(spark, sf_dir)), ORDER, TOP)


def _majority(rows: DataFrame) -> DataFrame:
    """One row: the share of the commonest label among the rows held out."""
    counts = rows.where("is_test").groupBy(schemas.LABEL).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.round(F.max("n") / F.sum("n"), 9).alias("majority"))


def _fitted(spark: SparkSession, sf_dir: str, kind: str = "forest", **params) -> tuple[model.Classifier, DataFrame]:
    rows, vocabularies = model.prepare(incidents(spark, sf_dir), ORDER, TOP)
    fitted = model.train(rows.where(~F.col("is_test")), kind, **params)
    return model.Classifier(fitted, vocabularies), rows


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incidents(spark, sf_dir).select("cmplnt_num", *schemas.REQUEST_FIELDS)


def _sound(classifier: model.Classifier, scored: DataFrame, *keep: str) -> DataFrame:
    """Per scored row: whether its label is known and its probability possible."""
    known = classifier.vocabularies.labels
    names = [row.value for row in known.collect()]  # the top labels of the model, few
    floor = 1 / len(names) - 1e-9
    return scored.select(
        *keep,
        F.col("prediction").isin(names).alias("label_known"),
        F.col("probability").between(floor, 1 + 1e-9).alias("probability_sound"),
    )


def _judged(report: DataFrame) -> DataFrame:
    """Per line of a report the rows judged, and whether its scores can be."""
    sound = reduce(and_, (F.col(c).between(0, 1) for c in ("precision", "recall", "f1")))
    return report.select("label", "support", sound.alias("sound"))


@query(HELD_SQL + "SELECT label, support, true AS sound FROM report")
def train_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report of a forest on the rows held out."""
    classifier, rows = _fitted(spark, sf_dir)
    return _judged(model.evaluate(classifier, rows.where("is_test"))[1])


@query(HELD_SQL + "SELECT label, support, true AS sound FROM report")
def train_boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report of boosted trees, one model per label, on the rows held out."""
    classifier, rows = _fitted(spark, sf_dir, "boosted", **BOOSTED)
    return _judged(model.evaluate(classifier, rows.where("is_test"))[1])


@query(
    PLACED_HELD_SQL + MAJORITY_SQL
    + "SELECT label, support, true AS sound, majority, true AS above FROM report, share"
)
def train_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report of trees boosted for all labels together, and whether they beat the commonest label."""
    rows, vocabularies = _placed_rows(spark, sf_dir)
    fitted = model.train(rows.where(~F.col("is_test")), "softmax", **SOFTMAX)
    right, report = model.evaluate(model.Classifier(fitted, vocabularies), rows.where("is_test"))
    above = F.lit(right.first().accuracy) > F.col("majority") + 0.1
    return _judged(report).crossJoin(F.broadcast(_majority(rows))).withColumn("above", above)


def _draws_sql(grid: dict[str, list]) -> str:
    """The twelve draws of a grid, in SQL."""
    values = lambda name: "(VALUES " + ", ".join(f"({v!r})" for v in grid[name]) + f") {name}_({name})"
    doubles = "cast(rate AS double), cast(rows AS double), cast(columns AS double)"
    return f"""drawn AS (
  SELECT rounds, depth, cast(rate AS double) AS rate, cast(rows AS double) AS rows, cast(columns AS double) AS columns
  FROM {", ".join(map(values, grid))}
  ORDER BY md5(concat_ws('|', {schemas.SEED}, rounds, depth, {doubles})) LIMIT 12
)"""


@query(
    PLACED_HELD_SQL + MAJORITY_SQL + ", " + _draws_sql(SOFTMAX_GRID)
    + "SELECT rounds, depth, rate, rows, columns, true AS sound, majority, true AS best_above FROM drawn, share"
)
def search_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve draws over three folds, grown side by side, and whether the best one beats the
    commonest label on the rows held out."""
    rows, vocabularies = _placed_rows(spark, sf_dir)
    best, tried = model.search_softmax(rows.where(~F.col("is_test")))
    right, _ = model.evaluate(model.Classifier(best, vocabularies), rows.where("is_test"))
    names = ["rounds", "depth", "rate", "rows", "columns"]
    lines = [(*(getattr(p, n) for n in names), 0.0 < score <= 1.0) for p, score in tried]
    shown = spark.createDataFrame(lines, "rounds int, depth int, rate double, rows double, columns double, sound boolean")
    above = F.lit(right.first().accuracy) > F.col("majority") + 0.1
    return shown.crossJoin(F.broadcast(_majority(rows))).withColumn("best_above", above)


@query(
    PLACED_HELD_SQL
    + f"""SELECT cast(r AS integer) AS round, (SELECT count(*) FROM top) AS trees, r < {CONTINUED} AS stored,
  true AS unchanged FROM range(0, {CONTINUED + 3}) t(r)"""
)
def refit_continued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored model continued by three micro-batches of messages: the trees of each round,
    and whether those stored before are still the same."""
    rows, vocabularies = _placed_rows(spark, sf_dir)
    fitted = model.train(rows.where(~F.col("is_test")), "softmax", rounds=CONTINUED)
    root, sent = scratch(spark, "model"), scratch(spark, "sent")
    model.save_model(model.Classifier(fitted, vocabularies), root)
    version = model.newest_version(spark, root)
    messages_of(placed(incidents(spark, sf_dir))).repartition(3).write.parquet(sent)
    stream = spark.readStream.schema("part int, off long, value binary").option("maxFilesPerTrigger", 1).parquet(sent)
    run_all([jobs.continue_stream(stream, version, vocabularies, scratch(spark, "state"), ONCE)], 600)
    after = model.load_model(spark, root).model
    same = [
        all((a == b).all() for x, y in zip(old, new) for a, b in ((x.feature, y.feature), (x.cut, y.cut), (x.value, y.value)))
        for old, new in zip(fitted.rounds, after.rounds)
    ]
    lines = [(r, len(t), r < CONTINUED, (same + [True] * 3)[r]) for r, t in enumerate(after.rounds)]
    return spark.createDataFrame(lines, "round int, trees long, stored boolean, unchanged boolean")


@query("SELECT 'draw ' || i AS draw, true AS fresh, true AS sound FROM range(0, 12) t(i)")
def param_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve draws: whether each is unlike those before it, and its accuracy can be."""
    rows, _ = model.prepare(incidents(spark, sf_dir), ORDER, TOP)
    _, tried = model.search_params(rows.where(~F.col("is_test")))
    lines = [
        (f"draw {i}", draw not in [d for d, _ in tried[:i]], 0.0 < float(score) <= 1.0)
        for i, (draw, score) in enumerate(tried)
    ]
    return spark.createDataFrame(lines, "draw string, fresh boolean, sound boolean")


@query("SELECT cast(event_id AS varchar) AS cmplnt_num, true AS percent_sound FROM events")
def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    classifier, _ = _fitted(spark, sf_dir)
    scored = model.score_batch(classifier, _requests(spark, sf_dir))
    shown = model.percent().between(0, 100) & (model.percent() == F.col("probability") * 100)
    return scored.select("cmplnt_num", shown.alias("percent_sound"))


@query("SELECT cast(event_id AS varchar) AS cmplnt_num, true AS label_known, true AS probability_sound FROM events")
def score_batch_sound(spark: SparkSession, sf_dir: str) -> DataFrame:
    classifier, _ = _fitted(spark, sf_dir)
    return _sound(classifier, model.score_batch(classifier, _requests(spark, sf_dir)), "cmplnt_num")


@query(
    """WITH asked AS (
  SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'missing latitude' WHEN 1 THEN 'bad cmplnt_fr_dt'
    WHEN 2 THEN 'bad cmplnt_fr_tm' WHEN 3 THEN 'bad longitude' END AS reason FROM events
)
SELECT cast(event_id AS varchar) AS cmplnt_num, reason FROM asked"""
)
def score_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request with the reason why it cannot be scored, or none if it can."""
    number = F.col("cmplnt_num").cast("bigint") % 6
    spoil = lambda column, k, bad: F.when(number == k, F.lit(bad)).otherwise(F.col(column).cast("string"))
    asked = _requests(spark, sf_dir).withColumns(
        {
            "latitude": spoil("latitude", 0, None),
            "cmplnt_fr_dt": spoil("cmplnt_fr_dt", 1, "no date"),
            "cmplnt_fr_tm": spoil("cmplnt_fr_tm", 2, "25:00:00"),
            "longitude": spoil("longitude", 3, "west"),
        }
    )
    accepted, rejected = model.split_scorable(asked)
    none = F.lit(None).cast("string").alias("reason")
    return accepted.select("cmplnt_num", none).unionAll(rejected.select("cmplnt_num", "reason"))


@query("SELECT cast(event_id AS varchar) AS cmplnt_num, true AS label_known, true AS probability_sound FROM events")
def score_boosted_sound(spark: SparkSession, sf_dir: str) -> DataFrame:
    classifier, _ = _fitted(spark, sf_dir, "boosted", **BOOSTED)
    return _sound(classifier, model.score_batch(classifier, _requests(spark, sf_dir)), "cmplnt_num")


@query("SELECT cast(event_id AS varchar) AS cmplnt_num, true AS same FROM events")
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of a model before it is saved and after it is loaded."""
    classifier, _ = _fitted(spark, sf_dir)
    path = scratch(spark, "model")
    model.save_model(classifier, path)
    loaded = model.load_model(spark, path)
    asked = _requests(spark, sf_dir)
    before = model.score_batch(classifier, asked).select("cmplnt_num", "prediction", "probability")
    after = model.score_batch(loaded, asked).select(
        "cmplnt_num", F.col("prediction").alias("p2"), F.col("probability").alias("q2")
    )
    same = (F.col("prediction") == F.col("p2")) & (F.abs(F.col("probability") - F.col("q2")) < 1e-12)
    return before.join(after, "cmplnt_num").select("cmplnt_num", same.alias("same"))


@query(
    with_sql(INCIDENTS_SQL, POSITIONS_SQL, CENTROIDS_SQL)
    + """, grid AS (
  SELECT cast(addr_pct_cd AS varchar) AS pct, boro_nm, '2024-02-01' AS day,
    strftime(TIMESTAMP '2000-01-01' + to_minutes(cast(i AS integer)), '%H:%M:%S') AS slot
  FROM centroids CROSS JOIN range(0, 1440, 10) t(i)
)
SELECT sha256(pct || '|' || boro_nm || '|' || day || '|' || slot) AS id, pct AS addr_pct_cd, slot AS prediction_time
FROM grid"""
)
def daily_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forecast of one day, stored once although asked for twice."""
    return _forecast(spark, sf_dir)[1].select("id", "addr_pct_cd", "prediction_time")


def _forecast(spark: SparkSession, sf_dir: str) -> tuple[model.Classifier, DataFrame]:
    classifier, _ = _fitted(spark, sf_dir)
    stored, table = Table("parquet", scratch(spark, "incidents")), Table("parquet", scratch(spark, "forecasts"))
    append(incidents(spark, sf_dir), stored)
    for _ in range(2):
        forecast.forecast_and_store(spark, stored, classifier, table, DAY)
    return classifier, read_table(spark, table)


@query(
    with_sql(INCIDENTS_SQL, POSITIONS_SQL, CENTROIDS_SQL)
    + """SELECT cast(addr_pct_cd AS varchar) AS addr_pct_cd, boro_nm, DATE '2024-02-01' AS prediction_date,
  strftime(TIMESTAMP '2000-01-01' + to_minutes(cast(i AS integer)), '%H:%M:%S') AS prediction_time,
  true AS label_known, true AS probability_sound
FROM centroids CROSS JOIN range(0, 1440, 10) t(i)"""
)
def daily_forecast_sound(spark: SparkSession, sf_dir: str) -> DataFrame:
    classifier, rows = _forecast(spark, sf_dir)
    return _sound(classifier, rows, "addr_pct_cd", "boro_nm", "prediction_date", "prediction_time")


@query(HELD_SQL + "SELECT label, support, true AS sound FROM report")
def train_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, split, search, evaluate and save; the rows judged and whether the scores can be."""
    _, _, report = model.train_all(
        incidents(spark, sf_dir), ORDER, scratch(spark, "model"), TOP, draws=3, grid=GRID
    )
    return _judged(report)


@query(
    with_sql(INCIDENTS_SQL, TOP_SQL, RECORDS_SQL, UNIQUE_SQL)
    + "SELECT count(*) AS rows, cast(0 AS bigint) AS batch FROM uniq SEMI JOIN top USING (ofns_desc)"
)
def refit_on_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training table sizes at which the streamed records led to a new fit."""
    classifier, _ = _fitted(spark, sf_dir)
    training, fits = Table("parquet", scratch(spark, "training")), Table("parquet", scratch(spark, "fits"))
    running = jobs.refit_stream(
        message_stream(spark, sf_dir), training, fits, classifier.vocabularies,
        scratch(spark, "model"), scratch(spark, "state"), every=50, trigger=ONCE,
    )
    run_all([running], 600)
    return read_table(spark, fits)
