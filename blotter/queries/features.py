"""Queries over sectors, labels, codes, the split and model quality."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from blotter import schemas
from blotter.bindings import INCIDENTS_SQL, incidents, table, with_sql
from blotter.functions.clock import cyclic_features, time_features
from blotter.operators import encoding, keys, labels, metrics, sectors
from blotter.operators.joins import lookup
from blotter.operators.sampling import stratified_split as split
from blotter.plans import model
from blotter.queries.registry import query
from blotter.session import materialise

DAY = datetime.date(2024, 2, 1)
_INCIDENTS = with_sql(INCIDENTS_SQL)
# Three of the five labels, so that the cut shows.
TOP = 3

POSITIONS_SQL = """positions AS (
  SELECT DISTINCT latitude, longitude, addr_pct_cd, boro_nm FROM incidents
  WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND addr_pct_cd IS NOT NULL
)"""
CENTROIDS_SQL = """centroids AS (
  SELECT addr_pct_cd, boro_nm, avg(latitude) AS latitude, avg(longitude) AS longitude
  FROM positions WHERE latitude <> 0 AND longitude <> 0 AND addr_pct_cd <> 0 AND boro_nm IS NOT NULL
  GROUP BY addr_pct_cd, boro_nm
)"""
# Every sixth position has no longitude and every borough of MIDDLE EAST is unknown.
HOLES_SQL = """incidents AS (
  SELECT * REPLACE (CASE WHEN event_id % 6 = 0 THEN NULL ELSE longitude END AS longitude,
    nullif(boro_nm, 'MIDDLE EAST') AS boro_nm) FROM whole
)"""
WHOLE_SQL = INCIDENTS_SQL.replace("incidents AS", "whole AS", 1)


def holed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incidents(spark, sf_dir).withColumns(
        {
            "longitude": F.when(F.col("event_id") % 6 != 0, F.col("longitude")),
            "boro_nm": F.nullif("boro_nm", F.lit("MIDDLE EAST")),
        }
    )


@query(with_sql(WHOLE_SQL, HOLES_SQL, POSITIONS_SQL) + "SELECT * FROM positions")
def distinct_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sectors.distinct_positions(holed(spark, sf_dir))


@query(
    with_sql(WHOLE_SQL, HOLES_SQL, POSITIONS_SQL, CENTROIDS_SQL)
    + """SELECT addr_pct_cd, boro_nm, round(latitude, 8) AS latitude, round(longitude, 8) AS longitude
FROM centroids"""
)
def sector_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sectors.sector_centroids(sectors.distinct_positions(holed(spark, sf_dir)))
    return found.withColumns({c: F.round(c, 8) for c in ("latitude", "longitude")})


@query(
    with_sql(INCIDENTS_SQL, POSITIONS_SQL, CENTROIDS_SQL)
    + """SELECT cast(addr_pct_cd AS varchar) AS addr_pct_cd, boro_nm, DATE '2024-02-01' AS cmplnt_fr_dt,
  strftime(TIMESTAMP '2000-01-01' + to_minutes(cast(i AS integer)), '%H:%M:%S') AS cmplnt_fr_tm,
  round(latitude, 8) AS latitude, round(longitude, 8) AS longitude
FROM centroids CROSS JOIN range(0, 1440, 10) t(i)"""
)
def forecast_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sectors.sector_centroids(sectors.distinct_positions(incidents(spark, sf_dir)))
    grid = sectors.forecast_grid(found, DAY)
    return grid.withColumns({c: F.round(c, 8) for c in ("latitude", "longitude")})


@query(_INCIDENTS + "SELECT ofns_desc, count(*) AS n FROM incidents GROUP BY ofns_desc")
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.label_counts(incidents(spark, sf_dir))


TOP_SQL = f"""top AS (
  SELECT ofns_desc, count(*) AS n FROM incidents GROUP BY ofns_desc
  ORDER BY n DESC, ofns_desc LIMIT {TOP}
)"""


@query(with_sql(INCIDENTS_SQL, TOP_SQL) + "SELECT * FROM top")
def top_k_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.top_k_labels(incidents(spark, sf_dir), TOP)


@query(
    with_sql(INCIDENTS_SQL, TOP_SQL)
    + "SELECT cmplnt_num, ofns_desc FROM incidents WHERE ofns_desc IN (SELECT ofns_desc FROM top)"
)
def keep_top_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.keep_top_labels(incidents(spark, sf_dir), TOP).select("cmplnt_num", "ofns_desc")


@query(
    _INCIDENTS
    + """SELECT cmplnt_num, ofns_desc FROM incidents
WHERE ofns_desc IN (SELECT ofns_desc FROM incidents WHERE ofns_desc < 'purchase')"""
)
def known_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = incidents(spark, sf_dir)
    seen = encoding.vocabulary(rows.where(F.col("ofns_desc") < "purchase"), "ofns_desc")
    return labels.known_label(rows, seen).select("cmplnt_num", "ofns_desc")


def vocabulary_sql(column: str, name: str, where: str = "") -> str:
    return f"""{name} AS (
  SELECT value, row_number() OVER (ORDER BY value) - 1 AS code
  FROM (SELECT DISTINCT cast({column} AS varchar) AS value FROM incidents {where})
)"""


@query(with_sql(INCIDENTS_SQL, vocabulary_sql("addr_pct_cd", "vocab")) + "SELECT * FROM vocab")
def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.vocabulary(incidents(spark, sf_dir), "addr_pct_cd")


@query(with_sql(INCIDENTS_SQL, vocabulary_sql("cmplnt_num", "vocab")) + "SELECT * FROM vocab")
def vocabulary_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken for vocabularies too large to sort in one task."""
    return encoding.vocabulary(incidents(spark, sf_dir), "cmplnt_num", limit=1000)


LABELS_SQL = vocabulary_sql("ofns_desc", "label_codes")


@query(
    with_sql(INCIDENTS_SQL, LABELS_SQL)
    + "SELECT cmplnt_num, ofns_desc, code AS y FROM incidents JOIN label_codes ON value = ofns_desc"
)
def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = incidents(spark, sf_dir).select("cmplnt_num", "ofns_desc")
    return encoding.label_encode(rows, encoding.vocabulary(rows, "ofns_desc"))


@query(
    with_sql(INCIDENTS_SQL, LABELS_SQL)
    + """SELECT cmplnt_num, addr_pct_cd % 6 AS code, value AS label FROM incidents
LEFT JOIN label_codes ON code = addr_pct_cd % 6"""
)
def label_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = incidents(spark, sf_dir)
    coded = rows.select("cmplnt_num", (F.col("addr_pct_cd") % 6).alias("code"))
    return encoding.label_decode(coded, encoding.vocabulary(rows, "ofns_desc"), "code", "label")


# Vocabularies learnt without one borough and without precincts from 100 on.
_SEEN = "WHERE boro_nm <> 'ASIA' AND addr_pct_cd < 100"
SEEN_SQL = (vocabulary_sql("addr_pct_cd", "pct", _SEEN), vocabulary_sql("boro_nm", "bor", _SEEN))
CODED_SQL = """FROM incidents LEFT JOIN pct ON pct.value = cast(addr_pct_cd AS varchar)
LEFT JOIN bor ON bor.value = boro_nm"""


def seen_categories(rows: DataFrame) -> dict[str, DataFrame]:
    seen = rows.where((F.col("boro_nm") != "ASIA") & (F.col("addr_pct_cd") < 100))
    return {c: encoding.vocabulary(seen, c) for c in schemas.CATEGORIES}


@query(
    with_sql(INCIDENTS_SQL, *SEEN_SQL)
    + f"SELECT cmplnt_num, coalesce(pct.code, -1) AS pct_enc, coalesce(bor.code, -1) AS bor_enc {CODED_SQL}"
)
def ordinal_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = incidents(spark, sf_dir)
    coded = encoding.ordinal_encode(rows, seen_categories(rows), schemas.CATEGORIES)
    return coded.select("cmplnt_num", "pct_enc", "bor_enc")


def _cyclic_sql(function: str, part: str, period: int, name: str) -> str:
    return f"round({function}(2 * pi() * {part} / {period}), 6) + 0.0 AS {name}"


_HOUR = "cast(cmplnt_fr_tm[1:2] AS integer)"
_WDAY = "(isodow(cmplnt_fr_dt) - 1)"


@query(
    with_sql(INCIDENTS_SQL, *SEEN_SQL)
    + f"""SELECT cmplnt_num, cast(month(cmplnt_fr_dt) AS integer) AS month,
  {_cyclic_sql('sin', _HOUR, 24, 'h_sin')}, {_cyclic_sql('cos', _HOUR, 24, 'h_cos')},
  {_cyclic_sql('sin', _WDAY, 7, 'w_sin')}, {_cyclic_sql('cos', _WDAY, 7, 'w_cos')},
  latitude AS lat, longitude AS lon, coalesce(pct.code, -1) AS pct_enc, coalesce(bor.code, -1) AS bor_enc
{CODED_SQL}"""
)
def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = incidents(spark, sf_dir)
    vocabularies = model.Vocabularies(encoding.vocabulary(rows, "ofns_desc"), seen_categories(rows))
    made = model.feature_matrix(cyclic_features(time_features(rows)), vocabularies)
    rounded = {c: F.round(c, 6) for c in ("h_sin", "h_cos", "w_sin", "w_cos")}
    return made.withColumns(rounded).select("cmplnt_num", *schemas.FEATURES)


@query(
    _INCIDENTS
    + """SELECT cmplnt_num, ofns_desc,
  row_number() OVER (PARTITION BY ofns_desc ORDER BY md5('42' || cmplnt_num), cmplnt_num)
    <= ceil(count(*) OVER (PARTITION BY ofns_desc) * cast(0.2 AS double)) AS is_test
FROM incidents"""
)
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split(incidents(spark, sf_dir).select("cmplnt_num", "ofns_desc"))


# A predictor that SQL can repeat: the commonest label of each precinct.
PREDICTED_SQL = """judged AS (
  SELECT ofns_desc AS actual, predicted FROM incidents JOIN (
    SELECT addr_pct_cd, ofns_desc AS predicted FROM incidents GROUP BY addr_pct_cd, ofns_desc
    QUALIFY row_number() OVER (PARTITION BY addr_pct_cd ORDER BY count(*) DESC, ofns_desc) = 1
  ) USING (addr_pct_cd)
  WHERE predicted IS NOT NULL
)"""


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = incidents(spark, sf_dir).select("addr_pct_cd", "ofns_desc")
    counts = rows.groupBy("addr_pct_cd", "ofns_desc").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("addr_pct_cd").orderBy(F.desc("n"), "ofns_desc")
    best = counts.withColumn("rank", F.row_number().over(order)).where("rank = 1")
    guess = materialise(best.select("addr_pct_cd", F.col("ofns_desc").alias("predicted")))
    return lookup(rows, guess, ["addr_pct_cd"], "inner").select(
        F.col("ofns_desc").alias("actual"), "predicted"
    )


@query(
    with_sql(INCIDENTS_SQL, PREDICTED_SQL)
    + "SELECT round(avg(cast(actual = predicted AS integer)), 6) AS accuracy FROM judged"
)
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.accuracy(judged(spark, sf_dir)).select(F.round("accuracy", 6).alias("accuracy"))


# "signup" is never predicted, so its precision is undefined and counts as 0.
@query(
    with_sql(INCIDENTS_SQL, PREDICTED_SQL)
    + """, called AS (SELECT actual, nullif(predicted, 'signup') AS predicted FROM judged),
voiced AS (SELECT actual, coalesce(predicted, 'view') AS predicted FROM called),
names AS (SELECT actual AS label FROM voiced UNION SELECT predicted FROM voiced),
per_label AS (
  SELECT label, (SELECT count(*) FROM voiced WHERE actual = label) AS support,
    (SELECT count(*) FROM voiced WHERE predicted = label) AS called,
    (SELECT count(*) FROM voiced WHERE predicted = label AND actual = label) AS hit
  FROM names
),
ratios AS (
  SELECT label, support, coalesce(hit / nullif(called, 0), 0) AS p, coalesce(hit / nullif(support, 0), 0) AS r
  FROM per_label
),
scored AS (SELECT label, support, p, r, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM ratios)
SELECT label, support, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1 FROM scored
UNION ALL SELECT 'macro avg', cast(sum(support) AS bigint), round(avg(p), 6), round(avg(r), 6), round(avg(f), 6)
FROM scored
UNION ALL SELECT 'weighted avg', cast(sum(support) AS bigint), round(sum(p * support) / sum(support), 6),
  round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6)
FROM scored"""
)
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    voiced = judged(spark, sf_dir).withColumn(
        "predicted", F.when(F.col("predicted") == "signup", "view").otherwise(F.col("predicted"))
    )
    report = metrics.classification_report(voiced)
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(
    """SELECT token, count(*) AS n FROM (
  SELECT unnest(string_split(text, ' ')) AS token FROM conversations
) GROUP BY token"""
)
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.token_counts(table(spark, sf_dir, "conversations"), "text")


@query(
    _INCIDENTS
    + """SELECT cmplnt_num, cmplnt_fr_dt FROM incidents
WHERE cmplnt_fr_dt NOT IN (SELECT cmplnt_fr_dt FROM incidents WHERE cmplnt_fr_dt < DATE '2024-01-11')"""
)
def once_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the days a table of earlier work does not hold yet."""
    rows = incidents(spark, sf_dir).select("cmplnt_num", "cmplnt_fr_dt")
    done = incidents(spark, sf_dir).where(F.col("cmplnt_fr_dt") < F.lit(datetime.date(2024, 1, 11)))
    return keys.not_yet_done(rows, done, "cmplnt_fr_dt")
