"""Queries over projections, filters, scalar functions and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from blotter import schemas
from blotter.bindings import INCIDENTS_SQL, incidents, table, with_sql
from blotter.functions.clock import cyclic_features, day_slots, time_features
from blotter.functions.conform import conform_schema
from blotter.functions.messages import decode_value
from blotter.operators import filters
from blotter.operators.ordering import page_slice
from blotter.queries.registry import query

_INCIDENTS = with_sql(INCIDENTS_SQL)


@query("SELECT event_id, props AS raw FROM events")
def decode_value_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = table(spark, sf_dir, "events").select(
        "event_id", F.col("props").cast("binary").alias("value")
    )
    return decode_value(sent)


# Texts of a numeric column, some of them no number, as a producer might send them.
_PRECINCT_TEXT = "CASE WHEN addr_pct_cd % 7 = 3 THEN 'n/a' ELSE cast(latitude AS varchar) END"


def _conform_sql() -> str:
    given = {
        "cmplnt_num": "cmplnt_num",
        "boro_nm": "boro_nm",
        "addr_pct_cd": f"cast(trunc(try_cast({_PRECINCT_TEXT} AS double)) AS integer)",
        "cmplnt_fr_dt": "CASE WHEN addr_pct_cd % 5 = 1 THEN NULL ELSE cast(cmplnt_fr_dt AS timestamp) END",
        "rpt_dt": "rpt_dt",
        "latitude": "CASE WHEN addr_pct_cd % 3 = 2 THEN NULL ELSE latitude END",
        "ky_cd": "cast(event_id AS integer)",
    }
    empty = {
        T.IntegerType(): "cast(0 AS integer)",
        T.DoubleType(): "cast(0 AS double)",
        T.StringType(): "cast(NULL AS varchar)",
        T.TimestampType(): "cast(NULL AS timestamp)",
    }
    columns = (
        f"{given.get(f.name, empty[f.dataType])} AS {f.name}" for f in schemas.INCIDENTS.fields
    )
    return _INCIDENTS + f"SELECT {', '.join(columns)} FROM incidents"


def wall_clock(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the checking SQL has them."""
    return df.select(
        *(
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


@query(_conform_sql())
def conform_schema_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = incidents(spark, sf_dir)
    text = F.when(F.col("addr_pct_cd") % 7 == 3, "n/a").otherwise(F.col("latitude").cast("string"))
    day = F.when(F.col("addr_pct_cd") % 5 == 1, "some day").otherwise(
        F.col("cmplnt_fr_dt").cast("string")
    )
    lat = F.when(F.col("addr_pct_cd") % 3 == 2, "north").otherwise(
        F.col("latitude").cast("string")
    )
    sent = rows.select(
        lat.alias("latitude"),
        "cmplnt_num",
        "boro_nm",
        text.alias("addr_pct_cd"),
        day.alias("cmplnt_fr_dt"),
        F.col("rpt_dt").cast("string").alias("rpt_dt"),
        F.col("event_id").alias("ky_cd"),
        F.lit("dropped").alias("no_such_column"),
    )
    return wall_clock(conform_schema(sent, schemas.INCIDENTS))


@query(
    _INCIDENTS
    + """SELECT cmplnt_num, nullif(boro_nm, 'ASIA') AS boro_nm, nullif(longitude, 0) AS longitude
FROM incidents WHERE boro_nm <> 'ASIA' AND longitude <> 0"""
)
def require_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = incidents(spark, sf_dir).select(
        "cmplnt_num",
        F.nullif("boro_nm", F.lit("ASIA")).alias("boro_nm"),
        F.nullif("longitude", F.lit(0)).alias("longitude"),
    )
    return filters.require(rows, ["boro_nm", "longitude"])


@query(
    _INCIDENTS
    + """SELECT cmplnt_num, latitude, longitude, cmplnt_fr_dt, cmplnt_fr_tm, boro_nm, pd_desc
FROM incidents WHERE latitude <> 0 AND longitude <> 0 AND addr_pct_cd % 10 <> 7"""
)
def map_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = incidents(spark, sf_dir)
    text = F.when(F.col("addr_pct_cd") % 10 == 7, "NaN").otherwise(
        F.col("latitude").cast("string")
    )
    sent = rows.withColumns(
        {
            "latitude": text,
            "longitude": F.col("longitude").cast("string"),
            "cmplnt_fr_dt": F.col("rpt_dt").cast("string"),
        }
    )
    return filters.plottable(filters.map_records(sent))


def _found(rows: DataFrame) -> DataFrame:
    return rows.select("cmplnt_num", "pd_desc", "cmplnt_fr_tm")


@query(
    _INCIDENTS
    + """SELECT cmplnt_num, pd_desc, cmplnt_fr_tm FROM incidents
WHERE cast(latitude AS varchar) LIKE '%ASIA%' OR cast(cmplnt_fr_dt AS varchar) LIKE '%ASIA%'
  OR cmplnt_fr_tm LIKE '%ASIA%' OR boro_nm LIKE '%ASIA%' OR pd_desc LIKE '%ASIA%'"""
)
def search_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(filters.search(incidents(spark, sf_dir), "All", "asia"))


@query(
    _INCIDENTS
    + "SELECT cmplnt_num, pd_desc, cmplnt_fr_tm FROM incidents WHERE cmplnt_fr_tm LIKE '%:1_:%'"
)
def search_one_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(filters.search(incidents(spark, sf_dir), "cmplnt_fr_tm", ":1_:"))


@query(_INCIDENTS + "SELECT cmplnt_num, pd_desc, cmplnt_fr_tm FROM incidents")
def search_short_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _found(filters.search(incidents(spark, sf_dir), "boro_nm", "asi"))


@query(
    _INCIDENTS
    + """SELECT cmplnt_num, CASE WHEN boro_nm = 'ASIA' THEN 'missing boro_nm'
  WHEN longitude = 0 THEN 'missing longitude' END AS reason
FROM incidents"""
)
def check_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = incidents(spark, sf_dir).withColumns(
        {
            "boro_nm": F.nullif("boro_nm", F.lit("ASIA")),
            "longitude": F.nullif("longitude", F.lit(0)),
        }
    )
    accepted, rejected = filters.split_requests(asked)
    return accepted.select("cmplnt_num", F.lit(None).cast("string").alias("reason")).unionByName(
        rejected.select("cmplnt_num", "reason")
    )


@query(
    """SELECT event_id, coalesce(cast(nullif(user_id % 4, 0) AS varchar), '114') AS addr_pct_cd,
  upper(event_type) AS boro_nm, strftime(ts, '%Y-%m-%d') AS cmplnt_fr_dt,
  strftime(ts, '%H:%M:00') AS cmplnt_fr_tm, value AS latitude, value AS longitude
FROM events"""
)
def normalise_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "events").select(
        "event_id",
        F.nullif(F.col("user_id") % 4, F.lit(0)).alias("addr_pct_cd"),
        F.col("event_type").alias("boro_nm"),
        F.col("ts").alias("asked_at"),
        F.col("value").alias("latitude"),
        F.col("value").alias("longitude"),
    )
    return filters.normalise_request(asked)


# Dates and times as text, some of them unusable.
_DATE_SQL = "CASE WHEN addr_pct_cd % 6 = 1 THEN NULL ELSE cmplnt_fr_dt END"
_TIME_SQL = "CASE WHEN addr_pct_cd % 6 IN (2, 3) THEN NULL ELSE cast(cmplnt_fr_tm[1:2] AS integer) END"


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.col("addr_pct_cd") % 6
    date = F.when(part == 1, "2024-13-45").otherwise(F.date_format("rpt_dt", "yyyy-MM-dd'T'HH:mm:ss"))
    time = F.when(part == 2, "24:00:00").when(part == 3, "(null)").otherwise(F.col("cmplnt_fr_tm"))
    texts = incidents(spark, sf_dir).withColumns({"cmplnt_fr_dt": date, "cmplnt_fr_tm": time})
    return time_features(texts)


@query(
    _INCIDENTS
    + f"""SELECT cmplnt_num, cast({_TIME_SQL} AS integer) AS hour,
  cast(month({_DATE_SQL}) AS integer) AS month, cast(isodow({_DATE_SQL}) - 1 AS integer) AS wday
FROM incidents"""
)
def time_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timed(spark, sf_dir).select("cmplnt_num", "hour", "month", "wday")


@query(
    _INCIDENTS
    + f"""SELECT cmplnt_num, round(sin(2 * pi() * ({_TIME_SQL}) / 24), 6) + 0.0 AS h_sin,
  round(cos(2 * pi() * ({_TIME_SQL}) / 24), 6) + 0.0 AS h_cos,
  round(sin(2 * pi() * (isodow({_DATE_SQL}) - 1) / 7), 6) + 0.0 AS w_sin,
  round(cos(2 * pi() * (isodow({_DATE_SQL}) - 1) / 7), 6) + 0.0 AS w_cos
FROM incidents"""
)
def cyclic_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cyclic_features(_timed(spark, sf_dir))
    return rows.select(
        "cmplnt_num", *(F.round(c, 6).alias(c) for c in ("h_sin", "h_cos", "w_sin", "w_cos"))
    )


@query(
    _INCIDENTS
    + """SELECT cmplnt_fr_dt, slot FROM (SELECT DISTINCT cmplnt_fr_dt FROM incidents)
CROSS JOIN (SELECT strftime(TIMESTAMP '2000-01-01' + to_minutes(cast(i AS integer)), '%H:%M:%S') AS slot
  FROM range(0, 1440, 10) t(i))"""
)
def day_slots_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = incidents(spark, sf_dir).select("cmplnt_fr_dt").distinct()
    return days.select("cmplnt_fr_dt", F.explode(day_slots()).alias("slot"))


@query(
    _INCIDENTS
    + """SELECT cmplnt_num, rpt_dt, pd_desc FROM incidents ORDER BY rpt_dt, cmplnt_num
LIMIT 100 OFFSET 150"""
)
def page_slice_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = incidents(spark, sf_dir).select("cmplnt_num", "rpt_dt", "pd_desc")
    return page_slice(rows, limit=100, offset=150, order=["rpt_dt", "cmplnt_num"])


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 100 OFFSET (SELECT count(*) * 9 // 10 FROM lineitem)"""
)
def page_slice_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page nine tenths into a table, found without sorting it. A task may hold 1 000 rows
    here, so that small tables are deep as well."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return page_slice(rows, 100, rows.count() * 9 // 10, order, fit=1000).drop("l_suppkey")
