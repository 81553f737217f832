"""The given tables seen as incidents, messages and requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

RECORD = [
    "cmplnt_num", "addr_pct_cd", "boro_nm", "cmplnt_fr_dt", "cmplnt_fr_tm", "rpt_dt",
    "ofns_desc", "pd_desc", "latitude", "longitude",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream."""
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def incidents_of(events: DataFrame, region: DataFrame) -> DataFrame:
    """Events as incidents; the region stands in for the borough."""
    joined = events.join(region, F.col("user_id") % 5 == F.col("r_regionkey"))
    return joined.select(
        F.col("event_id").cast("string").alias("cmplnt_num"),
        F.col("user_id").cast("int").alias("addr_pct_cd"),
        F.col("r_name").alias("boro_nm"),
        F.col("ts").cast("date").alias("cmplnt_fr_dt"),
        F.date_format("ts", "HH:mm:ss").alias("cmplnt_fr_tm"),
        F.col("ts").alias("rpt_dt"),
        F.col("event_type").alias("ofns_desc"),
        F.concat_ws(" ", "event_type", "r_name").alias("pd_desc"),
        F.col("value").alias("latitude"),
        F.get_json_object("props", "$.k").cast("double").alias("longitude"),
        "event_id",
    )


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incidents_of(table(spark, sf_dir, "events"), table(spark, sf_dir, "region"))


def acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders stand in for the acknowledgements of incidents of the same number."""
    return (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderstatus") == "F")
        .select(F.col("o_orderkey").cast("string").alias("id"), F.lit("sent").alias("status"))
    )


def _record(key: Column) -> Column:
    """The JSON object of an incident under the given key; ``rest`` holds the other fields."""
    return F.concat(F.lit('{"cmplnt_num":"'), key, F.lit('",'), F.substring("rest", 2, 1 << 30))


def messages_of(incidents: DataFrame) -> DataFrame:
    """Each incident as one message (part, off, value) in one of eight shapes.

    By event_id modulo 8: object; list with a non-object; list of two; broken text;
    scalar; object with an empty key; object whose key many messages share; empty list.
    """
    moment = F.date_format("rpt_dt", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("rpt_dt")
    day = F.col("cmplnt_fr_dt").cast("string").alias("cmplnt_fr_dt")
    texts = {"rpt_dt": moment, "cmplnt_fr_dt": day}
    rest = F.to_json(F.struct(*(texts.get(c, F.col(c)) for c in RECORD if c != "cmplnt_num")))
    shape = F.col("event_id") % 8
    own = F.col("cmplnt_num")
    raw = (
        F.when(shape == 0, _record(own))
        .when(shape == 1, F.concat(F.lit("["), _record(own), F.lit(", 5]")))
        .when(
            shape == 2,
            F.concat(
                F.lit(" ["), _record(F.concat(F.lit("A"), own)), F.lit(", "),
                _record(F.concat(F.lit("B"), own)), F.lit("]"),
            ),
        )
        .when(shape == 3, F.concat(F.lit("{bad "), own))
        .when(shape == 4, own)
        .when(shape == 5, _record(F.lit("")))
        .when(shape == 6, _record(F.concat(F.lit("U"), F.col("addr_pct_cd").cast("string"))))
        .otherwise(F.lit("[]"))
    )
    return incidents.withColumn("rest", rest).select(
        (F.col("event_id").cast("int") % 3).alias("part"),
        F.col("event_id").alias("off"),
        raw.cast("binary").alias("value"),
    )


def _sent(rows: DataFrame, offset: str, body: Column) -> DataFrame:
    return rows.select(
        (F.col(offset) % 3).cast("int").alias("part"),
        F.col(offset).alias("off"),
        body.cast("binary").alias("value"),
    )


def public_event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as public events; the key is a number, or text for urgent ones."""
    shared = [
        F.col("o_orderpriority").alias("event_type"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("start_date_time"),
        F.col("o_custkey").alias("police_precinct"),
    ]
    number = F.to_json(F.struct(F.col("o_orderkey").alias("event_id"), *shared))
    text = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("event_id"), *shared))
    body = F.when(F.col("o_orderpriority") == "1-URGENT", text).otherwise(number)
    return _sent(table(spark, sf_dir, "orders"), "o_orderkey", body)


def status_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order states as status records."""
    ident = F.col("o_orderkey").cast("string").alias("id")
    body = F.to_json(F.struct(ident, F.col("o_orderstatus").alias("status")))
    return _sent(table(spark, sf_dir, "orders"), "o_orderkey", body)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_of(incidents(spark, sf_dir))


def timed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages with the time they were sent, which is that of the event; offsets
    of different parts do not follow it."""
    rows = incidents(spark, sf_dir)
    times = rows.select(F.col("event_id").alias("off"), F.col("rpt_dt").cast("timestamp").alias("sent"))
    return messages_of(rows).join(times, "off").select("part", "off", "value", "sent")


def message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as a stream."""
    return messages_of(incidents_of(event_rows(spark, sf_dir), table(spark, sf_dir, "region")))


# The same bindings for the SQL that checks the queries.
INCIDENTS_SQL = """incidents AS (
  SELECT cast(event_id AS varchar) AS cmplnt_num, cast(user_id AS integer) AS addr_pct_cd,
    r_name AS boro_nm, cast(ts AS date) AS cmplnt_fr_dt, strftime(ts, '%H:%M:%S') AS cmplnt_fr_tm,
    ts AS rpt_dt, event_type AS ofns_desc, event_type || ' ' || r_name AS pd_desc,
    value AS latitude, cast(json_extract_string(props, '$.k') AS double) AS longitude, event_id
  FROM events JOIN region ON r_regionkey = user_id % 5
)"""

ACKS_SQL = """acks AS (
  SELECT cast(o_orderkey AS varchar) AS id, 'sent' AS status FROM orders WHERE o_orderstatus = 'F'
)"""

# Usable records of the messages, worked out from the events without any JSON.
RECORDS_SQL = """records AS (
  SELECT cast(event_id % 3 AS integer) AS part, event_id AS off, cast(p.pos AS integer) AS pos,
    CASE event_id % 8 WHEN 2 THEN (CASE p.pos WHEN 0 THEN 'A' ELSE 'B' END) || cmplnt_num
      WHEN 6 THEN 'U' || addr_pct_cd ELSE cmplnt_num END AS cmplnt_num,
    addr_pct_cd, boro_nm, cast(cmplnt_fr_dt AS timestamp) AS cmplnt_fr_dt, cmplnt_fr_tm, rpt_dt,
    ofns_desc, pd_desc, latitude, longitude
  FROM incidents JOIN (VALUES (0), (1)) p(pos) ON p.pos = 0 OR event_id % 8 = 2
  WHERE event_id % 8 IN (0, 1, 2, 6)
)"""

# The last record per key in arrival order.
UNIQUE_SQL = """uniq AS (
  SELECT * FROM records
  QUALIFY row_number() OVER (PARTITION BY cmplnt_num ORDER BY part DESC, off DESC, pos DESC) = 1
)"""
RECORD_COLUMNS = ", ".join(RECORD)


def with_sql(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
