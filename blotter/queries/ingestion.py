"""Queries over messages, keys, acknowledgements, release and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from blotter import schemas
from blotter.bindings import (
    ACKS_SQL, INCIDENTS_SQL, RECORD, RECORD_COLUMNS, RECORDS_SQL, UNIQUE_SQL, acks, incidents,
    messages, public_event_messages, status_messages, table, with_sql,
)
from blotter.functions.conform import conform_schema
from blotter.functions.messages import ARRIVAL, decode_value, flatten, rejects, valid_records
from blotter.operators import keys, metrics
from blotter.plans import ingest as plan
from blotter.plans.release import latest_of, pending_keys, release
from blotter.plans.requests import serve_pool, serve_requests
from blotter.queries.registry import query
from blotter.queries.rows import wall_clock
from blotter.session import materialise, scratch
from blotter.sources.messages import Topic, publish, publish_rows
from blotter.sources.paged import paged_folder, read_paged
from blotter.sources.tables import Table, append, ensure_table, query_session, read_query, read_table

KEY = schemas.INCIDENT_KEY
RECORDS = with_sql(INCIDENTS_SQL, RECORDS_SQL)
UNIQUE = with_sql(INCIDENTS_SQL, RECORDS_SQL, UNIQUE_SQL)
UNIQUE_ACKS = with_sql(INCIDENTS_SQL, RECORDS_SQL, UNIQUE_SQL, ACKS_SQL)

# What is already stored: records whose key ends in 4 or starts with U.
STORED_SQL = """stored AS (
  SELECT * FROM uniq WHERE cmplnt_num LIKE '%4' OR cmplnt_num LIKE 'U%'
)"""
STORED = with_sql(INCIDENTS_SQL, RECORDS_SQL, UNIQUE_SQL, STORED_SQL, ACKS_SQL)


def flat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(decode_value(messages(spark, sf_dir)), schemas.INCIDENTS, KEY)


def unique_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.unique_records(flat_messages(spark, sf_dir), schemas.INCIDENTS, KEY)


def stored_of(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(KEY).endswith("4") | F.col(KEY).startswith("U"))


@query(RECORDS + f"SELECT part, off, pos, {RECORD_COLUMNS} FROM records")
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = valid_records(flat_messages(spark, sf_dir))
    return wall_clock(rows.select(*ARRIVAL, *RECORD))


@query(
    """SELECT cast(event_id % 3 AS integer) AS part, event_id AS off,
  cast(CASE event_id % 8 WHEN 1 THEN 1 ELSE 0 END AS integer) AS pos,
  CASE event_id % 8 WHEN 1 THEN 'element_not_object' WHEN 3 THEN 'parse_error'
    WHEN 4 THEN 'unsupported_top_level' ELSE 'missing_key' END AS reason
FROM events WHERE event_id % 8 IN (1, 3, 4, 5)"""
)
def json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects(flat_messages(spark, sf_dir)).drop("raw")


@query(UNIQUE + f"SELECT part, off, pos, {RECORD_COLUMNS} FROM uniq")
def keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = valid_records(flat_messages(spark, sf_dir))
    return wall_clock(keys.keep_last(rows, KEY, ARRIVAL).select(*ARRIVAL, *RECORD))


@query(
    RECORDS
    + f"""SELECT part, off, pos, {RECORD_COLUMNS} FROM records
QUALIFY row_number() OVER (PARTITION BY cmplnt_num ORDER BY part, off, pos) = 1"""
)
def keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = valid_records(flat_messages(spark, sf_dir))
    return wall_clock(keys.keep_first(rows, KEY, ARRIVAL).select(*ARRIVAL, *RECORD))


@query(STORED + "SELECT DISTINCT cmplnt_num FROM records SEMI JOIN stored USING (cmplnt_num)")
def existing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialise(valid_records(flat_messages(spark, sf_dir)))
    return keys.existing_keys(rows, stored_of(keys.keep_last(rows, KEY, ARRIVAL)), KEY)


@query(STORED + "SELECT DISTINCT cmplnt_num FROM records ANTI JOIN stored USING (cmplnt_num)")
def new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialise(valid_records(flat_messages(spark, sf_dir)))
    return keys.new_keys(rows, stored_of(keys.keep_last(rows, KEY, ARRIVAL)), KEY)


@query(
    STORED
    + f"""
SELECT 'batch' AS origin, {RECORD_COLUMNS} FROM uniq ANTI JOIN stored USING (cmplnt_num)
UNION ALL SELECT 'stored', {RECORD_COLUMNS} FROM stored"""
)
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that holds some of the keys, then the whole batch inserted into it."""
    target = Table("parquet", scratch(spark, "incidents"))
    rows = materialise(unique_messages(spark, sf_dir).select(*RECORD))
    append(stored_of(rows).select(F.lit("stored").alias("origin"), "*"), target)
    batch = rows.select(F.lit("batch").alias("origin"), "*")
    append(keys.insert_if_absent(batch, read_table(spark, target), KEY), target)
    return wall_clock(read_table(spark, target))


# The number 0 is no key, the text '0' is one.
@query(
    """SELECT cast(o_orderkey AS integer) AS event_id, cast(NULL AS varchar) AS event_name,
  o_orderdate AS start_date_time, o_orderpriority AS event_type, cast(o_custkey AS varchar) AS police_precinct
FROM orders WHERE o_orderkey <> 0 OR o_orderpriority = '1-URGENT'"""
)
def ingest_public_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = Table("parquet", scratch(spark, "events"))
    plan.ingest_into(
        public_event_messages(spark, sf_dir), schemas.PUBLIC_EVENTS, schemas.PUBLIC_EVENT_KEY, target
    )
    return wall_clock(
        read_table(spark, target).select(
            "event_id", "event_name", "start_date_time", "event_type", "police_precinct"
        )
    )


@query(
    """SELECT cast(o_orderkey AS varchar) AS id,
  CASE WHEN o_orderstatus = 'F' THEN 'sent' ELSE o_orderstatus END AS status FROM orders"""
)
def ingest_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status records added to acknowledgements that are there; those stay as they are."""
    target = Table("parquet", scratch(spark, "acks"))
    append(acks(spark, sf_dir), target)
    plan.ingest_into(status_messages(spark, sf_dir), schemas.ACKS, schemas.ACK_KEY, target)
    return read_table(spark, target)


@query(UNIQUE + f"SELECT {RECORD_COLUMNS} FROM uniq")
def ingest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ingest of a batch into a new table."""
    target = Table("parquet", scratch(spark, "incidents"))
    plan.ingest_into(messages(spark, sf_dir), schemas.INCIDENTS, KEY, target)
    return wall_clock(read_table(spark, target).select(*RECORD))


@query("SELECT cast(event_id AS varchar) AS id, 'sent' AS status FROM events")
def ack_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.to_ack(incidents(spark, sf_dir))


@query(
    with_sql(INCIDENTS_SQL, ACKS_SQL)
    + f"SELECT {RECORD_COLUMNS} FROM incidents WHERE cmplnt_num NOT IN (SELECT id FROM acks)"
)
def pending_release_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.pending(incidents(spark, sf_dir), acks(spark, sf_dir)).select(*RECORD)


# Versions of one incident per user, the moment unknown for some.
VERSIONS_SQL = """versions AS (
  SELECT cmplnt_num AS version, cast(addr_pct_cd AS varchar) AS cmplnt_num, pd_desc,
    CASE WHEN event_id % 400 = 17 THEN NULL ELSE rpt_dt END AS rpt_dt
  FROM incidents
)"""


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incidents(spark, sf_dir).select(
        F.col("cmplnt_num").alias("version"),
        F.col("addr_pct_cd").cast("string").alias("cmplnt_num"),
        "pd_desc",
        F.when(F.col("event_id") % 400 == 17, None).otherwise(F.col("rpt_dt")).alias("rpt_dt"),
    )


LATEST_SQL = """latest AS (
  SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY cmplnt_num
    ORDER BY rpt_dt DESC NULLS FIRST, version DESC NULLS FIRST) = 1
)"""


@query(with_sql(INCIDENTS_SQL, VERSIONS_SQL, LATEST_SQL) + "SELECT * FROM latest")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.latest_per_key(versions(spark, sf_dir), KEY, "rpt_dt", ["version"])


@query(
    with_sql(INCIDENTS_SQL, VERSIONS_SQL, LATEST_SQL, ACKS_SQL)
    + "SELECT * FROM latest WHERE cmplnt_num NOT IN (SELECT id FROM acks)"
)
def pending_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = versions(spark, sf_dir)
    waiting = materialise(pending_keys(stored, acks(spark, sf_dir)))
    return latest_of(stored, waiting, ["version"])


@query(
    with_sql(INCIDENTS_SQL, ACKS_SQL)
    + """SELECT 'open' AS gate, cmplnt_num FROM incidents
WHERE (SELECT count(*) FROM incidents) >= 900
UNION ALL SELECT 'by borough', cmplnt_num FROM incidents
WHERE boro_nm = 'ASIA' AND (SELECT count(*) FROM incidents WHERE boro_nm = 'ASIA') >= 2000"""
)
def release_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = incidents(spark, sf_dir)
    one_borough = rows.where(F.col("boro_nm") == "ASIA")
    return (
        metrics.release_gate(rows)
        .select(F.lit("open").alias("gate"), KEY)
        .unionByName(
            metrics.release_gate(one_borough, 2000).select(F.lit("by borough").alias("gate"), KEY)
        )
    )


@query(
    STORED
    + """
SELECT 'received' AS metric, count(*) AS n FROM records
UNION ALL SELECT 'keys', count(*) FROM uniq
UNION ALL SELECT 'existing', count(*) FROM stored
UNION ALL SELECT 'inserted', (SELECT count(*) FROM uniq) - (SELECT count(*) FROM stored)
UNION ALL SELECT 'pending', count(*) FROM uniq WHERE cmplnt_num NOT IN (SELECT id FROM acks)
UNION ALL SELECT 'sent', CASE WHEN count(*) >= 900 THEN count(*) ELSE 0 END
  FROM uniq WHERE cmplnt_num NOT IN (SELECT id FROM acks)"""
)
def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialise(valid_records(flat_messages(spark, sf_dir)))
    unique = keys.keep_last(rows, KEY, ARRIVAL)
    counts = metrics.batch_metrics(rows, stored_of(unique), KEY)
    waiting = metrics.release_metrics(keys.pending(unique, acks(spark, sf_dir)))
    return by_name(counts).unionAll(by_name(waiting))


def by_name(counts: DataFrame) -> DataFrame:
    """One row per column of a one-row frame."""
    named = [F.struct(F.lit(c).alias("metric"), F.col(c).alias("n")) for c in counts.columns]
    return counts.select(F.inline(F.array(*named)))


@query(
    with_sql(INCIDENTS_SQL)
    + """SELECT cmplnt_num, nullif(boro_nm, 'ASIA') AS boro_nm, cmplnt_fr_tm, latitude, pd_desc
FROM incidents"""
)
def publish_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written as JSON messages and read back; null fields return from the schema."""
    rows = incidents(spark, sf_dir).select(
        "cmplnt_num", F.nullif("boro_nm", F.lit("ASIA")).alias("boro_nm"), "cmplnt_fr_tm",
        "latitude", "pd_desc",
    )
    topic = Topic("file", scratch(spark, "published"))
    publish_rows(rows, topic)
    return spark.read.schema(rows.schema).json(topic.name)


# Published JSON carries moments to the millisecond.
@query(
    UNIQUE_ACKS
    + f"""SELECT {RECORD_COLUMNS} FROM (SELECT * REPLACE (date_trunc('millisecond', rpt_dt) AS rpt_dt) FROM uniq)
WHERE cmplnt_num NOT IN (SELECT id FROM acks)"""
)
def release_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending incidents of two tables published at once, read back from the topic."""
    stored = Table("parquet", scratch(spark, "incidents"))
    acked = Table("parquet", scratch(spark, "acks"))
    topic = Topic("file", scratch(spark, "train"))
    append(unique_messages(spark, sf_dir), stored)
    append(acks(spark, sf_dir), acked)
    release(spark, stored, acked, topic, min_rows=100)
    return wall_clock(spark.read.schema(schemas.INCIDENTS).json(topic.name).select(*RECORD))


@query(
    UNIQUE_ACKS
    + """
SELECT cmplnt_num AS id, 'sent' AS status FROM uniq WHERE cmplnt_num NOT IN (SELECT id FROM acks)"""
)
def acknowledge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.acknowledge(messages(spark, sf_dir), acks(spark, sf_dir))


def _served(
    spark: SparkSession, sf_dir: str, where: dict[str, str] | None = None
) -> tuple[DataFrame, T.StructType]:
    """Events kept as pages of 1000 JSON records, pulled page by page by many tasks."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    url = scratch(spark, "pages")
    page = F.floor(F.col("event_id") / schemas.PAGE_ROWS).alias("page")
    pages = events.select(page, F.to_json(F.struct(*events.columns)).alias("value"))
    pages.repartition("page").write.partitionBy("page").text(url)
    pulled = read_paged(spark, paged_folder(spark, url), "event_id", pages_per_task=3, where=where)
    return pulled, events.schema


@query("SELECT event_id, event_type, value FROM events")
def paged_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    pulled, schema = _served(spark, sf_dir)
    return pulled.select(F.from_json("value", schema).alias("e")).select("e.*")


@query("SELECT event_id, event_type, value FROM events WHERE event_type = 'click'")
def paged_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    pulled, schema = _served(spark, sf_dir, {"event_type": "click"})
    return pulled.select(F.from_json("value", schema).alias("e")).select("e.*")


@query("SELECT event_id, event_type, value FROM events")
def publish_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pulled record sent on as one message."""
    pulled, schema = _served(spark, sf_dir)
    topic = Topic("file", scratch(spark, "sent"))
    publish(pulled, topic)
    return spark.read.schema(schema).json(topic.name)


@query(with_sql(INCIDENTS_SQL) + "SELECT cmplnt_num, rpt_dt, latitude FROM incidents")
def read_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table created empty, filled, and found intact by a second creation."""
    stored = Table("parquet", scratch(spark, "incidents"))
    ensure_table(spark, stored, schemas.INCIDENTS)
    append(conform_schema(incidents(spark, sf_dir), schemas.INCIDENTS), stored)
    ensure_table(spark, stored, schemas.INCIDENTS)
    return wall_clock(read_table(spark, stored).select("cmplnt_num", "rpt_dt", "latitude"))


@query(
    """SELECT r_name, count(*) AS n, max(ts) AS last_ts FROM events
JOIN region ON r_regionkey = user_id % 5 GROUP BY r_name"""
)
def read_query_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_query(
        query_session(spark, given_tables(sf_dir)),
        "SELECT r_name, count(*) AS n, max(ts) AS last_ts FROM events "
        "JOIN region ON r_regionkey = user_id % 5 GROUP BY r_name",
    )


def given_tables(sf_dir: str) -> dict[str, Table]:
    return {name: Table("parquet", f"{sf_dir}/{name}.parquet") for name in ("events", "region")}


REQUESTS_SQL = """
SELECT r_name AS boro, event_type AS kind, count(*) AS n, false AS failed
FROM events JOIN region ON r_regionkey = user_id % 5 GROUP BY r_name, event_type
UNION ALL SELECT NULL, NULL, NULL, true FROM region, range(0, 8)"""


def requests_of(region: DataFrame) -> DataFrame:
    """Per region one good request and eight that must fail, each in another way."""
    good = F.format_string(
        "SELECT r_name AS boro, event_type AS kind, count(*) AS n FROM events "
        "JOIN region ON r_regionkey = user_id %% 5 WHERE r_name = '%s' GROUP BY 1, 2",
        "r_name",
    )
    spark = region.sparkSession
    spark.range(1).createOrReplaceGlobalTempView("kept_apart")
    bad = [
        "DROP TABLE events",
        "SELECT no_such_column FROM events",
        "SELECT 1 / (user_id - user_id) AS x FROM events",
        f"SELECT count(*) AS n FROM parquet.`{region.inputFiles()[0]}`",
        "SELECT count(*) AS n FROM global_temp.kept_apart",
        "SELECT java_method('java.lang.System', 'setProperty', 'blotter.probe', 'x') AS x FROM region",
        "SELECT (SELECT r_name FROM region) AS x",
        "SELECT 1 AS x; SELECT 2 AS x",
    ]
    return region.select(F.explode(F.array(good, *map(F.lit, bad))).alias("sql_query"))


def answers(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.schema("boro string, kind string, n bigint, error string").json(folder)
    return rows.select("boro", "kind", "n", F.col("error").isNotNull().alias("failed"))


@query(REQUESTS_SQL)
def sql_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = Topic("file", scratch(spark, "answers"))
    serve_requests(requests_of(table(spark, sf_dir, "region")), given_tables(sf_dir), topic)
    return answers(spark, topic.name)


# More rows than anyone waits for, on one core.
ENDLESS = "SELECT sum(id % 7) AS n FROM range(0, 1000000000000000, 1, 1)"


@query(REQUESTS_SQL + " UNION ALL SELECT NULL, NULL, NULL, true")
def sql_requests_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same requests four at a time, with one among them that never ends and is given up."""
    topic = Topic("file", scratch(spark, "answers"))
    asked = requests_of(table(spark, sf_dir, "region"))
    endless = spark.createDataFrame([(ENDLESS,)], asked.schema)
    serve_pool(endless.unionByName(asked), given_tables(sf_dir), topic, seconds=30.0)
    return answers(spark, topic.name)
