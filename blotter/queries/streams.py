"""Streaming queries: each runs to the end of its input and returns what was stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from blotter import schemas
from blotter.bindings import (
    ACKS_SQL, INCIDENTS_SQL, RECORD, RECORD_COLUMNS, RECORDS_SQL, UNIQUE_SQL, acks, event_rows,
    incidents as incident_rows, message_stream, messages, messages_of, table, timed_messages, with_sql,
)
from blotter.functions.messages import ARRIVAL, CLOCK, decode_value, flatten, valid_records
from blotter.operators.keys import keep_last
from blotter.plans.ledger import Ledger, fold
from blotter.plans.release import release_waiting
from blotter.queries.ingestion import REQUESTS_SQL, UNIQUE, answers, given_tables, requests_of
from blotter.queries.registry import query
from blotter.queries.rows import wall_clock
from blotter.session import scratch
from blotter.sources.messages import TIMED, Topic, line_source, message_source, publish, publish_rows, published_source
from blotter.sources.paged import paged_folder, stream_paged
from blotter.sources.tables import Table, append, read_table
from blotter.streaming import jobs
from blotter.streaming.batches import ONCE, run_all
from blotter.streaming.keyed import keyed_ingest_stream, loads

LIMIT = 600  # seconds a query may stream


def _stored(spark: SparkSession, target: Table) -> DataFrame:
    return wall_clock(read_table(spark, target).select(*RECORD))


def _parquet(spark: SparkSession, label: str) -> Table:
    return Table("parquet", scratch(spark, label))


@query(UNIQUE + f"SELECT {RECORD_COLUMNS} FROM uniq")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages streamed from the events file into an incident table."""
    target = _parquet(spark, "incidents")
    running = jobs.ingest_stream(
        message_stream(spark, sf_dir), schemas.INCIDENTS, schemas.INCIDENT_KEY, target,
        scratch(spark, "state"), ONCE,
    )
    run_all([running], LIMIT)
    return _stored(spark, target)


@query(
    UNIQUE
    + f"""SELECT {RECORD_COLUMNS} FROM uniq
UNION ALL SELECT {RECORD_COLUMNS.replace('cmplnt_num', "'R' || cmplnt_num", 1)} FROM uniq WHERE boro_nm = 'ASIA' AND cmplnt_num LIKE 'A%'"""
)
def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages, then all of them again mixed with new ones, after a restart.

    The second run finds every old key stored and adds the new keys only.
    """
    target, state = _parquet(spark, "incidents"), scratch(spark, "state")
    topic = Topic("file", scratch(spark, "messages"))

    def run() -> None:
        running = jobs.ingest_stream(
            message_source(spark, topic), schemas.INCIDENTS, schemas.INCIDENT_KEY, target, state, ONCE
        )
        run_all([running], LIMIT)

    first = messages(spark, sf_dir)
    first.write.parquet(topic.name)
    run()
    text = F.col("value").cast("string")
    renamed = F.regexp_replace(text, '"cmplnt_num":"A', '"cmplnt_num":"RA')
    fresh = first.where(text.contains('"cmplnt_num":"A') & text.contains('"boro_nm":"ASIA"'))
    again = first.unionByName(fresh.withColumn("value", renamed.cast("binary")))
    again.write.mode("append").parquet(topic.name)
    run()
    return _stored(spark, target)


@query(
    UNIQUE
    + """SELECT (SELECT count(*) FROM records) AS received, count(*) AS keys, cast(0 AS bigint) AS existing,
count(*) AS inserted, count(*) AS pending, CASE WHEN count(*) >= 100 THEN count(*) ELSE 0 END AS sent FROM uniq"""
)
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the running incident stream reports of its batches."""
    reported = _parquet(spark, "metrics")
    running = jobs.incident_stream(
        message_stream(spark, sf_dir), _parquet(spark, "incidents"), _parquet(spark, "acks"),
        Topic("file", scratch(spark, "train")), scratch(spark, "state"), ONCE, 100, reported,
    )
    run_all([running], LIMIT)
    total = [F.sum(c).alias(c) for c in ("received", "keys", "existing", "inserted")]
    return read_table(spark, reported).agg(*total, F.max("pending").alias("pending"), F.max("sent").alias("sent"))


@query(UNIQUE + "SELECT cmplnt_num AS id, 'sent' AS status FROM uniq")
def stream_ack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents ingested and released by one stream, acknowledged by a second."""
    incidents, acks = _parquet(spark, "incidents"), _parquet(spark, "acks")
    topic = Topic("file", scratch(spark, "train"))
    releasing = jobs.incident_stream(
        message_stream(spark, sf_dir), incidents, acks, topic, scratch(spark, "state"), ONCE,
        min_rows=100,
    )
    run_all([releasing], LIMIT)
    acknowledging = jobs.ack_stream(
        published_source(spark, topic), acks, scratch(spark, "state"), ONCE
    )
    run_all([acknowledging], LIMIT)
    return read_table(spark, acks)


# The batch that brings a key first, and in it the record sent last.
FIRST_SQL = """first AS (
  SELECT * FROM records QUALIFY row_number() OVER (
    PARTITION BY cmplnt_num ORDER BY off // 8 % 3, rpt_dt DESC, part DESC, off DESC, pos DESC) = 1
)"""


@query(
    with_sql(INCIDENTS_SQL, RECORDS_SQL, FIRST_SQL)
    + f"""SELECT CASE WHEN cmplnt_num LIKE '%4' THEN 'stored' ELSE 'batch' END AS origin, {RECORD_COLUMNS} FROM first"""
)
def insert_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that holds some of the keys, and three batches that add the others, with a
    restart after each; only the stream's state tells which keys are known."""
    stored, target = _parquet(spark, "stored"), _parquet(spark, "incidents")
    topic, state = Topic("file", scratch(spark, "messages")), scratch(spark, "state")
    batch = F.floor(F.col("off") / 8) % 3
    sent = timed_messages(spark, sf_dir)
    records = valid_records(flatten(decode_value(sent), schemas.INCIDENTS, schemas.INCIDENT_KEY))
    before = records.where(F.col("cmplnt_num").endswith("4"))
    append(keep_last(before.withColumn("_turn", -batch), "cmplnt_num", ["_turn", *CLOCK]).select(schemas.INCIDENTS.names), stored)
    for number in range(3):
        sent.where(batch == number).select(TIMED.names).write.mode("append").parquet(topic.name)
        running = keyed_ingest_stream(
            message_source(spark, topic, timed=True), schemas.INCIDENTS, schemas.INCIDENT_KEY, target, state, ONCE, stored
        )
        run_all([running], LIMIT)
    added = loads(spark, target, schemas.INCIDENTS).select(F.lit("batch").alias("origin"), *RECORD)
    return wall_clock(
        read_table(spark, stored).select(F.lit("stored").alias("origin"), *RECORD).unionByName(added)
    )


@query(
    with_sql(INCIDENTS_SQL, RECORDS_SQL)
    + f"""SELECT part, off, pos, {RECORD_COLUMNS} FROM records
QUALIFY row_number() OVER (PARTITION BY cmplnt_num ORDER BY rpt_dt DESC, part DESC, off DESC, pos DESC) = 1"""
)
def keep_last_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last record of each key by the time it was sent, from partitions out of step."""
    flat = flatten(decode_value(timed_messages(spark, sf_dir)), schemas.INCIDENTS, schemas.INCIDENT_KEY)
    last = keep_last(valid_records(flat), schemas.INCIDENT_KEY, CLOCK)
    return wall_clock(last.select(*ARRIVAL, *RECORD))


def _dealt(off: str) -> Column:
    """Which of three batches a message is in, 0 to 2. All messages of a key that comes again
    are in one, as the last of a batch counts."""
    return F.coalesce(F.when(F.col(off) % 8 == 6, 0).otherwise(F.pmod(F.col(off), F.lit(3))), F.lit(0))


@query(
    with_sql(INCIDENTS_SQL, RECORDS_SQL, UNIQUE_SQL, ACKS_SQL)
    + f""", sent AS (SELECT * REPLACE (date_trunc('millisecond', rpt_dt) AS rpt_dt) FROM uniq WHERE cmplnt_num NOT IN (SELECT id FROM acks))
SELECT {RECORD_COLUMNS}, (SELECT count(*) FROM uniq) AS held_back, (SELECT count(*) FROM sent) AS waiting FROM sent"""
)
def release_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches stored behind a closed gate, with a restart after each, some of them
    acknowledged, the rest released: what was sent, how many rows the closed gate held back
    and how many waited at the end.

    Gates and counts come from the ledger, folded between batches.
    """
    incidents, acked = _parquet(spark, "incidents"), _parquet(spark, "acks")
    topic, sent = Topic("file", scratch(spark, "train")), Topic("file", scratch(spark, "sent"))
    ledger, reported = Ledger(scratch(spark, "ledger")), _parquet(spark, "metrics")
    came, state = Topic("file", scratch(spark, "messages")), scratch(spark, "state")
    # Written and parsed by many tasks, however few the events are read by.
    spread = messages_of(incident_rows(spark, sf_dir).repartition("event_id"))
    for number in range(3):
        spread.where(_dealt("off") == number).write.mode("append").parquet(came.name)
        storing = jobs.incident_stream(
            message_source(spark, came), incidents, acked, topic, state, ONCE, 1 << 40, reported, ledger
        )
        run_all([storing], LIMIT)
    publish_rows(acks(spark, sf_dir).select(F.col("id").alias(schemas.INCIDENT_KEY)), sent)
    fold(spark, ledger, 1)
    returned = published_source(spark, sent)
    run_all([jobs.ack_stream(returned, acked, scratch(spark, "state"), ONCE, ledger)], LIMIT)
    done = release_waiting(spark, incidents, ledger, topic, 1)
    held_back = read_table(spark, reported).agg(F.max("pending")).first()[0]
    return wall_clock(
        spark.read.schema(schemas.INCIDENTS).json(topic.name).select(*RECORD)
    ).withColumns({"held_back": F.lit(held_back).cast("long"), "waiting": F.lit(done["sent"]).cast("long")})


@query(
    UNIQUE
    + """SELECT 'incidents' AS stored, count(*) AS n FROM uniq
UNION ALL SELECT 'tokens', count(DISTINCT token) FROM (SELECT unnest(string_split(event_type, ' ')) AS token FROM events)"""
)
def stream_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams at once under one supervisor."""
    target, counts = _parquet(spark, "incidents"), _parquet(spark, "tokens")
    lines = event_rows(spark, sf_dir).select(F.col("event_type").alias("value"))
    ingesting = jobs.ingest_stream(
        message_stream(spark, sf_dir), schemas.INCIDENTS, schemas.INCIDENT_KEY, target,
        scratch(spark, "state"), ONCE,
    )
    counting = jobs.token_stream(lines, counts, scratch(spark, "state"), ONCE)
    run_all([ingesting, counting], LIMIT)
    rows = read_table(spark, target).select(F.lit("incidents").alias("stored"))
    tokens = read_table(spark, counts).select(F.lit("tokens").alias("stored"))
    return rows.unionAll(tokens).groupBy("stored").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT token, count(*) AS n FROM (
  SELECT unnest(string_split(line, ' ')) AS token FROM (
    SELECT unnest(string_split(text, chr(10))) AS line FROM conversations))
GROUP BY token"""
)
def token_counts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts per micro-batch of text lines, summed over the batches."""
    folder, counts = scratch(spark, "lines"), _parquet(spark, "tokens")
    table(spark, sf_dir, "conversations").select(
        F.explode(F.split("text", "\n")).alias("value")
    ).repartition(3).write.text(folder)
    lines = line_source(spark, "text", path=folder, maxFilesPerTrigger="1", lineSep="\n")
    run_all([jobs.token_stream(lines, counts, scratch(spark, "state"), ONCE)], LIMIT)
    per_batch = read_table(spark, counts)
    return per_batch.groupBy("token").agg(F.sum("n").alias("n"))


@query(REQUESTS_SQL)
def stream_sql_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL requests arriving as messages, answered with JSON rows."""
    asked, answered = Topic("file", scratch(spark, "asked")), Topic("file", scratch(spark, "answers"))
    publish(requests_of(table(spark, sf_dir, "region")).select(F.col("sql_query").alias("value")), asked)
    running = jobs.request_stream(
        published_source(spark, asked), given_tables(sf_dir), answered, scratch(spark, "state"), ONCE
    )
    run_all([running], LIMIT)
    return answers(spark, answered.name)


@query("SELECT event_id, event_type, value FROM events")
def page_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A paged dataset sent on while it grows, within its last page and beyond, with a restart
    in between."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    url, state, topic = scratch(spark, "pages"), scratch(spark, "state"), Topic("file", scratch(spark, "sent"))
    page = F.floor(F.col("event_id") / schemas.PAGE_ROWS).alias("page")
    pages = events.select("event_id", page, F.to_json(F.struct(*events.columns)).alias("value"))
    # An early and a late part: the page that both have records in grows.
    cut = events.agg(F.max("event_id")).first()[0] * 5 // 8
    for part in (pages.where(F.col("event_id") <= cut), pages.where(F.col("event_id") > cut)):
        part.select("page", "value").repartition("page").write.mode("append").partitionBy("page").text(url)
        stream = stream_paged(spark, paged_folder(spark, url), "event_id", pages_per_task=3)
        run_all([jobs.publish_stream(stream, topic, state, ONCE)], LIMIT)
    return spark.read.schema(events.schema).json(topic.name)
