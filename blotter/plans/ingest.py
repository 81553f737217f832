"""Messages to table: flatten, keep the last per key, add what is not stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from blotter import schemas
from blotter.functions.conform import project
from blotter.functions.messages import ARRIVAL, clock_of, decode_value, flatten, rejects, valid_records
from blotter.operators.joins import BROADCAST_BYTES
from blotter.operators.keys import insert_if_absent, keep_last, to_ack
from blotter.plans.ledger import Ledger, record
from blotter.session import materialise
from blotter.sources.tables import Table, append, ensure_table, read_table


def unique_records(flat: DataFrame, schema: T.StructType, key: str) -> DataFrame:
    """The last usable record per key, in the declared columns."""
    return project(keep_last(valid_records(flat), key, clock_of(flat)), schema.names)


def ingest(
    messages: DataFrame,
    schema: T.StructType,
    key: str,
    target: DataFrame,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows that messages (part, off, value) add to ``target``."""
    flat = flatten(decode_value(messages), schema, key)
    return insert_if_absent(materialise(unique_records(flat, schema, key)), target, key, limit)


def acknowledge(messages: DataFrame, acks: DataFrame) -> DataFrame:
    """Acknowledgement rows that published incidents add to ``acks``."""
    key_only = T.StructType([schemas.INCIDENTS[schemas.INCIDENT_KEY]])
    flat = flatten(decode_value(messages), key_only, schemas.INCIDENT_KEY)
    ids = materialise(valid_records(flat).select(schemas.INCIDENT_KEY).distinct())
    return insert_if_absent(to_ack(ids), acks, schemas.ACK_KEY)


def ingest_into(
    messages: DataFrame,
    schema: T.StructType,
    key: str,
    target: Table,
    reject_table: Table | None = None,
    ledger: Ledger | None = None,
    batch: str = "",
) -> dict[str, int]:
    """Ingest one batch into its table; usable records received, their keys, how many of
    these were stored already and how many rows were inserted.

    With a ``ledger`` the new keys are noted there, under the name of the ``batch``. The batch is parsed once, whether or not its rejects are kept. A batch that comes again
    adds neither rows nor rejects.
    """
    spark = messages.sparkSession
    ensure_table(spark, target, schema)
    flat = flatten(decode_value(messages), schema, key)
    if reject_table is not None:
        flat = materialise(flat)
        refused = rejects(flat)
        ensure_table(spark, reject_table, refused.schema)
        known = read_table(spark, reject_table).select(*ARRIVAL)
        append(refused.join(known, ARRIVAL, "left_anti").select(refused.columns), reject_table)
    came = Observation()
    usable = valid_records(flat).observe(came, F.count(F.lit(1)).alias("received"))
    records = materialise(project(keep_last(usable, key, clock_of(flat)), schema.names))
    fresh = insert_if_absent(records, read_table(spark, target), key)
    if ledger is not None:
        fresh = materialise(fresh)
        record(ledger, fresh.select(key), "stored", batch)
    seen = Observation()
    append(fresh.observe(seen, F.count(F.lit(1)).alias("inserted")), target)
    keys, inserted = records.count(), seen.get["inserted"]
    return {**came.get, "keys": keys, "existing": keys - inserted, "inserted": inserted}


def acknowledge_into(
    messages: DataFrame, acks: Table, ledger: Ledger | None = None, batch: str = ""
) -> None:
    """Record the ids seen on the output topic as sent, and note them in the ``ledger``."""
    spark = messages.sparkSession
    ensure_table(spark, acks, schemas.ACKS)
    fresh = acknowledge(messages, read_table(spark, acks))
    if ledger is not None:
        fresh = materialise(fresh)
        record(ledger, fresh.select(schemas.ACK_KEY), "acked", batch)
    append(fresh, acks)
