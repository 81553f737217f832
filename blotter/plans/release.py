"""Pending incidents to the output topic, all or nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from blotter import schemas
from blotter.operators.joins import BROADCAST_BYTES, payload_bytes
from blotter.operators.keys import latest_per_key, pending
from blotter.plans.ledger import Ledger, fold, waiting
from blotter.session import materialise
from blotter.sources.messages import Topic, publish_rows
from blotter.sources.tables import Table, ensure_table, read_table


def pending_keys(incidents: DataFrame, acks: DataFrame) -> DataFrame:
    """Keys of the incidents that are not acknowledged; reads the key columns only."""
    return pending(incidents.select(schemas.INCIDENT_KEY).distinct(), acks)


def latest_of(
    incidents: DataFrame, keys: DataFrame, tiebreak: list[str] = (), limit: int = BROADCAST_BYTES
) -> DataFrame:
    """The latest version of each incident among the distinct ``keys``.

    Few keys are sent to the incidents, of which all others drop out where they are
    scanned. With many keys the versions are reduced first, which drops most rows of a
    much-repeated key before the shuffle; the join then reuses the partitioning.
    """
    key = schemas.INCIDENT_KEY
    if payload_bytes(keys) <= limit:
        wanted = incidents.join(F.broadcast(keys), key, "left_semi")
        return latest_per_key(wanted, key, "rpt_dt", tiebreak).select(incidents.columns)
    latest = latest_per_key(incidents, key, "rpt_dt", tiebreak)
    return latest.join(keys, key, "left_semi").select(incidents.columns)


def release_counted(
    spark: SparkSession,
    incidents: Table,
    acks: Table,
    topic: Topic,
    min_rows: int = schemas.RELEASE_ROWS,
) -> dict[str, int]:
    """Publish every pending incident once at least ``min_rows`` wait; rows pending and sent.

    The gate looks at keys only, so a closed gate never reads whole incidents. Gate and
    publication see the same files. Until the acknowledgements arrive the same rows go
    out again, which the receivers tolerate.
    """
    ensure_table(spark, incidents, schemas.INCIDENTS)
    ensure_table(spark, acks, schemas.ACKS)
    stored = read_table(spark, incidents)
    keys = materialise(pending_keys(stored, read_table(spark, acks)))
    rows = keys.count()
    if rows < min_rows:
        return {"pending": rows, "sent": 0}
    publish_rows(latest_of(stored, keys), topic)
    return {"pending": rows, "sent": rows}


def release_waiting(
    spark: SparkSession,
    incidents: Table,
    ledger: Ledger,
    topic: Topic,
    min_rows: int = schemas.RELEASE_ROWS,
) -> dict[str, int]:
    """``release_counted`` by a ledger: what waits is read from there, once.

    A closed gate reads neither incidents nor acknowledgements. The ledger is folded on
    the way, so one process releases.
    """
    fold(spark, ledger)
    keys = materialise(waiting(spark, ledger))
    rows = keys.count()
    if rows < min_rows:
        return {"pending": rows, "sent": 0}
    publish_rows(latest_of(read_table(spark, incidents), keys), topic)
    return {"pending": rows, "sent": rows}


def release(
    spark: SparkSession,
    incidents: Table,
    acks: Table,
    topic: Topic,
    min_rows: int = schemas.RELEASE_ROWS,
) -> int:
    """``release_counted``; rows sent."""
    return release_counted(spark, incidents, acks, topic, min_rows)["sent"]
