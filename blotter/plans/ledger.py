"""What waits for release, kept up to date by those who store and acknowledge.

A ledger is a folder of changes: each batch that stores incidents or acknowledgements adds
their keys in a folder of its own. From time to time the changes are folded into a base
that holds only keys still open. What waits is read from base and changes alone, so its
cost follows the open keys and the latest batches, not the tables.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from blotter import schemas
from blotter.sources.tables import Table, folders, mark_whole, read_table, remove

#: Changes that are folded into a new base once so many have gathered.
FOLD = 32
_ROW = "key string, stored boolean, acked boolean"


@dataclass(frozen=True)
class Ledger:
    """``path`` is a folder that all executors see; one process folds it."""

    path: str

    def changes(self, spark: SparkSession) -> list[str]:
        return folders(spark, f"{self.path}/changes")

    def base(self, spark: SparkSession) -> str | None:
        """The newest base that was written to its end."""
        return max(folders(spark, f"{self.path}/base"), default=None)


def record(ledger: Ledger, keys: DataFrame, change: str, name: str) -> None:
    """Note that the ``keys`` (one column) are being ``stored`` or ``acked``.

    Every call adds a change of its own, with ``name`` in its name; a key may be noted more
    than once and in any order. Note keys before they are stored: a batch that is lost in
    between finds them missing from the table and notes them again, and one that comes
    again later finds them there, and what it noted at first stays.
    """
    key = F.col(keys.columns[0]).cast("string").alias("key")
    noted = keys.select(key, *(F.lit(change == c).alias(c) for c in ("stored", "acked")))
    noted.write.parquet(f"{ledger.path}/changes/{change}-{name}-{uuid.uuid4().hex}")


def _covered(spark: SparkSession, base: str | None) -> set[str]:
    if base is None:
        return set()
    return {row.change for row in spark.read.schema("change string").parquet(f"{base}/covers").collect()}


def _open(spark: SparkSession, ledger: Ledger) -> tuple[DataFrame, list[str], list[str]]:
    """Open keys with what happened to them, and the changes outside and inside the base."""
    base = ledger.base(spark)
    covered = _covered(spark, base)
    changes = ledger.changes(spark)
    fresh = [c for c in changes if c.rpartition("/")[2] not in covered]
    paths = [*([f"{base}/keys"] if base else []), *fresh]
    if not paths:
        return spark.createDataFrame([], _ROW), [], []
    seen = spark.read.schema(_ROW).parquet(*paths)
    # A key in very many changes weighs one row a task.
    state = seen.groupBy("key").agg(F.max("stored").alias("stored"), F.max("acked").alias("acked"))
    return state.where(~(F.col("stored") & F.col("acked"))), fresh, [c for c in changes if c not in fresh]


def waiting(spark: SparkSession, ledger: Ledger) -> DataFrame:
    """Keys that are stored and not acknowledged, as one column named like the incidents' key.

    Keys acknowledged before they are stored never wait. Neither table is read.
    """
    open_, _, _ = _open(spark, ledger)
    return open_.where("stored").select(F.col("key").alias(schemas.INCIDENT_KEY))


def fold(spark: SparkSession, ledger: Ledger, least: int = FOLD) -> bool:
    """Fold the changes into a new base if at least ``least`` are outside it.

    Keys both stored and acknowledged drop out; keys acknowledged only are kept until they
    are stored. The list of changes inside is written first and the keys last, and a base
    without its keys is not read, so a lost run changes nothing. The changes inside the
    base before are removed, as no reader needs them any more; readers of that base fail
    at worst and read again.
    """
    open_, fresh, inside = _open(spark, ledger)
    if len(fresh) < max(1, least):
        return False
    before = ledger.base(spark)
    number = int(before.rpartition("-")[2]) + 1 if before else 0
    path = f"{ledger.path}/base/base-{number:09d}"
    covers = [(c.rpartition("/")[2],) for c in [*fresh, *inside]]
    spark.createDataFrame(covers, "change string").coalesce(1).write.mode("overwrite").parquet(f"{path}/covers")
    open_.write.mode("overwrite").parquet(f"{path}/keys")
    mark_whole(spark, path)
    for change in inside:
        remove(spark, change)
    return True


def found_ledger(spark: SparkSession, ledger: Ledger, incidents: Table, acks: Table) -> None:
    """Start a ledger from two tables that exist already; reads the keys of both once."""
    stored = read_table(spark, incidents).select(schemas.INCIDENT_KEY)
    acked = read_table(spark, acks).select(schemas.ACK_KEY)
    record(ledger, stored.distinct(), "stored", "founding")
    record(ledger, acked.distinct(), "acked", "founding")
    fold(spark, ledger, 1)
