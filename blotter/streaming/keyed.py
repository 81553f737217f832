"""Ingest that remembers its keys in the stream's state instead of asking the table."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from blotter.functions.conform import typed
from blotter.functions.messages import SENT, decode_value, flatten, valid_records
from blotter.sources.tables import Table

#: Keeps the keys on disk, a look-up for each key of a batch, and writes changes only.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
_CLOCK = ["_sent", "part", "off", "pos"]


def _first_seen(rows: DataFrame) -> DataFrame:
    """The last record of each key in the batch that knows it first; nothing in later ones.

    Rows without a record are keys that are stored elsewhere. The state of a key is the time
    of the first and last batch it came in, as Spark logs it for a batch and gives it again
    when the batch is repeated, and its last record: while both times are the same, all of
    it is of one batch. Tasks reduce a key with very many records before it is shuffled.
    """
    # Messages that carry no time come before those that do: nulls are least.
    last = F.max(F.struct(*_CLOCK, "record"))
    timed = rows.withColumn("_batch", F.current_timestamp())
    seen = timed.groupBy("_key").agg(
        F.min("_batch").alias("_first"), F.max("_batch").alias("_last"),
        F.max(F.col("record").isNull()).alias("_elsewhere"), last.alias("_record"),
    )
    fresh = (F.col("_first") == F.col("_last")) & ~F.col("_elsewhere")
    return seen.where(fresh).select("_key", F.col("_record.record").alias("record"))


def _texts(schema: T.StructType):
    return F.to_json(F.struct(*(F.col(f.name).cast("string").alias(f.name) for f in schema.fields)))


def keyed_rows(stream: DataFrame, schema: T.StructType, key: str) -> DataFrame:
    """Usable records of a message stream with their key, clock and fields as text."""
    flat = valid_records(flatten(decode_value(stream), schema, key))
    sent = F.col(SENT) if SENT in flat.columns else F.lit(None).cast("timestamp")
    return flat.select(
        F.col(key).cast("string").alias("_key"), sent.alias("_sent"), "part", "off", "pos", _texts(schema).alias("record")
    )


def stored_rows(spark: SparkSession, table: Table, schema: T.StructType, key: str) -> DataFrame:
    """The keys of a Parquet table as a stream: known from the start, without records."""
    none = {"_sent": "timestamp", "part": "int", "off": "long", "pos": "int", "record": "string"}
    keys = spark.readStream.schema(T.StructType([schema[key]])).parquet(table.name)
    return keys.select(
        F.col(key).cast("string").alias("_key"), *(F.lit(None).cast(kind).alias(c) for c, kind in none.items())
    )


def keyed_ingest_stream(
    stream: DataFrame,
    schema: T.StructType,
    key: str,
    target: Table,
    checkpoint: str,
    trigger: dict | None = None,
    stored: Table | None = None,
) -> StreamingQuery:
    """Messages (part, off, value[, sent]) into loads below ``target``, each key once.

    The last record of a key in the batch that brings the key first is kept, by the time
    its message was sent and then by place; later batches cannot replace it, however they
    are ordered. Keys of the table ``stored`` are known from the start: they are read once,
    as part of the stream.

    Neither table is read for a batch. What is known lies in the stream's state, which
    looks up the keys of the batch alone, so a batch costs the same however much is stored.
    Each batch writes a folder of its own and replaces it when it comes again. A lost checkpoint means a new target, with the old one as ``stored``.
    """
    rows = keyed_rows(stream, schema, key)
    if stored is not None:
        rows = rows.unionByName(stored_rows(stream.sparkSession, stored, schema, key))
    fresh = _first_seen(rows)
    texts = T.StructType([T.StructField(name, T.StringType()) for name in schema.names])

    def write(batch: DataFrame, number: int) -> None:
        fields = F.from_json("record", texts)
        batch.select(fields.alias("_r")).select(
            *(typed(F.col("_r")[f.name], f.dataType).alias(f.name) for f in schema.fields)
        ).write.mode("overwrite").parquet(f"{target.name}/load={number}")

    writer = fresh.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
    with _settings(stream.sparkSession, STATE_STORE):  # a stream keeps those of its start
        return (writer.trigger(**trigger) if trigger else writer).start()


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def loads(spark: SparkSession, target: Table, schema: T.StructType) -> DataFrame:
    """What a keyed ingest has stored."""
    return spark.read.schema(schema).parquet(f"{target.name}/load=*")
