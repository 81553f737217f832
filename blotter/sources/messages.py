"""Message and line sources, and the sinks messages go to."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from blotter.functions.messages import to_json_value

# Offline shape of a message: where it arrived and its body.
MESSAGE = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("off", T.LongType()),
        T.StructField("value", T.BinaryType()),
    ]
)

# The same with the time it was sent, as Kafka's messages have it.
TIMED = T.StructType([*MESSAGE.fields, T.StructField("sent", T.TimestampType())])


@dataclass(frozen=True)
class Topic:
    """A message channel: a Kafka topic, or a folder that stands in for one."""

    kind: str  # kafka or file
    name: str  # topic or folder
    options: dict[str, str] = field(default_factory=dict)


def kafka_options(topic: Topic, starting: str = "latest", fail_on_data_loss: bool = False) -> dict:
    """Read options of a Kafka topic."""
    return {
        **topic.options,
        "subscribe": topic.name,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }


def message_source(
    spark: SparkSession, topic: Topic, starting: str = "latest", fail_on_data_loss: bool = False,
    timed: bool = False,
) -> DataFrame:
    """Stream of messages (part, off, value); those of Kafka carry the time they were sent,
    and those of a folder if it is ``timed``."""
    if topic.kind == "kafka":
        stream = spark.readStream.format("kafka").options(
            **kafka_options(topic, starting, fail_on_data_loss)
        )
        return stream.load().select(
            F.col("partition").alias("part"), F.col("offset").alias("off"), "value",
            F.col("timestamp").alias("sent"),
        )
    return spark.readStream.schema(TIMED if timed else MESSAGE).options(**topic.options).parquet(topic.name)


def line_source(spark: SparkSession, kind: str = "text", **options: str) -> DataFrame:
    """Stream of text lines in ``value``: a folder of text files, or a socket."""
    return spark.readStream.format(kind).options(**options).load().select("value")


def publish(values: DataFrame, topic: Topic) -> None:
    """Write each ``value`` as one message."""
    values = values.select("value")
    if topic.kind == "kafka":
        values.write.format("kafka").options(**topic.options, topic=topic.name).save()
    else:
        values.write.mode("append").text(topic.name)


def published_source(spark: SparkSession, topic: Topic) -> DataFrame:
    """Stream over what ``publish`` wrote, in the shape of ``message_source``.

    A text folder has no offsets, so all its messages share one place.
    """
    if topic.kind == "kafka":
        return message_source(spark, topic)
    lines = spark.readStream.format("text").options(**topic.options).load(topic.name)
    return lines.select(
        F.lit(0).alias("part"),
        F.lit(0).cast("bigint").alias("off"),
        F.col("value").cast("binary").alias("value"),
    )


def publish_rows(df: DataFrame, topic: Topic) -> None:
    """Write each row as one JSON message."""
    publish(to_json_value(df), topic)


def console_sink(df: DataFrame, rows: int = 20) -> StreamingQuery:
    """Print each micro-batch."""
    return df.writeStream.format("console").option("numRows", rows).outputMode("append").start()
