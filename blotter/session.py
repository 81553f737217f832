"""Session set-up, the shared scratch folder and reliable materialisation."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SPLIT_BYTES = 128 * 1024 * 1024
#: Beyond a few ten thousand partitions a shuffle costs the driver more than it saves.
SHUFFLE_BYTES = 512 * 1024 * 1024
MOST_PARTITIONS = 20_000
_tables: ContextVar[list[str] | None] = ContextVar("tables", default=None)


def build_session(
    app: str = "blotter",
    master: str | None = None,
    input_bytes: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session for these jobs; the master comes from spark-submit unless given.

    ``input_bytes`` sizes the shuffle so that one partition stays near 512 MB before
    adaptive execution merges small ones and splits skewed ones; their number is bounded.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.files.maxPartitionBytes", str(SPLIT_BYTES))
    )
    if master:
        builder = builder.master(master)
    if input_bytes:
        builder = builder.config(
            "spark.sql.shuffle.partitions", str(min(MOST_PARTITIONS, max(200, -(-input_bytes // SHUFFLE_BYTES))))
        )
    for name, value in (conf or {}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` of the session.

    A temporary folder stands in only for a local master, as in tests.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not path:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the executors")
        path = tempfile.mkdtemp(prefix="blotter-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(path)
    return path


def scratch(spark: SparkSession, label: str) -> str:
    """A path of its own below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute once into a table in the shared folder and read that.

    This cuts the lineage and survives the loss of executors; later steps read only the
    columns they need, and the planner knows the size.
    """
    path = scratch(df.sparkSession, "table")
    if (tables := _tables.get()) is not None:
        tables.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Drop the tables that ``materialise`` writes inside the block when it ends.

    Outside such a block they stay until the shared folder is cleared.
    """
    token = _tables.set([])
    try:
        yield
    finally:
        context = spark.sparkContext
        for path in _tables.get():
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
        _tables.reset(token)
