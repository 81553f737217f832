"""Tables by reference: Parquet folder, catalog table or database table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, types as T

from blotter.sources.guard import VIEWS, check_query


@dataclass(frozen=True)
class Table:
    """Where a table lives. ``options`` are the connection options of a database table."""

    kind: str  # parquet, catalog or jdbc
    name: str  # folder, catalog name or database table
    options: dict[str, str] = field(default_factory=dict)


def exists(spark: SparkSession, table: Table) -> bool:
    if table.kind == "catalog":
        return spark.catalog.tableExists(table.name)
    place, system = _place(spark, table.name)
    if not system.exists(place):
        return False
    names = [status.getPath().getName() for status in system.listStatus(place)]
    return any(not name.startswith(("_", ".")) for name in names)


def _place(spark: SparkSession, path: str):
    """A path and its file system."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(context._jsc.hadoopConfiguration())


def folders(spark: SparkSession, path: str) -> list[str]:
    """Folders in a folder that were written to their end, by name."""
    place, system = _place(spark, path)
    if not system.exists(place):
        return []
    names = sorted(s.getPath().getName() for s in system.listStatus(place) if s.isDirectory())
    whole = lambda name: system.exists(_place(spark, f"{path}/{name}/_SUCCESS")[0])
    return [f"{path}/{name}" for name in names if whole(name)]


def mark_whole(spark: SparkSession, path: str) -> None:
    """Mark a folder as written to its end, as Spark marks those it writes."""
    place, system = _place(spark, f"{path}/_SUCCESS")
    system.create(place, True).close()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of the caller's own."""
    place, system = _place(spark, path)
    system.delete(place, True)


def partitioned_jdbc(table: Table, column: str, low, high, partitions: int) -> Table:
    """The same table read by ``partitions`` tasks, cut on a numeric, date or time column."""
    split = {
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
    }
    return Table(table.kind, table.name, {**table.options, **split})


def read_table(spark: SparkSession, table: Table) -> DataFrame:
    """The whole table; filters and column choices made later reach the scan."""
    if table.kind == "parquet":
        return spark.read.parquet(table.name)
    if table.kind == "catalog":
        return spark.table(table.name)
    return spark.read.format("jdbc").options(**table.options, dbtable=table.name).load()


def query_session(spark: SparkSession, tables: dict[str, Table]) -> SparkSession:
    """A session for queries of others: ``read_query`` lets them use the named tables only."""
    scoped = spark.newSession()
    scoped.conf.set("spark.sql.runSQLOnFiles", "false")
    scoped.conf.set(VIEWS, ",".join(tables))
    scoped.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    for name, table in tables.items():
        read_table(scoped, table).createOrReplaceTempView(name)
    return scoped


def read_query(spark: SparkSession, sql: str, database: Table | None = None) -> DataFrame:
    """The result of a query, run by the database if one is given, else by Spark.

    As a subquery the text can only be a query: a statement that changes anything, or a
    second statement, does not parse. In a session of ``query_session`` its analysed plan
    is checked as well, before anything runs.
    """
    if database is not None:
        return read_table(spark, Table(database.kind, f"({sql}) as result", database.options))
    result = spark.sql(f"select * from ({sql}) as result")
    views = spark.conf.get(VIEWS, None)
    if views is not None:
        check_query(result, set(views.split(",")))
    return result


def append(df: DataFrame, table: Table) -> None:
    """Add rows."""
    writer = df.write.mode("append")
    if table.kind == "parquet":
        writer.parquet(table.name)
    elif table.kind == "catalog":
        writer.saveAsTable(table.name)
    else:
        writer.format("jdbc").options(**table.options, dbtable=table.name).save()


def ensure_table(spark: SparkSession, table: Table, schema: T.StructType) -> None:
    """Create the table empty when it is missing; never touches one that is there."""
    if table.kind == "jdbc":
        # CREATE TABLE happens only if the database lacks it; ignore keeps existing rows.
        empty = spark.createDataFrame([], schema)
        empty.write.mode("ignore").format("jdbc").options(
            **table.options, dbtable=table.name
        ).save()
    elif not exists(spark, table):
        append(spark.createDataFrame([], schema), table)
