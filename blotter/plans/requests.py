"""SQL requests that arrive as rows and are answered with JSON rows."""

from __future__ import annotations

import threading
import uuid
from collections import deque
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from blotter.functions.messages import to_json_value
from blotter.session import materialise
from blotter.sources.guard import ForbiddenQuery
from blotter.sources.messages import Topic, publish
from blotter.sources.tables import Table, query_session, read_query


#: Whatever a request can fail with while it is analysed or runs.
FAILURES = (PySparkException, Py4JJavaError, ForbiddenQuery)


def _error(spark: SparkSession, failure: Exception) -> DataFrame:
    text = str(failure.java_exception) if isinstance(failure, Py4JJavaError) else str(failure)
    return spark.createDataFrame([(text,)], "error string")


def run_request(spark: SparkSession, sql: str, database: Table | None = None) -> DataFrame:
    """The result of one request, or one row ``error`` when it cannot be analysed."""
    try:
        return read_query(spark, sql, database)
    except FAILURES as failure:
        return _error(spark, failure)


def answer(
    spark: SparkSession, sql: str, send: Callable[[DataFrame], None], database: Table | None = None
) -> None:
    """Send the JSON rows of one request, or its error.

    Sending happens inside the guard, so a request that only fails while it runs is
    answered with an error as well; the sink commits a failed write not at all.
    """
    try:
        send(to_json_value(read_query(spark, sql, database)))
    except FAILURES as failure:
        send(to_json_value(_error(spark, failure)))


def serve_requests(
    requests: DataFrame, source: Table | dict[str, Table], topic: Topic, column: str = "sql_query"
) -> None:
    """Answer every request row on ``topic``, from a database or from named tables.

    Request texts come to the driver one partition at a time; each query runs distributed.
    """
    spark = requests.sparkSession
    database = source if isinstance(source, Table) else None
    session = spark if database is not None else query_session(spark, source)
    for row in requests.select(column).toLocalIterator():
        answer(session, row[0], lambda values: publish(values, topic), database)


def _limited(
    session: SparkSession, sql: str, database: Table | None, seconds: float, pool: str
) -> DataFrame:
    """The JSON rows of one request, written to the shared folder, or its error.

    Its jobs are a group of their own, which is cancelled once ``seconds`` have passed.
    """
    context, group, late = session.sparkContext, f"request-{uuid.uuid4().hex}", threading.Event()

    def cancel() -> None:
        late.set()
        context.cancelJobGroup(group)

    context.setJobGroup(group, "SQL request", interruptOnCancel=True)
    context.setLocalProperty("spark.scheduler.pool", pool)
    timer = threading.Timer(seconds, cancel)
    timer.start()
    try:
        found = materialise(to_json_value(read_query(session, sql, database)))
        if not late.is_set():
            return found
    except FAILURES as failure:
        if not late.is_set():
            return to_json_value(_error(session, failure))
    finally:
        timer.cancel()
        context.setJobGroup("", "")
    return to_json_value(session.createDataFrame([(f"no answer within {seconds:g} s",)], "error string"))


def serve_pool(
    requests: DataFrame,
    source: Table | dict[str, Table],
    topic: Topic,
    column: str = "sql_query",
    in_flight: int = 4,
    seconds: float = 300.0,
    pool: str = "requests",
) -> None:
    """``serve_requests`` with up to ``in_flight`` requests at once and a limit on each.

    Answers go out in the order of the requests. A request that runs longer than
    ``seconds`` is cancelled and answered with an error, so none holds up the others for
    longer; time it waits for a free core counts, as running tasks are not taken off theirs. Tasks of a
    cancelled request end at their next batch of rows; where that may be long, let
    spark.task.reaper.enabled end them. At most twice ``in_flight`` answers lie
    ready before they go out. All run in the scheduler pool ``pool``: in a session with
    spark.scheduler.mode FAIR, other work keeps its share.
    """
    spark = requests.sparkSession
    database = source if isinstance(source, Table) else None
    session = spark if database is not None else query_session(spark, source)
    ready: deque[Future] = deque()
    with ThreadPoolExecutor(in_flight) as workers:
        for row in requests.select(column).toLocalIterator():
            if len(ready) >= 2 * in_flight:
                publish(ready.popleft().result(), topic)
            # Wrapped for each request, as its local properties are its own.
            run = inheritable_thread_target(_limited)
            ready.append(workers.submit(run, session, row[0], database, seconds, pool))
        while ready:
            publish(ready.popleft().result(), topic)
