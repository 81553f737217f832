"""Tables, messages, pages and SQL requests."""

from __future__ import annotations

import json
from urllib.error import HTTPError, URLError

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from blotter import schemas
from blotter.plans.requests import run_request, serve_pool, serve_requests
from blotter.sources.messages import (
    Topic, console_sink, kafka_options, line_source, publish, publish_rows, published_source,
)
from blotter.sources import paged
from blotter.sources.guard import ForbiddenQuery
from blotter.sources.paged import (
    MissingPage, PageReader, PageStreamReader, count_pages, read_paged, stream_paged,
)
from blotter.sources.tables import (
    Table, append, ensure_table, partitioned_jdbc, query_session, read_query, read_table,
)


@pytest.fixture(params=["parquet", "catalog"])
def table(request, spark, tmp_path):
    if request.param == "parquet":
        yield Table("parquet", str(tmp_path / "t"))
    else:
        yield Table("catalog", "acks_for_test")
        spark.sql("DROP TABLE IF EXISTS acks_for_test")


def test_table_is_created_once_and_never_emptied(spark, table):
    ensure_table(spark, table, schemas.ACKS)
    assert read_table(spark, table).isEmpty()
    append(spark.createDataFrame([("a", "sent")], schemas.ACKS), table)
    ensure_table(spark, table, schemas.ACKS)
    assert [tuple(r) for r in read_table(spark, table).collect()] == [("a", "sent")]


def test_failure_to_read_is_not_absence(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part-0.parquet").write_bytes(b"no parquet at all")
    table = Table("parquet", str(tmp_path / "t"))
    ensure_table(spark, table, schemas.ACKS)
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_table(spark, table).collect()
    assert (tmp_path / "t" / "part-0.parquet").read_bytes() == b"no parquet at all"


def test_partitioned_jdbc_options():
    table = partitioned_jdbc(Table("jdbc", "incidents", {"url": "u"}), "rpt_dt", "2020-01-01", "2024-01-01", 64)
    assert table.options == {
        "url": "u", "partitionColumn": "rpt_dt", "lowerBound": "2020-01-01",
        "upperBound": "2024-01-01", "numPartitions": "64",
    }


def test_queries_see_named_tables_only_and_change_nothing(spark, tmp_path):
    table = Table("parquet", str(tmp_path / "t"))
    append(spark.range(5), table)
    spark.range(1).createOrReplaceTempView("hidden_view")
    session = query_session(spark, {"numbers": table})
    assert read_query(session, "select sum(id) as s from numbers").first().s == 10
    for bad in ("select * from hidden_view", "drop view numbers", "select 1; select 2", "create table x (a int)"):
        assert run_request(session, bad).columns == ["error"]
    assert not spark.catalog.tableExists("numbers")


def test_requests_are_answered_even_when_they_fail_late(spark, tmp_path):
    table = Table("parquet", str(tmp_path / "t"))
    append(spark.range(5), table)
    asked = ["select id from t where id < 2", "select 1 / (id - id) as x from t", "nonsense"]
    requests = spark.createDataFrame([(q,) for q in asked], "sql_query string")
    topic = Topic("file", str(tmp_path / "answers"))
    serve_requests(requests, {"t": table}, topic)
    answers = [json.loads(r.value) for r in spark.read.text(topic.name).collect()]
    assert sorted(a["id"] for a in answers if "id" in a) == [0, 1]
    assert sum("error" in a for a in answers) == 2


def test_a_pool_keeps_order_and_gives_up_endless_requests(spark, tmp_path):
    table = Table("parquet", str(tmp_path / "t"))
    append(spark.range(400), table)
    endless = "select sum(id % 7) as n from range(0, 1000000000000000, 1, 1)"  # on one core
    asked = [endless, *(f"select {i} as id from t where id = {i}" for i in range(7)), "nonsense"]
    requests = spark.createDataFrame([(q,) for q in asked], "sql_query string").coalesce(1)
    sent = []
    kept = spark.sparkContext.getLocalProperty("spark.jobGroup.id")

    def keep(values, topic):
        sent.extend(json.loads(r.value) for r in values.collect())

    with pytest.MonkeyPatch.context() as patched:
        patched.setattr("blotter.plans.requests.publish", keep)
        serve_pool(requests, {"t": table}, Topic("file", str(tmp_path / "answers")), in_flight=3, seconds=15)
    assert sent[0] == {"error": "no answer within 15 s"}
    assert [a.get("id") for a in sent[1:8]] == list(range(7)) and "error" in sent[8] and len(sent) == 9
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") == kept


def test_kafka_options_are_those_of_a_cautious_reader():
    topic = Topic("kafka", "incoming", {"kafka.bootstrap.servers": "b:1"})
    assert kafka_options(topic) == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "incoming", "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    assert kafka_options(topic, "earliest", True)["failOnDataLoss"] == "true"


def test_published_rows_leave_nulls_out(spark, tmp_path):
    topic = Topic("file", str(tmp_path / "topic"))
    publish_rows(spark.createDataFrame([("a", None)], "k string, v string"), topic)
    assert spark.read.text(topic.name).first().value == '{"k":"a"}'
    stream = published_source(spark, topic)
    assert stream.isStreaming and stream.columns == ["part", "off", "value"]


def test_line_source_and_console(spark, tmp_path, capfd):
    publish(spark.createDataFrame([("one two",)], "value string"), Topic("file", str(tmp_path / "l")))
    shown = console_sink(line_source(spark, path=str(tmp_path / "l")))
    shown.processAllAvailable()
    shown.stop()
    assert shown.exception() is None


def test_pages_cover_the_dataset_once(spark, tmp_path):
    rows = spark.range(2500).select(
        F.floor(F.col("id") / 1000).alias("page"), F.to_json(F.struct("id")).alias("value")
    )
    rows.repartition(5).write.partitionBy("page").text(str(tmp_path / "pages"))
    pulled = read_paged(spark, f"file://{tmp_path}/pages", "id", pages_per_task=1)
    assert pulled.rdd.getNumPartitions() == 3
    ids = pulled.select(F.get_json_object("value", "$.id").cast("int").alias("id"))
    assert sorted(r.id for r in ids.collect()) == list(range(2500))
    with pytest.raises(ValueError):
        read_paged(spark, "file:///x", "")


def served(pages: list[int], monkeypatch, **options: str) -> PageReader:
    """A reader of a server whose pages hold so many records."""
    def page(url, order, limit, number, where):
        return [f'{{"p": {number}}}'] * (pages[number] if number < len(pages) else 0)

    monkeypatch.setattr(paged, "_http_page", page)
    return PageReader({"url": "http://x", "order": "id", "page": "10", "pagesPerTask": "2", **options})


def pulled_from(reader: PageReader) -> int:
    return sum(1 for part in reader.partitions() for _ in reader.read(part))


@pytest.mark.parametrize("last", [0, 1, 9, 10])
@pytest.mark.parametrize("full", [0, 1, 2, 3, 7, 8, 9])
def test_pages_are_read_to_the_end(monkeypatch, full, last):
    assert pulled_from(served([10] * full + [last], monkeypatch)) == 10 * full + last


def test_records_that_come_late_are_read(monkeypatch):
    pages = [10, 10, 10]
    reader = served(pages, monkeypatch)
    parts = reader.partitions()
    pages += [10, 4]
    assert sum(1 for part in parts for _ in reader.read(part)) == 44


def test_short_pages_before_the_end_raise(monkeypatch):
    for pages in ([10, 3, 10, 10], [10, 10, 10, 3, 5]):
        with pytest.raises(MissingPage):
            pulled_from(served(pages, monkeypatch))


def test_very_many_pages_make_bounded_tasks(monkeypatch):
    """A task takes more pages then, each record still comes once."""
    pages = [10] * 1000 + [3]
    reader = served(pages, monkeypatch)
    assert len(reader.partitions()) <= paged.MOST_TASKS and pulled_from(reader) == 10_003
    stream = PageStreamReader({"url": "http://x", "order": "id", "page": "10", "pagesPerTask": "2"})
    start, end = {"page": 5, "rows": 4}, stream.latestOffset()
    assert len(stream.partitions(start, end)) <= paged.MOST_TASKS
    assert new_records(stream, start, end) == 10_003 - 54
    few = served(pages, monkeypatch, tasks="7")
    assert len(few.partitions()) <= 7 and pulled_from(few) == 10_003


def test_the_folder_of_pages_is_found_by_its_first_page(spark, tmp_path):
    rows = spark.range(40).selectExpr("id as page", "'{}' as value")
    rows.coalesce(1).write.partitionBy("page").text(f"{tmp_path}/pages")
    context = spark.sparkContext
    context.setJobGroup("folder", "")
    try:
        found = paged.paged_folder(spark, f"{tmp_path}/pages")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert found.removeprefix("file:").replace("//", "") == f"{tmp_path}/pages"
    tracker = context.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("folder") for s in tracker.getJobInfo(job).stageIds]
    assert sum(tracker.getStageInfo(s).numTasks for s in stages) == 1  # nobody lists the others


def new_records(reader: PageStreamReader, start: dict, end: dict) -> int:
    return sum(1 for part in reader.partitions(start, end) for _ in reader.read(part))


def test_a_stream_of_pages_takes_each_record_once(monkeypatch):
    pages: list[int] = []
    served(pages, monkeypatch)
    options = {"url": "http://x", "order": "id", "page": "10", "pagesPerTask": "2"}
    reader, offset, seen = PageStreamReader(options), {"page": 0, "rows": 0}, 0
    grown = ([], [4], [9], [10], [10, 1], [10] * 7, [10] * 7 + [3], [10] * 12 + [9], [10] * 13)
    for number, sizes in enumerate(grown):
        pages[:] = sizes
        if number % 3 == 2:  # a restart knows nothing but the committed offset
            reader = PageStreamReader(options)
        end = reader.latestOffset()
        assert end == {"page": sum(sizes) // 10, "rows": sum(sizes) % 10}
        came = new_records(reader, offset, end)
        assert came == new_records(PageStreamReader(options), offset, end)  # a batch made again
        pages.append(2)  # what comes after the offset was taken belongs to the next batch
        assert came == new_records(reader, offset, end) == sum(sizes) - seen
        offset, seen = end, sum(sizes)


def test_a_stream_whose_page_loses_records_raises(spark, monkeypatch):
    pages = [10, 10, 5]
    served(pages, monkeypatch)
    reader = PageStreamReader({"url": "http://x", "order": "id", "page": "10"})
    end = reader.latestOffset()
    pages[:] = [10, 10, 4]
    with pytest.raises(MissingPage):
        reader.latestOffset()
    with pytest.raises(MissingPage):
        new_records(reader, {"page": 0, "rows": 0}, end)
    with pytest.raises(ValueError):
        stream_paged(spark, "http://x", "")


@pytest.mark.parametrize(
    "failures, error, asked",
    [(2, URLError("down"), 3), (3, URLError("down"), 3), (1, 503, 2), (1, 429, 2), (1, 404, 1), (1, 400, 1)],
)
def test_failed_requests_are_made_again(monkeypatch, failures, error, asked):
    """Pauses before each request; a refusal, or the last of the attempts, is raised."""
    calls, waits = [], []

    def page(*_):
        calls.append(1)
        if len(calls) <= failures:
            raise HTTPError("http://x", error, "", None, None) if isinstance(error, int) else error
        return ["{}"]

    monkeypatch.setattr(paged, "_http_page", page)
    monkeypatch.setattr(paged.time, "sleep", waits.append)
    reader = PageReader({"url": "http://x", "order": "id", "page": "10", "pause": "0.5"})
    if failures >= asked:
        with pytest.raises(URLError):
            reader.fetch(0)
    else:
        assert reader.fetch(0) == ["{}"]
    assert len(calls) == asked and waits[0] == 0.5 and sum(waits) == 0.5 * asked + 0.5 * (2 ** (asked - 1) - 1)


def test_count_pages():
    for n in range(40):
        assert count_pages(lambda page: page < n) == n


def test_missing_folders_and_pages_raise(spark, tmp_path):
    rows = spark.range(3000).select(
        F.floor(F.col("id") / 1000).alias("page"), F.to_json(F.struct("id")).alias("value")
    )
    rows.where("page != 1").write.partitionBy("page").text(str(tmp_path / "gap"))
    with pytest.raises(Exception, match="is missing"):
        read_paged(spark, f"file://{tmp_path}/gap", "id").count()
    with pytest.raises(Exception, match="nowhere"):
        read_paged(spark, f"file://{tmp_path}/nowhere", "id").count()


def test_stored_pages_are_filtered(spark, tmp_path):
    rows = spark.range(2500).select(
        F.floor(F.col("id") / 1000).alias("page"),
        F.to_json(F.struct("id", (F.col("id") % 3).alias("kind"))).alias("value"),
    )
    rows.repartition(5).write.partitionBy("page").text(str(tmp_path / "pages"))
    assert read_paged(spark, f"file://{tmp_path}/pages", "id", where={"kind": "1"}).count() == 833


def test_queries_reach_named_tables_only(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "mine"))
    spark.range(5).createOrReplaceGlobalTempView("not_offered")
    session = query_session(spark, {"mine": Table("parquet", str(tmp_path / "mine"))})
    good = [
        "select count(*) as n from mine", "with a as (select id from mine) select * from a join a b using (id)",
        "select * from range(3)", "select * from values (1), (2)", "select 1 as x where exists (select * from mine)",
    ]
    for sql in good:
        read_query(session, sql).collect()
    bad = [
        f"select * from parquet.`{tmp_path}/mine`", "select * from global_temp.not_offered",
        "select java_method('java.lang.System', 'setProperty', 'blotter.probe', 'x') from mine",
        "select 1 where exists (select reflect('java.lang.System', 'getProperty', 'user.home'))",
        "select try_reflect('java.lang.System', 'getProperty', 'user.home') as x",
        "select * from mine; select 1", "drop table mine",
    ]
    for sql in bad:
        with pytest.raises((ForbiddenQuery, PySparkException)):
            read_query(session, sql)
    assert spark._jvm.System.getProperty("blotter.probe") is None
