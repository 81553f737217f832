"""A dataset served in pages, read by many tasks at once, up to its first empty page, or
streamed as it grows.

Each input partition covers a range of pages and asks for them one after another, so
neither the driver nor any one task ever holds the whole dataset. The number of pages is
looked for, not stated; the last range goes on until a page is empty, so records that are
added meanwhile come as well. A stream's offset is the number of full pages and of records
in the page after them.
"""

from __future__ import annotations

import json
import sys
import time
import urllib.error
import urllib.parse
import urllib.request

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, InputPartition,
)

from blotter import schemas


#: Tasks that one read or batch starts at most, or four a core if that is more.
MOST_TASKS = 200


class MissingPage(ValueError):
    """A page that is missing, or too short, before the end of the dataset."""


def _http_page(url: str, order: str, limit: int, page: int, where: dict[str, str]) -> list[str]:
    query = urllib.parse.urlencode(
        {**where, "$order": order, "$limit": limit, "$offset": page * limit}
    )
    with urllib.request.urlopen(f"{url}?{query}", timeout=60) as answer:
        return [json.dumps(record) for record in json.load(answer)]


def _worth_asking_again(error: OSError) -> bool:
    """Whether a request may succeed later; a server that refuses it will refuse it again."""
    return not isinstance(error, urllib.error.HTTPError) or error.code >= 500 or error.code in (408, 429)


def _folder(url: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(url.replace("s3a://", "s3://", 1))


def _stored_page(url: str, page: int) -> list[str]:
    """A page kept as JSON lines in the folder ``page=<number>``, on any file system; later
    files hold later records."""
    from pyarrow import fs

    system, root = _folder(url)
    found = fs.FileSelector(f"{root}/page={page}", allow_not_found=True)
    records = []
    for info in sorted(system.get_file_info(found), key=lambda f: (f.mtime_ns or 0, f.path)):
        if info.is_file and info.size and not info.base_name.startswith(("_", ".")):
            with system.open_input_stream(info.path) as stream:
                text = stream.read().decode("utf-8")
                records += [line for line in text.split("\n") if line]
    return records


def _stored_pages(url: str) -> int:
    """How many pages the folder holds; it must be there, without a gap."""
    from pyarrow import fs

    system, root = _folder(url)
    names = [info.base_name for info in system.get_file_info(fs.FileSelector(root))]
    numbers = {int(n.removeprefix("page=")) for n in names if n.startswith("page=")}
    if gaps := set(range(len(numbers))) - numbers:
        raise MissingPage(f"page {min(gaps)} of {url} is missing")
    return len(numbers)


def count_pages(full) -> int:
    """The number of pages, given whether a page holds anything: doubling, then halving."""
    low, high = 0, 1
    while full(high - 1):
        low, high = high, high * 2
    while low < high - 1:
        middle = (low + high) // 2
        low, high = (middle, high) if full(middle - 1) else (low, middle)
    return low


class PageRange(InputPartition):
    """Pages ``first`` to ``last``, or from ``first`` on to the end of the dataset."""

    def __init__(self, first: int, last: int | None):
        self.first = first
        self.last = last


class PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.url = options["url"]
        self.order = options["order"]
        self.size = int(options["page"])
        self.per_task = int(options.get("pagesPerTask", 50))
        self.tasks = int(options.get("tasks", MOST_TASKS))
        self.where = json.loads(options.get("where", "{}"))
        self.pause = float(options.get("pause", 0))
        self.attempts = int(options.get("attempts", 3))
        self.served = self.url.startswith("http")

    def fetch(self, page: int) -> list[str]:
        """All records of a page; a server applies the filter itself.

        A request that fails is made again, ``attempts`` times in all, each after twice the
        wait; what it fails with in the end is raised, so no page is left out.
        """
        for attempt in range(1, self.attempts + 1):
            try:
                if self.served:
                    time.sleep(self.pause)
                    return _http_page(self.url, self.order, self.size, page, self.where)
                return _stored_page(self.url, page)
            except OSError as error:
                if attempt >= self.attempts or not _worth_asking_again(error):
                    raise
                time.sleep(max(self.pause, 0.5) * 2 ** (attempt - 1))
        raise ValueError("a page needs at least one attempt")

    def pages(self) -> int:
        if self.served:
            return count_pages(lambda page: bool(self.fetch(page)))
        return _stored_pages(self.url)

    def step(self, pages: int) -> int:
        """How many of so many pages one task asks for: more, not more tasks, once these are
        many, as each starts a process, takes a place in the plan and writes a file."""
        return max(self.per_task, -(-pages // self.tasks))

    def partitions(self) -> list[PageRange]:
        pages = self.pages()
        starts = list(range(0, max(1, pages), self.step(pages)))
        return [PageRange(a, b) for a, b in zip(starts, [*starts[1:], None])]

    def wanted(self, record: str) -> bool:
        if self.served or not self.where:
            return True
        fields = json.loads(record)
        return all(str(fields.get(name)) == value for name, value in self.where.items())

    def read(self, partition: PageRange):
        page, short = partition.first, False
        while partition.last is None or page < partition.last:
            records = self.fetch(page)
            if partition.last is None and not records:
                return
            if short or (partition.last is not None and len(records) < self.size):
                raise MissingPage(f"page {page - short} of {self.url} ends before the dataset does")
            short = len(records) < self.size
            for record in records:
                if self.wanted(record):
                    yield (record,)
            page += 1


class PagePart(InputPartition):
    """Pages ``first`` to ``last`` without the first page's records before ``skip``; of the
    page ``end`` only those before ``take``."""

    def __init__(self, first: int, last: int, skip: int, end: int, take: int):
        self.first = first
        self.last = last
        self.skip = skip
        self.end = end
        self.take = take


class PageStreamReader(DataSourceStreamReader):
    """New records of a dataset that only grows at its end.

    An offset is a place in the dataset, so after a restart the stream goes on at the last
    committed record, and a batch that is repeated has the same records.
    """

    def __init__(self, options: dict[str, str]):
        self.reader = PageReader(options)
        self.known = self.initialOffset()

    def initialOffset(self) -> dict:
        return {"page": 0, "rows": 0}

    def latestOffset(self) -> dict:
        """The end of the dataset, looked for from the last known one on."""
        base, size = self.known["page"], self.reader.size
        rows = len(self.reader.fetch(base))
        if rows < self.known["rows"]:
            raise MissingPage(f"page {base} of {self.reader.url} lost records")
        if rows >= size:
            base += count_pages(lambda page: len(self.reader.fetch(base + page)) >= size)
            rows = min(len(self.reader.fetch(base)), size - 1)  # if it is full by now, next time
        self.known = {"page": base, "rows": rows}
        return self.known

    def partitions(self, start: dict, end: dict) -> list[PagePart]:
        last = end["page"] + (end["rows"] > 0)
        step = self.reader.step(last - start["page"])
        return [
            PagePart(first, min(first + step, last), start["rows"] * (first == start["page"]),
                     end["page"], end["rows"])
            for first in range(start["page"], last, step)
        ]

    def read(self, partition: PagePart):
        for page in range(partition.first, partition.last):
            records = self.reader.fetch(page)
            needed = partition.take if page == partition.end else self.reader.size
            if len(records) < needed:
                raise MissingPage(f"page {page} of {self.reader.url} lost records")
            if page == partition.end:
                records = records[:needed]
            for record in records[partition.skip if page == partition.first else 0 :]:
                if self.reader.wanted(record):
                    yield (record,)

    def commit(self, end: dict) -> None:
        """Nothing to release: the dataset keeps its pages."""


class PagedSource(DataSource):
    """Options: url, order, page, pagesPerTask, tasks (beyond so many, tasks take more pages
    each), where (JSON object of column and text), and for servers pause (seconds before
    each request) and attempts."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> PageReader:
        return PageReader(self.options)

    def streamReader(self, schema) -> PageStreamReader:
        return PageStreamReader(self.options)


def _configured(source, spark, url, order, page, pages_per_task, where, pause, attempts):
    """``source``, a reader or a stream reader of ``spark``, with the options of pages."""
    if not order:
        raise ValueError("pages need an order")
    # Executors then need no copy of this module.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(PagedSource)
    tasks = max(MOST_TASKS, 4 * spark.sparkContext.defaultParallelism)
    return source.format("paged").options(
        url=url, order=order, page=str(page), pagesPerTask=str(pages_per_task), tasks=str(tasks),
        where=json.dumps(where or {}), pause=str(pause), attempts=str(attempts),
    )


def paged_folder(spark: SparkSession, path: str) -> str:
    """A folder of pages as the executors' file system names it; lists its first page alone."""
    return spark.read.text(f"{path}/page=0").select(F.input_file_name()).first()[0].split("/page=")[0]


def read_paged(
    spark: SparkSession,
    url: str,
    order: str,
    page: int = schemas.PAGE_ROWS,
    pages_per_task: int = 50,
    where: dict[str, str] | None = None,
    pause: float = 0,
    attempts: int = 3,
) -> DataFrame:
    """All records of a paged dataset, one JSON text per row in ``value``.

    ``where`` keeps records whose column, as text, equals the given one; a server is asked
    for these only. An order is required: without one, pages may repeat or miss records. A
    page that is missing or short before the end raises ``MissingPage``, as does a folder
    that is not there an error of its file system. Each task waits ``pause`` seconds before
    a request to a server and makes it up to ``attempts`` times.
    """
    return _configured(
        spark.read, spark, url, order, page, pages_per_task, where, pause, attempts
    ).load()


def stream_paged(
    spark: SparkSession,
    url: str,
    order: str,
    page: int = schemas.PAGE_ROWS,
    pages_per_task: int = 50,
    where: dict[str, str] | None = None,
    pause: float = 0,
    attempts: int = 3,
) -> DataFrame:
    """The records of a paged dataset as a stream, as ``read_paged`` gives them.

    Each batch takes what came since the last one, many pages at once; records may come
    into the last page and after it. The order must be one in which new records are last.
    A restart goes on where the checkpoint ends; a page that loses records raises.
    """
    return _configured(
        spark.readStream, spark, url, order, page, pages_per_task, where, pause, attempts
    ).load()
