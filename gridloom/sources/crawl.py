"""The paginated archive as a Spark data source: one partition a page, windows of pages read ahead."""

from __future__ import annotations

import urllib.request
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .pages import attempts, crawl, stop_page

PAGES = "page_no int, url string, html string, error string"
AGENT = {"User-Agent": "Mozilla/5.0"}


def page_url(archive: str, page: int) -> str:
    """Address of a page; the first has no number."""
    return archive if page == 1 else f"{archive}{'&' if '?' in archive else '?'}paged={page}"


def open_url(url: str, seconds: float = 60.0) -> bytes:
    with urllib.request.urlopen(urllib.request.Request(url, headers=AGENT), timeout=seconds) as answer:
        return answer.read()


class Page(InputPartition):
    def __init__(self, number: int):
        super().__init__(number)
        self.number = number


def page_source(get: Callable[[str], bytes] = open_url, tries: int = 1, pause: float = 1.0) -> type[DataSource]:
    """A data source "archive_pages" with the options archive, first and last; a page that cannot be got has an error and no html.

    Each page is a partition, so pages are fetched side by side on the executors and a lost task fetches its page anew.
    """

    class ArchiveReader(DataSourceReader):
        def __init__(self, options):
            self.archive, self.first, self.last = options["archive"], int(options["first"]), int(options["last"])

        def partitions(self) -> list[Page]:
            return [Page(n) for n in range(self.first, self.last + 1)]

        def read(self, partition: Page) -> Iterator[tuple]:
            url = page_url(self.archive, partition.number)
            content, _, error = attempts(get, url, tries, pause)
            yield partition.number, url, None if content is None else content.decode("utf-8", "replace"), error

    class ArchivePages(DataSource):
        @classmethod
        def name(cls) -> str:
            return "archive_pages"

        def schema(self) -> str:
            return PAGES

        def reader(self, schema) -> DataSourceReader:
            return ArchiveReader(self.options)

    return ArchivePages


def read_archive(spark: SparkSession, archive: str, folder: str, get: Callable[[str], bytes] = open_url, most_pages: int = 80, window: int = 8, empty_pages: int = 2, tries: int = 1, **options) -> DataFrame:
    """page_no, url, html of the archive's pages 1..most_pages up to where a loop over them would stop.

    Windows of `window` pages are fetched at once and written under `folder`, which all hosts share. The
    stop, a page that cannot be got or empty_pages pages in a row without a report that no page before has,
    is looked for in all pages read so far, so it holds across windows; no window is read after it.
    """
    spark.dataSource.register(page_source(get, tries))
    place, read, first = f"{folder}/pages-{uuid.uuid4().hex}", 0, 1
    while first <= most_pages:
        last = min(most_pages, first + window - 1)
        spark.read.format("archive_pages").options(archive=archive, first=str(first), last=str(last)).load().write.mode("append").parquet(place)
        pages = spark.read.schema(PAGES).parquet(place)
        stop = stop_page(pages.filter("html is not null"), empty_pages, **options)
        broken = pages.filter("html is null").agg(F.min("page_no")).first()[0]
        stops = [s for s in (stop, broken) if s is not None]
        if stops:
            return pages.filter(F.col("page_no") < min(stops)).drop("error")
        read, first = last, last + 1
    return spark.read.schema(PAGES).parquet(place).drop("error") if read else spark.createDataFrame([], PAGES).drop("error")


def crawl_archive(spark: SparkSession, archive: str, folder: str, get: Callable[[str], bytes] = open_url, **options) -> DataFrame:
    """Reports of the archive, each from the first page that lists it, in the order in which a loop over the pages meets them."""
    reading = {k: options.pop(k) for k in ("most_pages", "window", "empty_pages", "tries") if k in options}
    return crawl(read_archive(spark, archive, folder, get, **reading, **options), reading.get("empty_pages", 2), **options)
