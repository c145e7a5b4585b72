"""Numbered pages as a data source: a task for each range of page numbers.

Pages lie below a folder as ``page-<number>.json``, one document each, as an API
delivers them. The numbers are given, so nothing is listed on the driver; a page that
can't be read is tried again, and one that is missing or malformed is a row that says so.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from voltaflow.sources.segments import _store

SCHEMA = "page long, status string, error string, body string"


@dataclass
class PageRange(InputPartition):
    first: int
    last: int


def fetch(read: Callable[[int], bytes], page: int, tries: int, wait: float = 0.1) -> tuple[int, str, str | None, str | None]:
    """A page's row: ``ok`` with its text, ``missing``, or ``failed`` after that many tries."""
    for n in range(tries):
        try:
            return page, "ok", None, read(page).decode("utf-8", "replace")
        except FileNotFoundError:
            return page, "missing", None, None
        except OSError as e:
            error = f"{type(e).__name__}: {e}"
            time.sleep(wait * 2 ** n if n + 1 < tries else 0)
    return page, "failed", error, None


class PageSource(DataSource):
    """Options: ``path``, ``firstPage``, ``lastPage``, ``pagesPerTask`` (16), ``tries`` (3)."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.tries = options["path"].rstrip("/"), max(1, int(options.get("tries", 3)))
        self.first, self.last, self.per_task = int(options["firstPage"]), int(options["lastPage"]), int(options.get("pagesPerTask", 16))

    def partitions(self):
        starts = range(self.first, self.last + 1, self.per_task)
        return [PageRange(a, min(a + self.per_task - 1, self.last)) for a in starts] or [PageRange(0, -1)]

    def read(self, partition: PageRange) -> Iterator[tuple]:
        store, root = _store(self.path)

        def content(page: int) -> bytes:
            with store.open_input_stream(f"{root}/page-{page}.json") as f:
                return f.read()
        for page in range(partition.first, partition.last + 1):
            yield fetch(content, page, self.tries)


def land_numbered(pages: DataFrame, path: str) -> None:
    """Write ``pages(page, body)``, a file for each; written again, a page is replaced.
    Tasks that run twice write the same files."""
    def write(batches):
        store, root = _store(path.rstrip("/"))
        store.create_dir(root, recursive=True)
        for part in batches:
            for page, body in zip(part["page"], part["body"]):
                with store.open_output_stream(f"{root}/page-{page}.json", compression=None) as f:
                    f.write(body.encode())
            yield part[["page"]]
    pages.select("page", "body").where("page is not null and body is not null").mapInPandas(write, "page long").count()


def read_numbered(spark: SparkSession, path: str, first: int, last: int, per_task: int = 16, tries: int = 3) -> DataFrame:
    """``page, status, error, body`` of the pages ``first .. last``."""
    spark.dataSource.register(PageSource)
    return (spark.read.format("pages").option("path", path).option("firstPage", first).option("lastPage", last)
            .option("pagesPerTask", per_task).option("tries", tries).load())


def page_records(pages: DataFrame, record_ddl: str) -> tuple[DataFrame, DataFrame]:
    """(records with their ``page``, pages that gave none because they are missing,
    failed or malformed): documents ``{"page": n, "data": [records]}``. A page with an
    empty array gives no records and is no fault."""
    doc = F.from_json("body", f"page bigint, data array<struct<{record_ddl}>>, _corrupt_record string", {"mode": "PERMISSIVE"})
    read = pages.withColumn("_doc", doc)
    broken = F.col("_doc._corrupt_record").isNotNull() | F.col("_doc.data").isNull()
    status = F.when((F.col("status") == "ok") & broken, "malformed").otherwise(F.col("status"))
    read = read.withColumn("status", status)
    records = read.where("status = 'ok'").select("page", F.explode("_doc.data").alias("r")).select("page", "r.*")
    return records, read.where("status <> 'ok'").select("page", "status", "error", "body")
