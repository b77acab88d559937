"""Numbered pages as a Spark data source; how a page is got is a function that the caller gives."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class _Range(InputPartition):
    def __init__(self, first: int, last: int) -> None:
        self.first, self.last = first, last


def read_pages(
    spark: SparkSession,
    fetch: Callable[[int], str | None],
    last: int,
    *,
    first: int = 1,
    pages_per_task: int = 100,
    empties: int | None = None,
    name: str = "inkfold_pages",
) -> DataFrame:
    """``page, html`` of the pages ``first`` to ``last``, each got by ``fetch``; a page that isn't there (null) has no row.

    Tasks get runs of ``pages_per_task`` pages and fetch one after the other. With ``empties``, a task stops after so
    many pages in a row that are null or empty, as a reader does who doesn't know where a list ends. A task that is lost
    fetches its pages again.
    """

    class Pages(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "page bigint, html string"

        def reader(self, schema) -> DataSourceReader:
            return Reader()

    class Reader(DataSourceReader):
        def partitions(self) -> list[InputPartition]:
            return [_Range(at, min(at + pages_per_task - 1, last)) for at in range(first, last + 1, pages_per_task)] or [_Range(1, 0)]

        def read(self, partition: InputPartition) -> Iterator[tuple[int, str]]:
            missed = 0
            for page in range(partition.first, partition.last + 1):
                html = fetch(page)
                missed = 0 if html else missed + 1
                if html is not None:
                    yield page, html
                if empties is not None and missed >= empties:
                    return

    spark.dataSource.register(Pages)
    return spark.read.format(name).load()
