"""A url index as a Spark data source: ``spark.read.format("url_index")``, one partition for each range of index pages.

Options: ``collections`` (a JSON list of objects with ``id`` and ``cdx-api``), ``prefixes`` (a JSON list), ``pageSize``,
``maxPages`` of a query, ``pagesPerPartition``, ``pause`` seconds between requests of a task, ``timeout``, ``retries``,
``backoff``. The number of pages of each query is asked for when the read is planned; the pages are read by the tasks.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlencode

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from fiscalis.functions.identity import legacy_audit_hash
from fiscalis.operators import queues
from fiscalis.sources.http import FetchParams, fetch
from fiscalis.sources.tables import TableSpec

FORMAT = "url_index"
SCHEMA = "collection_id string, prefix string, page int, url string, line string, error string"
MAX_ERROR = 350
#: State of the index collections between scans.
STATE = TableSpec("cc_collections", "collection_id", "collection_id string, status string, hashes_found bigint, last_scanned string, last_error string")


def query_url(api: str, prefix: str, **more: object) -> str:
    """A query for all urls of the index that begin with ``prefix``."""
    return f"{api}?{urlencode({'url': prefix, 'matchType': 'prefix', **more})}"


def number_of_pages(api: str, prefix: str, page_size: int, p: FetchParams) -> int:
    """Pages of a query: none if the index knows nothing of it, one if it does not say how many."""
    _, status, body, error = fetch(query_url(api, prefix, showNumPages="true", pageSize=page_size), p)
    if status == 404:
        return 0
    if error:
        raise ConnectionError(error)
    try:
        told = json.loads(body or "")
    except ValueError:
        return int(bool((body or "").strip()))
    return max(0, int(told.get("pages") or 0)) if isinstance(told, dict) else 0


def page_lines(api: str, prefix: str, page: int, page_size: int, p: FetchParams) -> list[str]:
    """Lines of one page; an index that refuses the number of its first page is asked again without paging."""
    _, status, body, error = fetch(query_url(api, prefix, output="json", page=page, pageSize=page_size), p)
    if status == 400 and page == 0:
        _, status, body, error = fetch(query_url(api, prefix, output="json"), p)
    if status == 404:
        return []
    if error:
        raise ConnectionError(error)
    return [x.strip() for x in (body or "").splitlines() if x.strip()]


@dataclass
class Pages(InputPartition):
    """Pages ``first`` to ``last`` of a query; or the error that counting them met."""

    collection: str
    api: str
    prefix: str
    first: int
    last: int
    error: str = ""


class UrlIndexReader(DataSourceReader):
    def __init__(self, options: dict):
        self.collections = json.loads(options.get("collections", "[]"))
        self.prefixes = json.loads(options.get("prefixes", "[]"))
        number = lambda name, default: type(default)(options.get(name, default))
        self.page_size, self.most, self.together = number("pageSize", 5), number("maxPages", 20), number("pagesPerPartition", 4)
        self.fetch = FetchParams(number("timeout", 45.0), number("retries", 3), number("backoff", 0.8), number("pause", 0.35))

    def partitions(self) -> list[Pages]:
        out = []
        for c in self.collections:
            api = c.get("cdx-api") or ""
            for prefix in self.prefixes:
                try:
                    n = min(number_of_pages(api, prefix, self.page_size, self.fetch), self.most)
                    out += [Pages(c["id"], api, prefix, a, min(a + self.together, n)) for a in range(0, n, self.together)]
                except (OSError, ValueError) as e:
                    out.append(Pages(c["id"], api, prefix, 0, 0, f"{type(e).__name__}: {e}"[:MAX_ERROR]))
        return out or [Pages("", "", "", 0, 0)]

    def read(self, partition: Pages) -> Iterator[tuple]:
        q = partition
        if q.error:
            yield q.collection, q.prefix, None, None, None, q.error
        for page in range(q.first, q.last):
            try:
                for line in page_lines(q.api, q.prefix, page, self.page_size, self.fetch):
                    yield q.collection, q.prefix, page, _url(line), line, ""
            except (OSError, ValueError) as e:
                yield q.collection, q.prefix, page, None, None, f"{type(e).__name__}: {e}"[:MAX_ERROR]
            time.sleep(self.fetch.pause)


def _url(line: str) -> str | None:
    try:
        row = json.loads(line)
    except ValueError:
        return None
    return row.get("url") if isinstance(row, dict) else None


class UrlIndex(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> UrlIndexReader:
        return UrlIndexReader(self.options)


def read_index(spark: SparkSession, collections: list[dict], prefixes: list[str], **options: object) -> DataFrame:
    """``(collection_id, prefix, page, url, line, error)``: every line of the pages, and a row for each error.

    A line that is not JSON has no url. A page that fails is one error row; the other pages are read.
    """
    spark.dataSource.register(UrlIndex)
    reader = spark.read.format(FORMAT).option("collections", json.dumps(collections)).option("prefixes", json.dumps(prefixes))
    return reader.options(**options).load()


def scanned(lines: DataFrame, indexes: DataFrame, registry: DataFrame, state: DataFrame, now: str, channel: str = "URL_INDEX") -> tuple[DataFrame, DataFrame]:
    """Registry rows to upsert and the state of the collections after the read ``lines`` of ``indexes (collection_id)``.

    ``lines`` is used twice: write what :func:`read_index` gives before, or its pages are fetched twice.
    """
    found = lines.filter("url is not null").select("collection_id", legacy_audit_hash(F.col("url")).alias("audit_hash")).filter("audit_hash <> ''").distinct()
    errors = lines.filter("error <> ''").select("collection_id", "error")
    listed = found.groupBy("audit_hash").agg(F.array_sort(F.collect_set("collection_id")).alias("collections"))
    rows = queues.register_hashes(registry, listed, channel, "", now)
    return rows, queues.collection_state(indexes, found, errors, state, now)
