"""Fetching of urls inside tasks: a bounded number of tries, errors as rows; and the pages of a url index."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlencode

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Answers that are tried again.
RETRIED = (429, 500, 502, 503, 504)


@dataclass(frozen=True)
class FetchParams:
    """``pause`` seconds between the urls of a task, ``tasks`` at a time: together they bound the load on a host."""

    timeout: float = 35.0
    retries: int = 3
    backoff: float = 0.8
    pause: float = 0.0
    tasks: int = 2
    agent: str = "fiscalis/1.0"


def fetch(url: str, p: FetchParams = FetchParams()) -> tuple[str, int | None, str | None, str]:
    """``(final url, status, body, error)`` of a GET; failures are an error text, not an exception."""
    for k in range(p.retries + 1):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": p.agent}), timeout=p.timeout) as r:
                body = r.read().decode(r.headers.get_content_charset() or "utf-8", "replace")
                return r.geturl(), r.status, body, ""
        except urllib.error.HTTPError as e:
            if e.code not in RETRIED or k == p.retries:
                return url, e.code, None, f"HTTPError: {e.code}"
        except (OSError, ValueError) as e:
            if isinstance(e, ValueError) or k == p.retries:
                return url, None, None, f"{type(e).__name__}: {e}"
        time.sleep(p.backoff * 2**k)
    raise AssertionError("unreachable")


def fetch_pages(urls: DataFrame, p: FetchParams = FetchParams(), column: str = "url") -> DataFrame:
    """``(requested, source_url, http_status, html, error, fetched_at)`` of every distinct url of ``urls``."""
    schema = "requested string, source_url string, http_status int, html string, error string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for u in f["requested"]:
                rows.append((u, *fetch(u, p)))
                time.sleep(p.pause)
            yield pd.DataFrame(rows, columns=["requested", "source_url", "http_status", "html", "error"])

    own = urls.select(F.col(column).alias("requested")).filter("requested <> ''").distinct().repartition(p.tasks, "requested")
    return own.mapInPandas(run, schema).withColumn("fetched_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX"))


def index_queries(collections: DataFrame, prefixes: tuple[str, ...], pages: int, page_size: int = 5) -> DataFrame:
    """``(collection_id, prefix, page, url)``: the queries that read each prefix of each index collection of ``(collection_id, api)``."""
    asked = F.explode(F.array(*[F.struct(F.lit(x).alias("prefix"), F.lit(urlencode({"url": x, "matchType": "prefix", "output": "json"})).alias("q")) for x in prefixes])).alias("p")
    rows = collections.select("collection_id", "api", asked).select("collection_id", "api", "p.*")
    rows = rows.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(pages - 1))))
    return rows.select("collection_id", "prefix", "page", F.concat("api", F.lit("?"), "q", F.lit("&page="), F.col("page").cast("string"), F.lit(f"&pageSize={page_size}")).alias("url"))
