"""Landing of fetched pages: page and article rows, links to audits, articles and further pages, crawl frontiers.

A page is one row with its url and html, or with an error in place of html; errors become rows, not exceptions. Links
are one array per page, so filters, caps and distinct sets are array functions and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fiscalis.functions import urls
from fiscalis.functions.identity import OFFICIAL_HOSTS, canonical_audit_url, official_url
from fiscalis.functions.text import bound, missing, normalize_ws, text_or_empty
from fiscalis.sources import html as H
from fiscalis.sources import scratch

#: Urls of audits in raw text, paths of news, names and texts of links to further pages, sizes of excerpts.
RAW_AUDIT_URL = r"(?i)https?://[^\s\"']*contraloria\.cl/buscadorpdf/auditoria/[a-f0-9]+/html"
AUDIT_DIR, NEWS_DIR, CONTENT_DIR, PUBLISHER = "/buscadorpdf/auditoria/", "/noticias/", "/content/", "asset_publisher"
PAGE_KEYS, PAGE_TEXTS = ("cur", "page", "delta"), ("siguiente", "next", ">", "›", "»")
PAGE_EXCERPT, ARTICLE_EXCERPT, LINK_TEXT = 3000, 5000, 250


def with_links(pages: DataFrame, url: str = "source_url", html: str = "html", more: tuple[str, ...] = ()) -> DataFrame:
    """``pages`` with ``anchors array<struct<url, text, href>>``, urls absolute, in document order.

    ``more`` names further parts of the same reading of the page, as ``page_<part>``.
    """
    found = pages.withColumn("__page", H.parts(F.col(html), "links", *more))
    base = F.col(url)
    anchors = F.transform("__page.links", lambda x: F.struct(urls.resolve(base, x["href"]).alias("url"), x["text"].alias("text"), x["href"].alias("href")))
    return found.withColumns({"anchors": anchors} | {f"page_{part}": F.col(f"__page.{part}") for part in more}).drop("__page")


def audit_links(html: Column, anchors: Column) -> Column:
    """Sorted distinct urls of audits: in the raw html, and of anchors, resolved against the page."""
    raw = F.regexp_extract_all(text_or_empty(html), F.lit(RAW_AUDIT_URL), F.lit(0))
    own = F.filter(anchors, lambda x: x["href"].contains(AUDIT_DIR) & x["href"].endswith("/html"))
    return F.array_sort(F.array_union(raw, F.transform(own, lambda x: x["url"])))


def official_links(anchors: Column, max_items: Column | int) -> Column:
    """The first ``max_items`` distinct official links of a page: ``array<struct<url, text>>``."""
    most = max_items if isinstance(max_items, Column) else F.lit(max_items)

    def first_of_each(own: Column) -> Column:
        """Each url once, with the text of its first place; only the urls that stay are looked up."""

        def taken(names: Column) -> Column:
            kept = F.slice(F.array_distinct(names), F.lit(1), most)
            text = lambda u: F.element_at(own, F.array_position(names, u).cast("int"))["text"]
            return F.transform(kept, lambda u: F.struct(u.alias("url"), F.substring(text(u), 1, LINK_TEXT).alias("text")))

        return bound(F.transform(own, lambda x: x["url"]), taken)

    return bound(F.filter(anchors, lambda x: official_url(x["url"])), first_of_each)


def landing_rows(pages: DataFrame, max_items: int = 80) -> DataFrame:
    """One row per page of ``(source_id, source_name, source_url, html, http_status, error, fetched_at)``.

    ``title`` (else the name of the source), ``links``, ``text_excerpt``, ``content_hash`` and ``audit_links``; a page
    with an error has its error and empty values.
    """
    ok = missing(F.col("error")).isNull()
    body = F.when(ok, text_or_empty(F.col("html"))).otherwise(F.lit(""))
    rows = with_links(pages.withColumn("__body", body), html="__body", more=("text",))
    return rows.select(
        "source_id", "source_url",
        F.when(ok, F.col("http_status")).alias("status_code"),
        "fetched_at",
        F.when(ok, F.sha2("__body", 256)).otherwise(F.lit("")).alias("content_hash"),
        F.when(ok, F.coalesce(missing(H.title(F.col("__body"))), F.col("source_name"))).otherwise(F.lit("")).alias("title"),
        F.substring(normalize_ws(F.col("page_text")), 1, PAGE_EXCERPT).alias("text_excerpt"),
        official_links(F.col("anchors"), max_items).alias("links"),
        audit_links(F.col("__body"), F.col("anchors")).alias("audit_links"),
        text_or_empty(F.col("error")).alias("error"),
    )


def news_candidates(anchors: Column, max_items: int) -> Column:
    """The first ``max_items`` distinct urls of articles on an index page."""
    all_urls = F.transform(anchors, lambda x: x["url"])
    news = F.filter(all_urls, lambda u: u.contains(NEWS_DIR) & (u.contains(PUBLISHER) | u.contains(CONTENT_DIR)))
    return F.slice(F.array_distinct(news), 1, max_items)


def _official_host(url: Column) -> Column:
    return urls.host(url).endswith(OFFICIAL_HOSTS[0])


def article_links(anchors: Column) -> Column:
    """Distinct official urls of articles without their fragments, in order."""
    own = F.filter(anchors, lambda x: _official_host(x["url"]) & urls.path(x["url"]).contains(NEWS_DIR) & urls.path(x["url"]).contains(CONTENT_DIR))
    return F.array_distinct(F.transform(own, lambda x: F.substring_index(x["url"], "#", 1)))


def pagination_links(anchors: Column) -> Column:
    """Distinct urls of further pages of a news index: by a parameter's name or by the text of the link."""

    def further(x: Column) -> Column:
        keys = urls.query_keys(x["url"])
        named = F.lower(x["text"]).isin(*PAGE_TEXTS)
        for k in PAGE_KEYS:
            named = named | keys.contains(k)
        p = urls.path(x["url"])
        return _official_host(x["url"]) & p.contains(NEWS_DIR.rstrip("/")) & ~p.contains(CONTENT_DIR) & named

    return F.array_distinct(F.transform(F.filter(anchors, further), lambda x: x["url"]))


def article_rows(pages: DataFrame) -> DataFrame:
    """One row per fetched article of ``(url, html, error)``: title, first date, digest, excerpt, audit links, error."""
    ok = missing(F.col("error")).isNull()
    rows = with_links(pages, "url", more=("headings", "text")).withColumn("__text", normalize_ws(F.col("page_text")))
    when_ok = lambda c: F.when(ok, c)
    return rows.select(
        "url",
        when_ok(H.first_heading(F.col("page_headings"), "h1", "h2", "h3")).alias("title"),
        when_ok(F.regexp_extract("__text", r"(?U)\b(\d{2}/\d{2}/\d{4})\b", 1)).alias("date"),
        when_ok(F.sha2("__text", 256)).alias("content_hash"),
        when_ok(F.substring("__text", 1, ARTICLE_EXCERPT)).alias("text_excerpt"),
        when_ok(audit_links(F.col("html"), F.col("anchors"))).alias("audit_links"),
        missing(F.col("error")).alias("error"),
    )


def discovered(seeds: DataFrame, *landed: DataFrame) -> DataFrame:
    """``(url)``: seeds and the audit links of landed rows, distinct and canonical."""
    rows = seeds.select("url")
    for df in landed:
        rows = rows.unionByName(df.select(F.explode("audit_links").alias("url")))
    return rows.select(canonical_audit_url(F.col("url")).alias("url")).filter("url <> ''").distinct()


def crawl(pages: DataFrame | Callable[[DataFrame], DataFrame], start: str, max_pages: int, max_articles: int, state: str | None = None, spark: SparkSession | None = None) -> tuple[DataFrame, DataFrame]:
    """Breadth-first walk over a news archive: ``(level, seq, url)`` of the pages visited, and the articles ``(url)`` to read.

    ``pages (source_url, next array, articles array)`` is a landed archive, or a function that gives such rows for the
    urls of a frontier ``(url)``, by fetching them. Visited pages and frontiers are tables below ``state``, a level each:
    a frontier is joined with its pages, their further pages meet all levels before by an anti join, and the first ones in
    reading order, up to ``max_pages`` in all, are the next level. A level that is written is never walked again, so a
    driver that starts over with the same ``state`` goes on where the last one stopped. Articles are distinct, by url,
    the first ``max_articles``.
    """
    spark = spark or (pages.sparkSession if isinstance(pages, DataFrame) else SparkSession.getActiveSession())
    state = state or scratch.fresh_path(spark, "crawl")
    fetched = None if isinstance(pages, DataFrame) else pages
    table = lambda kind, k: f"{state}/{kind}/level={k}"
    first = spark.range(1).select(F.lit(0).cast("long").alias("seq"), F.lit(start).alias("url"))
    level, total, k = first, 0, 0
    while True:
        scratch.write_once(level, table("visited", k))
        done = spark.read.parquet(f"{state}/visited")
        size = spark.read.parquet(table("visited", k)).count()
        total += size
        frontier = spark.read.parquet(table("visited", k))
        if fetched and size and not scratch.is_complete(spark, table("pages", k)):
            scratch.write_once(fetched(frontier.select("url")).select("source_url", "next", "articles"), table("pages", k))
        if not size or total >= max_pages:
            break
        own = spark.read.parquet(table("pages", k)) if fetched else pages
        after = frontier.join(own.select(F.col("source_url").alias("url"), F.slice("next", 1, max_pages).alias("next")), "url")
        each = after.select("seq", F.posexplode("next").alias("pos", "to")).groupBy(F.col("to").alias("url")).agg(F.min(F.struct("seq", "pos")).alias("at"))
        ahead = each.filter("url is not null").join(done.select("url"), "url", "left_anti").orderBy("at", "url").limit(max_pages - total)
        level = ahead.select((F.row_number().over(Window.orderBy("at", "url")) - 1).cast("long").alias("seq"), "url")  # max_pages rows at most
        k += 1
    visited = spark.read.parquet(f"{state}/visited").select("level", "seq", "url")
    own = spark.read.parquet(f"{state}/pages") if fetched else pages
    found = own.join(visited.select(F.col("url").alias("source_url")), "source_url", "left_semi").select(F.explode("articles").alias("url")).distinct()
    return visited, found.orderBy("url").limit(max_articles)


def reference_batches(pages: DataFrame) -> DataFrame:
    """``(audit_hash, channel, source)`` of every audit that a reference page of ``(source_url, html, channel)`` names."""
    rows = with_links(pages)
    each = rows.select(F.coalesce(missing(F.col("channel")), F.lit("REFERENCE_PAGE")).alias("channel"), F.col("source_url").alias("source"), F.explode(audit_links(F.col("html"), F.col("anchors"))).alias("u"))
    h = F.regexp_extract(canonical_audit_url(F.col("u")), "([0-9a-f]{32})", 1)
    return each.select(h.alias("audit_hash"), "channel", "source").filter("audit_hash <> ''").distinct()
