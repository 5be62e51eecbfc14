"""From sources to documents: landing pages, the audits that they and the seeds name, their documents, findings and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalis.functions.identity import OFFICIAL_HOSTS
from fiscalis.functions.text import stable_id, text_or_empty
from fiscalis.functions.urls import resolve
from fiscalis.operators import documents, landing, publications
from fiscalis.operators.store import keep_last, upsert
from fiscalis.sources import html, http, scratch
from fiscalis.sources.tables import SPECS, read_jsonl, write_jsonl


def fetched(urls: DataFrame, p: http.FetchParams, mirror: str | None = None) -> DataFrame:
    """:func:`http.fetch_pages` of ``urls (url)``, written at once: a page is fetched by one task and read by many.

    ``mirror`` stands in for the official host; ``source_url`` names the official page all the same.
    """
    own = urls.filter(text_or_empty(F.col("url")) != "").select("url").distinct()
    if not mirror:
        return scratch.written(http.fetch_pages(own, p), "fetched")
    at = F.regexp_replace("url", rf"^https?://(?:www\.)?{OFFICIAL_HOSTS[0]}", mirror.rstrip("/"))
    pages = own.withColumn("at", at)
    got = http.fetch_pages(pages.select(F.col("at").alias("url")), p).join(pages, F.col("requested") == F.col("at")).drop("at")
    return scratch.written(got.withColumn("requested", F.col("url")).withColumn("source_url", F.col("url")).drop("url"), "fetched")


def landing_of(sources: DataFrame, p: http.FetchParams, mirror: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Fetched pages of ``sources (id, name, url, max_items)`` and their landing rows; errors are rows of both."""
    got = fetched(sources.select("url"), p, mirror)
    pages = got.join(sources.select(F.col("id").alias("source_id"), F.col("name").alias("source_name"), F.col("url").alias("requested")), "requested")
    pages = pages.select("source_id", "source_name", "source_url", "html", "http_status", "error", "fetched_at")
    return pages, scratch.written(landing.landing_rows(pages), "landing")


def collected_documents(audits: DataFrame, p: http.FetchParams, mirror: str | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Rows of documents, events, findings and evidence of the audits ``(url)``, and the pages that failed ``(source_url, error)``."""
    pages = fetched(audits, p, mirror)
    read = pages.filter("error = ''").select("source_url", "fetched_at", html.parts(F.col("html"), "text", "headings").alias("page"))
    docs = documents.parse_documents(read.select("source_url", F.col("page.text").alias("text"), F.col("page.headings").alias("headings"), F.col("fetched_at").alias("retrieved_at")))
    docs = scratch.written(docs, "documents")
    finds = scratch.written(documents.document_findings(docs), "findings")
    rows = {"documents": docs, "events": documents.document_events(docs), "findings": finds, "evidence": documents.evidence_rows(finds, docs)}
    return rows, pages.filter("error <> ''").select("source_url", "error")


def source_runs(landed: DataFrame, sources: DataFrame, failed: DataFrame, started: str) -> DataFrame:
    """A run for each source, and one for each audit page that failed."""
    own = landed.join(sources.select(F.col("id").alias("source_id"), F.col("name").alias("source_name")), "source_id", "left")
    status = F.when(F.col("error") != "", "ERROR").otherwise("OK")
    runs = own.select(
        stable_id("RUN", F.col("source_id"), F.lit(started)).alias("run_id"), "source_id", "source_name", "source_url", F.lit(started).alias("started_at"), F.col("fetched_at").alias("finished_at"),
        status.alias("status"), F.col("status_code").alias("http_status"), "content_hash", "error",
    )
    audit = failed.select(stable_id("RUN", F.lit("audit_detail"), F.col("source_url"), F.lit(started)).alias("run_id"), F.lit("audit_detail").alias("source_id"), "source_url", F.lit(started).alias("started_at"), F.lit("ERROR").alias("status"), "error")
    return runs.unionByName(audit, allowMissingColumns=True)


def merged(spark: SparkSession, root: str, name: str, rows: DataFrame) -> dict[str, int]:
    """Merge ``rows`` into the table of JSON lines below ``root``; how many rows are new and changed."""
    spec = SPECS[name]
    whole = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in spec.schema])
    path = f"{root}/silver/{name}.jsonl"
    out = scratch.written(upsert(read_jsonl(spark, spec, path), keep_last(whole, spec.key, F.to_json(F.struct(*whole.columns))), spec.key), f"merged-{name}")
    write_jsonl(out.drop("change"), spec, path)
    kinds = {r.change: r["count"] for r in out.groupBy("change").count().collect()}
    return {f"new_{name}": kinds.get("inserted", 0), f"updated_{name}": kinds.get("updated", 0)}


def collect(spark: SparkSession, root: str, sources: DataFrame, seeds: DataFrame, started: str, p: http.FetchParams, mirror: str | None = None) -> dict[str, int]:
    """Land the sources, fetch the audits that they and the seeds name, and merge all that is found into the tables."""
    pages, landed = landing_of(sources, p, mirror)
    audits = scratch.written(landing.discovered(seeds, landed), "discovered")
    rows, failed = collected_documents(audits, p, mirror)
    stats = {"pages": landed.count(), "audits": audits.count(), "errors": failed.count() + landed.filter("error <> ''").count()}
    for name, df in rows.items():
        stats |= merged(spark, root, name, df)
    stats |= merged(spark, root, "source_runs", source_runs(landed, sources, failed, started))
    blocks = html.blocks(pages.filter("error = ''"), "source_id")
    watch = None
    for s in sources.select("id", "url").collect():  # the sources of the configuration file
        url = F.when(F.col("href") != "", resolve(F.lit(s.url), F.col("href"))).otherwise(F.lit("")).alias("url")
        own = publications.watch_candidates(blocks.filter(F.col("source_id") == s.id).select("pos", "text", url), s.id, s.url, started)
        watch = own if watch is None else watch.unionByName(own)
    if watch is not None:
        known = read_jsonl(spark, SPECS["watch_items"], f"{root}/silver/watch_items.jsonl")
        stats |= merged(spark, root, "watch_items", publications.merge_watch(watch, known))
    return stats
