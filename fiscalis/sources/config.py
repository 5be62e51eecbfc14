"""Configuration: sources by collector, seeds, historical lists; JSON documents read as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalis.functions.identity import canonical_audit_url
from fiscalis.functions.text import missing
from fiscalis.sources.tables import _exists

#: Sources with a reader of their own, and the collector whose pages lead to articles.
BY_SOURCE = (("cgr_fiscalizaciones", "WATCH"), ("cgr_tribunal_cuentas", "TRIBUNAL"), ("cgr_semaforo", "MUNICIPAL"))
NEWS_COLLECTOR = "news_index"
_SOURCE = "struct<id:string,name:string,url:string,collector:string,enabled:boolean,max_items:int,priority:int>"
_KNOWN = "struct<enabled:boolean,channel:string,source:string,label:string,url:string>"
_ARCHIVE = "struct<enabled:boolean,channel:string,url:string,max_pages:int,max_articles:int>"
_PAGE = "struct<channel:string,url:string>"


def _document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON document under its schema; an absent file is a document without anything."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.option("multiLine", True).schema(schema).json(path)


def sources(spark: SparkSession, path: str, only: str | None = None) -> DataFrame:
    """Enabled sources with the ``reader`` that takes their pages; ``only`` keeps one of them."""
    s = _document(spark, path, f"sources array<{_SOURCE}>").select(F.explode("sources").alias("s")).select("s.*").filter(F.coalesce("enabled", F.lit(True)))
    s = s.withColumn("max_items", F.coalesce("max_items", F.lit(80))).withColumn("reader", reader(F.col("id"), F.col("collector")))
    return s.filter(F.col("id") == only) if only else s


def reader(source_id: Column, collector: Column) -> Column:
    """What reads a source's page: by its id, else by its collector, else only the landing row is kept."""
    out = F.when(collector == NEWS_COLLECTOR, F.lit("NEWS")).otherwise(F.lit("LANDING"))
    for sid, name in BY_SOURCE:
        out = F.when(source_id == sid, F.lit(name)).otherwise(out)
    return out


def seed_audits(spark: SparkSession, path: str) -> DataFrame:
    """``(url)`` of the enabled seeds of ``{"audits": [{"url", "enabled"}]}``."""
    s = _document(spark, path, "audits array<struct<url:string,enabled:boolean>>").select(F.explode("audits").alias("a"))
    return s.filter(F.coalesce("a.enabled", F.lit(True))).select(F.col("a.url").alias("url"))


def history(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """``news_archives, reference_pages, known_audits`` of the historical configuration; empty without a file."""
    d = _document(spark, path, f"news_archives array<{_ARCHIVE}>, reference_pages array<{_PAGE}>, known_audits array<{_KNOWN}>")
    lists = {k: d.select(F.explode(k).alias("x")).select("x.*") for k in ("news_archives", "reference_pages", "known_audits")}
    for k in ("news_archives", "known_audits"):
        lists[k] = lists[k].filter(F.coalesce("enabled", F.lit(True)))
    known = lists["known_audits"].withColumn("channel", F.coalesce(missing(F.col("channel")), F.lit("KNOWN_SEED"))).withColumn("source", F.coalesce(missing(F.col("source")), F.lit("CONFIG")))
    lists["known_audits"] = known.withColumn("audit_url", canonical_audit_url(F.col("url"))).filter("audit_url <> ''")
    return lists
