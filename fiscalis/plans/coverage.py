"""How far the collection reaches: registry, index collections, documents, findings, tribunal, sources, a reference period.

Figures of one table are one global aggregation; counts by name are one small aggregation each. A queue that is empty
does not prove that the history is complete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalis.functions.dates import iso_date, text_max, text_min
from fiscalis.functions.text import missing, text_or_empty
from fiscalis.operators.queues import MAX_ATTEMPTS
from fiscalis.plans.marts import latest_per_group
from fiscalis.rules import tables as T


def publication_day(col: Column) -> Column:
    """``DD-MM-YYYY`` as ISO text, anything else as empty."""
    t = text_or_empty(col)
    return F.when(t.rlike(r"^\d{1,2}-\d{1,2}-\d{4}$"), iso_date(F.substring_index(t, "-", -1), F.split(t, "-")[1], F.substring_index(t, "-", 1))).otherwise(F.lit(""))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.bround(F.lit(100.0) * part / F.greatest(whole, F.lit(1)), digits)


def counts_by(df: DataFrame, name: Column) -> DataFrame:
    """``(name, n)``, a missing name as UNKNOWN, most frequent first."""
    return df.groupBy(F.coalesce(missing(name), F.lit("UNKNOWN")).alias("name")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "name")


def by_year(df: DataFrame, day: Column) -> DataFrame:
    """``(year, n)`` of the rows with a day, by year."""
    return df.filter(missing(day).isNotNull()).groupBy(F.substring(day, 1, 4).alias("year")).agg(F.count("*").alias("n")).orderBy("year")


def registry_coverage(registry: DataFrame) -> DataFrame:
    """Discovered, fetched, pending and exhausted audits, and the share of the fetched."""
    status, tries = F.col("status"), F.coalesce(F.col("attempts"), F.lit(0))
    out = registry.agg(
        F.count("*").alias("total_discovered"), F.count_if(status == "FETCHED").alias("fetched"), F.count_if((status != "FETCHED") & (tries < MAX_ATTEMPTS)).alias("pending"),
        F.count_if((status == "ERROR") & (tries >= MAX_ATTEMPTS)).alias("exhausted_errors"),
    )
    return out.withColumn("fetch_pct", percent(F.col("fetched"), F.col("total_discovered")))


def index_coverage(collections: DataFrame) -> DataFrame:
    status = F.col("status")
    out = collections.agg(F.count("*").alias("registered"), F.count_if(status == "SCANNED").alias("scanned"), F.count_if(status == "ERROR").alias("errors"), F.count_if(status != "SCANNED").alias("unfinished"))
    return out.withColumn("scan_pct", percent(F.col("scanned"), F.col("registered")))


def document_coverage(documents: DataFrame) -> DataFrame:
    """Documents, first and last publication, and how many fall in the reference period, by what was reported for it."""
    lo, hi, total = T.BENCHMARK_PERIOD
    day = publication_day(F.col("document_date"))
    out = documents.withColumn("__d", day).agg(F.count("*").alias("documents"), text_min(F.col("__d")).alias("publication_oldest"), text_max(F.col("__d")).alias("publication_newest"), F.count_if(F.col("__d").between(lo, hi)).alias("in_reference_period"))
    return out.withColumn("reference_pct", F.bround(F.lit(100.0) * F.col("in_reference_period") / F.lit(total), 2))


def finding_coverage(findings: DataFrame) -> DataFrame:
    anchor = missing(F.col("occurrence_date_anchor"))
    return findings.agg(
        F.count("*").alias("findings"), text_min(F.col("occurrence_date_from")).alias("occurrence_oldest"), text_max(F.col("occurrence_date_to")).alias("occurrence_newest"),
        F.count_if(anchor.isNotNull()).alias("known_temporality"), F.count_if(anchor.isNull()).alias("unknown_temporality"),
    )


def tribunal_coverage(cases: DataFrame) -> DataFrame:
    return cases.agg(F.count("*").alias("records"), text_min(F.col("state_date")).alias("state_date_oldest"), text_max(F.col("state_date")).alias("state_date_newest"))


def latest_runs(runs: DataFrame) -> DataFrame:
    """``(source_id, finished_at, run_id, status, error)`` of the last run of each source."""
    own = runs.filter(missing(F.col("source_id")).isNotNull()).select("source_id", text_or_empty(F.col("finished_at")).alias("finished_at"), "run_id", "status", "error")
    return latest_per_group(own, "source_id", "finished_at", "run_id")


def coverage_status(registry: DataFrame, collections: DataFrame) -> DataFrame:
    """One row: BACKFILLING while something is pending, exhausted or not scanned, else DISCOVERY_QUEUE_EMPTY."""
    tries = F.coalesce(F.col("attempts"), F.lit(0))
    open_audits = registry.filter(((F.col("status") != "FETCHED") & (tries < MAX_ATTEMPTS)) | ((F.col("status") == "ERROR") & (tries >= MAX_ATTEMPTS))).select(F.lit(1).alias("x"))
    rest = open_audits.unionByName(collections.filter(F.col("status") != "SCANNED").select(F.lit(1).alias("x")))
    return rest.limit(1).agg(F.when(F.count("*") > 0, "BACKFILLING").otherwise("DISCOVERY_QUEUE_EMPTY").alias("coverage_status"))
