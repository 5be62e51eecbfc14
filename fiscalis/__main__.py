"""Command line: ``python -m fiscalis daily|discover|history|coverage|export --root FOLDER``; tables are JSON lines below ``FOLDER/silver``."""

from __future__ import annotations

import argparse
import json
from datetime import UTC, datetime

from pyspark.sql import functions as F

from fiscalis.operators import queues
from fiscalis.plans import collect, coverage, interop
from fiscalis.plans.derive import derive
from fiscalis.session import get_session
from fiscalis.sources import config, http, scratch, tables, url_index


def _now() -> str:
    return datetime.now(UTC).replace(microsecond=0).isoformat()


def _table(spark, root: str, name: str):
    return tables.read_jsonl(spark, tables.SPECS[name], f"{root}/silver/{name}.jsonl")


def daily(spark, a) -> dict:
    """Land the sources and fetch the audits that they name unless told not to, derive all products, write the marts.

    The numbers are those of new and changed rows, and of the rows of each mart.
    """
    stats = {}
    if not a.skip_network:
        src = config.sources(spark, f"{a.root}/config/sources.json", a.source)
        seeds = config.seed_audits(spark, f"{a.root}/config/seed_audits.json")
        stats |= collect.collect(spark, a.root, src, seeds, a.now or _now(), http.FetchParams(pause=0.2), a.mirror)
    docs, finds, watch, events = (_table(spark, a.root, n) for n in ("documents", "findings", "watch_items", "events"))
    return stats | tables.write_marts(derive(docs, finds, watch, events, work=f"{a.root}/work"), f"{a.root}/gold")


def discover(spark, a) -> dict:
    """Scan the url indexes of ``config/collections.json`` that are not scanned yet; registry rows and index state."""
    doc = spark.read.option("multiLine", True).schema("collections array<struct<id:string,`cdx-api`:string>>, prefixes array<string>").json(f"{a.root}/config/collections.json").first()
    state = tables.read_jsonl(spark, url_index.STATE, f"{a.root}/silver/cc_collections.jsonl")
    every = spark.createDataFrame([(c["id"], c["cdx-api"]) for c in doc.collections], "collection_id string, api string")
    todo = queues.scannable_collections(every, state, a.min_year, a.max_year, a.rescan)
    own = [{"id": r.collection_id, "cdx-api": r.api} for r in todo.collect()]  # rows of the configuration file
    lines = scratch.written(url_index.read_index(spark, own, list(doc.prefixes), maxPages=a.max_pages, pause=a.pause), "index-lines")
    registry = _table(spark, a.root, "audit_registry").withColumns({c: F.lit("") for c in ("document_date", "document_number")}).withColumn("discovery_collections", F.array().cast("array<string>"))
    rows, after = url_index.scanned(lines, todo.select("collection_id"), registry, state, a.now or _now())
    stats = collect.merged(spark, a.root, "audit_registry", rows)
    tables.write_jsonl(scratch.written(after, "index-state"), url_index.STATE, f"{a.root}/silver/cc_collections.jsonl")
    return stats | {"collections": len(own), "errors": lines.filter("error <> ''").count()}


def history(spark, a) -> dict:
    """The registry after the known audits and documents, and the next batch to fetch."""
    now = a.now
    known = config.history(spark, f"{a.root}/config/historical_sources.json")["known_audits"]
    registry = queues.sync_documents(_table(spark, a.root, "audit_registry"), _table(spark, a.root, "documents"), now)
    found = known.select(F.regexp_extract("audit_url", "([0-9a-f]{32})", 1).alias("key"), "channel").withColumnRenamed("key", "audit_hash")
    merged = queues.sync_registry(registry.withColumnRenamed("discovery_channel", "channel"), found.select("audit_hash"), "audit_hash", "KNOWN_SEED", now)
    batch = queues.next_batch(merged, a.batch_size, ("KNOWN_SEED", "CEA_REFERENCE", "FOUNDATIONS", "NEWS_ARCHIVE"), "audit_hash")
    return tables.write_marts({"audit_registry": merged, "next_batch": batch}, f"{a.root}/gold")


def coverage_report(spark, a) -> dict:
    docs, finds, reg, runs = (_table(spark, a.root, n) for n in ("documents", "findings", "audit_registry", "source_runs"))
    parts = {"registry": coverage.registry_coverage(reg), "documents": coverage.document_coverage(docs), "findings": coverage.finding_coverage(finds)}
    report = {k: df.first().asDict() for k, df in parts.items()}
    return report | {"sources": [r.asDict() for r in coverage.latest_runs(runs).limit(40).collect()]}


def export(spark, a) -> dict:
    """Evidence, events, entities and relationships for other systems; refuses to export nothing."""
    docs, events, evidence, rel = (_table(spark, a.root, n) for n in ("documents", "events", "evidence", "relationships"))
    interop.require_rows(events, evidence)
    hub = spark.read.parquet(f"{a.root}/gold/entity_hub")
    objects, _ = interop.export_evidence(evidence, docs, events)
    own = interop.export_events(events, objects)
    out = {"evidence": objects, "events": own, "entities": interop.export_entities(hub, objects), "relationships": interop.export_relationships(rel, hub, objects, own)}
    return interop.write_export(out, f"{a.root}/silver")


def main(argv: list[str] | None = None) -> dict:
    p = argparse.ArgumentParser(prog="fiscalis")
    p.add_argument("command", choices=("daily", "discover", "history", "coverage", "export"))
    p.add_argument("--root", required=True)
    p.add_argument("--source")
    p.add_argument("--skip-network", action="store_true")
    p.add_argument("--batch-size", type=int, default=120)
    p.add_argument("--now", default="")
    p.add_argument("--mirror", help="stands in for the official host when pages are fetched")
    p.add_argument("--min-year", type=int, default=2013)
    p.add_argument("--max-year", type=int, default=2026)
    p.add_argument("--max-pages", type=int, default=20)
    p.add_argument("--pause", type=float, default=0.35)
    p.add_argument("--rescan", action="store_true")
    a = p.parse_args(argv)
    done = {"daily": daily, "discover": discover, "history": history, "coverage": coverage_report, "export": export}[a.command](get_session(), a)
    print(json.dumps(done, ensure_ascii=False, default=str))
    return done


if __name__ == "__main__":
    main()
