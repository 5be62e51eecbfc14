"""Rows from other pages: watch items, tribunal cases, municipal indicators, circulars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from fiscalis.functions.dates import document_date
from fiscalis.functions.identity import official_url
from fiscalis.functions.text import missing, name_tokens, normalize_name, normalize_ws, stable_id
from fiscalis.operators import linking
from fiscalis.operators.findings import circular_number, datasets, indicator_status
from fiscalis.rules import tables as T

#: Limits and patterns of the extractors.
WATCH_THRESHOLD, TRIBUNAL_THRESHOLD, WATCH_PER_PAGE = 0.62, 0.55, 80
STATUSES = ("GREEN", "YELLOW", "RED", "NA", "UNKNOWN", "OTHER")
SIGNAL = r"(?iu)fiscaliz|auditor|investigaci[oó]n|inspecci[oó]n|revisi[oó]n"
CASE_ROW = r"(?iuU)\b(\d{2}/\d{2}/\d{4})\s+(\d+\s*/\s*\d{4})\s+(RES\.?\s*N?[º°]?\s*\d+)\s+(?:RES\.?\s*N?[º°]?\s*\d+\s+)?"


def watch_tokens(col: Column) -> Column:
    return name_tokens(col, 4, T.WATCH_STOP, digits=False)


def tribunal_tokens(col: Column) -> Column:
    return name_tokens(col, 3, T.TRIBUNAL_STOP, digits=True)


def watch_candidates(blocks: DataFrame, source_id: str, source_url: str, now: str) -> DataFrame:
    """Watch items from ``blocks (page, pos, text, url)`` of one source, ``url`` absolute or empty.

    Texts of 18 to 420 characters with a word of supervision and three significant tokens, no generic headings, on
    official urls; of equal texts and of equal ids the first of a page, ``WATCH_PER_PAGE`` a page at most; an item that
    several pages hold once. A source without a watch type gives none.
    """
    kind = dict(T.WATCH_TYPES).get(source_id)
    if "page" not in blocks.columns:
        blocks = blocks.withColumn("page", F.lit(source_url))
    text = normalize_ws(F.col("text"))
    rows = blocks.withColumn("title", text).filter(F.length("title").between(18, 420)).withColumn("norm", normalize_name(F.col("title")))
    rows = rows.withColumn("source_url", F.when(F.col("url") != "", F.col("url")).otherwise(F.lit(source_url)))
    rows = _first_of(rows, ["page", "norm"])
    excluded = F.lit(False)
    for part in T.WATCH_EXCLUDED_URLS:
        excluded = excluded | F.col("source_url").contains(part)
    generic = F.array(*[normalize_name(F.lit(t)) for t in T.WATCH_GENERIC])
    keep = F.lit(kind is not None) & ~F.array_contains(generic, F.col("norm")) & F.col("title").rlike(SIGNAL)
    keep = keep & ((F.col("url") == "") | official_url(F.col("url"))) & ~excluded & (F.size(watch_tokens(F.col("title"))) >= 3)
    identity = F.when((F.col("url") != "") & (F.col("url") != source_url), F.col("url")).otherwise(F.col("norm"))
    rows = _first_of(rows.filter(keep).withColumn("watch_id", stable_id("WAT", F.lit(source_id), identity)), ["page", "watch_id"])
    within = Window.partitionBy("page").orderBy("pos")
    rows = rows.withColumn("__n", F.row_number().over(within)).filter(F.col("__n") <= WATCH_PER_PAGE)
    rows = rows.groupBy("watch_id").agg(F.min(F.struct("page", "pos", "title", "source_url")).alias("r")).select("watch_id", "r.*")
    return rows.select(
        "watch_id", F.lit(source_id).alias("source_id"), F.lit(kind).alias("watch_type"), F.substring("title", 1, 350).alias("title"), "source_url", F.lit("WATCH").alias("stage"),
        F.lit("OPEN").alias("status"), F.lit(now).alias("first_seen"), F.lit(now).alias("last_seen"), F.lit("").alias("matched_document_id"), F.lit(0.0).alias("match_confidence"),
    )


def _first_of(df: DataFrame, keys: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("pos")
    return df.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")


def merge_seen(candidates: DataFrame, existing: DataFrame, key: str, matched: str, carried: tuple[str, ...]) -> DataFrame:
    """Candidates with the first sight of rows known before, and their match if they have one.

    ``matched`` is the column that tells of a match: a text or an array that is not empty; ``carried`` goes with it.
    """
    old = existing.filter(missing(F.col(key)).isNotNull()).select(F.col(key).alias("__key"), F.struct("first_seen", *dict.fromkeys((matched, *carried))).alias("__old"))
    out = candidates.join(old, F.col(key) == F.col("__key"), "left")
    value = F.col(f"__old.{matched}")
    has = F.size(value) > 0 if isinstance(candidates.schema[matched].dataType, ArrayType) else missing(value).isNotNull()
    out = out.withColumn("first_seen", F.coalesce(missing(F.col("__old.first_seen")), F.col("first_seen")))
    for c in dict.fromkeys((matched, *carried)):
        out = out.withColumn(c, F.when(has, F.col(f"__old.{c}")).otherwise(F.col(c)))
    return out.drop("__key", "__old")


def merge_watch(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    return merge_seen(candidates, existing, "watch_id", "matched_document_id", ("match_confidence", "stage", "status"))


def merge_cases(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    return merge_seen(candidates, existing, "tribunal_case_event_id", "candidate_reparo_ids", ("match_status", "match_confidence"))


def match_watch(watch: DataFrame, documents: DataFrame) -> DataFrame:
    """Watch items with their best document by title, or open again: recomputed, so a match may be withdrawn."""
    left = watch.select(F.col("watch_id"), watch_tokens(F.col("title")).alias("tokens"))
    right = documents.select(F.col("document_id"), watch_tokens(F.col("title")).alias("tokens"))
    best = linking.best_match(linking.token_overlap(left, right, "watch_id", "document_id", "tokens", 2, WATCH_THRESHOLD))
    best = best.select(F.col("left_id").alias("watch_id"), F.col("right_id").alias("matched_document_id"), F.bround("score", 2).alias("match_confidence"))
    out = watch.drop("matched_document_id", "match_confidence", "stage", "status").join(best, "watch_id", "left")
    hit = F.col("matched_document_id").isNotNull()
    return (
        out.withColumn("stage", F.when(hit, "REPORT_PUBLISHED").otherwise("WATCH"))
        .withColumn("status", F.when(hit, "CLOSED_MATCHED").otherwise("OPEN"))
        .withColumn("matched_document_id", F.coalesce("matched_document_id", F.lit("")))
        .withColumn("match_confidence", F.coalesce("match_confidence", F.lit(0.0)))
    )


def _case_rows(rows: DataFrame) -> DataFrame:
    """Ids and normal forms of ``rows (source_url, pos, date, role, resolution, claimant, defendants_raw)``, the first of an id."""
    rows = rows.withColumn("tribunal_case_event_id", stable_id("TDC", F.col("date"), F.col("role"), F.col("resolution"), F.col("claimant")))
    first = rows.groupBy("tribunal_case_event_id").agg(F.min(F.struct("source_url", "pos", "date", "role", "resolution", "claimant", "defendants_raw")).alias("r"))
    out = first.select("tribunal_case_event_id", "r.*").drop("pos")
    return out.withColumn("state_date", document_date(F.col("date"))).withColumn("role", F.regexp_replace("role", r"\s+", ""))


def tribunal_cases(pages: DataFrame) -> DataFrame:
    """Cases from ``pages (source_url, text)`` of running text: segments between matches, claimant by its pattern."""
    t = normalize_ws(F.col("text"))
    marked = F.regexp_replace(t, CASE_ROW, "\u0001$1\u0002$2\u0002$3\u0002")
    parts = pages.select("source_url", F.posexplode_outer(F.slice(F.split(marked, "\u0001"), 2, 1_000_000)).alias("pos", "p")).filter("p is not null")
    cells = F.split("p", "\u0002")
    claimant = rf"(?iu)^(División de Gobiernos Regionales y Municipalidades|Contraloría Regional de (?:{T.REGION_NAMES}))\s+(.+)$"
    rows = parts.select("source_url", "pos", cells[0].alias("date"), cells[1].alias("role"), cells[2].alias("resolution"), F.trim(cells[3]).alias("tail"))
    rows = rows.filter(F.col("tail").rlike(claimant))
    rows = rows.withColumn("claimant", F.regexp_extract("tail", claimant, 1)).withColumn("defendants_raw", normalize_ws(F.regexp_extract("tail", claimant, 2)))
    return _case_rows(rows.drop("tail"))


def _position(cells: Column, test, after: Column) -> Column:
    """Index (from 1) of the first cell behind ``after`` that passes a test, else 0."""
    return F.coalesce(F.array_min(F.filter(F.transform(cells, lambda x, i: F.when(test(x) & (i + 1 > after), i + 1)), lambda i: i.isNotNull())), F.lit(0))


def tribunal_table_cases(cells: DataFrame) -> DataFrame:
    """Cases from ``cells (source_url, table, row, cell, text)`` of tables.

    A row holds a date, behind it a role, behind that resolutions; of what follows the last one, without repeats, the
    first is the claimant and the rest are the defendants. Other rows are left out.
    """
    own = cells.withColumn("text", normalize_ws(F.col("text"))).filter("text <> ''")
    rows = own.groupBy("source_url", "table", "row").agg(F.array_sort(F.collect_list(F.struct("cell", "text"))).alias("c"))
    rows = rows.withColumn("c", F.transform("c", lambda x: x["text"]))
    rows = rows.withColumn("d", _position(F.col("c"), lambda x: x.rlike(r"^\d{2}/\d{2}/\d{4}$"), F.lit(0))).filter("d > 0")
    rows = rows.withColumn("r", _position(F.col("c"), lambda x: x.rlike(r"^\d+\s*/\s*\d{4}$"), F.col("d"))).filter("r > 0")
    resolution = lambda x: x.rlike(r"(?i)RES\.?\s*N?[º°]?\s*\d+")
    found = F.filter(F.transform("c", lambda x, i: F.when(resolution(x) & (i + 1 > F.col("r")), i + 1)), lambda i: i.isNotNull())
    rows = rows.withColumn("s", found).filter(F.size("s") > 0)
    rows = rows.withColumn("tail", F.array_distinct(F.slice("c", F.array_max("s") + 1, F.greatest(F.size("c"), F.lit(1)))))
    picked = rows.select(
        "source_url", F.struct("table", "row").alias("pos"), F.element_at("c", F.col("d")).alias("date"), F.element_at("c", F.col("r")).alias("role"),
        F.element_at("c", F.array_min("s")).alias("resolution"), F.coalesce(F.try_element_at("tail", F.lit(1)), F.lit("")).alias("claimant"),
        F.array_join(F.slice("tail", 2, 1_000_000), " | ").alias("defendants_raw"),
    )
    return _case_rows(picked)


def all_tribunal_cases(cells: DataFrame, pages: DataFrame) -> DataFrame:
    """Cases of the tables of each page; of pages whose tables hold none, those of the running text."""
    tabled = tribunal_table_cases(cells)
    rest = pages.join(tabled.select("source_url").distinct(), "source_url", "left_anti")
    return tabled.unionByName(tribunal_cases(rest)).dropDuplicates(["tribunal_case_event_id"])


def link_cases(cases: DataFrame, reparos: DataFrame) -> DataFrame:
    """Cases with all follow-up actions of units like the claimant, none dated after the case.

    ``reparos (enforcement_event_id, unit_cgr, action_date)``.
    """
    left = cases.select("tribunal_case_event_id", tribunal_tokens(F.col("claimant")).alias("tokens"))
    right = reparos.select("enforcement_event_id", tribunal_tokens(F.col("unit_cgr")).alias("tokens"))
    pairs = linking.token_overlap(left, right, "tribunal_case_event_id", "enforcement_event_id", "tokens", 1, TRIBUNAL_THRESHOLD)
    later = (F.col("action_date") != "") & (F.col("state_date") != "") & (F.col("action_date") > F.col("state_date"))
    pairs = linking.filter_pairs(pairs, cases.select("tribunal_case_event_id", "state_date"), reparos.select("enforcement_event_id", "action_date"), "tribunal_case_event_id", "enforcement_event_id", ~later)
    found = linking.all_matches(pairs).select(F.col("left_id").alias("tribunal_case_event_id"), F.col("right_ids").alias("candidate_reparo_ids"), F.bround("score", 2).alias("match_confidence"))
    out = cases.drop("candidate_reparo_ids", "match_confidence", "match_status").join(found, "tribunal_case_event_id", "left")
    return out.withColumn("match_status", F.when(F.col("candidate_reparo_ids").isNull(), "UNLINKED").otherwise("CANDIDATE_REPARO_LINK"))


#: A day as the header of a column names it.
HEADER_DAY = r"\((\d{2}/\d{2})\)"


def header_dates(headers: Column) -> Column:
    """Days ``(dd/mm)`` of a table's headers; of sixteen and more, which stand in pairs, every other; eight at most."""
    found = F.filter(F.transform(headers, lambda x: F.regexp_extract(x, HEADER_DAY, 1)), lambda x: x != "")
    single = F.filter(found, lambda x, i: i % 2 == 0)
    return F.slice(F.when(F.size(found) >= 16, single).otherwise(found), 1, 8)


def municipal_snapshot(cells: DataFrame, day: str) -> DataFrame:
    """Indicators from ``cells (page, table, row, cell, is_header, text)``.

    The table with most rows (the first of equals); rows of ten data cells and more that name commune and region; eight
    columns melted, each with the day that its header names. All is told within a page by windows, after one shuffle:
    nothing is joined, so nothing that grows with the pages is broadcast.
    """
    if "is_header" not in cells.columns:
        cells = cells.withColumn("is_header", F.lit(False))
    head, pair = F.coalesce(F.col("is_header"), F.lit(False)), F.struct("cell", "text")
    listed = lambda x: F.array_sort(F.collect_list(x))
    lines = cells.filter("page is not null and table is not null").repartition("page").groupBy("page", "table", "row")
    lines = lines.agg(listed(F.when(~head, pair)).alias("c"), listed(F.when(head & F.col("text").rlike(HEADER_DAY), pair)).alias("h"))
    table, page = Window.partitionBy("page", "table"), Window.partitionBy("page")
    lines = lines.withColumn("n", F.count("row").over(table)).withColumn("__best", F.min(F.struct((-F.col("n")).alias("n"), "table")).over(page))
    own = lines.filter(F.col("table") == F.col("__best.table")).withColumn("h", F.slice(F.transform("h", lambda x: F.regexp_substr(x["text"], F.lit(HEADER_DAY))), 1, 16))
    # sixteen days tell all that is read of the headers, so no line carries more of its page
    before = F.coalesce(F.sum(F.size("h")).over(page.orderBy("row").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = own.withColumn("__first", F.when((before < 16) & (F.size("h") > 0), F.struct("row", "h")))
    own = own.withColumn("__first", F.array_sort(F.collect_list("__first").over(page))).filter(F.size("c") >= 10)
    rows = own.select("c", header_dates(F.flatten(F.transform("__first", lambda x: x["h"]))).alias("dates"))
    day_of = lambda i: F.coalesce(F.get("dates", F.lit(i)), F.lit(""))
    melted = F.array(*[F.struct(F.lit(code).alias("indicator_code"), F.lit(label).alias("indicator_label"), day_of(i).alias("indicator_as_of_ddmm"), F.col("c")[i + 2]["text"].alias("raw_value")) for i, (code, label) in enumerate(T.INDICATORS)])
    out = rows.select(F.col("c")[0]["text"].alias("commune"), F.col("c")[1]["text"].alias("region"), F.explode_outer(melted).alias("m")).select("commune", "region", "m.*")
    out = out.filter("commune <> '' and region <> ''")
    out = out.withColumn("status", indicator_status(F.col("indicator_code"), F.col("raw_value"))).withColumn("snapshot_date", F.lit(day))
    return out.withColumn("snapshot_id", stable_id("SEM", F.lit(day), F.col("commune"), F.col("indicator_code")))


def municipal_stats(snapshot: DataFrame, expected: int = 345) -> DataFrame:
    """Rows, municipalities and whether all are there, and the number of indicators by status as a map."""
    counts = F.create_map(*[x for k in STATUSES for x in (F.lit(k), F.count_if(F.col("status") == k))])
    whole = snapshot.agg(F.count("*").alias("rows"), F.countDistinct("commune", "region").alias("municipalities"), F.map_filter(counts, lambda k, n: n > 0).alias("statuses"))
    return whole.withColumn("complete", F.col("municipalities") >= expected)


def watch_stats(watch: DataFrame) -> DataFrame:
    matched = missing(F.col("matched_document_id")).isNotNull()
    return watch.agg(F.count("*").alias("watch_items"), F.count_if(matched).alias("matched_reports"), F.count_if(F.col("status") == "OPEN").alias("open_watch"))


def case_stats(cases: DataFrame) -> DataFrame:
    return cases.agg(F.count("*").alias("tribunal_cases"), F.count_if(F.col("match_status") != "UNLINKED").alias("candidate_links"))


def circular_stats(circulars: DataFrame) -> DataFrame:
    """Distinct numbers in order and the greatest, 0 without any."""
    n = F.col("cic_number")
    return circulars.filter(n > 0).agg(F.count("*").alias("rows"), F.array_sort(F.collect_set(n)).alias("numbers"), F.coalesce(F.max(n), F.lit(0)).alias("max_number"))


def circulars(articles: DataFrame) -> DataFrame:
    """Numbered circulars among ``articles (title, text, date, url)``, the last article of a number; those without one are dropped."""
    if "error" in articles.columns:
        articles = articles.filter(missing(F.col("error")).isNull()).drop("error")
    articles = articles.withColumn("title", normalize_ws(F.col("title"))).withColumn("text", normalize_ws(F.col("text")))
    both = F.lower(F.concat_ws(" ", "title", "text"))
    about = both.contains("consolidado de información circularizada") | F.col("title").rlike(r"(?iuU)\bCIC\b")
    rows = articles.filter(about).withColumn("cic_number", circular_number(F.col("title"), F.col("text"))).filter("cic_number > 0")
    last = rows.groupBy("cic_number").agg(F.max_by(F.struct("title", "text", "date", "url"), "url").alias("a")).select("cic_number", "a.*")
    return last.withColumn("datasets_detected", datasets(F.col("text"))).withColumn("cic_id", stable_id("CIC", F.col("cic_number")))
