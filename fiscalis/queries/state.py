"""Queries over keyed state: upserts, registries, queues, calendars, runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from fiscalis.functions import dates as D
from fiscalis.functions import identity as I
from fiscalis.operators import queues, store
from fiscalis.plans import explore, marts
from fiscalis.queries.synthetic import tables

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


_OLD = "select o_orderkey as k, o_orderstatus as v, cast(o_custkey as string) as last_seen from orders"
_NEW = "select case when o_orderkey % 4 = 0 then -1 - o_orderkey else o_orderkey end as k, case when o_orderkey % 5 = 0 then 'X' else o_orderstatus end as v, 'now' as last_seen from orders"


def _versions(spark, sf):
    (o,) = tables(spark, sf, "orders")
    old = o.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v"), F.col("o_custkey").cast("string").alias("last_seen"))
    new = o.select(F.when(F.col("o_orderkey") % 4 == 0, -1 - F.col("o_orderkey")).otherwise(F.col("o_orderkey")).alias("k"), F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus")).alias("v"), F.lit("now").alias("last_seen"))
    return old, new


@query("upsert_table", f"select coalesce(o.k, n.k) as k, case when n.k is null or o.v = n.v then o.v else n.v end as v, case when n.k is null or o.v = n.v then o.last_seen else n.last_seen end as last_seen, case when o.k is null then 'inserted' when n.k is null then 'absent' when o.v <> n.v then 'updated' else 'unchanged' end as change from ({_OLD}) o full join ({_NEW}) n on o.k = n.k")
def upsert_table(spark, sf):
    return store.upsert(*_versions(spark, sf), "k")


@query("replace_stats", f"select cast(count_if(o.k is null) as bigint) as inserted, cast(count_if(o.v <> n.v) as bigint) as updated, cast(count_if(n.k is null) as bigint) as deleted from ({_OLD}) o full join ({_NEW}) n on o.k = n.k")
def replace_stats(spark, sf):
    return store.change_counts(store.replace(*_versions(spark, sf), "k"))


@query("keep_last_first", "select user_id, max(event_id) as last_id, min(event_id) as first_id from events group by 1")
def keep_last_first(spark, sf):
    (e,) = tables(spark, sf, "events")
    last = store.keep_last(e.select("user_id", "event_id"), "user_id", "event_id").withColumnRenamed("event_id", "last_id")
    return last.join(store.keep_first(e.select("user_id", "event_id"), "user_id", "event_id").withColumnRenamed("event_id", "first_id"), "user_id")


@query("latest_run_per_source", "select event_type, event_id, user_id from (select *, row_number() over (partition by event_type order by ts desc, event_id desc) as k from events) where k = 1")
def latest_run_per_source(spark, sf):
    (e,) = tables(spark, sf, "events")
    return marts.latest_per_group(e.select("event_type", "ts", "event_id", "user_id"), "event_type", "ts", "event_id").select("event_type", "event_id", "user_id")


_KNOWN = "select md5(url) as registry_id, 'DOCUMENTS' as channel, '2020' as first_seen, case when page_id % 2 = 0 then 'FETCHED' else 'DISCOVERED' end as status from pages"
_SEEN = "select md5(case when page_id % 5 = 0 then url || '#new' else url end) as registry_id from pages"


def _registry(spark, sf):
    (p,) = tables(spark, sf, "pages")
    known = p.select(F.md5("url").alias("registry_id"), F.lit("DOCUMENTS").alias("channel"), F.lit("2020").alias("first_seen"), F.lit("2020").alias("last_seen"), F.when(F.col("page_id") % 2 == 0, "FETCHED").otherwise("DISCOVERED").alias("status"), (F.col("page_id") % 6).cast("int").alias("attempts"))
    found = p.select(F.md5(F.when(F.col("page_id") % 5 == 0, F.concat("url", F.lit("#new"))).otherwise(F.col("url"))).alias("registry_id"))
    return known, found


@query("registry_sync_full_outer", f"select coalesce(k.registry_id, s.registry_id) as registry_id, coalesce(k.channel, 'NEWS') as channel, coalesce(k.first_seen, '2021') as first_seen, case when s.registry_id is null then '2020' else '2021' end as last_seen, coalesce(k.status, 'DISCOVERED') as status from (select distinct * from ({_KNOWN})) k full join (select distinct * from ({_SEEN})) s on k.registry_id = s.registry_id")
def registry_sync_full_outer(spark, sf):
    known, found = _registry(spark, sf)
    out = queues.sync_registry(known, found, "registry_id", "NEWS", "2021").select("registry_id", "channel", "first_seen", "last_seen", "status")
    return out.distinct()  # pages of one url may differ in their attempts alone


@query("queue_priority_batch", "select page_id from pages where (page_id % 4) < 4 and page_id % 3 <> 0 order by case page_id % 5 when 0 then 0 when 1 then 1 when 2 then 2 when 3 then 3 else 9 end, url, page_id limit 40")
def queue_priority_batch(spark, sf):
    (p,) = tables(spark, sf, "pages")
    rows = p.select("page_id", F.expr("element_at(array('DOCUMENTS', 'SEED', 'NEWS', 'REFERENCE', 'OTHER'), cast(page_id % 5 as int) + 1)").alias("channel"), F.col("url").alias("first_seen"), F.when(F.col("page_id") % 3 == 0, "FETCHED").otherwise("ERROR").alias("status"), (F.col("page_id") % 4).cast("int").alias("attempts"))
    return queues.next_batch(rows, 40, ("DOCUMENTS", "SEED", "NEWS", "REFERENCE"), "page_id").select("page_id")


@query("queue_transitions", "select page_id, cast(page_id % 4 + 1 as int) as attempts, case when page_id % 2 = 0 then 'FETCHED' else 'ERROR' end as status from pages")
def queue_transitions(spark, sf):
    (p,) = tables(spark, sf, "pages")
    rows = p.select("page_id", (F.col("page_id") % 4).cast("int").alias("attempts"), F.lit("DISCOVERED").alias("status"), F.when(F.col("page_id") % 2 == 1, "timeout").alias("error"))
    return queues.after_attempt(rows, F.col("error"), "2021-01-01T00:00:00+00:00").select("page_id", "attempts", "status")


@query("coverage_metrics", "select count(*) as discovered, cast(count_if(page_id % 2 = 0) as bigint) as fetched, cast(count_if(page_id % 2 = 1 and page_id % 6 >= 4) as bigint) as exhausted, cast(count_if(page_id % 2 = 1 and page_id % 6 < 4) as bigint) as pending, '2020' as first_seen, '2020' as last_seen, round_even(cast(100 as double) * count_if(page_id % 2 = 0) / greatest(count(*), 1), 1) as fetched_pct from pages")
def coverage_metrics(spark, sf):
    known, _ = _registry(spark, sf)
    return marts.coverage(known.withColumn("status", F.when(F.col("status") == "DISCOVERED", "ERROR").otherwise(F.col("status"))))


@query("cdx_hash_inverse", "select h, array_to_string(list_slice(list_sort(list_distinct(list(c))), 1, 12), ',') as collections, count(distinct c) as n from (select md5(cast(l_partkey as string)) as h, 'C' || cast(l_orderkey % 17 as string) as c from lineitem) group by 1")
def cdx_hash_inverse(spark, sf):
    (li,) = tables(spark, sf, "lineitem")
    rows = li.select(F.md5(F.col("l_partkey").cast("string")).alias("h"), F.concat(F.lit("C"), F.col("l_orderkey") % 17).alias("c"))
    return queues.invert(rows, "h", "c", 12).select("h", F.array_join("collections", ",").alias("collections"), "n")


@query("top_collections", "select c, count(distinct h) as n from (select l_partkey as h, 'C' || cast(l_orderkey % 97 as string) as c from lineitem) group by 1 order by n desc, c limit 30")
def top_collections(spark, sf):
    (li,) = tables(spark, sf, "lineitem")
    rows = li.select(F.col("l_partkey").alias("h"), F.concat(F.lit("C"), F.col("l_orderkey") % 97).alias("c"))
    return rows.groupBy("c").agg(F.countDistinct("h").alias("n")).orderBy(F.desc("n"), "c").limit(30)


@query("window_state_left_anti", "select strftime(m, '%Y-%m') as window_id, 'PENDING' as status from (select unnest(generate_series(timestamp '1990-01-01', timestamp '2003-12-01', interval 1 month)) as m) where strftime(m, '%Y-%m') not in (select strftime(o_orderdate, '%Y-%m') from orders) union all select distinct strftime(o_orderdate, '%Y-%m'), 'SCANNED' from orders")
def window_state_left_anti(spark, sf):
    (o,) = tables(spark, sf, "orders")
    state = o.select(F.date_format("o_orderdate", "yyyy-MM").alias("window_id"), F.lit("SCANNED").alias("status")).distinct()
    return queues.seed_windows(D.month_windows(spark, 1990, 2003, 12), state).select("window_id", "status")


@query("window_scan_status", "select o_orderkey, case when o_orderkey % 4 < o_orderkey % 3 then 'PARTIAL' when o_orderkey % 4 = 0 and o_orderkey % 5 = 0 and not (o_orderkey % 7 = 0) then 'PARTIAL' else 'SCANNED' end as status from orders")
def window_scan_status(spark, sf):
    (o,) = tables(spark, sf, "orders")
    k = F.col("o_orderkey")
    expected = F.when((k % 5 == 0) & (k % 3 == 0), F.lit(None)).otherwise(k % 3)
    found = k % 4
    status = queues.scan_status(found, F.when(k % 5 == 0, F.when(found >= k % 3, F.lit(None)).otherwise(k % 3)).otherwise(expected), k % 7 == 0)
    return o.select("o_orderkey", status.alias("status"))


@query("audit_hash_set", "select distinct md5(url) as h from pages where page_id % 2 = 0")
def audit_hash_set(spark, sf):
    (p,) = tables(spark, sf, "pages")
    line = F.concat(F.lit('{"url": "https://h/buscadorpdf/auditoria/'), F.md5("url"), F.lit('/html"}'))
    text = F.when(F.col("page_id") % 2 == 0, line).otherwise(F.lit("not json"))
    return queues.index_hashes(p.select(text.alias("value")), "value").select(F.col("hash").alias("h"))


@query("explore_enforcement", "select o_orderkey from orders where o_orderstatus = 'F' and case when o_orderkey % 6 = 0 then '' else strftime(o_orderdate, '%Y-%m-%d') end <= '1996-06-30'")
def explore_enforcement(spark, sf):
    (o,) = tables(spark, sf, "orders")
    rows = o.select("o_orderkey", F.col("o_orderstatus").alias("enforcement_type"), F.when(F.col("o_orderkey") % 6 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("action_date"))
    return explore.enforcement(rows, "F", hi="1996-06-30").select("o_orderkey")


@query("enforcement_top", "select o_orderkey, d as action_date from (select o_orderkey, case when o_orderkey % 6 = 0 then '' else strftime(o_orderdate, '%Y-%m-%d') end as d from orders) order by d desc, o_orderkey desc limit 400")
def enforcement_top(spark, sf):
    (o,) = tables(spark, sf, "orders")
    d = F.when(F.col("o_orderkey") % 6 == 0, F.lit(None)).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", F.coalesce(d, F.lit("")).alias("action_date")).orderBy(F.desc("action_date"), F.desc("o_orderkey")).limit(400)
