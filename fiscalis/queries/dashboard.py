"""Queries over the published views: full profiles, ranked lists with context, coverage, statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from fiscalis.plans import coverage as C
from fiscalis.plans import dashboard as D
from fiscalis.queries.synthetic import registry, tables
from fiscalis.rules import tables as T

QUERIES, SQL, query = registry()

# one text for both engines: the enrichment of the orders, cheap to make
_ENRICHED = """select 'F-' || cast(o_orderkey as string) as finding_id, 'D-' || cast(cast(floor(o_orderkey / 3) as bigint) as string) as document_id,
 case when o_custkey % 13 = 0 then '' else 'O-' || cast(o_custkey % 40 as string) end as organization_id, 'Org ' || cast(o_custkey % 40 as string) as organization_name,
 case o_custkey % 6 when 0 then '' when 1 then 'Maule' when 2 then 'Biobío' when 3 then 'Ñuble' when 4 then 'Los Lagos' else 'Aysén' end as region,
 case o_orderkey % 4 when 0 then {slice}({list}('x'), 1, 0) when 1 then {list}('P-' || cast(o_orderkey % 23 as string)) else {list}('P-' || cast(o_orderkey % 23 as string), 'P-' || cast(o_orderkey % 23 + 30 as string)) end as provider_ids,
 case when o_orderkey % 3 = 0 then null else cast(floor(o_totalprice) as bigint) end as amount_clp, cast(o_orderkey % 89 as int) as cgr_score, cast(o_custkey % 97 as int) as penal_score, cast(o_orderkey % 71 as int) as aml_score,
 case when o_custkey % 97 >= 75 then 'HIGH' else 'LOW' end as penal_relevance, o_orderkey % 5 = 0 as disciplinary, o_orderkey % 7 = 0 as reparo, o_orderkey % 11 = 0 as criminal_referral, o_orderkey % 17 = 0 as cde_referral,
 case o_orderkey % 6 when 0 then {slice}({list}('x'), 1, 0) when 1 then {list}('Pago') when 2 then {list}('Control', 'Pago') when 3 then {list}('Deuda') when 4 then {list}('Compra', 'Deuda', 'Trato') else {list}('Fondos', 'Pago', 'Activo') end as irregularity_labels,
 'https://h/' || cast(o_custkey % 31 as string) as source_url, 'Texto ' || cast(o_orderkey as string) as description,
 case when o_orderkey % 4 = 1 then '' else {day} end as occurrence_date_from, case when o_orderkey % 4 = 1 then '' else {later} end as occurrence_date_to,
 case when o_orderkey % 4 = 1 then '' else {later} end as occurrence_date_anchor, case o_orderkey % 4 when 0 then 'EXACT' when 1 then 'UNKNOWN' when 2 then 'AUDIT_YEAR' else 'RANGE' end as occurrence_date_precision
 from {orders}"""
_E = _ENRICHED.format(list="list_value", slice="list_slice", day="strftime(o_orderdate, '%Y-%m-%d')", later="strftime(o_orderdate + interval 30 day, '%Y-%m-%d')", orders="orders")


def enriched(spark, sf):
    (o,) = tables(spark, sf, "orders")
    o = o.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    text = _ENRICHED.format(list="array", slice="slice", day="date_format(o_orderdate, 'yyyy-MM-dd')", later="date_format(o_orderdate + interval 30 day, 'yyyy-MM-dd')", orders="{orders}")
    return spark.sql(text, orders=o)


def _dims(spark, sf):
    """Organizations and providers, some of them unknown."""
    orgs = spark.range(0, 36).select(F.concat(F.lit("O-"), "id").alias("organization_id"), F.concat(F.lit("Organismo "), "id").alias("name"), F.when(F.col("id") % 2 == 0, "Maule").otherwise("").alias("region"))
    provs = spark.range(0, 45).select(F.concat(F.lit("P-"), "id").alias("provider_id"), F.concat(F.lit("Proveedor "), "id").alias("name"))
    return orgs, provs


_WITH = f"""with e as ({_E}), orgs as (select 'O-' || cast(i as string) as organization_id, 'Organismo ' || cast(i as string) as name, case when i % 2 = 0 then 'Maule' else '' end as region from (select unnest(range(0, 36)) as i)),
provs as (select 'P-' || cast(i as string) as provider_id, 'Proveedor ' || cast(i as string) as name from (select unnest(range(0, 45)) as i))"""


def _labels_sql(rows: str, group: str, n: int) -> str:
    """Common table expressions: the most frequent labels of each group, ties by first encounter."""
    return f"""lx as (select {group} as g, finding_id, unnest(irregularity_labels) as name, generate_subscripts(irregularity_labels, 1) as pos from {rows}),
lc as (select g, name, count(*) as c, min(finding_id || '|' || cast(pos as string)) as f from lx group by 1, 2),
lt as (select g, string_agg(name || ':' || cast(c as string), ';' order by k) as top_labels from (select *, row_number() over (partition by g order by c desc, f) as k from lc) where k <= {n} group by 1)"""


def _urls_sql(rows: str, group: str) -> str:
    return f"us as (select g, string_agg(source_url, ' ' order by source_url) as source_urls from (select *, row_number() over (partition by g order by source_url) as k from (select distinct {group} as g, source_url from {rows})) where k <= 10 group by 1)"


def _flat(df):
    """Arrays as text, so that both engines compare them."""
    labels = F.array_join(F.transform("top_labels", lambda x: F.concat_ws(":", x["name"], x["count"].cast("string"))), ";")
    return df.withColumn("top_labels", F.when(F.col("top_labels").isNotNull(), labels))


_ORG_DETAILS = f"""{_WITH}, o as (select * from e where organization_id <> ''), {_labels_sql('o', 'organization_id', 6)}, {_urls_sql('o', 'organization_id')},
ps as (select organization_id as g, list_sort(list_distinct(flatten(list(provider_ids)))) as ids from o group by 1),
pn as (select g, string_agg(coalesce(provs.name, x), ',' order by x) as provider_names from (select g, unnest(ids) as x from ps) left join provs on provider_id = x group by 1),
a as (select organization_id, count(distinct document_id) as documents, count(*) as findings, cast(sum(coalesce(amount_clp, 0)) as bigint) as amount, max(cgr_score) as cgr_max, max(penal_score) as penal_max, max(aml_score) as aml_max, count_if(penal_relevance = 'HIGH') as penal_high,
 count_if(disciplinary) as disciplinary, count_if(reparo) as reparos, count_if(criminal_referral) as criminal_referrals, count_if(cde_referral) as cde_referrals from o group by 1),
b as (select a.*, len(ids) as providers_count, least(100, findings * 3 + documents * 6 + penal_high * 6 + criminal_referrals * 12 + reparos * 8 + len(ids) * 2) as recurrence_score from a join ps on g = organization_id),
d as (select b.*, cast(least(100, round_even(cast(0.55 as double) * cgr_max + cast(0.25 as double) * penal_max + cast(0.20 as double) * recurrence_score, 0)) as bigint) as priority_score from b)"""
_ORG_COLS = "d.organization_id, coalesce(orgs.name, 'Organismo sin normalizar') as name, coalesce(orgs.region, '') as region, cast(documents as bigint) as documents, cast(findings as bigint) as findings, amount, cast(reparos as bigint) as reparos, cast(cde_referrals as bigint) as cde_referrals, cast(providers_count as bigint) as providers_count, cast(recurrence_score as bigint) as recurrence_score, priority_score, pn.provider_names, lt.top_labels, us.source_urls"


@query("organization_details", f"{_ORG_DETAILS} select {_ORG_COLS} from d left join orgs on orgs.organization_id = d.organization_id left join pn on pn.g = d.organization_id left join lt on lt.g = d.organization_id left join us on us.g = d.organization_id")
def organization_details(spark, sf):
    out = D.organization_details(enriched(spark, sf), *_dims(spark, sf))
    return _flat(out).select("organization_id", "name", "region", "documents", "findings", "amount", "reparos", "cde_referrals", "providers_count", "recurrence_score", "priority_score", F.array_join("provider_names", ",").alias("provider_names"), "top_labels", F.array_join("source_urls", " ").alias("source_urls"))


_PRV_DETAILS = f"""{_WITH}, p as (select e.* exclude (region), coalesce(nullif(region, ''), 'Sin región') as region, unnest(provider_ids) as provider_id from e), {_labels_sql('p', 'provider_id', 6)}, {_urls_sql('p', 'provider_id')},
a as (select provider_id, cast(count(distinct document_id) as bigint) as documents, cast(count(*) as bigint) as findings, list_sort(list_distinct(list(organization_id))) as orgs_all, array_to_string(list_sort(list_distinct(list(region))), ',') as regions, cast(sum(coalesce(amount_clp, 0)) as bigint) as amount, count_if(penal_relevance = 'HIGH') as penal_high from p group by 1),
n as (select provider_id as g, string_agg(coalesce(orgs.name, x), ',' order by x) as organization_names, count(*) as organizations_count from (select provider_id, unnest(orgs_all) as x from a) left join orgs on organization_id = x where x <> '' group by 1)"""


@query("provider_details", f"{_PRV_DETAILS} select a.provider_id, coalesce(provs.name, 'Proveedor sin normalizar') as name, documents, findings, regions, amount, cast(organizations_count as bigint) as organizations_count, organization_names, cast(least(100, len(orgs_all) * 15 + documents * 8 + findings * 4 + penal_high * 8) as bigint) as exposure_score, top_labels, source_urls from a left join provs on provs.provider_id = a.provider_id left join n on n.g = a.provider_id left join lt on lt.g = a.provider_id left join us on us.g = a.provider_id")
def provider_details(spark, sf):
    out = _flat(D.provider_details(enriched(spark, sf), *_dims(spark, sf)))
    return out.select("provider_id", "name", "documents", "findings", F.array_join("regions", ",").alias("regions"), "amount", "organizations_count", F.array_join("organization_names", ",").alias("organization_names"), "exposure_score", "top_labels", F.array_join("source_urls", " ").alias("source_urls"))


@query("providers_top", f"{_PRV_DETAILS} select provider_id, cast(least(100, len(orgs_all) * 15 + documents * 8 + findings * 4 + penal_high * 8) as bigint) as exposure_score from a left join n on n.g = provider_id order by 2 desc, coalesce(organizations_count, 0) desc, findings desc, provider_id limit 20")
def providers_top(spark, sf):
    return D.providers_list(D.provider_details(enriched(spark, sf), *_dims(spark, sf)), 20).select("provider_id", "exposure_score")


@query("region_details", f"{_WITH}, p as (select e.* exclude (region), coalesce(nullif(region, ''), 'Sin región') as region from e), {_labels_sql('p', 'region', 4)}, s as (select region as g, count(distinct x) as providers from (select region, unnest(provider_ids) as x from p) group by 1) select p.region, count(distinct nullif(organization_id, '')) as organizations, count(distinct document_id) as documents, count(*) as findings, cast(count_if(penal_relevance = 'HIGH') as bigint) as penal_high, cast(count_if(reparo) as bigint) as reparos, cast(count_if(criminal_referral) as bigint) as criminal_referrals, cast(sum(coalesce(amount_clp, 0)) as bigint) as amount, any_value(s.providers) as providers, any_value(lt.top_labels) as top_labels from p left join lt on lt.g = p.region left join s on s.g = p.region group by 1")
def region_details(spark, sf):
    return _flat(D.region_details(enriched(spark, sf)))


@query("profile_bounds", f"{_WITH} select organization_id, coalesce(min(nullif(occurrence_date_from, '')), '') as first_occurrence, coalesce(max(nullif(occurrence_date_to, '')), '') as last_occurrence from e where organization_id <> '' group by 1")
def profile_bounds(spark, sf):
    e = enriched(spark, sf)
    ids = e.filter("organization_id <> ''").select("organization_id").distinct()
    return D.with_bounds(ids, e, "organization_id")


_HYP = "select 'H-' || finding_id as hypothesis_id, finding_id, penal_score as score from e where penal_score >= 50"


def _hypotheses(e):
    return e.filter("penal_score >= 50").select(F.concat(F.lit("H-"), "finding_id").alias("hypothesis_id"), "finding_id", F.col("penal_score").alias("score"))


@query("penal_case_list", f"{_WITH}, h as ({_HYP}), t as (select * from h order by score desc, hypothesis_id limit 250) select t.hypothesis_id, t.score, e.organization_name, e.region, e.amount_clp, e.description as finding_text, e.occurrence_date_from, e.occurrence_date_precision, array_to_string(e.provider_ids, ',') as provider_names from t join e on e.finding_id = t.finding_id")
def penal_case_list(spark, sf):
    e = enriched(spark, sf).withColumn("provider_names", F.col("provider_ids"))
    return D.penal_cases(_hypotheses(e), e, e).select("hypothesis_id", "score", "organization_name", "region", "amount_clp", "finding_text", "occurrence_date_from", "occurrence_date_precision", F.array_join("provider_names", ",").alias("provider_names"))


@query("enforcement_list", f"{_WITH}, t as (select 'A-' || finding_id as enforcement_event_id, finding_id, occurrence_date_from as action_date from e where reparo order by action_date desc, enforcement_event_id desc limit 400) select t.enforcement_event_id, t.action_date, coalesce(x.organization_name, '') as organization_name, coalesce(x.region, '') as region, coalesce(x.description, '') as finding_text from t left join (select * from e where cgr_score > 10) x on x.finding_id = t.finding_id")
def enforcement_list(spark, sf):
    e = enriched(spark, sf)
    events = e.filter("reparo").select(F.concat(F.lit("A-"), "finding_id").alias("enforcement_event_id"), "finding_id", F.when(F.col("occurrence_date_from") != "", F.col("occurrence_date_from")).alias("action_date"))
    known = e.filter("cgr_score > 10")
    return D.enforcement_list(events, known, known).drop("finding_id")


@query("alerts_list", f"{_WITH}, t as (select 'M-' || finding_id as fau_match_id, finding_id, aml_score as score from e order by score desc, fau_match_id desc limit 400) select t.fau_match_id, t.score, e.organization_name, e.region, e.description as finding_text, e.occurrence_date_from, e.occurrence_date_to, e.occurrence_date_anchor from t join e on e.finding_id = t.finding_id")
def alerts_list(spark, sf):
    e = enriched(spark, sf)
    return D.alerts_list(e.select(F.concat(F.lit("M-"), "finding_id").alias("fau_match_id"), "finding_id", F.col("aml_score").alias("score")), e, e).drop("finding_id")


@query("watch_list", "select 'W-' || cast(page_id as string) as watch_id, case when page_id % 3 = 0 then 'OPEN' else 'CLOSED_MATCHED' end as status, case when page_id % 5 = 0 then null else url end as last_seen from pages order by page_id % 3 = 0 desc, coalesce(case when page_id % 5 = 0 then null else url end, '') desc, 'W-' || cast(page_id as string) limit 40")
def watch_list(spark, sf):
    (p,) = tables(spark, sf, "pages")
    n = F.col("page_id")
    rows = p.select(F.concat(F.lit("W-"), n.cast("string")).alias("watch_id"), F.when(n % 3 == 0, "OPEN").otherwise("CLOSED_MATCHED").alias("status"), F.when(n % 5 != 0, F.col("url")).alias("last_seen"))
    return D.watch_list(rows, 40)


@query("tribunal_list", "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as state_date, cast(o_custkey as string) as role from orders order by o_orderdate desc, role desc, o_orderkey limit 300")
def tribunal_list(spark, sf):
    (o,) = tables(spark, sf, "orders")
    rows = o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("state_date"), F.col("o_custkey").cast("string").alias("role"), F.col("o_orderkey").alias("tribunal_case_event_id"))
    return D.tribunal_list(rows).drop("tribunal_case_event_id")


@query("source_health", "select cast(event_id as string) as run_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as finished_at from events order by ts desc, run_id limit 40")
def source_health(spark, sf):
    (e,) = tables(spark, sf, "events")
    return D.source_health(e.select(F.col("event_id").cast("string").alias("run_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("finished_at")))


@query("temporal_kpis", f"{_WITH} select cast(count_if(occurrence_date_anchor <> '') as bigint) as known, cast(count_if(occurrence_date_anchor = '') as bigint) as unknown, round_even(cast(100 as double) * count_if(occurrence_date_anchor <> '') / greatest(count(*), 1), 1) as coverage_pct from e")
def temporal_kpis(spark, sf):
    return D.temporal_kpis(enriched(spark, sf))


@query("temporality_stats", f"{_WITH} select count(*) as findings, cast(count_if(occurrence_date_anchor <> '') as bigint) as known, cast(count_if(occurrence_date_precision = 'EXACT') as bigint) as exact, cast(count_if(starts_with(occurrence_date_precision, 'AUDIT_')) as bigint) as inherited from e")
def temporality_stats(spark, sf):
    return D.temporality_stats(enriched(spark, sf))


@query("alert_stats", f"{_WITH} select count(*) as fau_matches, cast(count_if(cgr_score >= 75) as bigint) as high from e")
def alert_stats(spark, sf):
    return D.alert_stats(enriched(spark, sf).withColumn("score", F.col("cgr_score")))


@query("enforcement_stats", "select count(*) as enforcement_events, " + ", ".join(f"cast(count_if(o_orderkey % 4 = {i}) as bigint) as {k.lower()}" for i, (k, _) in enumerate(T.ENFORCEMENT_STAGES)) + " from orders")
def enforcement_stats(spark, sf):
    (o,) = tables(spark, sf, "orders")
    kinds = F.array(*[F.lit(k) for k, _ in T.ENFORCEMENT_STAGES])
    return D.enforcement_stats(o.select(F.element_at(kinds, (F.col("o_orderkey") % 4 + 1).cast("int")).alias("enforcement_type")))


@query("anchors_list", f"{_WITH} select finding_id, occurrence_date_anchor from e where occurrence_date_anchor <> ''")
def anchors_list(spark, sf):
    return D.anchors_list(enriched(spark, sf)).select("finding_id", "occurrence_date_anchor")


@query("year_scale", f"{_WITH}, y as (select substr(occurrence_date_anchor, 1, 4) as year, count(*) as n from e where occurrence_date_anchor <> '' group by 1) select year, n, cast(n as double) / max(n) over () as share from y")
def year_scale(spark, sf):
    return D.year_scale(enriched(spark, sf))


@query("region_names", f"{_WITH} select distinct region from e where region <> ''")
def region_names(spark, sf):
    return D.region_names(enriched(spark, sf))


@query("question_catalogue", f"{_WITH}, q as (select unnest([" + ", ".join(f"'{k}'" for k, _ in T.QUESTIONS) + "]) as id, cast(unnest(range(" + str(len(T.QUESTIONS)) + ")) as int) as position) select id, position, count(e.finding_id) as findings from q left join e on e.cgr_score % " + str(len(T.QUESTIONS)) + " = position group by 1, 2")
def question_catalogue(spark, sf):
    """The published questions, each with the findings whose score falls to it."""
    n = enriched(spark, sf).groupBy((F.col("cgr_score") % len(T.QUESTIONS)).cast("int").alias("position")).agg(F.count("*").alias("findings"))
    return D.questions(spark).join(n, "position", "left").select("id", "position", F.coalesce("findings", F.lit(0)).alias("findings"))


_REG = "select page_id, case page_id % 5 when 0 then 'FETCHED' when 1 then 'ERROR' when 2 then 'FETCHED' when 3 then '' else 'DISCOVERED' end as status, cast(page_id % 6 as int) as attempts, case page_id % 3 when 0 then 'NEWS_ARCHIVE' when 1 then 'KNOWN_SEED' else '' end as discovery_channel from pages"


def _registry(spark, sf):
    (p,) = tables(spark, sf, "pages")
    return spark.sql(_REG.replace("from pages", "from {pages}"), pages=p)


@query("registry_coverage", f"select count(*) as total_discovered, cast(count_if(status = 'FETCHED') as bigint) as fetched, cast(count_if(status <> 'FETCHED' and attempts < 4) as bigint) as pending, cast(count_if(status = 'ERROR' and attempts >= 4) as bigint) as exhausted_errors, round_even(cast(100 as double) * count_if(status = 'FETCHED') / greatest(count(*), 1), 1) as fetch_pct from ({_REG})")
def registry_coverage(spark, sf):
    return C.registry_coverage(_registry(spark, sf))


@query("registry_by_status", f"select coalesce(nullif(status, ''), 'UNKNOWN') as name, count(*) as n from ({_REG}) group by 1")
def registry_by_status(spark, sf):
    return C.counts_by(_registry(spark, sf), F.col("status"))


@query("registry_by_channel", f"select coalesce(nullif(discovery_channel, ''), 'UNKNOWN') as name, count(*) as n from ({_REG}) group by 1")
def registry_by_channel(spark, sf):
    return C.counts_by(_registry(spark, sf), F.col("discovery_channel"))


@query("index_coverage", f"select count(*) as registered, cast(count_if(status = 'FETCHED') as bigint) as scanned, cast(count_if(status = 'ERROR') as bigint) as errors, cast(count_if(status <> 'FETCHED') as bigint) as unfinished, round_even(cast(100 as double) * count_if(status = 'FETCHED') / greatest(count(*), 1), 1) as scan_pct from ({_REG})")
def index_coverage(spark, sf):
    return C.index_coverage(_registry(spark, sf).withColumn("status", F.regexp_replace("status", "FETCHED", "SCANNED")))


def _dated(spark, sf):
    """Documents of the orders, moved by 29 years so that some fall in the reference period."""
    (o,) = tables(spark, sf, "orders")
    day = F.date_format(F.add_months("o_orderdate", 29 * 12), "dd-MM-yyyy")
    return o.select(F.when(F.col("o_orderkey") % 10 == 0, "31-02-2024").otherwise(day).alias("document_date"))


_DAY = "case when o_orderkey % 10 = 0 then null else strftime(o_orderdate + interval 29 year, '%Y-%m-%d') end"


@query("document_coverage", f"select count(*) as documents, min(d) as publication_oldest, max(d) as publication_newest, cast(count_if(d between '2024-04-01' and '2025-03-31') as bigint) as in_reference_period, round_even(cast(100 as double) * count_if(d between '2024-04-01' and '2025-03-31') / 792, 2) as reference_pct from (select {_DAY} as d from orders)")
def document_coverage(spark, sf):
    return C.document_coverage(_dated(spark, sf))


@query("documents_by_year", f"select substr(d, 1, 4) as year, count(*) as n from (select {_DAY} as d from orders) where d is not null group by 1")
def documents_by_year(spark, sf):
    rows = _dated(spark, sf)
    return C.by_year(rows, C.publication_day(F.col("document_date")))


@query("finding_coverage", f"{_WITH} select count(*) as findings, min(nullif(occurrence_date_from, '')) as occurrence_oldest, max(nullif(occurrence_date_to, '')) as occurrence_newest, cast(count_if(occurrence_date_anchor <> '') as bigint) as known_temporality, cast(count_if(occurrence_date_anchor = '') as bigint) as unknown_temporality from e")
def finding_coverage(spark, sf):
    return C.finding_coverage(enriched(spark, sf))


@query("tribunal_coverage", "select count(*) as records, strftime(min(o_orderdate), '%Y-%m-%d') as state_date_oldest, strftime(max(o_orderdate), '%Y-%m-%d') as state_date_newest from orders")
def tribunal_coverage(spark, sf):
    (o,) = tables(spark, sf, "orders")
    return C.tribunal_coverage(o.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("state_date")))


@query("latest_runs", "select event_type as source_id, run_id, status from (select event_type, cast(event_id as string) as run_id, cast(user_id as string) as status, row_number() over (partition by event_type order by ts desc, cast(event_id as string) desc) as k from events) where k = 1")
def latest_runs(spark, sf):
    (e,) = tables(spark, sf, "events")
    rows = e.select(F.col("event_type").alias("source_id"), F.col("event_id").cast("string").alias("run_id"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("finished_at"), F.col("user_id").cast("string").alias("status"), F.lit("").alias("error"))
    return C.latest_runs(rows).select("source_id", "run_id", "status")


@query("coverage_status", "select 'BACKFILLING' as coverage_status")
def coverage_status(spark, sf):
    r = _registry(spark, sf)
    return C.coverage_status(r, r)
