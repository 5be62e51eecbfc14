"""Queries over scalar functions: names, ids, amounts, dates, urls, national ids, indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from fiscalis.functions import dates as D
from fiscalis.functions import identity as I
from fiscalis.functions import text as X
from fiscalis.operators import findings as ops
from fiscalis.operators import temporal
from fiscalis.plans import explore, marts
from fiscalis.queries.synthetic import AMOUNT_SQL, finding_sql, findings, lit, list_sql, tables
from fiscalis.rules import tables as T

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


_FOLD = f"translate(upper({{}}), '{X.ACCENTED}', '{X.PLAIN}')"


def name_sql(col: str) -> str:
    plain = f"' ' || trim(regexp_replace(regexp_replace({_FOLD.format(col)}, '[^A-Za-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')) || ' '"
    return f"trim(replace(replace(replace({plain}, ' S A ', ' SA '), ' S P A ', ' SPA '), ' LTDA ', ' LIMITADA '))"


_RAW_NAME = "s_name || case s_suppkey % 4 when 0 then ', Ltda.' when 1 then ' S.A. de Ñuñoa' when 2 then ' S.p.A.   Río' else ' y Cía' end"


@query("normalize_names", f"select s_suppkey, {name_sql('(' + _RAW_NAME + ')')} as name from supplier")
def normalize_names(spark, sf):
    (s,) = tables(spark, sf, "supplier")
    return s.select("s_suppkey", X.normalize_name(F.expr(_RAW_NAME)).alias("name"))


@query("normalize_ws", r"select doc_id, sha256(trim(regexp_replace(text, '[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'))) as digest from documents")
def normalize_ws(spark, sf):
    (d,) = tables(spark, sf, "documents")
    return d.select("doc_id", F.sha2(X.normalize_ws(F.col("text")), 256).alias("digest"))


@query("stable_ids", "select o_orderkey, 'ENT-' || substr(sha256(upper(trim(o_orderpriority)) || '|' || case when o_custkey % 10 = 0 then '' else cast(o_custkey % 10 as string) end || '|'), 1, 20) as id from orders")
def stable_ids(spark, sf):
    (o,) = tables(spark, sf, "orders")
    return o.select("o_orderkey", X.stable_id("ENT", F.col("o_orderpriority"), F.col("o_custkey") % 10, F.lit(None)).alias("id"))


@query("parse_amounts", f"select finding_id, {AMOUNT_SQL} as amount_clp from ({finding_sql('duckdb')})")
def parse_amounts(spark, sf):
    return findings(spark, sf).select("finding_id", "amount_clp")


_REGION_IN = "n_name || ' ' || case n_nationkey % 5 when 0 then 'Región de Tarapacá' when 1 then 'Biobío' when 2 then 'región metropolitana' when 3 then 'O''Higgins' else '' end"
_REGION_CASE = "case " + " ".join(f"when contains(n, {lit(k)}) then {lit(v)}" for k, v in T.REGION_LABELS) + " else '' end"


@query("region_normalize", f"select n_nationkey, {_REGION_CASE} as region from (select n_nationkey, {name_sql('(' + _REGION_IN + ')')} as n from nation)")
def region_normalize(spark, sf):
    (n,) = tables(spark, sf, "nation")
    return n.select("n_nationkey", ops.region_label(F.expr(_REGION_IN)).alias("region"))


_ORG_IN = "case s_suppkey % 9 when 0 then 'Municipalidad de ' when 1 then 'Gobierno Regional de ' when 2 then 'Servicio de Salud ' when 3 then 'Hospital ' when 4 then 'Universidad de ' when 5 then 'El Instituto ' when 6 then 'La Comisión ' when 7 then 'Seremi de ' else 'Otra ' end || s_name"


@query("org_types", f"select s_suppkey, case when n like 'MUNICIPALIDAD%' then 'MUNICIPALITY' when n like 'GOBIERNO REGIONAL%' or n like 'GORE %' then 'REGIONAL_GOVERNMENT' when n like 'SERVICIO DE SALUD%' then 'HEALTH_SERVICE' when n like 'HOSPITAL%' then 'HOSPITAL' when n like 'UNIVERSIDAD%' then 'STATE_UNIVERSITY' when contains(n, 'INSTITUTO') then 'PUBLIC_INSTITUTE' when contains(n, 'COMISION') then 'PUBLIC_COMMISSION' when contains(n, 'MINISTERIO') or contains(n, 'SEREMI') then 'CENTRAL_GOVERNMENT' else 'PUBLIC_ORGANIZATION' end as org_type from (select s_suppkey, {name_sql('(' + _ORG_IN + ')')} as n from supplier)")
def org_types(spark, sf):
    (s,) = tables(spark, sf, "supplier")
    return s.select("s_suppkey", ops.org_type(F.expr(_ORG_IN)).alias("org_type"))


_DATA_IN = "coalesce(text, '') || case doc_id % 6 when 0 then ' cruce con SIAPER y la PDI' when 1 then ' Servicio de Impuestos Internos' when 2 then ' SISREC, portal de transparencia' when 3 then ' Registro Nacional de Deudores' else '' end"


@query("dataset_tags", "select doc_id, array_to_string(" + list_sql([("(" + " or ".join(f"contains(low, {lit(t)})" for t in terms) + ")", lit(code)) for code, terms in T.DATASETS]) + f", ',') as tags from (select doc_id, lower({_DATA_IN}) as low from documents)")
def dataset_tags(spark, sf):
    (d,) = tables(spark, sf, "documents")
    return d.select("doc_id", F.array_join(ops.datasets(F.expr(_DATA_IN)), ",").alias("tags"))


_CIRC = "case doc_id % 5 when 0 then 'Informe CIC N° ' || cast(doc_id % 30 as string) when 1 then 'el cuarto consolidado de información circularizada' when 2 then 'Undécimo Consolidado de Información Circularizada' when 3 then 'CIC' else 'sin número' end"
_ORD = "case " + " ".join(f"when regexp_matches(lower(t), '(^|[^a-záéíóú]){w} +consolidado de información circularizada') then {n}" for w, n in T.ORDINALS) + " end"


@query("ordinal_numbers", f"select doc_id, cast(coalesce(try_cast(nullif(regexp_extract(t, 'CIC N° ([0-9]{{1,2}})', 1), '') as int), {_ORD}) as int) as number from (select doc_id, {_CIRC} as t from documents)")
def ordinal_numbers(spark, sf):
    (d,) = tables(spark, sf, "documents")
    return d.select("doc_id", ops.circular_number(F.expr(_CIRC), F.lit("")).alias("number"))


_RUT_IN = "case c_custkey % 3 when 0 then cast(1000000 + c_custkey * 7919 as string) || '-' || substr('0123456789K', cast(c_custkey % 11 as int) + 1, 1) when 1 then '00' || cast(c_custkey as string) || '.k' else 'x' end"
_SUM = "list_sum(list_transform(range(1, len(b) + 1), lambda i: cast(substr(reverse(b), i, 1) as int) * (2 + (i - 1) % 6)))"
_RUT = f"select c_custkey, c, case when regexp_matches(c, '^[0-9]{{1,8}}[0-9K]$') then substr(c, 1, len(c) - 1) end as b from (select c_custkey, upper(regexp_replace({_RUT_IN}, '[^0-9Kk]', '', 'g')) as c from customer)"
_RUT_OK = f"select c_custkey, case when (case 11 - s % 11 when 11 then '0' when 10 then 'K' else cast(11 - s % 11 as string) end) = right(c, 1) then cast(cast(b as bigint) as string) || '-' || right(c, 1) end as rut from (select *, cast({_SUM} as bigint) as s from ({_RUT}))"


@query("rut_check_digits", _RUT_OK)
def rut_check_digits(spark, sf):
    (c,) = tables(spark, sf, "customer")
    return c.select("c_custkey", I.normalize_rut(F.expr(_RUT_IN)).alias("rut"))


_KIND = "case c_custkey % 4 when 0 then 'PROVIDER' when 1 then 'PUBLIC_ORGANIZATION' when 2 then 'PERSON' else '' end"


@query("entity_hub", f"select c_custkey, 'ENT-RUT-' || rut as entity_id, rut is not null as rut_valid, case when rut is null then 'UNRESOLVED' else 'RESOLVED' end as identity_status, case c_custkey % 4 when 0 then 'PROVIDER' when 1 then 'PUBLIC_BODY' when 2 then 'PERSON_MENTIONED' else 'SOURCE_ENTITY' end as entity_role, cast(case when rut is null then 0 else 1 end as double) as identity_confidence from ({_RUT_OK})")
def entity_hub(spark, sf):
    from fiscalis.plans import interop

    (c,) = tables(spark, sf, "customer")
    rows = c.select("c_custkey", F.col("c_custkey").cast("string").alias("entity_id"), F.expr(_KIND).alias("entity_type"), F.expr(_RUT_IN).alias("rut"), F.col("c_name").alias("name"))
    return interop.adapt_entities(rows).select("c_custkey", "entity_id", "rut_valid", "identity_status", "entity_role", "identity_confidence")


_TERR = "case n_nationkey % 7 when 0 then 'Región de Tarapacá' when 1 then 'Región del Biobío' when 2 then 'Región de La Araucanía' when 3 then 'Metropolitana de Santiago' when 4 then 'O''Higgins' when 5 then 'ñuble' else n_name end"


@query("territories", "select n_nationkey, case n " + " ".join(f"when '{k}' then 'CL-REG-{v}'" for k, v in I.REGION_CODES) + f" end as territory from (select n_nationkey, trim(regexp_replace(trim(regexp_replace(regexp_replace(trim(translate(upper({_TERR}), '{X.ACCENTED}', '{X.PLAIN}')), '[^A-Z0-9 ]+', ' ', 'g'), ' +', ' ', 'g')), '^REGION (DE |DEL |DE LA )?', '')) as n from nation)")
def territories(spark, sf):
    (n,) = tables(spark, sf, "nation")
    return n.select("n_nationkey", I.territory(F.expr(_TERR)).alias("territory"))


def _dates_in(engine: str) -> str:
    f = {"spark": ("date_format(o_orderdate, '{}')", "dd-MM-yyyy", "dd/MM/yyyy", "yyyy-MM-dd"), "duckdb": ("strftime(o_orderdate, '{}')", "%d-%m-%Y", "%d/%m/%Y", "%Y-%m-%d")}[engine]
    a, b, c = (f[0].format(x) for x in f[1:])
    return f"case o_orderkey % 6 when 0 then {a} when 1 then {b} when 2 then {c} when 3 then '31-02-2020' when 4 then '2020/01/02' else '' end"


_DOC = "case when regexp_matches(t, '^[0-9]{2}(-[0-9]{2}-|/[0-9]{2}/)[0-9]{4}$') then coalesce(cast(try_cast(substr(t, 7, 4) || '-' || substr(t, 4, 2) || '-' || substr(t, 1, 2) as date) as string), '') when regexp_matches(t, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') then coalesce(cast(try_cast(t as date) as string), '') else '' end"


@query("document_dates", f"select o_orderkey, {_DOC} as iso, case when {_DOC} <> '' then {_DOC} || 'T00:00:00+00:00' end as stamp from (select o_orderkey, {_dates_in('duckdb')} as t from orders)")
def document_dates(spark, sf):
    (o,) = tables(spark, sf, "orders")
    t = F.expr(_dates_in("spark"))
    return o.select("o_orderkey", D.document_date(t).alias("iso"), D.export_timestamp(t).alias("stamp"))


@query("official_urls", "select page_id, regexp_matches(h, '(contraloria|infoprobidad)[.]cl$') as official, h in ('contraloria.cl', 'infoprobidad.cl') or regexp_matches(h, '[.](contraloria|infoprobidad)[.]cl$') as official_strict from (select page_id, lower(regexp_extract(u, '^[A-Za-z]+://([^/?#:]*)', 1)) as h from (select page_id, case page_id % 4 when 0 then 'https://www.contraloria.cl/x' when 1 then 'http://malacontraloria.cl/' when 2 then 'https://infoprobidad.cl?x=1' else url end as u from pages))")
def official_urls(spark, sf):
    (p,) = tables(spark, sf, "pages")
    u = F.expr("case page_id % 4 when 0 then 'https://www.contraloria.cl/x' when 1 then 'http://malacontraloria.cl/' when 2 then 'https://infoprobidad.cl?x=1' else url end")
    return p.select("page_id", I.official_url(u).alias("official"), I.official_url(u, strict=True).alias("official_strict"))


_AUDIT_IN = "case page_id % 4 when 0 then 'https://h/buscadorpdf/auditoria/' || upper(md5(url)) || '/html' when 1 then 'https://h/x?docIdcm=' || substr(md5(url), 1, 8) || '-' || substr(md5(url), 9, 24) when 2 then 'https://h/x?docIdcm=' || substr(md5(url), 1, 30) || 'zz' else url end"


@query("audit_hashes", f"select page_id, case page_id % 4 when 0 then md5(url) else '' end as modern, case when page_id % 4 < 2 then md5(url) else '' end as any_form, case page_id % 4 when 0 then 'https://www.contraloria.cl/buscadorpdf/auditoria/' || md5(url) || '/html' else '' end as canonical from pages")
def audit_hashes(spark, sf):
    (p,) = tables(spark, sf, "pages")
    u = F.expr(_AUDIT_IN)
    return p.select("page_id", I.audit_hash(u).alias("modern"), I.legacy_audit_hash(u).alias("any_form"), I.canonical_audit_url(u).alias("canonical"))


_CELL = "case (p_partkey + i) % 9 when 0 then 'Oportunamente' when 1 then 'No aplica' when 2 then 'menos de 20' when 3 then '100% todos los informes' when 4 then 'menos del 50%' when 5 then 'Ha actualizado correctamente' when 6 then 'incumplimiento' when 7 then 'No ha informado' else '' end"


def _status_case() -> str:
    parts = []
    for code, tests in T.INDICATOR_STATUS:
        inner = " ".join(f"when {'starts_with' if kind == 'starts' else 'contains'}(x, {lit(text)}) then '{value}'" for kind, text, value in tests)
        parts.append(f"when code = '{code}' then case {inner} else 'OTHER' end")
    return f"case when x = '' then 'UNKNOWN' when contains(x, 'no aplica') then 'NA' {' '.join(parts)} else 'OTHER' end"


@query("semaforo_melt", f"select p_partkey, code, {_status_case()} as status from (select p_partkey, case i " + " ".join(f"when {i} then '{c}'" for i, (c, _) in enumerate(T.INDICATORS)) + f" end as code, lower({_CELL}) as x from part, (select unnest(range(8)) as i))")
def semaforo_melt(spark, sf):
    (p,) = tables(spark, sf, "part")
    cells = F.array(*[F.struct(F.lit(c).alias("code"), F.expr(_CELL.replace("+ i)", f"+ {i})")).alias("raw")) for i, (c, _) in enumerate(T.INDICATORS)])
    rows = p.select("p_partkey", F.explode(cells).alias("c")).select("p_partkey", "c.*")
    return rows.select("p_partkey", "code", ops.indicator_status(F.col("code"), F.col("raw")).alias("status"))


@query("semaforo_histogram", f"select code, status, count(*) as n from (select code, {_status_case()} as status from (select case i " + " ".join(f"when {i} then '{c}'" for i, (c, _) in enumerate(T.INDICATORS)) + f" end as code, lower({_CELL}) as x from part, (select unnest(range(8)) as i))) group by 1, 2")
def semaforo_histogram(spark, sf):
    return semaforo_melt(spark, sf).groupBy("code", "status").agg(F.count("*").alias("n"))


@query("month_calendar", "select strftime(m, '%Y-%m') as window_id, cast(cast(m as date) as string) as date_from, cast(last_day(cast(m as date)) as string) as date_to, '01/' || strftime(m, '%m/%Y') as from_text, strftime(last_day(cast(m as date)), '%d/%m/%Y') as to_text, count(o_orderkey) as orders from (select unnest(generate_series(timestamp '1992-01-01', timestamp '2001-03-01', interval 1 month)) as m) left join orders on strftime(o_orderdate, '%Y-%m') = strftime(m, '%Y-%m') group by m")
def month_calendar(spark, sf):
    """Search windows with the days that a search form takes, and the orders that fall into each."""
    (o,) = tables(spark, sf, "orders")
    months = o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("window_id")).agg(F.count("*").alias("orders"))
    out = D.month_windows(spark, 1992, 2001, 3).join(months, "window_id", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))
    return out.select("window_id", "date_from", "date_to", D.search_day(F.col("date_from")).alias("from_text"), D.search_day(F.col("date_to")).alias("to_text"), "orders")


@query("interval_overlap", "select o_orderkey, case when coalesce(a, b) is null then false else coalesce(a, b) <= '1997-06-30' and coalesce(b, a) >= '1996-01-15' end as inside from (select o_orderkey, case when o_orderkey % 4 < 2 then strftime(o_orderdate, '%Y-%m-%d') end as a, case when o_orderkey % 4 in (0, 2) then strftime(o_orderdate + interval 40 day, '%Y-%m-%d') end as b from orders)")
def interval_overlap(spark, sf):
    (o,) = tables(spark, sf, "orders")
    a = F.expr("case when o_orderkey % 4 < 2 then date_format(o_orderdate, 'yyyy-MM-dd') else '' end")
    b = F.expr("case when o_orderkey % 4 in (0, 2) then date_format(o_orderdate + interval 40 day, 'yyyy-MM-dd') else '' end")
    return o.select("o_orderkey", D.overlaps(a, b, "1996-01-15", "1997-06-30").alias("inside"))


def _occurrence(spark, sf):
    return temporal.with_occurrence(findings(spark, sf), doc_date=None)


def _words(col: str, words: tuple[str, ...]) -> str:
    return " or ".join(f"contains({col}, '{x}')" for x in words)


# a refused range leaves its first day to the step of single days, whose context begins elsewhere
_OCC = f"""with f as (select finding_id, organization_id, o_orderkey % 11 as k, lower(trim(description)) as t from ({finding_sql('duckdb')})),
m as (select *, case k when 1 then 'durante el año 2019' when 2 then 'en marzo de 2020' when 3 then 'el día 5 de mayo de 2018' when 4 then 'entre el 1 de enero de 2017 y el 30 de junio de 2018' when 6 then 'con fecha 12/03/2019' when 7 then 'en los años 2015 y 2016' when 10 then 'al 31 de diciembre de 2016' end as hit from f),
w as (select *, substr(t, greatest(1, strpos(t, hit) - 85), len(hit) + 85 + least(85, strpos(t, hit) - 1)) as around from m),
g as (select *, hit is not null and not ({_words('around', T.NORMATIVE_WORDS)}) and not (k in (3, 6, 10) and ({_words('around', T.FUTURE_WORDS)})) as first_ok from w),
v as (select *, case when k = 4 and not first_ok then substr(t, greatest(1, strpos(t, 'el 1 de enero de 2017') - 85), 21 + 85 + least(85, strpos(t, 'el 1 de enero de 2017') - 1)) end as day_around from g),
u as (select *, day_around is not null and not ({_words('day_around', T.NORMATIVE_WORDS + T.FUTURE_WORDS)}) as day_ok from v),
o as (select finding_id, organization_id,
 case when day_ok then '2017-01-01' when not first_ok then '' else case k when 1 then '2019-01-01' when 2 then '2020-03-01' when 3 then '2018-05-05' when 4 then '2017-01-01' when 6 then '2019-03-12' when 7 then '2015-01-01' when 10 then '2016-12-31' end end as date_from,
 case when day_ok then '2017-01-01' when not first_ok then '' else case k when 1 then '2019-12-31' when 2 then '2020-03-31' when 3 then '2018-05-05' when 4 then '2018-06-30' when 6 then '2019-03-12' when 7 then '2016-12-31' when 10 then '2016-12-31' end end as date_to,
 case when day_ok then 'EXACT' when not first_ok then 'UNKNOWN' else case k when 1 then 'YEAR' when 2 then 'MONTH' when 3 then 'EXACT' when 4 then 'RANGE' when 6 then 'EXACT' when 7 then 'YEAR_RANGE' when 10 then 'AS_OF_DATE' end end as precision from u)"""


@query("occurrence_cascade", f"{_OCC} select finding_id, date_from, date_to, precision from o")
def occurrence_cascade(spark, sf):
    return _occurrence(spark, sf).select("finding_id", F.col("occurrence.from").alias("date_from"), F.col("occurrence.to").alias("date_to"), F.col("occurrence.precision").alias("precision"))


@query("temporal_precision", f"{_OCC} select precision, count(*) as n, cast(round_even(cast(100 as double) * count(*) / sum(count(*)) over (), 1) as double) as pct from o group by 1")
def temporal_precision(spark, sf):
    return marts.temporal_summary(_occurrence(spark, sf))[1]


@query("temporal_years", f"{_OCC} select substr(date_to, 1, 4) as year, count(*) as n from o where date_to <> '' group by 1")
def temporal_years(spark, sf):
    return marts.temporal_summary(_occurrence(spark, sf))[0]


@query("occurrence_bounds", f"{_OCC} select organization_id, coalesce(min(nullif(date_from, '')), '') as first_day, coalesce(max(nullif(date_to, '')), '') as last_day from o group by 1")
def occurrence_bounds(spark, sf):
    return marts.occurrence_bounds(_occurrence(spark, sf), "organization_id")


@query("explore_temporal", f"{_OCC} select finding_id from o where date_from <> '' and date_from <= '2018-12-31' and date_to >= '2018-01-01' and precision = 'EXACT'")
def explore_temporal(spark, sf):
    return explore.temporal(_occurrence(spark, sf), "2018-01-01", "2018-12-31", "EXACT").select("finding_id")
