"""Queries over joins, remaps, set operations and the export."""

from __future__ import annotations

from pyspark.sql import functions as F

from fiscalis.functions import text as X
from fiscalis.operators import entities, linking
from fiscalis.plans import interop
from fiscalis.queries.scalars import name_sql
from fiscalis.queries.synthetic import classified, classified_sql, tables
from fiscalis.rules import tables as T

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _token_sql(expr: str, min_len: int, digits: bool, stop: tuple[str, ...]) -> str:
    words = ", ".join(f"'{w}'" for w in stop)
    num = "" if digits else " and not regexp_matches(x, '^[0-9]+$')"
    return f"list_distinct(list_filter(string_split({name_sql(expr)}, ' '), lambda x: len(x) >= {min_len} and x not in ({words}){num}))"


_LEFT = "select item_id as id, replace(coalesce(text, ''), 'ß', 'ss') as t from benchmark"
_RIGHT = "select doc_id as id, replace(coalesce(text, ''), 'ß', 'ss') as t from documents"


def _pairs_sql(min_len: int, digits: bool, stop: tuple[str, ...], floor: int, threshold: float) -> str:
    return f"""with l as (select id, {_token_sql('t', min_len, digits, stop)} as w from ({_LEFT})), r as (select id, {_token_sql('t', min_len, digits, stop)} as w from ({_RIGHT})),
p as (select l.id as left_id, r.id as right_id, len(list_intersect(l.w, r.w)) as common, least(len(l.w), len(r.w)) as small from l, r),
q as (select left_id, right_id, common, cast(common as double) / greatest(small, 1) as score from p where common >= {floor} and cast(common as double) / greatest(small, 1) >= {threshold})"""


def _sides(spark, sf, min_len, digits, stop):
    b, d = tables(spark, sf, "benchmark", "documents")
    left, right = b.select(F.col("item_id").alias("id"), "text"), d.select(F.col("doc_id").alias("id"), "text")
    return tuple(x.select("id", X.name_tokens(F.col("text"), min_len, stop, digits).alias("tokens")) for x in (left, right))


@query("token_overlap_best", f"{_pairs_sql(4, False, T.WATCH_STOP, 2, 0.62)} select left_id, right_id, score from (select *, row_number() over (partition by left_id order by score desc, right_id) as k from q) where k = 1")
def token_overlap_best(spark, sf):
    left, right = _sides(spark, sf, 4, False, T.WATCH_STOP)
    return linking.best_match(linking.token_overlap(left, right, "id", "id", "tokens", 2, 0.62)).select("left_id", "right_id", "score")


@query("token_overlap_all", f"{_pairs_sql(3, True, T.TRIBUNAL_STOP, 1, 0.55)} select left_id, array_to_string(list_sort(list(right_id)), ',') as right_ids, max(score) as score from q group by 1")
def token_overlap_all(spark, sf):
    left, right = _sides(spark, sf, 3, True, T.TRIBUNAL_STOP)
    out = linking.all_matches(linking.token_overlap(left, right, "id", "id", "tokens", 1, 0.55))
    return out.select("left_id", F.array_join(F.transform("right_ids", lambda x: x.cast("string")), ",").alias("right_ids"), "score")


_S = f"select s_suppkey, {name_sql('s_name')} as n from supplier"
_CN = "select 'SUPPLIER ' || substr(c_name, 10) as n from customer where c_custkey % 3 = 0 union all select 'OTHER ' || substr(c_name, 10) from customer where c_custkey % 3 <> 0"


def _names(spark, sf):
    s, c = tables(spark, sf, "supplier", "customer")
    providers = s.select("s_suppkey", X.normalize_name(F.col("s_name")).alias("normalized_name"))
    public = c.select(X.normalize_name(F.replace("c_name", F.lit("Customer"), F.when(F.col("c_custkey") % 3 == 0, "Supplier").otherwise("Other"))).alias("normalized_name"))
    return providers, public


@query("semi_collisions", f"select s_suppkey from ({_S}) where n in ({_CN})")
def semi_collisions(spark, sf):
    return entities.collisions(*_names(spark, sf)).select("s_suppkey")


@query("anti_join_quality_gate", f"select s_suppkey from ({_S}) where n not in ({_CN})")
def anti_join_quality_gate(spark, sf):
    return entities.without_collisions(*_names(spark, sf)).select("s_suppkey")


_MAP = "select s_suppkey, unnest(case when s_suppkey % 5 = 0 then cast([] as bigint[]) when s_suppkey % 5 = 1 then [s_suppkey + 1000, s_suppkey + 2000] else [s_suppkey + 1000] end) as target from (select s_suppkey * 2 as s_suppkey from supplier)"


@query("provider_remap_fanout", f"with e as (select distinct l_orderkey, l_suppkey from lineitem), m as ({_MAP}), k as (select s_suppkey * 2 as s_suppkey from supplier) select distinct l_orderkey, cast(coalesce(m.target, e.l_suppkey) as bigint) as provider from e left join k on k.s_suppkey = l_suppkey left join m on m.s_suppkey = l_suppkey where k.s_suppkey is null or m.target is not null")
def provider_remap_fanout(spark, sf):
    li, s = tables(spark, sf, "lineitem", "supplier")
    edges = li.select(F.col("l_orderkey").alias("edge_id"), F.col("l_suppkey").alias("id")).distinct()
    target = F.when(F.col("s_suppkey") % 5 == 0, F.array().cast("array<bigint>")).when(F.col("s_suppkey") % 5 == 1, F.array(F.col("s_suppkey") + 1000, F.col("s_suppkey") + 2000)).otherwise(F.array(F.col("s_suppkey") + 1000))
    mapping = s.select((F.col("s_suppkey") * 2).alias("s_suppkey")).withColumn("targets", target).select(F.col("s_suppkey").alias("id"), "targets")
    return entities.remap(edges, mapping, "id").select(F.col("edge_id").alias("l_orderkey"), F.col("id").alias("provider")).distinct()


@query("provider_election", "select grp, name from (select p_partkey % 50 as grp, n as name, row_number() over (partition by p_partkey % 50 order by case when upper(n) like 'DE %' or upper(n) like 'DEL %' or upper(n) like 'LA %' or upper(n) like 'EMPRESA %' then 1 else 0 end, len(regexp_extract_all(lower(n), '(^| )(y|e)( |$)')), len(n), n) as k from (select p_partkey, case p_partkey % 3 when 0 then 'De ' || p_name when 1 then p_name || ' y Cia' else p_name end as n from part)) where k = 1")
def provider_election(spark, sf):
    (p,) = tables(spark, sf, "part")
    name = F.expr("case p_partkey % 3 when 0 then 'De ' || p_name when 1 then p_name || ' y Cia' else p_name end")
    return entities.elect_names(p.select((F.col("p_partkey") % 50).alias("grp"), name.alias("name")), "grp", "name")


@query("evidence_fallback_union", "select cast(doc_id as string) as document_id, 'E' || cast(doc_id as string) as evidence_id, false as synthetic from labels union all select cast(doc_id as string), 'EVD-' || substr(sha256('DOCUMENT|' || cast(doc_id as string)), 1, 20), true from documents where doc_id not in (select doc_id from labels)")
def evidence_fallback_union(spark, sf):
    d, lab = tables(spark, sf, "documents", "labels")
    docs = d.select(F.col("doc_id").cast("string").alias("document_id"), F.col("source").alias("source_url"))
    ev = lab.select(F.col("doc_id").cast("string").alias("document_id"), F.concat(F.lit("E"), F.col("doc_id")).alias("evidence_id"), F.lit("").alias("source_url"))
    return interop.with_fallback_evidence(docs, ev).select("document_id", "evidence_id", "synthetic")


@query("relationship_promotion", "select o_orderkey, 'G' || cast(o_custkey as string) as source_global_id, 'G' || cast(l_suppkey as string) as target_global_id from (select distinct o_orderkey, o_custkey, o_orderstatus, l_suppkey from orders join lineitem on l_orderkey = o_orderkey) where o_custkey % 3 <> 0 and l_suppkey % 4 <> 0 and o_orderstatus <> 'F'")
def relationship_promotion(spark, sf):
    o, li = tables(spark, sf, "orders", "lineitem")
    rel = o.join(li, F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", F.concat(F.lit("C"), F.col("o_custkey")).alias("source_entity_id"), F.concat(F.lit("S"), F.col("l_suppkey")).alias("target_entity_id"), F.col("o_orderkey").alias("evidence_id")).distinct()
    c = o.select("o_custkey").distinct().select(F.concat(F.lit("C"), F.col("o_custkey")).alias("source_entity_id"), F.when(F.col("o_custkey") % 3 != 0, F.concat(F.lit("G"), F.col("o_custkey"))).alias("entity_id"))
    s = li.select("l_suppkey").distinct().select(F.concat(F.lit("S"), F.col("l_suppkey")).alias("source_entity_id"), F.when(F.col("l_suppkey") % 4 != 0, F.concat(F.lit("G"), F.col("l_suppkey"))).alias("entity_id"))
    ev = o.filter("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("evidence_id"))
    return interop.promote_relationships(rel, c.unionByName(s), ev).select("o_orderkey", "source_global_id", "target_global_id")


@query("array_setops", "select l_orderkey, len(list_distinct(a || b)) as u, len(list_intersect(list_distinct(a), list_distinct(b))) as i, array_to_string(list_sort(list_distinct(a)), ',') as parts from (select l_orderkey, list(l_suppkey) as a, list(l_partkey % 100) as b from lineitem group by 1)")
def array_setops(spark, sf):
    (li,) = tables(spark, sf, "lineitem")
    g = li.groupBy("l_orderkey").agg(F.collect_list("l_suppkey").alias("a"), F.collect_list(F.col("l_partkey") % 100).alias("b"))
    parts = F.array_join(F.transform(F.array_sort(F.array_distinct("a")), lambda x: x.cast("string")), ",")
    return g.select("l_orderkey", F.size(F.array_union("a", "b")).cast("bigint").alias("u"), F.size(F.array_intersect("a", "b")).cast("bigint").alias("i"), parts.alias("parts"))


@query("set_union_except", "select s_nationkey as k, 'both' as side from supplier intersect select c_nationkey, 'both' from customer union all (select n_nationkey, 'none' from nation except select s_nationkey, 'none' from supplier)")
def set_union_except(spark, sf):
    s, c, n = tables(spark, sf, "supplier", "customer", "nation")
    both = s.select(F.col("s_nationkey").alias("k")).intersect(c.select("c_nationkey"))
    none = n.select(F.col("n_nationkey").alias("k")).join(s.select(F.col("s_nationkey").alias("k")), "k", "left_anti")
    return both.withColumn("side", F.lit("both")).unionByName(none.withColumn("side", F.lit("none")))


@query("page_titles", "select page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g')) as title from pages")
def page_titles(spark, sf):
    from fiscalis.sources.html import title

    (p,) = tables(spark, sf, "pages")
    return p.select("page_id", title(F.col("html")).alias("title"))


@query("page_links", "select page_id, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) as href from pages")
def page_links(spark, sf):
    from fiscalis.sources.html import links

    (p,) = tables(spark, sf, "pages")
    return links(p.select("page_id", "html"), "page_id").select("page_id", "href")


@query("page_text", None)
def page_text(spark, sf):
    from fiscalis.sources.html import visible_text

    (p,) = tables(spark, sf, "pages")
    return visible_text(p.select("page_id", "html"), "page_id")


@query("provider_mentions", None)
def provider_mentions(spark, sf):
    c = classified(spark, sf).select("finding_id", F.concat_ws(" ", "description", F.expr("case o_orderkey % 3 when 0 then 'Se pagó a Constructora Los Andes Ltda. por la licitación' when 1 then 'Transferencia a Fundación Nueva Vida' else 'sin empresa' end")).alias("text"))
    return entities.provider_mentions(c, "finding_id", "text")


@query("high_risk_documents", f"{classified_sql()} select document_id, cast(max(greatest(cgr_score, penal_score, aml_score)) as int) as score, count(*) as n from c group by 1 having max(greatest(cgr_score, penal_score, aml_score)) >= 90")
def high_risk_documents(spark, sf):
    c = classified(spark, sf)
    return c.groupBy("document_id").agg(F.max("priority_score").alias("score"), F.count("*").alias("n")).filter("score >= 90")
