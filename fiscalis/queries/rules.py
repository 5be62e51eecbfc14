"""Queries over classified findings: rules, scores, alerts, profiles, top lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from fiscalis.functions.dates import document_date
from fiscalis.operators import findings as ops
from fiscalis.plans import marts
from fiscalis.queries.synthetic import any_sql, classified, classified_sql, lit, list_sql, relevance_sql
from fiscalis.rules import tables as T

C = classified_sql()
QUERIES, SQL = {}, {}


def query(name: str, sql: str | None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


@query("aml_scores", f"{C} select finding_id, risk_code, risk_family, cast(aml_score as int) as aml_score, case when aml_score >= 80 then 'HIGH' when aml_score >= 55 then 'MEDIUM' else 'LOW' end as aml_relevance, case when aml_score >= 90 then 'CRITICAL' when aml_score >= 75 then 'HIGH' when aml_score >= 50 then 'MEDIUM' else 'LOW' end as severity from c")
def aml_scores(spark, sf):
    c = classified(spark, sf)
    return c.select("finding_id", F.col("risk.code").alias("risk_code"), F.col("risk.family").alias("risk_family"), F.col("risk.score").alias("aml_score"), F.col("risk.relevance").alias("aml_relevance"), F.col("risk.severity").alias("severity"))


@query("enforcement_labels", f"{C} select finding_id, array_to_string(enforcement, ',') as labels, list_contains(enforcement, 'REPARO') as reparo from c")
def enforcement_labels(spark, sf):
    return classified(spark, sf).select("finding_id", F.array_join("enforcement", ",").alias("labels"), F.array_contains("enforcement", "REPARO").alias("reparo"))


_STAGE = "case t " + " ".join(f"when '{k}' then '{v}'" for k, v in T.ENFORCEMENT_STAGES) + " end"


@query("enforcement_events", f"{C} select finding_id, t as enforcement_type, {_STAGE} as stage, 'ENF-' || substr(sha256(finding_id || '|' || t), 1, 20) as enforcement_event_id, case when t = 'REPARO' then 'PENDING_TRIBUNAL_LINK' else 'NOT_APPLICABLE' end as tribunal_link_status, substr(document_date, 7, 4) || '-' || substr(document_date, 4, 2) || '-' || substr(document_date, 1, 2) as action_date from (select finding_id, document_date, unnest(enforcement) as t from c) where t <> 'FOLLOW_UP'")
def enforcement_events(spark, sf):
    c = classified(spark, sf).withColumn("action_date", document_date(F.col("document_date")))
    return ops.enforcement_events(c).select("finding_id", "enforcement_type", "stage", "enforcement_event_id", "tribunal_link_status", "action_date")


@query("enforcement_counts", f"{C} select t as enforcement_type, count(*) as n, cast(coalesce(sum(amount_clp), 0) as bigint) as amount from (select unnest(enforcement) as t, amount_clp from c) group by 1")
def enforcement_counts(spark, sf):
    rows = classified(spark, sf).select(F.explode_outer("enforcement").alias("enforcement_type"), "amount_clp").filter("enforcement_type is not null")
    return rows.groupBy("enforcement_type").agg(F.count("*").alias("n"), F.coalesce(F.sum("amount_clp"), F.lit(0)).alias("amount"))


_IRR = "case code " + " ".join(f"when '{r[0]}' then {{}}" for r in T.IRREGULARITY_RULES) + " end"


@query("irregularities_exploded", f"{C} select finding_id, code, {_IRR.format(*[lit(r[1]) for r in T.IRREGULARITY_RULES])} as label, {_IRR.format(*[lit(r[2]) for r in T.IRREGULARITY_RULES])} as family, cast({_IRR.format(*[r[3] for r in T.IRREGULARITY_RULES])} as int) as weight, 'IRR-' || substr(sha256(finding_id || '|' || code), 1, 20) as irregularity_id from (select finding_id, unnest(codes) as code from c)")
def irregularities_exploded(spark, sf):
    return ops.irregularity_rows(classified(spark, sf)).select("finding_id", "code", "label", "family", "weight", "irregularity_id")


@query("penal_hypotheses", f"{C}, h as (select finding_id, unnest(hyp_codes) as code, unnest(hyp_scores) as s, list_contains(enforcement, 'CRIMINAL_REFERRAL') as r from c) select finding_id, code, cast(s as int) as score, {relevance_sql('s')} as relevance, case when r then 'EXPLICIT_CGR_REFERRAL' when s >= 70 then 'STRONG_INDICATORS' else 'ANALYTICAL_HYPOTHESIS' end as evidence_level, cast(case when r then 1 else 2 end as int) as n_limits from h")
def penal_hypotheses(spark, sf):
    return ops.hypothesis_rows(classified(spark, sf)).select("finding_id", "code", "score", "relevance", "evidence_level", F.size("limitations").alias("n_limits"))


@query("cgr_scores", f"{C} select finding_id, cast(cgr_score as int) as cgr_score, cast(penal_score as int) as penal_score, {relevance_sql('penal_score')} as penal_relevance, cast(greatest(cgr_score, penal_score, aml_score) as int) as priority_score from c")
def cgr_scores(spark, sf):
    return classified(spark, sf).select("finding_id", "cgr_score", "penal_score", "penal_relevance", "priority_score")


@query("roles_detected", f"{C} select finding_id, array_to_string({list_sql([(any_sql('description', (p,)), lit(n)) for n, p in T.ROLE_RULES])}, ',') as roles from c")
def roles_detected(spark, sf):
    return classified(spark, sf).select("finding_id", F.array_join(ops.roles(F.col("description")), ",").alias("roles"))


def _alert_sql() -> str:
    labels = "array_to_string(list_sort(list_distinct(" + list_sql([(f"list_contains(codes, '{r[0]}')", lit(r[1])) for r in T.IRREGULARITY_RULES]) + ")), ' ')"
    parts = []
    for code, label, _, _, patterns in T.ALERT_PATTERNS:
        basis = list_sql([(any_sql("t", (p,)), f"substr(regexp_extract(t, {lit('(?is)' + p)}, 0), 1, 120)") for p in patterns])
        parts.append(f"select finding_id, cgr_score, '{code}' as pattern_code, {lit(label)} as pattern_label, {basis} as found from a")
    return f"""{C}, a as (select *, description || ' ' || {labels} as t from c), m as ({' union all '.join(parts)})
select finding_id, pattern_code, pattern_label, cast(least(100, least(100, 40 + 14 * len(found)) + case when cgr_score >= 75 then 8 else 0 end) as int) as score,
 array_to_string(list_slice(list_sort(list_distinct(found)), 1, 8), '; ') as basis, 'FAU-' || substr(sha256(finding_id || '|' || pattern_code), 1, 20) as fau_match_id
from m where len(found) > 0"""


@query("fau_matches", _alert_sql())
def fau_matches(spark, sf):
    m = ops.alert_matches(classified(spark, sf))
    return m.select("finding_id", "pattern_code", "pattern_label", "score", F.array_join("match_basis", "; ").alias("basis"), "fau_match_id")


_RECURRENCE = "least(100, findings * 3 + documents * 6 + penal_high * 6 + criminal_referrals * 12 + reparos * 8 + providers * 2)"
_ORG = f"""{C}, o as (select organization_id, count(*) as findings, count(distinct document_id) as documents, count(distinct provider_id) as providers,
 cast(sum(coalesce(amount_clp, 0)) as bigint) as amount, max(cgr_score) as cgr_max, max(penal_score) as penal_max, max(aml_score) as aml_max,
 count_if(penal_score >= 75) as penal_high, count_if(list_contains(enforcement, 'DISCIPLINARY')) as disciplinary, count_if(list_contains(enforcement, 'REPARO')) as reparos,
 count_if(list_contains(enforcement, 'CRIMINAL_REFERRAL')) as criminal_referrals, count_if(list_contains(enforcement, 'CDE_REFERRAL')) as cde_referrals from c group by 1),
p as (select organization_id, cast(findings as bigint) as findings, cast(documents as bigint) as documents, cast(providers as bigint) as providers, amount, cast(cgr_max as int) as cgr_max,
 cast(penal_max as int) as penal_max, cast(aml_max as int) as aml_max, cast(penal_high as bigint) as penal_high, cast(disciplinary as bigint) as disciplinary, cast(reparos as bigint) as reparos,
 cast(criminal_referrals as bigint) as criminal_referrals, cast(cde_referrals as bigint) as cde_referrals, cast({_RECURRENCE} as bigint) as recurrence_score,
 cast(least(100, round_even(cast(0.55 as double) * cgr_max + cast(0.25 as double) * penal_max + cast(0.20 as double) * {_RECURRENCE}, 0)) as bigint) as priority_score from o)"""


@query("org_profiles", f"{_ORG} select * from p")
def org_profiles(spark, sf):
    return marts.organization_profiles(classified(spark, sf))


@query("flagship_org_risk_profile", f"{_ORG} select * from p order by priority_score desc, findings desc, organization_id limit 250")
def flagship_org_risk_profile(spark, sf):
    return marts.top_organizations(classified(spark, sf))


@query("provider_profiles", f"{C}, o as (select provider_id, count(*) as findings, count(distinct document_id) as documents, count(distinct organization_id) as organizations, cast(sum(coalesce(amount_clp, 0)) as bigint) as amount, count_if(penal_score >= 75) as penal_high from c group by 1) select provider_id, cast(findings as bigint) as findings, cast(documents as bigint) as documents, cast(organizations as bigint) as organizations, amount, cast(penal_high as bigint) as penal_high, cast(least(100, organizations * 15 + documents * 8 + findings * 4 + penal_high * 8) as bigint) as exposure_score from o")
def provider_profiles(spark, sf):
    return marts.provider_profiles(classified(spark, sf))


@query("region_profiles", f"{C}, r as (select c.*, case when n_name is null or o_custkey % 11 = 0 then 'Sin región' else n_name end as region from c left join customer on c_custkey = o_custkey left join nation on n_nationkey = c_nationkey) select region, count(*) as findings, count(distinct organization_id) as organizations, count(distinct document_id) as documents, cast(sum(coalesce(amount_clp, 0)) as bigint) as amount, cast(count_if(penal_score >= 75) as bigint) as penal_high from r group by 1")
def region_profiles(spark, sf):
    customer, nation = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("customer", "nation"))
    c = classified(spark, sf).join(customer.select("c_custkey", "c_nationkey"), F.col("c_custkey") == F.col("o_custkey"), "left")
    c = c.join(nation.select("n_nationkey", "n_name"), F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return marts.region_profiles(c.withColumn("region", F.when(F.col("o_custkey") % 11 == 0, F.lit("")).otherwise(F.col("n_name"))))


@query("top_irregularities_per_org", f"{C}, x as (select organization_id, code, count(*) as n, min(finding_id) as first_id, min(pos) as p from (select organization_id, finding_id, unnest(codes) as code, generate_subscripts(codes, 1) as pos from c) group by 1, 2), fp as (select e.organization_id, e.code, min(e.pos) as pos from (select organization_id, finding_id, unnest(codes) as code, generate_subscripts(codes, 1) as pos from c) e join x on x.organization_id = e.organization_id and x.code = e.code and x.first_id = e.finding_id group by 1, 2), r as (select x.*, row_number() over (partition by x.organization_id order by x.n desc, x.first_id, fp.pos) as rank from x join fp using (organization_id, code)) select organization_id, code, cast(n as bigint) as n, cast(rank as int) as rank from r where rank <= 6")
def top_irregularities_per_org(spark, sf):
    return marts.top_labels(classified(spark, sf), "organization_id", "irregularity_codes", 6)


@query("kpis", f"{C} select count(*) as findings, count(distinct document_id) as documents, count(distinct organization_id) as organizations, count(distinct provider_id) as providers, cast(count_if(aml_score >= 80) as bigint) as aml_high, cast(count_if(penal_score >= 75) as bigint) as penal_high, cast(count_if(list_contains(enforcement, 'CRIMINAL_REFERRAL')) as bigint) as criminal_referrals, cast(count_if(list_contains(enforcement, 'REPARO')) as bigint) as reparos, cast(sum(coalesce(amount_clp, 0)) as bigint) as amount from c")
def kpis(spark, sf):
    return marts.kpis(classified(spark, sf))


@query("findings_top", f"{C} select finding_id, cast(greatest(cgr_score, penal_score, aml_score) as int) as priority_score from c order by priority_score desc, finding_id desc limit 250")
def findings_top(spark, sf):
    return marts.top_findings(classified(spark, sf)).select("finding_id", "priority_score")


@query("penal_cases_top", f"{C}, h as (select finding_id, organization_id, amount_clp, unnest(hyp_codes) as code, unnest(hyp_scores) as s from c), i as (select *, 'PNL-' || substr(sha256(finding_id || '|' || code), 1, 20) as hypothesis_id from h) select hypothesis_id, finding_id, code, cast(s as int) as score, organization_id, amount_clp from i order by score desc, hypothesis_id limit 250")
def penal_cases_top(spark, sf):
    c = classified(spark, sf)
    return marts.top_cases(ops.hypothesis_rows(c), c.select("finding_id", "organization_id", "amount_clp")).select("hypothesis_id", "finding_id", "code", "score", "organization_id", "amount_clp")


@query("explore_findings", f"{C} select finding_id from c where contains(lower(description || ' ' || organization_id), 'proveedor') and penal_score >= 50")
def explore_findings(spark, sf):
    from fiscalis.plans import explore

    return explore.findings(classified(spark, sf), q="Proveedor", columns=("description", "organization_id"), min_penal=50).select("finding_id")


@query("explore_point_lookup", f"{C} select finding_id, cast(cgr_score as int) as cgr_score from c where organization_id = 'O-7'")
def explore_point_lookup(spark, sf):
    return classified(spark, sf).filter(F.col("organization_id") == "O-7").select("finding_id", "cgr_score")
