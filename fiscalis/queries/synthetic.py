"""Findings made from the order tables, by one SQL text that both engines run, and SQL forms of the rule operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalis.functions.text import max_amount
from fiscalis.operators import findings as ops
from fiscalis.rules import tables as T

#: Sentences that touch the rule families; invented.
SENTENCES = (
    "Se verificaron pagos improcedentes a un proveedor del municipio", "Existe un conflicto de interés entre la jefatura y la empresa contratada",
    "La licitación pública se adjudicó sin respaldo de la comisión", "Los fondos públicos se usaron para fines distintos a los autorizados",
    "Se constató una debilidad de control en la supervisión de bodega", "El inventario de bienes inmuebles presenta diferencias",
    "Los honorarios de funcionarios carecen de informes de desempeño", "Se detectó una factura falsa y documentos falsos en la rendición",
    "El trato directo no contó con resolución fundada", "Saldos por cobrar y deuda morosa no contabilizada",
    "La prestación de servicios no se encuentra acreditada", "Hubo un pago en exceso a la empresa constructora",
    "El cónyuge de una funcionaria figura como socio del proveedor", "Las transferencias a la fundación están sin rendir",
    "Un funcionario habría recibido una coima", "Los vehículos fueron a remate sin antecedentes de respaldo",
    "Texto neutro sin observaciones de interés", "Se observó malversación y desvío de fondos municipales",
    "Beneficiarios que no cumplen requisitos del subsidio", "La contratación fue irregular por inhabilidad del oferente",
)
ACTIONS = (
    "", "Se instruyó un sumario administrativo", "La entidad formulará reparo", "Los antecedentes fueron remitidos al Ministerio Público",
    "Se dará cuenta al Consejo de Defensa del Estado", "Quedará en el sistema de seguimiento con plazo de 60 días",
    "Se ordena procedimiento disciplinario y reparo",
)
DATES = (
    "", "durante el año 2019", "en marzo de 2020", "el día 5 de mayo de 2018", "entre el 1 de enero de 2017 y el 30 de junio de 2018",
    "conforme a la ley vigente el 3 de abril de 2015", "con fecha 12/03/2019", "en los años 2015 y 2016", "el 31 de febrero de 2018", "deberá rendir al 30 de mayo de 2021",
    "al 31 de diciembre de 2016",
)


def registry():
    """A module's queries, their SQL, and the decorator that adds a query with its SQL (None: not expressible)."""
    queries, sqls = {}, {}

    def query(name: str, sql: str | None):
        def add(f):
            queries[name] = f
            if sql:
                sqls[name] = sql
            return f

        return add

    return queries, sqls, query


def _pick(expr: str, values: tuple[str, ...]) -> str:
    cases = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"(case cast({expr} as int) {cases} end)"


FINDINGS = f"""
select 'F-' || cast(o_orderkey as string) as finding_id,
 'D-' || cast(cast(floor(o_orderkey / 3) as bigint) as string) as document_id,
 'O-' || cast(o_custkey % 400 as string) as organization_id,
 'P-' || cast((o_orderkey * 7) % 211 as string) as provider_id,
 o_orderkey, o_custkey, o_orderstatus,
 {_pick(f"o_orderkey % {len(SENTENCES)}", SENTENCES)} || '. ' || {_pick(f"(o_custkey * 3) % {len(SENTENCES)}", SENTENCES)}
 || case when o_orderkey % 3 <> 0 then ' por $ ' || cast(cast(floor(o_totalprice) as bigint) * (1 + (o_custkey % 5) * 7919) as string) else '' end
 || ' ' || {_pick(f"o_orderkey % {len(DATES)}", DATES)} || '. ' || {_pick(f"(o_orderkey + o_custkey) % {len(ACTIONS)}", ACTIONS)} as description,
 {{dmy}} as document_date
from orders
"""


def finding_sql(engine: str) -> str:
    return FINDINGS.format(dmy="date_format(o_orderdate, 'dd-MM-yyyy')" if engine == "spark" else "strftime(o_orderdate, '%d-%m-%Y')")


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]


def findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The synthetic findings with their amounts."""
    # narrow rows and costly patterns: a small file is one split, so deal its rows out before they are classified
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    orders = orders.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spark.sql(finding_sql("spark").replace("from orders", "from {orders}"), orders=orders).withColumn("amount_clp", max_amount(F.col("description")))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.classify(findings(spark, sf_dir))


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def any_sql(col: str, patterns: tuple[str, ...]) -> str:
    return "(" + " or ".join(f"regexp_matches({col}, {lit('(?is)' + p)})" for p in patterns) + ")"


def count_sql(col: str, patterns: tuple[str, ...]) -> str:
    return "(" + " + ".join(f"cast(regexp_matches({col}, {lit('(?is)' + p)}) as int)" for p in patterns) + ")"


def list_sql(tests: list[tuple[str, str]]) -> str:
    return "list_filter([" + ", ".join(f"case when {test} then {value} end" for test, value in tests) + "], lambda x: x is not null)"


AMOUNT_SQL = r"list_max(list_transform(regexp_extract_all(description, '\$\s*([0-9][0-9.,]{2,})', 1), lambda x: cast(regexp_replace(x, '[^0-9]', '', 'g') as bigint)))"
TIER_SQL = "(case when coalesce(amount_clp, 0) >= 1000000000 then 10 when coalesce(amount_clp, 0) >= 100000000 then 7 when coalesce(amount_clp, 0) >= 10000000 then 4 else 0 end)"


def relevance_sql(score: str) -> str:
    return f"(case when {score} >= 75 then 'HIGH' when {score} >= 50 then 'MEDIUM' when {score} > 0 then 'LOW' else 'NONE' end)"


def classified_sql() -> str:
    """Common table expressions ``f`` (findings), ``c`` (classified)."""
    low = "lower(description)"
    keys = [f"case when h{i} > 0 then least(100, {r[2]} + (h{i} - 1) * 4) * 16 + {15 - i} else 0 end" for i, r in enumerate(T.RISK_RULES)]
    hits = ", ".join(f"{count_sql(low, r[3])} as h{i}" for i, r in enumerate(T.RISK_RULES))
    total = " + ".join(f"h{i}" for i in range(len(T.RISK_RULES)))
    enforcement = list_sql([(any_sql("description", p), lit(n)) for n, p in T.ENFORCEMENT_RULES])
    codes = list_sql([(any_sql("description", r[4]), lit(r[0])) for r in T.IRREGULARITY_RULES])
    weights = list_sql([(any_sql("description", r[4]), str(r[3])) for r in T.IRREGULARITY_RULES])
    family = "case 15 - best % 16 " + " ".join(f"when {i} then {lit(r[1])}" for i, r in enumerate(T.RISK_RULES)) + " end"
    code = "case 15 - best % 16 " + " ".join(f"when {i} then {lit(r[0])}" for i, r in enumerate(T.RISK_RULES)) + " end"
    has = lambda a: f"list_contains(enforcement, '{a}')"
    overlap = lambda names: f"list_has_any(codes, [{', '.join(lit(n) for n in names)}])"
    tests = [
        overlap(ops.SPENDING),
        f"(list_contains(codes, 'PUBLIC_FUNDS_MISUSE') or {any_sql(low, (ops.MALVERSATION,))})",
        f"({overlap(ops.INTEREST)} and {any_sql(low, (ops.CONTRACTING,))})",
        any_sql(low, (ops.BRIBERY,)),
        any_sql(low, (ops.FALSE_DOCUMENT,)),
    ]
    tests.append(f"({has('CRIMINAL_REFERRAL')} and not ({' or '.join(tests)}))")
    extra = f"({TIER_SQL} + case when {has('CRIMINAL_REFERRAL')} then 15 else 0 end + case when {has('REPARO')} then 8 else 0 end + case when {has('DISCIPLINARY')} then 5 else 0 end)"
    hyp_codes = list_sql([(t, lit(h[0])) for t, h in zip(tests, ops.HYPOTHESES, strict=True)])
    hyp_scores = list_sql([(t, f"least(100, {h[2]} + {extra})") for t, h in zip(tests, ops.HYPOTHESES, strict=True)])
    cgr = f"least(100, coalesce(list_max(weights), 35) + {TIER_SQL} + case when {has('DISCIPLINARY')} then 6 else 0 end + case when {has('REPARO')} then 12 else 0 end + case when {has('CDE_REFERRAL')} then 8 else 0 end + case when {has('CRIMINAL_REFERRAL')} then 15 else 0 end)"
    return f"""
with f as (select *, {AMOUNT_SQL} as amount_clp from ({finding_sql('duckdb')})),
c0 as (select *, {enforcement} as enforcement, {codes} as codes, {weights} as weights, {hits} from f),
c1 as (select *, greatest(495, {', '.join(keys)}) as best, {hyp_codes} as hyp_codes, {hyp_scores} as hyp_scores, {cgr} as cgr_score from c0),
c as (select *, case when best > 495 then {family} else 'CONTROL_OR_COMPLIANCE' end as risk_family, case when best > 495 then {code} else 'GEN' end as risk_code,
 least(100, cast(floor(best / 16) as int) + case when amount_clp is not null then 4 else 0 end + case when {has('CRIMINAL_REFERRAL')} then 10 when len(enforcement) > 0 then 5 else 0 end + case when {total} >= 3 then 4 else 0 end) as aml_score,
 coalesce(list_max(hyp_scores), 0) as penal_score from c1)
"""
