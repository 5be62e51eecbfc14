"""Classification of findings: risk families, follow-up actions, irregularities, penal hypotheses, alerts, scores.

All of it is declared as expressions over the text column, so a finding is classified in one narrow stage; only the
exploded results add rows. Patterns are literals and so compiled once for each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalis.functions.text import any_match, count_matches, low_regex, pinned, regex, stable_id, text_or_empty
from fiscalis.rules import tables as T


def labels_of(low: Column, rules: tuple[tuple[str, tuple[str, ...]], ...]) -> Column:
    """Array of the labels with a pattern that matches a text in lower case, in table order."""
    return F.array_compact(F.array(*[F.when(any_match(low, p), F.lit(name)) for name, p in rules]))


def enforcement(text: Column) -> Column:
    """Follow-up actions named in a text."""
    return labels_of(F.lower(text_or_empty(text)), T.ENFORCEMENT_RULES)


def roles(text: Column) -> Column:
    return labels_of(F.lower(text_or_empty(text)), tuple((name, (p,)) for name, p in T.ROLE_RULES))


def datasets(text: Column) -> Column:
    """Codes of the data sets that a text names, in table order."""
    low = F.lower(text_or_empty(text))
    return F.array_compact(F.array(*[F.when(_has_any(low, terms), F.lit(code)) for code, terms in T.DATASETS]))


def _has_any(col: Column, terms: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for t in terms:
        out = out | col.contains(t)
    return out


def relevance(score: Column) -> Column:
    return F.when(score >= 75, "HIGH").when(score >= 50, "MEDIUM").when(score > 0, "LOW").otherwise("NONE")


def amount_bonus(amount: Column) -> Column:
    a = F.coalesce(amount, F.lit(0))
    return F.when(a >= 1_000_000_000, 10).when(a >= 100_000_000, 7).when(a >= 10_000_000, 4).otherwise(0)


def assess_risk(df: DataFrame, text: str, has_amount: Column, actions: str = "enforcement", out: str = "risk") -> DataFrame:
    """``df`` with ``struct<code, family, score, relevance, severity>`` of a finding.

    The best family by base score and 4 for each further pattern, capped; ties keep the earlier rule and nothing below
    30 counts. Then 4 for an amount, 10 for a referral to prosecution or else 5 for any action, 4 for three and more
    patterns in all. Intermediate results are columns, so each pattern is tried once.
    """
    low = F.lower(text_or_empty(F.col(text)))
    n = len(T.RISK_RULES)
    df = df.withColumn("__hits", F.array(*[count_matches(low, p) for _, _, _, p in T.RISK_RULES]))
    # one number orders candidates by score and then by place in the table
    keys = [
        F.when(F.col("__hits")[i] > 0, F.least(F.lit(100), F.lit(base) + (F.col("__hits")[i] - 1) * 4) * 16 + (15 - i)).otherwise(F.lit(0))
        for i, (_, _, base, _) in enumerate(T.RISK_RULES)
    ]
    df = df.withColumn("__best", F.greatest(F.lit(30 * 16 + 15), *keys))
    score = (
        F.floor(F.col("__best") / 16).cast("int")
        + F.when(has_amount, 4).otherwise(0)
        + F.when(F.array_contains(actions, "CRIMINAL_REFERRAL"), 10).when(F.size(actions) > 0, 5).otherwise(0)
        + F.when(F.aggregate("__hits", F.lit(0), lambda a, x: a + x) >= 3, 4).otherwise(0)
    )
    df = df.withColumn("__score", F.least(F.lit(100), score))
    found, place, score = F.col("__best") > 30 * 16 + 15, F.lit(16) - F.col("__best") % 16, F.col("__score")
    pick = lambda i, other: F.when(found, F.element_at(F.array(*[F.lit(r[i]) for r in T.RISK_RULES]), F.least(place, F.lit(n)))).otherwise(F.lit(other))
    risk = F.struct(
        pick(0, "GEN").alias("code"),
        pick(1, "CONTROL_OR_COMPLIANCE").alias("family"),
        score.alias("score"),
        F.when(score >= 80, "HIGH").when(score >= 55, "MEDIUM").otherwise("LOW").alias("relevance"),
        F.when(score >= 90, "CRITICAL").when(score >= 75, "HIGH").when(score >= 50, "MEDIUM").otherwise("LOW").alias("severity"),
    )
    return df.withColumn(out, risk).drop("__hits", "__best", "__score")


def irregularities(text: Column) -> Column:
    """``array<struct<code, label, family, weight>>`` of a text, in table order."""
    low = F.lower(text_or_empty(text))
    rows = [
        F.when(any_match(low, p), F.struct(F.lit(code).alias("code"), F.lit(label).alias("label"), F.lit(family).alias("family"), F.lit(weight).alias("weight")))
        for code, label, family, weight, p in T.IRREGULARITY_RULES
    ]
    return F.array_compact(F.array(*rows))


def audit_score(irregular: Column, actions: Column, amount: Column) -> Column:
    """Largest weight (35 without any), amount tier and 6, 12, 8, 15 for the four actions; 100 at most."""
    base = F.coalesce(F.array_max(F.transform(irregular, lambda x: x["weight"])), F.lit(35))
    extra = [F.when(F.array_contains(actions, a), n).otherwise(0) for a, n in (("DISCIPLINARY", 6), ("REPARO", 12), ("CDE_REFERRAL", 8), ("CRIMINAL_REFERRAL", 15))]
    return F.least(F.lit(100), base + amount_bonus(amount) + sum(extra[1:], extra[0]))


#: Hypotheses with their labels and base scores.
HYPOTHESES = (
    ("POTENTIAL_FRAUD_AGAINST_STATE", "Posible relevancia para fraude al Fisco", 55),
    ("POTENTIAL_MALVERSATION", "Posible relevancia para malversación de caudales públicos", 62),
    ("POTENTIAL_INCOMPATIBLE_NEGOTIATION", "Posible relevancia para negociación incompatible", 68),
    ("POTENTIAL_BRIBERY", "Posible relevancia para cohecho", 78),
    ("POTENTIAL_FALSE_DOCUMENT", "Posible relevancia penal documental", 58),
    ("POTENTIAL_OTHER_PUBLIC_OFFICIAL_OFFENCE", "Otra posible relevancia penal asociada al hallazgo", 70),
)
#: Patterns and code sets of the hypotheses, sentences of their bases and limits.
SPENDING = ("PAYMENT_IMPROPER", "PAYMENT_UNSUPPORTED", "SERVICE_NOT_PROVEN", "OVERPAYMENT", "PROCUREMENT_IRREGULAR")
UNPROVEN = ("PAYMENT_IMPROPER", "SERVICE_NOT_PROVEN", "OVERPAYMENT")
INTEREST = ("CONFLICT_INTEREST", "RELATED_PARTY")
MALVERSATION = r"malvers|desv[ií]o.{0,80}fondos|fondos?.{0,100}fines? distintos"
CONTRACTING = r"contrat|licitaci|adjudic|proveedor|empresa"
BRIBERY = r"\b(cohecho|soborno|d[aá]diva|coima)\b"
FALSE_DOCUMENT = r"falsific|documento[s]? falsos?|facturas? falsas?"
BASES = (
    "Uso o contratación de recursos públicos con observaciones CGR",
    "Pago, sobrepago o prestación no acreditada",
    "CGR anuncia o formula reparo",
    "Uso o destino de fondos públicos observado como distinto al autorizado",
    "Contratación o decisión pública asociada a inhabilidad, parentesco o conflicto de interés",
    "El texto CGR contiene una referencia explícita compatible con cohecho/soborno",
    "Documento o antecedente descrito como falso o falsificado",
    "CGR remite expresamente antecedentes al Ministerio Público",
)
LIMITS = (
    "La clasificación es una hipótesis analítica y no acredita dolo ni responsabilidad penal individual.",
    "No consta en este hallazgo una remisión explícita al Ministerio Público.",
)


def hypotheses(df: DataFrame, text: str, amount: str, codes: str = "irregularity_codes", actions: str = "enforcement", out: str = "hypotheses") -> DataFrame:
    """``df`` with ``array<struct<code, label, score, relevance, evidence_level, basis, limitations>>`` of a finding.

    Signals for analysts to look at first; they state no offence and no responsibility.
    """
    low = F.lower(text_or_empty(F.col(text)))
    acts = F.col(actions)
    of = lambda names: F.arrays_overlap(F.col(codes), F.array(*[F.lit(n) for n in names]))
    has = lambda p: low.rlike(low_regex(p))
    flags = F.struct(
        of(SPENDING).alias("t0"),
        (F.array_contains(codes, "PUBLIC_FUNDS_MISUSE") | has(MALVERSATION)).alias("t1"),
        (of(INTEREST) & has(CONTRACTING)).alias("t2"),
        has(r"(?U)" + BRIBERY).alias("t3"),
        has(FALSE_DOCUMENT).alias("t4"),
        of(UNPROVEN).alias("unproven"),
        F.array_contains(acts, "CRIMINAL_REFERRAL").alias("referred"),
        F.array_contains(acts, "REPARO").alias("reparo"),
        F.array_contains(acts, "DISCIPLINARY").alias("disciplinary"),
    )
    df = df.withColumn("__f", flags)
    f = F.col("__f")
    extra = amount_bonus(F.col(amount)) + F.when(f["referred"], 15).otherwise(0) + F.when(f["reparo"], 8).otherwise(0) + F.when(f["disciplinary"], 5).otherwise(0)
    df = df.withColumn("__extra", extra)
    tests = [f[f"t{i}"] for i in range(5)]
    tests.append(f["referred"] & ~(tests[0] | tests[1] | tests[2] | tests[3] | tests[4]))
    b = [F.lit(x) for x in BASES]
    bases = [F.array_compact(F.array(b[0], F.when(f["unproven"], b[1]), F.when(f["reparo"], b[2]))), *[F.array(x) for x in b[3:]]]
    rows = [
        F.when(test, F.struct(F.lit(code).alias("code"), F.lit(label).alias("label"), F.least(F.lit(100), F.lit(base) + F.col("__extra")).alias("score"), basis.alias("basis")))
        for (code, label, base), test, basis in zip(HYPOTHESES, tests, bases, strict=True)
    ]
    df = df.withColumn("__rows", F.array_compact(F.array(*rows)))
    limits = F.when(f["referred"], F.array(F.lit(LIMITS[0]))).otherwise(F.array(*[F.lit(x) for x in LIMITS]))

    def whole(x: Column) -> Column:
        level = F.when(f["referred"], "EXPLICIT_CGR_REFERRAL").when(x["score"] >= 70, "STRONG_INDICATORS").otherwise("ANALYTICAL_HYPOTHESIS")
        return F.struct(
            x["code"].alias("code"), x["label"].alias("label"), x["score"].alias("score"), relevance(x["score"]).alias("relevance"),
            level.alias("evidence_level"), x["basis"].alias("basis"), limits.alias("limitations"),
        )

    return df.withColumn(out, F.transform("__rows", whole)).drop("__f", "__extra", "__rows")


def classify(findings: DataFrame, text: str = "description", amount: str = "amount_clp") -> DataFrame:
    """``findings`` with actions, risk, irregularities, audit and penal scores.

    In steps of one projection each, so that generated methods stay small and no pattern is tried twice.
    """
    low, a = F.col("__low"), F.col(amount)
    out = findings.withColumn("__low", pinned(F.lower(text_or_empty(F.col(text)))))
    out = out.withColumn("enforcement", enforcement(low)).withColumn("irregular", irregularities(low))
    out = out.withColumn("irregularity_codes", F.transform("irregular", lambda x: x["code"]))
    out = hypotheses(assess_risk(out, "__low", a.isNotNull()), "__low", amount).drop("__low")
    out = out.withColumn("cgr_score", audit_score(F.col("irregular"), F.col("enforcement"), a))
    out = out.withColumn("penal_score", F.coalesce(F.array_max(F.transform("hypotheses", lambda x: x["score"])), F.lit(0)))
    out = out.withColumn("penal_relevance", relevance(F.col("penal_score")))
    out = out.withColumn("aml_score", F.col("risk.score")).withColumn("aml_relevance", F.col("risk.relevance"))
    return out.withColumn("priority_score", F.greatest("cgr_score", "penal_score", "aml_score"))


def irregularity_rows(classified: DataFrame) -> DataFrame:
    # outer, then filtered: an inner explode would have its array computed again by an inferred filter
    rows = classified.select("finding_id", "document_id", F.explode_outer("irregular").alias("i")).filter("i is not null").select("finding_id", "document_id", "i.*")
    return rows.withColumn("irregularity_id", stable_id("IRR", F.col("finding_id"), F.col("code")))


def hypothesis_rows(classified: DataFrame) -> DataFrame:
    rows = classified.select("finding_id", "document_id", F.explode_outer("hypotheses").alias("h")).filter("h is not null").select("finding_id", "document_id", "h.*")
    return rows.withColumn("hypothesis_id", stable_id("PNL", F.col("finding_id"), F.col("code")))


def enforcement_events(classified: DataFrame, action_date: str = "action_date") -> DataFrame:
    """One row per finding and follow-up action that has a stage."""
    rows = classified.select("finding_id", "document_id", "organization_id", "amount_clp", F.col(action_date).alias("action_date"), F.explode_outer("enforcement").alias("enforcement_type"))
    stage = F.lit(None).cast("string")
    for kind, name in T.ENFORCEMENT_STAGES:
        stage = F.when(F.col("enforcement_type") == kind, F.lit(name)).otherwise(stage)
    link = F.when(F.col("enforcement_type") == "REPARO", "PENDING_TRIBUNAL_LINK").otherwise("NOT_APPLICABLE")
    rows = rows.withColumn("stage", stage).filter("stage is not null").withColumn("tribunal_link_status", link)
    return rows.withColumn("enforcement_event_id", stable_id("ENF", F.col("finding_id"), F.col("enforcement_type")))


def alert_matches(classified: DataFrame, text: str = "description") -> DataFrame:
    """Findings by the alert catalogue: 40 and 14 for each pattern, 8 more from an audit score of 75; 100 at most.

    ``match_basis``: first matches, distinct and sorted, 120 characters and 8 entries at most.
    """
    labels = F.array_join(F.array_sort(F.array_distinct(F.transform("irregular", lambda x: x["label"]))), " ")
    base = classified.withColumn("__t", F.concat_ws(" ", text_or_empty(F.col(text)), labels)).withColumn("__l", pinned(F.lower("__t")))
    rows = []
    for code, label, _, origin, patterns in T.ALERT_PATTERNS:
        basis = F.array_compact(F.array(*[F.when(F.col("__l").rlike(low_regex(p)), F.substring(F.regexp_extract("__t", regex(p), 0), 1, 120)) for p in patterns]))
        rows.append(F.struct(F.lit(code).alias("pattern_code"), F.lit(label).alias("pattern_label"), F.lit(origin).alias("origin"), basis.alias("found")))
    out = base.select("finding_id", "document_id", "cgr_score", F.explode_outer(F.array(*rows)).alias("m")).select("finding_id", "document_id", "cgr_score", "m.*").filter(F.size("found") > 0)
    score = F.least(F.lit(100), F.lit(40) + F.size("found") * 14)
    score = F.when(F.col("cgr_score") >= 75, F.least(F.lit(100), score + 8)).otherwise(score)
    out = out.withColumn("score", score).withColumn("match_basis", F.slice(F.array_sort(F.array_distinct("found")), 1, 8))
    return out.withColumn("fau_match_id", stable_id("FAU", F.col("finding_id"), F.col("pattern_code"))).drop("found", "cgr_score")


def indicator_status(code: Column, raw: Column) -> Column:
    """Traffic light of a municipal indicator cell."""
    from fiscalis.functions.text import normalize_ws

    x = F.lower(normalize_ws(raw))
    out = F.lit("OTHER")
    for name, tests in T.INDICATOR_STATUS:
        status = F.lit("OTHER")
        for kind, text, value in reversed(tests):
            status = F.when(x.startswith(text) if kind == "starts" else x.contains(text), F.lit(value)).otherwise(status)
        out = F.when(code == name, status).otherwise(out)
    return F.when(x == "", "UNKNOWN").when(x.contains("no aplica"), "NA").otherwise(out)


def circular_number(title: Column, text: Column) -> Column:
    """Number of a circular: after CIC, else the first ordinal word of the table before the fixed phrase; else null."""
    both = F.concat_ws(" ", text_or_empty(title), text_or_empty(text))
    direct = F.nullif(F.regexp_extract(both, r"(?iuU)\bCIC\s*(?:N[°ºo.]?\s*)?(\d{1,2})\b", 1), F.lit("")).cast("int")
    low = F.lower(both)
    word = F.lit(None).cast("int")
    for name, n in reversed(T.ORDINALS):
        word = F.when(low.rlike(rf"(?U)\b{name}\s+consolidado de información circularizada\b"), F.lit(n)).otherwise(word)
    return F.coalesce(direct, word)


def region_label(*values: Column) -> Column:
    """Label of the first region key, in table order, inside the joined values; else empty."""
    from fiscalis.functions.text import normalize_name

    norm = normalize_name(F.concat_ws(" ", *[text_or_empty(v) for v in values]))
    out = F.lit("")
    for key, label in reversed(T.REGION_LABELS):
        out = F.when(norm.contains(key), F.lit(label)).otherwise(out)
    return out


def org_type(name: Column) -> Column:
    from fiscalis.functions.text import normalize_name

    n = normalize_name(name)
    return (
        F.when(n.startswith("MUNICIPALIDAD"), "MUNICIPALITY")
        .when(n.startswith("GOBIERNO REGIONAL") | n.startswith("GORE "), "REGIONAL_GOVERNMENT")
        .when(n.startswith("SERVICIO DE SALUD"), "HEALTH_SERVICE")
        .when(n.startswith("HOSPITAL"), "HOSPITAL")
        .when(n.startswith("UNIVERSIDAD"), "STATE_UNIVERSITY")
        .when(n.contains("INSTITUTO"), "PUBLIC_INSTITUTE")
        .when(n.contains("COMISION"), "PUBLIC_COMMISSION")
        .when(n.contains("MINISTERIO") | n.contains("SEREMI"), "CENTRAL_GOVERNMENT")
        .otherwise("PUBLIC_ORGANIZATION")
    )
