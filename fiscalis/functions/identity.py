"""National ids with a mod-11 check digit, urls of audits, territory codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fiscalis.functions.text import fold, text_or_empty

#: Region names as they are exported, and their codes.
REGION_CODES = (
    ("TARAPACA", "01"), ("ANTOFAGASTA", "02"), ("ATACAMA", "03"), ("COQUIMBO", "04"), ("VALPARAISO", "05"),
    ("LIBERTADOR GENERAL BERNARDO OHIGGINS", "06"), ("OHIGGINS", "06"), ("MAULE", "07"), ("BIOBIO", "08"),
    ("LA ARAUCANIA", "09"), ("ARAUCANIA", "09"), ("LOS LAGOS", "10"), ("AYSEN", "11"), ("MAGALLANES", "12"),
    ("METROPOLITANA DE SANTIAGO", "13"), ("METROPOLITANA", "13"), ("LOS RIOS", "14"), ("ARICA Y PARINACOTA", "15"), ("NUBLE", "16"),
)
#: Official hosts and the path of an audit.
OFFICIAL_HOSTS = ("contraloria.cl", "infoprobidad.cl")
AUDIT_PATH = r"(?i)/buscadorpdf/auditoria/([0-9a-f]{32})/html"
AUDIT_URL = "https://www.contraloria.cl/buscadorpdf/auditoria/%s/html"


def check_digit(body: Column) -> Column:
    """Weights 2 to 7 from the right, repeating; 11 gives 0 and 10 gives K."""
    digits = F.split(F.reverse(body), "")
    total = F.aggregate(
        F.transform(F.filter(digits, lambda x: x != ""), lambda x, i: x.cast("int") * (F.lit(2) + i % 6)), F.lit(0), lambda a, x: a + x
    )
    v = F.lit(11) - total % 11
    return F.when(v == 11, F.lit("0")).when(v == 10, F.lit("K")).otherwise(v.cast("string"))


def normalize_rut(col: Column) -> Column:
    """``body-digit`` of a valid id without leading zeros, else null."""
    c = F.upper(F.regexp_replace(text_or_empty(col), "[^0-9Kk]", ""))
    body, digit = F.regexp_extract(c, "^([0-9]{1,8})([0-9K])$", 1), F.regexp_extract(c, "^([0-9]{1,8})([0-9K])$", 2)
    valid = (body != "") & (check_digit(body) == digit)
    return F.when(valid, F.concat(F.coalesce(body.try_cast("bigint"), F.lit(0)).cast("string"), F.lit("-"), digit))


def global_entity_id(rut: Column) -> Column:
    return F.concat(F.lit("ENT-RUT-"), normalize_rut(rut))


def entity_role(kind: Column) -> Column:
    k = F.upper(text_or_empty(kind))
    return (
        F.when(k.contains("PROVIDER"), F.lit("PROVIDER"))
        .when(k.contains("PUBLIC") | k.contains("ORGANIZATION"), F.lit("PUBLIC_BODY"))
        .when(k.contains("PERSON"), F.lit("PERSON_MENTIONED"))
        .otherwise(F.lit("SOURCE_ENTITY"))
    )


def territory(region: Column) -> Column:
    """``CL-REG-nn`` of a region name, with or without a leading ``Región de``; null for names that are not listed."""
    name = F.trim(F.regexp_replace(F.regexp_replace(F.trim(fold(region)), "[^A-Z0-9 ]+", " "), " +", " "))
    name = F.trim(F.regexp_replace(name, "^REGION (DE |DEL |DE LA )?", ""))
    out = F.lit(None).cast("string")
    for key, code in REGION_CODES:
        out = F.when(name == key, F.lit(f"CL-REG-{code}")).otherwise(out)
    return out


def official_url(url: Column, strict: bool = False) -> Column:
    """Host ends with an official domain; ``strict`` asks for a label border before it."""
    host = F.lower(F.regexp_extract(text_or_empty(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    found = F.lit(False)
    for h in OFFICIAL_HOSTS:
        found = found | ((host == h) | host.endswith("." + h) if strict else host.endswith(h))
    return found


def audit_hash(url: Column) -> Column:
    """32 hexadecimal digits of an audit's url in lower case, else empty."""
    return F.lower(F.regexp_extract(text_or_empty(url), AUDIT_PATH, 1))


def legacy_audit_hash(url: Column) -> Column:
    """As :func:`audit_hash`, else from the legacy ``docIdcm`` parameter with its hyphens."""
    old = F.regexp_replace(F.lower(F.regexp_extract(text_or_empty(url), r"[?&]docIdcm=([0-9a-fA-F-]{32,40})", 1)), "[^0-9a-f]", "")
    return F.coalesce(F.nullif(audit_hash(url), F.lit("")), F.when(F.length(old) == 32, old), F.lit(""))


def canonical_audit_url(url: Column) -> Column:
    h = audit_hash(url)
    return F.when(h != "", F.format_string(AUDIT_URL, h)).otherwise(F.lit(""))
