import hashlib
import unicodedata

import pytest
from pyspark.sql import functions as F

from fiscalis.functions import dates as D
from fiscalis.functions import identity as I
from fiscalis.functions import text as X
from fiscalis.operators import findings as ops


def values(spark, rows, *exprs):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ", ".join(f"c{k} string" for k in range(len(rows[0]))))
    return [tuple(r)[1:] for r in df.select("i", *exprs).orderBy("i").collect()]


def test_names_and_white_space(spark):
    rows = [("  Árbol  y   Ñandú, S.A.\t",), (None,), ("Empresa X Ltda. ",), ("constructora s.p.a. sur",)]
    got = values(spark, rows, X.normalize_ws(F.col("c0")), X.normalize_name(F.col("c0")), X.normalize_name(F.col("c0"), exact=True))
    assert got[0] == ("Árbol y Ñandú, S.A.", "ARBOL Y NANDU SA", "ARBOL Y NANDU SA")
    assert got[1] == ("", "", "") and got[2][1] == "EMPRESA X LIMITADA" and got[3][1] == "CONSTRUCTORA SPA SUR"


def test_exact_folding_equals_decomposition(spark):
    rows = [("Ǻçé ﬁn ½ Žižek",), ("Ελληνικά",)]
    got = values(spark, rows, X.normalize_name(F.col("c0"), exact=True))
    for (text,), (name,) in zip(rows, got, strict=True):
        flat = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).upper()
        assert name == " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in flat).split())


def test_stable_ids_are_deterministic_and_case_free(spark):
    got = values(spark, [("a", " b"), ("A ", "B"), ("a", "c"), ("0", None)], X.stable_id("ENT", F.col("c0"), F.col("c1")))
    digest = "ENT-" + hashlib.sha256(b"A|B").hexdigest()[:20]
    assert got[0] == got[1] == (digest,) and got[2] != got[0]
    assert got[3] == ("ENT-" + hashlib.sha256(b"|").hexdigest()[:20],)


def test_amounts(spark):
    got = values(spark, [("pagó $ 1.234.567 y luego $9,000",), ("sin monto $12",), ("$1.234,50",), (None,)], X.clp_amounts(F.col("c0")), X.max_amount(F.col("c0")))
    assert got == [([1234567, 9000], 1234567), ([], None), ([123450], 123450), ([], None)]


def test_dates(spark):
    rows = [("05-03-2020",), ("05/03/2020",), ("2020-03-05",), ("31-02-2020",), ("5-3-2020",), (None,), ("2020-03-05T10:00:00",)]
    got = values(spark, rows, D.document_date(F.col("c0")), D.export_timestamp(F.col("c0")))
    assert [g[0] for g in got] == ["2020-03-05"] * 3 + [""] * 4
    assert got[0][1] == "2020-03-05T00:00:00+00:00" and got[6][1] == "2020-03-05T10:00:00" and got[3][1] is None
    windows = D.month_windows(spark, 2024, 2024, 2).collect()
    assert [tuple(w) for w in windows] == [("2024-01", "2024-01-01", "2024-01-31"), ("2024-02", "2024-02-01", "2024-02-29")]


@pytest.mark.parametrize("lo,hi,want", [("", "", True), ("2020-01-01", "2020-12-31", True), ("2021-01-01", "", False), ("", "2019-12-31", False)])
def test_interval_overlap(spark, lo, hi, want):
    got = values(spark, [("2020-05-01", "2020-06-01"), ("", "")], D.overlaps(F.col("c0"), F.col("c1"), lo, hi))
    assert got[0] == (want,) and got[1] == (not lo and not hi,)


def plain_digit(body):
    v = 11 - sum(int(d) * (2 + i % 6) for i, d in enumerate(reversed(body))) % 11
    return {11: "0", 10: "K"}.get(v, str(v))


def test_national_ids(spark):
    rows = [(f"{n}-{plain_digit(str(n)).lower()}",) for n in (1, 12, 7654321, 11111111, 23456789)] + [("12.345.678-0",), ("x",), (None,), ("0012-" + plain_digit("12"),)]
    got = [g[0] for g in values(spark, rows, I.normalize_rut(F.col("c0")))]
    assert got[:5] == [f"{n}-{plain_digit(str(n))}" for n in (1, 12, 7654321, 11111111, 23456789)]
    assert got[5:8] == ["12345678-0" if plain_digit("12345678") == "0" else None, None, None]
    assert got[8] == ("12-" + plain_digit("12") if plain_digit("0012") == plain_digit("12") else None)


def test_audit_urls(spark):
    h = "0123456789abcdef" * 2
    rows = [(f"https://x/buscadorpdf/auditoria/{h.upper()}/html",), (f"https://x/?docIdcm={h[:8]}-{h[8:]}",), ("https://x/",)]
    got = values(spark, rows, I.audit_hash(F.col("c0")), I.legacy_audit_hash(F.col("c0")), I.canonical_audit_url(F.col("c0")))
    assert got[0][:2] == (h, h) and got[0][2].endswith(f"/{h}/html") and got[1][:2] == ("", h) and got[2] == ("", "", "")


def test_regions_types_and_circulars(spark):
    rows = [("Región de Ñuble", "Municipalidad de Chillán"), ("Gran Biobío", "GORE Maule"), ("", "Seremi de Salud")]
    assert values(spark, rows, ops.region_label(F.col("c0")), ops.org_type(F.col("c1"))) == [("Ñuble", "MUNICIPALITY"), ("Biobío", "REGIONAL_GOVERNMENT"), ("", "CENTRAL_GOVERNMENT")]
    rows = [("Nuevo CIC N° 12", ""), ("", "el Séptimo consolidado de información circularizada"), ("CIC", "")]
    assert values(spark, rows, ops.circular_number(F.col("c0"), F.col("c1"))) == [(12,), (7,), (None,)]
    rows = [("ROYALTY_SUBDERE", "No ha informado"), ("ROYALTY_SUBDERE", "Ha informado"), ("SALDO_INICIAL_CAJA", "No ha actualizado correctamente"), ("DIP_ALCALDE", ""), ("X", "No aplica")]
    assert [g[0] for g in values(spark, rows, ops.indicator_status(F.col("c0"), F.col("c1")))] == ["RED", "GREEN", "RED", "UNKNOWN", "NA"]


def test_sections(spark):
    rows = [("x OBJETIVO revisar pagos CONCLUSIONES fin",), ("sin nada",), ("objetivo hasta el final",)]
    got = values(spark, rows, X.section(F.col("c0"), "OBJETIVO", "CONCLUSIONES"))
    assert [g[0] for g in got] == ["revisar pagos", "", "hasta el final"]
