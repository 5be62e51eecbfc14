import random
import re
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from fiscalis.operators import entities, findings, linking, queues, store, temporal
from fiscalis.plans import interop, marts
from fiscalis.sources import html


def classify(spark, *rows):
    df = spark.createDataFrame([(f"F{i}", "D1", "O1", "P1", t, a) for i, (t, a) in enumerate(rows)], "finding_id string, document_id string, organization_id string, provider_id string, description string, amount_clp long")
    return {r.finding_id: r for r in findings.classify(df).collect()}


def test_risk_and_actions(spark):
    got = classify(
        spark,
        ("Pagos improcedentes y fraude, antecedentes al Ministerio Público para su conocimiento", 5),
        ("Nada que observar", None),
        ("Unidad de Seguimiento de Fiscalía", None),
        (None, None),
    )
    assert got["F0"].risk.code == "CRM" and got["F0"].aml_score == 100 and "CRIMINAL_REFERRAL" in got["F0"].enforcement
    assert got["F1"].risk.family == "CONTROL_OR_COMPLIANCE" and got["F1"].aml_score == 30 and got["F1"].cgr_score == 35
    assert got["F2"].enforcement == [] and got["F3"].aml_score == 30


def test_ties_keep_the_earlier_rule(spark):
    got = classify(spark, ("transferencia fondos públicos y deuda sin respaldo", None), ("rendición de vehículos", None))
    assert got["F0"].risk.code == "PUB"
    assert got["F1"].risk.code == "AST"


def test_hypotheses(spark):
    got = classify(spark, ("Conflicto de interés en la contratación de una empresa; reparo", 2_000_000_000), ("Se remitieron antecedentes al Ministerio Público", None), ("Hubo una coima", None))
    (h,) = got["F0"].hypotheses
    assert (h.code, h.score, h.relevance, h.evidence_level) == ("POTENTIAL_INCOMPATIBLE_NEGOTIATION", 86, "HIGH", "STRONG_INDICATORS") and len(h.limitations) == 2
    assert [h.code for h in got["F1"].hypotheses] == ["POTENTIAL_OTHER_PUBLIC_OFFICIAL_OFFENCE"] and len(got["F1"].hypotheses[0].limitations) == 1
    assert [h.code for h in got["F2"].hypotheses] == ["POTENTIAL_BRIBERY"]


CASES = [
    ("Pagos entre el 1 de enero y el 30 de junio de 2018", "", "2018-01-01", "2018-06-30", "RANGE"),
    ("Revisado entre 01/02/2019 y 28-02-2019", "", "2019-02-01", "2019-02-28", "RANGE"),
    ("en los años 2015 a 2017", "", "2015-01-01", "2017-12-31", "YEAR_RANGE"),
    ("durante el año 2020", "", "2020-01-01", "2020-12-31", "YEAR"),
    ("en Febrero de 2020", "", "2020-02-01", "2020-02-29", "MONTH"),
    ("saldo al 31 de diciembre de 2016", "", "2016-12-31", "2016-12-31", "AS_OF_DATE"),
    ("saldo con fecha de corte al 31 de diciembre de 2016", "", "", "", "UNKNOWN"),
    ("decreto N° 5 de 3 de mayo de 2018, que el día 3 de mayo de la presente anualidad pagó", "", "2018-05-03", "2018-05-03", "EXACT"),
    ("pagó el día 7 de abril de 2021", "", "2021-04-07", "2021-04-07", "EXACT"),
    ("pagó con fecha 07/04/2021", "", "2021-04-07", "2021-04-07", "EXACT"),
    ("según la ley, el día 7 de abril de 2021", "", "", "", "UNKNOWN"),
    ("deberá informar el 7 de abril de 2030", "", "", "", "UNKNOWN"),
    ("pagó el 31 de febrero de 2021", "", "", "", "UNKNOWN"),
    ("pagó el 7 de abril de 2021", "01-01-2020", "", "", "UNKNOWN"),
    ("pagó el 7 de abril de 2021", "07-04-2021", "2021-04-07", "2021-04-07", "EXACT"),
    ("", "", "", "", "UNKNOWN"),
    (None, None, "", "", "UNKNOWN"),
]


def test_occurrence_cascade(spark):
    df = spark.createDataFrame([(i, c[0], c[1]) for i, c in enumerate(CASES)], "i int, description string, d string")
    rows = temporal.with_occurrence(df, doc_date="d").orderBy("i").collect()
    for r, c in zip(rows, CASES, strict=True):
        assert (r.occurrence["from"], r.occurrence["to"], r.occurrence["precision"]) == c[2:], c
        assert r.occurrence["from"] <= r.occurrence["to"]


def test_occurrence_is_inherited_from_the_objective(spark):
    raw = "OBJETIVO Revisar gastos durante el año 2019\nCONCLUSIONES durante el año 2021"
    df = spark.createDataFrame([("sin fecha", raw)], "description string, raw string").withColumn("o", temporal.objective(F.col("raw")))
    (r,) = temporal.with_occurrence(df, audit_objective="o").collect()
    assert r.occurrence["precision"] == "AUDIT_YEAR" and r.occurrence["confidence"] == 0.68 and r.occurrence["to"] == "2019-12-31"


def test_upsert_is_idempotent_and_ignores_volatile_columns(spark):
    old = spark.createDataFrame([("a", 1, "t0"), ("b", 2, "t0"), ("c", 3, "t0")], "k string, v int, last_seen string")
    new = spark.createDataFrame([("a", 1, "t1"), ("b", 9, "t1"), ("d", 4, "t1"), (None, 5, "t1")], "k string, v int, last_seen string")
    once = store.upsert(old, new, "k")
    got = {r.k: (r.v, r.last_seen, r.change) for r in once.collect()}
    assert got == {"a": (1, "t0", "unchanged"), "b": (9, "t1", "updated"), "c": (3, "t0", "absent"), "d": (4, "t1", "inserted")}
    again = store.upsert(once.drop("change"), new, "k")
    assert {r.change for r in again.collect()} == {"unchanged", "absent"}
    moved = {r.k: r.last_seen for r in store.upsert(old, new, "k", advance_last_seen=True).collect()}
    assert moved["a"] == "t1"
    assert store.change_counts(store.replace(old, new, "k")).first().asDict() == {"inserted": 1, "updated": 1, "deleted": 1}


@pytest.mark.parametrize("parts", [1, 16])
def test_order_does_not_depend_on_partitions(spark, parts):
    df = spark.createDataFrame([("g", i % 3, i) for i in range(30)], "g string, a int, pos int").repartition(parts)
    assert store.keep_last(df, "g", "a", "pos").first().pos == 29 and store.keep_first(df, "g", "a", "pos").first().pos == 0


def test_token_overlap_equals_nested_loop(spark):
    words = ["pago", "obras", "salud", "norte", "hospital", "compra", "riego"]
    left = [(i, [words[(i + k) % 7] for k in range(1 + i % 4)]) for i in range(12)] + [(50, [])]
    right = [(i, [words[(i * 2 + k) % 7] for k in range(1 + i % 5)]) for i in range(12)] + [(60, [])]
    a, b = (spark.createDataFrame(x, "id int, tokens array<string>") for x in (left, right))
    got = {(r.left_id, r.right_id): r.score for r in linking.token_overlap(a, b, "id", "id", "tokens", 2, 0.62).collect()}
    want = {}
    for i, x in left:
        for j, y in right:
            n = len(set(x) & set(y))
            if n >= 2 and n / min(len(x), len(y)) >= 0.62:
                want[i, j] = n / min(len(x), len(y))
    assert got == want
    best = {r.left_id: r.right_id for r in linking.best_match(linking.token_overlap(a, b, "id", "id", "tokens", 2, 0.62)).collect()}
    assert best == {i: min((-s, j) for (k, j), s in want.items() if k == i)[1] for i in {k for k, _ in want}}


def test_mentions(spark):
    text = "Se pagó a Constructora Los Robles Ltda. y a Fundación Vida Nueva por transferencia; don Pedro Soto, alcalde subrogante"
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "k int, t string")
    found = entities.provider_mentions(df, "k", "t").orderBy("normalized_name").collect()
    assert [(f.normalized_name, f.relationship_type) for f in found] == [("CONSTRUCTORA LOS ROBLES LIMITADA", "PAYMENT_RECIPIENT"), ("FUNDACION VIDA NUEVA", "TRANSFER_RECIPIENT")]
    assert [(p.k, p.normalized_name, p.role) for p in entities.person_mentions(df, "k", "t").collect()] == [(1, "PEDRO SOTO", "ALCALDE")]


def test_the_last_mention_of_a_provider_counts(spark):
    far = " y nada más que decir sobre este punto del informe" * 5
    text = f"La licitación adjudicó: Obras Sur Ltda. fue revisada.{far} Se efectuó un desembolso: Obras Sur Ltda."
    (r,) = entities.provider_mentions(spark.createDataFrame([(1, text)], "k int, t string"), "k", "t").collect()
    assert r.relationship_type == "PAYMENT_RECIPIENT"


def test_resolution(spark):
    df = spark.createDataFrame([("p1", "de Obras Sur Ltda. y Aridos Norte SpA"), ("p2", "Obras Sur Limitada"), ("p3", "SA")], "provider_id string, name string")
    mapping, resolved = entities.resolve_providers(df)
    targets = {r.provider_id: r.targets for r in mapping.collect()}
    names = {r.provider_id: r.name for r in resolved.collect()}
    assert len(targets["p1"]) == 2 and targets["p2"][0] in targets["p1"] and targets["p3"] == []
    assert set(names) == set(targets["p1"])
    edges = spark.createDataFrame([("e1", "p1"), ("e2", "p3"), ("e3", "zz")], "e string, provider_id string")
    assert sorted(r.e for r in entities.remap(edges, mapping, "provider_id").collect()) == ["e1", "e1", "e3"]


def test_organizations(spark):
    rows = [("INFORME MUNICIPALIDAD DE LOS LAGOS AUDITORÍA 2020", "", ""), ("x", "revisión en Carabineros de Chile", ""), ("x", "", "CONAF"), ("x", "", "desconocido")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, t string, o string, c string")
    got = [r[1] for r in df.select("i", entities.infer_organization(F.col("t"), F.col("o"), F.col("c"))).orderBy("i").collect()]
    assert got == ["MUNICIPALIDAD DE LOS LAGOS", "Carabineros de Chile", "Corporación Nacional Forestal", ""]


def test_quality_gate_splits_providers(spark):
    p = spark.createDataFrame([("a", "X"), ("b", "Y"), ("c", "")], "id string, normalized_name string")
    o = spark.createDataFrame([("X",), ("",)], "normalized_name string")
    assert [r.id for r in entities.collisions(p, o).collect()] == ["a"]
    assert sorted(r.id for r in entities.without_collisions(p, o).collect()) == ["b", "c"]


def test_html(spark):
    page = "<html><title> A\n b </title><style>x</style><body><!-- c --><p>Uno <a href='/x?a=1'>dos</a></p><table><tr><th>h</th><td>1</td></tr></table><script>no()</script></body>"
    df = spark.createDataFrame([(1, page), (2, None), (3, "<p>broken <a href=y>")], "id long, html string")
    assert [tuple(r) for r in html.links(df, "id").orderBy("id").collect()] == [(1, "/x?a=1", "dos"), (3, "y", "")]
    assert {r.id: r.text for r in html.visible_text(df, "id").collect()}[1] == "A\n b\nUno\ndos\nh\n1"
    assert [(r.table, r.row, r.cell, r.is_header, r.text) for r in html.table_cells(df, "id").orderBy("cell").collect()] == [(0, 0, 0, True, "h"), (0, 0, 1, False, "1")]
    assert ("p", "Uno dos", "/x?a=1") in [(r.tag, r.text, r.href) for r in html.blocks(df, "id").collect()]


def test_scan_status_and_windows(spark):
    rows = [(0, 5, False), (5, 5, False), (0, None, False), (0, None, True), (3, None, False), (0, 0, False)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, f int, e int, z boolean")
    got = [r[1] for r in df.select("i", queues.scan_status(F.col("f"), F.col("e"), F.col("z"))).orderBy("i").collect()]
    assert got == ["PARTIAL", "SCANNED", "PARTIAL", "SCANNED", "SCANNED", "SCANNED"]
    w = spark.createDataFrame([("a", "SCANNED", 1), ("b", "ERROR", 1), ("c", "PENDING", 0), ("d", "ERROR", 4)], "window_id string, status string, attempts int").withColumn("date_from", F.col("window_id"))
    assert [r.window_id for r in queues.scannable_windows(w, True, 9).collect()] == ["b", "c"]
    assert [r.window_id for r in queues.scannable_windows(w, False, 9).collect()] == ["c"]


def test_export_refuses_nothing(spark):
    empty = spark.createDataFrame([], "event_id string")
    with pytest.raises(ValueError):
        interop.require_rows(empty, empty)


def test_nested_hypotheses_order(spark):
    df = spark.createDataFrame([("f", "h2", "B", 70), ("f", "h1", "A", 70), ("f", "h3", "C", 90)], "finding_id string, hypothesis_id string, code string, score int")
    assert [d[1] for d in marts.nested_hypotheses(df).first().details] == ["C", "A", "B"]


def test_documents_and_findings(spark):
    from fiscalis.operators import documents

    item = "Se constató que el municipio pagó servicios sin respaldo suficiente por $ 12.000.000 durante el año 2019 a su proveedor"
    text = f"NÚMERO\n: 123\nFECHA DOCUMENTO\n05-03-2020\nNIVEL\nregional\nOBJETIVO revisar pagos\nCONCLUSIONES\n1. {item}\n2. {item} y otro\n- corto"
    pages = spark.createDataFrame([("u1", text), ("u2", None)], "source_url string, text string")
    docs = documents.parse_documents(pages)
    d = {r.source_url: r for r in docs.collect()}
    assert (d["u1"].document_number, d["u1"].document_date, d["u1"].level, d["u1"].objective) == ("123", "05-03-2020", "regional", "revisar pagos")
    rows = documents.document_findings(docs).orderBy("finding_order").collect()
    assert [r.finding_order for r in rows] == [1, 2] and rows[0].amount_clp == 12_000_000 and rows[0].finding_id != rows[1].finding_id
    assert documents.evidence_rows(documents.document_findings(docs)).count() == 2


def test_finding_splitter_tiers(spark):
    from fiscalis.operators.documents import split_findings

    long = "Una oración que describe con detalle suficiente lo observado por la fiscalización en terreno. "
    texts = ["", "corto", None, f"{long}\n\n{long}", long * 14, f"x\n1) {long}\n2) {long}\n- {long}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.f for r in df.select("i", split_findings(F.col("t")).alias("f")).orderBy("i").collect()]
    assert [len(g) for g in got] == [0, 0, 0, 2, 2, 3] and all(len(p) > 80 for p in got[4])
    assert got[4][0] == " ".join([long.strip()] * 7) and got[5][2].startswith("- Una")


def test_metadata_of_documents(spark):
    from fiscalis.operators import documents

    text = "INFORME FINAL N° 12-2020 sobre pagos del hospital\nNÚMERO 77 FECHA DOCUMENTO 01-02-2021 NIVEL undefined UNIDAD CGR CONTRALORÍA REGIONAL DEL MAULE\nTIPO\n: Auditoría\nTIPO\nInforme\nNOMBRE x OBJETIVO auditoría en el Hospital de Curicó, 2020 CONCLUSIONES y"
    url = "https://www.contraloria.cl/buscadorpdf/auditoria/" + "a" * 32 + "/html"
    (d,) = documents.parse_documents(spark.createDataFrame([(url, text)], "source_url string, text string")).collect()
    assert (d.document_number, d.document_date, d.level, d.document_type) == ("77", "01-02-2021", "", "Informe")
    assert d.document_id == "CGR-AUD-" + "a" * 32 and d.pdf_url.endswith("a" * 32 + "&pdf=1")
    assert d.region == "Del Maule" and d.title.startswith("INFORME FINAL") and d.entity_name == "Hospital de Curicó"


def plain_label(text, label, following):
    """The label's value by its definition: every occurrence with the rest of the text."""
    clean = lambda vs: [v for v in (" ".join(x.split()).strip(": ") for x in vs) if v and "undefined" not in v.lower()]
    below = re.findall(rf"(?:^|\n)\s*{label}\s*\n\s*:?\s*\n?\s*([^\n]+)", text, re.I)
    flat = []
    for m in re.finditer(label, text, re.I):
        rest = text[m.end() :]
        end = re.search("|".join(following), rest, re.I)
        flat.append(rest[: end.start()] if end else rest[:400])
    found = [v for v in clean(flat) if len(v) < 350]
    return (clean(below) or found or [""])[-1]


def test_labels_equal_their_definition(spark):
    from fiscalis.operators.documents import LABELS, metadata

    rng = random.Random(4)
    words = [w for _, label, ends in LABELS for w in (label, *ends)] + ["valor", ":", "\n", "\n:", " ", "undefined", "x" * 120, "nombre ", "Regional\n", "a b " * 60, " " * 90, "ñandú"]
    texts = ["".join(rng.choice(words) + rng.choice(["", " ", "\n", " "]) for _ in range(rng.randrange(0, 40))) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    rows = df.select("t", *[metadata(F.col("t"), label, ends).alias(name) for name, label, ends in LABELS]).collect()
    for r in rows:
        for name, label, ends in LABELS:
            assert r[name] == plain_label(r.t, label, ends), (name, r.t)


def test_labels_of_a_very_long_text(spark):
    from fiscalis.operators.documents import metadata

    text = ("TIPO " + "palabra " * 125) * 10_000  # 10 MB, 10,000 labels, no end for any of them
    df = spark.createDataFrame([(text,), (text + " REGIÓN x",), (text + "\n \n" * 20_000,)], "t string")
    began = time.perf_counter()
    got = [r.v for r in df.select(metadata(F.col("t"), "TIPO", ("REGIÓN", "NOMBRE")).alias("v")).collect()]
    assert got == ["", "", ""] and time.perf_counter() - began < 60


def test_publications(spark):
    from fiscalis.operators import publications as pub

    blocks = spark.createDataFrame([(0, "Fiscalización al hospital regional de Temuco", "https://www.contraloria.cl/a"), (1, "Fiscalización al hospital regional de Temuco", "https://www.contraloria.cl/a"), (2, "Otra noticia sin señal alguna", ""), (3, "Auditoría ajena con enlace externo a otra parte", "https://x.org/b")], "pos int, text string, url string")
    watch = pub.watch_candidates(blocks, "cgr_fiscalizaciones", "https://www.contraloria.cl/", "t0")
    assert watch.count() == 1
    docs = spark.createDataFrame([("D2", "Informe hospital regional Temuco"), ("D1", "Hospital regional Temuco obras"), ("D3", "Nada")], "document_id string, title string")
    (m,) = pub.match_watch(watch, docs).collect()
    assert (m.matched_document_id, m.status) == ("D2", "CLOSED_MATCHED")
    assert pub.match_watch(watch, docs.filter("document_id = 'D3'")).first().status == "OPEN"
    text = "Estado 01/02/2024 12 / 2023 RES. N° 45 Contraloría Regional de Maule Juan Pérez y otros 02/02/2024 13/2023 RES. N° 46 sin reclamante"
    cases = pub.tribunal_cases(spark.createDataFrame([("u", text)], "source_url string, text string"))
    (c,) = cases.collect()
    assert (c.state_date, c.role, c.claimant, c.defendants_raw) == ("2024-02-01", "12/2023", "Contraloría Regional de Maule", "Juan Pérez y otros")
    rep = spark.createDataFrame([("E1", "Contraloría Regional del Maule", "2024-01-01"), ("E2", "Contraloría Regional del Maule", "2025-01-01"), ("E3", "Otra", "")], "enforcement_event_id string, unit_cgr string, action_date string")
    assert pub.link_cases(cases, rep).first().candidate_reparo_ids == ["E1"]
    cells = spark.createDataFrame([(1, 0, r, i, "Oportunamente" if i == 2 else f"x{i}") for r in range(2) for i in range(10)] + [(1, 1, 0, 0, "menu")], "page int, table int, row int, cell int, text string")
    snap = pub.municipal_snapshot(cells, "2024-01-01")
    assert snap.count() == 16 and snap.filter("indicator_code = 'DIP_ALCALDE'").first().status == "GREEN"
    art = spark.createDataFrame([("CIC N° 3", "cruce con SIAPER", "d", "u1"), ("CIC N° 3", "SII y SIAPER", "d", "u2"), ("Nada", "x", "d", "u3")], "title string, text string, date string, url string")
    (a,) = pub.circulars(art).collect()
    assert (a.cic_number, a.url, a.datasets_detected) == (3, "u2", ["SIAPER"])


def test_dataset_tags_reads_whole_texts(spark, tmp_path):
    rows = [(4, "x " * 5000 + "SICOGEN"), (5, None), (0, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.tags for r in entry.queries()["dataset_tags"](spark, str(tmp_path)).collect()}
    assert got == {4: "SICOGEN", 5: "", 0: "SIAPER,MIGRACIONES"}
