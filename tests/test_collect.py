"""From a source's page to documents, findings and marts, against a local server in place of the official host."""

import http.server
import json
import threading

import pytest

from fiscalis import __main__ as cli
from fiscalis.sources import tables

A, B, C = ("a" * 32, "b" * 32, "c" * 32)
LONG = "Se constató que el municipio efectuó pagos improcedentes a Constructora Los Robles Ltda. por $ 20.000.000 sin respaldo, por lo que se formulará reparo"
AUDIT = f"""<h2>INFORME FINAL N° 12-2020 MUNICIPALIDAD DE PICA</h2><p>NÚMERO</p><p>12-2020</p><p>FECHA DOCUMENTO</p><p>05-03-2021</p><p>NIVEL</p><p>Regional</p>
<p>OBJETIVO auditoría en la Municipalidad de Pica, pagos del año 2019</p><p>CONCLUSIONES</p><p>1) {LONG} uno.</p><p>2) {LONG} dos.</p>"""
LANDING = f"""<title>Noticias</title><a href="/buscadorpdf/auditoria/{A}/html">uno</a><a href="https://www.contraloria.cl/buscadorpdf/auditoria/{C}/html">tres</a>
<ul><li>Contraloría fiscaliza el hospital regional de Temuco por sus contratos</li></ul>"""


@pytest.fixture(scope="module")
def server():
    class Handler(http.server.BaseHTTPRequestHandler):
        def log_message(self, *a):
            pass

        def do_GET(self):
            body = {"/web/noticias": LANDING, f"/buscadorpdf/auditoria/{A}/html": AUDIT, f"/buscadorpdf/auditoria/{B}/html": AUDIT.replace("PICA", "ARICA").replace("Pica", "Arica")}.get(self.path)
            if self.path.startswith("/CC-MAIN"):
                body = json.dumps({"pages": 1}) if "showNumPages" in self.path else json.dumps({"url": f"https://www.contraloria.cl/buscadorpdf/auditoria/{B}/html"})
            self.send_response(200 if body else 404)
            self.end_headers()
            self.wfile.write((body or "").encode())

    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_daily_from_a_page_to_the_marts(spark, server, tmp_path):
    (tmp_path / "config").mkdir()
    sources = [{"id": "cgr_fiscalizaciones", "name": "Fiscalizaciones", "url": "https://www.contraloria.cl/web/noticias"}, {"id": "gone", "name": "Nada", "url": "https://www.contraloria.cl/none"}]
    (tmp_path / "config/sources.json").write_text(json.dumps({"sources": sources}))
    (tmp_path / "config/seed_audits.json").write_text(json.dumps({"audits": [{"url": f"https://www.contraloria.cl/buscadorpdf/auditoria/{B}/html"}]}))
    root = f"file://{tmp_path}"
    first = cli.main(["daily", "--root", root, "--mirror", server, "--now", "2024-01-01T00:00:00+00:00"])
    assert (first["pages"], first["audits"], first["errors"]) == (2, 3, 2)
    assert (first["new_documents"], first["new_findings"], first["new_events"], first["new_source_runs"]) == (2, 4, 2, 3)
    assert first["finding_enrichment"] == 4 and first["organizations"] == 2 and first["new_watch_items"] == 1
    read = lambda name: tables.read_jsonl(spark, tables.SPECS[name], f"{root}/silver/{name}.jsonl").collect()
    docs = {r.document_id: r for r in read("documents")}
    assert set(docs) == {f"CGR-AUD-{A}", f"CGR-AUD-{B}"} and {d.document_number for d in docs.values()} == {"12-2020"}
    assert docs[f"CGR-AUD-{A}"].source_url == f"https://www.contraloria.cl/buscadorpdf/auditoria/{A}/html"
    assert {r.amount_clp for r in read("findings")} == {20_000_000}
    assert sorted((r.source_id, r.status) for r in read("source_runs")) == [("audit_detail", "ERROR"), ("cgr_fiscalizaciones", "OK"), ("gone", "ERROR")]
    again = cli.main(["discover", "--root", root, "--pause", "0"]) if (tmp_path / "config/collections.json").write_text(json.dumps({"collections": [{"id": "CC-MAIN-2020-05", "cdx-api": f"{server}/CC-MAIN-2020-05"}, {"id": "CC-MAIN-2001-05", "cdx-api": "x"}], "prefixes": ["a/"]})) else {}
    assert (again["collections"], again["errors"], again["new_audit_registry"]) == (1, 0, 1)
    assert cli.main(["discover", "--root", root, "--pause", "0"])["collections"] == 0
    assert [(r.audit_hash, r.status) for r in read("audit_registry")] == [(B, "DISCOVERED")]
