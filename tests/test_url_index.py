"""The url index as a data source, against a local server."""

import http.server
import json
import threading
from urllib.parse import parse_qs, urlparse

import pytest

from fiscalis.operators import queues
from fiscalis.sources import scratch
from fiscalis.sources.tables import SPECS
from fiscalis.sources.url_index import read_index, scanned

HASHES = [f"{i:032x}" for i in range(1, 60)]


def line(h, legacy=False):
    return json.dumps({"url": f"https://www.contraloria.cl/x?docIdcm={h.upper()}" if legacy else f"https://www.contraloria.cl/buscadorpdf/auditoria/{h}/html"})


class Handler(http.server.BaseHTTPRequestHandler):
    asked: list[tuple] = []
    failures = {"CC-MAIN-2019-05": 1}

    def log_message(self, *a):
        pass

    def answer(self, status, body=""):
        self.send_response(status)
        self.end_headers()
        self.wfile.write(body.encode())

    def do_GET(self):
        u = urlparse(self.path)
        q = {k: v[0] for k, v in parse_qs(u.query).items()}
        cid, page = u.path.strip("/"), q.get("page")
        Handler.asked.append((cid, q["url"], page, "showNumPages" in q))
        if "showNumPages" in q:
            if Handler.failures.get(cid):  # passes on the second try
                Handler.failures[cid] -= 1
                return self.answer(503)
            if cid == "CC-MAIN-2021-10":
                return self.answer(500)
            if q["url"] == "none/":
                return self.answer(404)
            return self.answer(200, "" if cid == "CC-MAIN-2015-01" and q["url"] == "b/" else "one page" if cid == "CC-MAIN-2015-01" else json.dumps({"pages": 7 if q["url"] == "a/" else 2}))
        if cid == "CC-MAIN-2015-01" and page is not None:  # knows no paging
            return self.answer(400)
        if cid == "CC-MAIN-2019-05" and q["url"] == "b/":
            return self.answer(404 if page == "0" else 500)
        if page is None:
            return self.answer(200, "\n".join([line(HASHES[50]), "not json", line(HASHES[51], True), "[1]", ""]))
        k = int(page)
        return self.answer(200, "\n".join(line(h, k % 2) for h in HASHES[3 * k : 3 * k + 4]))


@pytest.fixture(scope="module")
def server():
    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_pages_retries_and_errors(spark, server):
    names = ["CC-MAIN-2015-01", "CC-MAIN-2019-05", "CC-MAIN-2021-10"]
    collections = [{"id": n, "cdx-api": f"{server}/{n}"} for n in names]
    df = read_index(spark, collections, ["a/", "b/", "none/"], pause=0.0, backoff=0.01, retries=1, maxPages=5, pagesPerPartition=2, timeout=5.0)
    assert df.rdd.getNumPartitions() >= 1 + 3 + 1 + 3  # unpaged, five pages by two, two pages, three errors of the count
    lines = scratch.written(df, "index")
    rows = lines.collect()
    by = lambda c, p: [r for r in rows if (r.collection_id, r.prefix) == (c, p)]
    assert [r.url is None for r in by("CC-MAIN-2015-01", "a/")] == [False, True, False, True]  # read again without paging
    assert by("CC-MAIN-2015-01", "b/") == [] == by("CC-MAIN-2019-05", "none/")
    got = by("CC-MAIN-2019-05", "a/")
    assert sorted({r.page for r in got}) == [0, 1, 2, 3, 4] and len(got) == 20 and not any(r.error for r in got)  # no more than maxPages
    assert [(r.page, r.line, r.error) for r in by("CC-MAIN-2019-05", "b/")] == [(1, None, "ConnectionError: HTTPError: 500")]
    assert [r.error for p in ("a/", "b/", "none/") for r in by("CC-MAIN-2021-10", p)] == ["ConnectionError: HTTPError: 500"] * 3
    assert ("CC-MAIN-2019-05", "a/", "5", False) not in Handler.asked

    registry = spark.createDataFrame([("AUDREG-" + HASHES[0], HASHES[0], "FETCHED", 2, "t-1", "KNOWN_SEED", "CONFIG", "D1", "", "", "", ["CC-MAIN-2013-01"])], "registry_id string, audit_hash string, status string, attempts int, first_seen string, discovery_channel string, discovery_source string, document_id string, document_date string, document_number string, last_error string, discovery_collections array<string>")
    state = spark.createDataFrame([("CC-MAIN-2013-01", "SCANNED", 4, "t-1", "")], "collection_id string, status string, hashes_found bigint, last_scanned string, last_error string")
    indexes = spark.createDataFrame([(n,) for n in names], "collection_id string")
    found, after = scanned(lines, indexes, registry, state, "t0")
    got = {r.audit_hash: r for r in found.collect()}
    assert set(got) == set(HASHES[:16]) | {HASHES[50], HASHES[51]}
    first = got[HASHES[0]]
    assert (first.status, first.attempts, first.discovery_channel, first.discovery_collections) == ("FETCHED", 2, "KNOWN_SEED", ["CC-MAIN-2013-01", "CC-MAIN-2019-05"])
    assert (got[HASHES[50]].status, got[HASHES[50]].discovery_source) == ("DISCOVERED", "CC-MAIN-2015-01")
    assert {r.collection_id: (r.status, r.hashes_found) for r in after.collect()} == {"CC-MAIN-2013-01": ("SCANNED", 4), "CC-MAIN-2015-01": ("SCANNED", 2), "CC-MAIN-2019-05": ("ERROR", 16), "CC-MAIN-2021-10": ("ERROR", 0)}
    assert [r.collection_id for r in queues.scannable_collections(indexes, after, 2014, 2026).collect()] == ["CC-MAIN-2019-05", "CC-MAIN-2021-10"]
    assert SPECS["audit_registry"].key in found.columns


def test_nothing_to_read(spark):
    assert read_index(spark, [], ["a/"]).collect() == []
