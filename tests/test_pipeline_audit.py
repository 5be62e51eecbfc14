import json

import pytest
from pyspark.sql import functions as F

from fiscalis.plans.derive import derive
from fiscalis.sources import tables
from fiscalis.streaming import ingest


def corpus(spark):
    docs = spark.createDataFrame(
        [("D1", "INFORME MUNICIPALIDAD DE LOS LAGOS AUDITORÍA", "OBJETIVO pagos durante el año 2019 CONCLUSIONES x", "05-03-2021", "Región de Los Lagos", "u"), ("D2", "Otro", "", "", "", "")],
        "document_id string, title string, raw_text string, document_date string, region string, unit_cgr string",
    )
    rows = [
        ("F1", "D1", "Pagos improcedentes a Constructora Los Robles Ltda. Se formulará reparo", 20_000_000),
        ("F2", "D1", "Fondos para fines distintos, pagó el día 7 de abril de 2020", None),
        ("F3", "D2", "Sin observaciones", None),
    ]
    finds = spark.createDataFrame(rows, "finding_id string, document_id string, description string, amount_clp long")
    watch = spark.createDataFrame([("W1", "Auditoría municipalidad lagos informe", "a", "b")], "watch_id string, title string, first_seen string, last_seen string")
    return docs, finds, watch


def test_derivation_end_to_end(spark, tmp_path):
    marts = derive(*corpus(spark), work=f"file://{tmp_path}/work")
    rows = {r.finding_id: r for r in marts["finding_enrichment"].collect()}
    assert rows["F1"].organization_name == "MUNICIPALIDAD DE LOS LAGOS" and rows["F1"].region == "Los Lagos"
    assert rows["F1"].occurrence["precision"] == "AUDIT_YEAR" and rows["F2"].occurrence["from"] == "2020-04-07"
    assert rows["F3"].organization_id == "" and rows["F3"].occurrence["precision"] == "UNKNOWN"
    assert [r.name for r in marts["provider_links"].collect()] == ["Constructora Los Robles Ltda"] or [r.name for r in marts["provider_links"].collect()] == ["Constructora Los Robles Ltda."]
    assert marts["organization_profiles"].first().reparos == 1
    written = tables.write_marts(marts, f"file://{tmp_path}/gold")
    assert written["kpis"] == 1 and written["penal_cases"] > 0 and spark.read.parquet(f"{tmp_path}/gold/kpis").first().findings == 3


def test_jsonl_round_trip_and_absent_table(spark, tmp_path):
    spec = tables.SPECS["providers"]
    assert tables.read_jsonl(spark, spec, f"file://{tmp_path}/none").count() == 0
    df = spark.createDataFrame([("b", "B"), ("a", "Á")], "provider_id string, name string")
    whole = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(spec.schema[c].dataType).alias(c) for c in spec.schema.names])
    tables.write_jsonl(whole, spec, f"file://{tmp_path}/p")
    assert sorted(tuple(r) for r in tables.read_jsonl(spark, spec, f"file://{tmp_path}/p").collect()) == sorted(tuple(r) for r in whole.collect())


def test_snapshots(spark, tmp_path):
    from pyspark.sql.types import StructType

    place = tmp_path / "bronze" / "s1" / "2024-01-02"
    place.mkdir(parents=True)
    (place / "snapshot.json").write_text(json.dumps({"title": "t"}, indent=1))
    (r,) = tables.read_snapshots(spark, f"file://{tmp_path}/bronze", StructType.fromDDL("title string")).collect()
    assert (r.title, r.source_id, r.run_date) == ("t", "s1", "2024-01-02")
    cfg = tmp_path / "c.json"
    cfg.write_text(json.dumps({"sources": [{"id": "a", "enabled": False}, {"id": "b"}]}))
    assert [x.id for x in tables.enabled_sources(spark, f"file://{cfg}").collect()] == ["b"]


def test_stream_merges_like_a_batch(spark, tmp_path):
    spec = tables.TableSpec("t", "k", "k string, v int, last_seen string")
    src = f"{tmp_path}/in"
    stream = spark.readStream.schema(spec.schema)
    for rows in ([("a", 1, "t0"), ("b", 2, "t0")], [("a", 1, "t1"), ("b", 3, "t1"), ("c", 4, "t1")]):
        spark.createDataFrame(rows, spec.schema).coalesce(1).write.mode("append").parquet(src)
        ingest.stream_upserts(stream.parquet(src), f"file://{tmp_path}/out", spec, "last_seen", f"{tmp_path}/ck").awaitTermination()
    got = {r.k: (r.v, r.last_seen) for r in ingest.current_version(spark, f"file://{tmp_path}/out", spec).collect()}
    assert got == {"a": (1, "t0"), "b": (3, "t1"), "c": (4, "t1")}


def test_a_stream_that_begins_anew_goes_on(spark, tmp_path):
    spec = tables.TableSpec("t", "k", "k string, v int, last_seen string")
    stream = spark.readStream.schema(spec.schema)
    for n in range(3):
        src = f"{tmp_path}/in{n}"
        spark.createDataFrame([("a", n, f"t{n}")], spec.schema).write.parquet(src)
        ingest.stream_upserts(stream.parquet(src), f"file://{tmp_path}/out", spec, "last_seen", f"{tmp_path}/ck{n}").awaitTermination()
        assert ingest.current_version(spark, f"file://{tmp_path}/out", spec).first().v == n
    assert len([x for x in (tmp_path / "out").iterdir() if x.name.startswith("v")]) == 2


def test_a_batch_writes_the_buckets_of_its_keys_only(spark, tmp_path):
    spec = tables.TableSpec("t", "k", "k string, v int, last_seen string")
    root = f"file://{tmp_path}/out"
    write = ingest.merge_batch(root, spec, "last_seen", buckets=64)
    rows = lambda part: spark.createDataFrame(part, spec.schema)
    write(rows([(f"k{i}", i, "t0") for i in range(2000)]), 0)
    files = lambda: {str(x.relative_to(tmp_path / "out")) for x in (tmp_path / "out").glob("v*/bucket=*")}
    before = files()
    assert len(before) == 64
    want = {f"k{i}": (i, "t0") for i in range(2000)}
    for n in range(1, 6):
        batch = [(f"k{i * 7 * n}", -n, f"t{n}") for i in range(8)] + [(f"new{n}", n, f"t{n}"), (f"k{n}", n, f"t{n}")]  # the last one is unchanged
        write(rows(batch), n)
        new = {x for x in files() - before if x.startswith(f"v{n:012d}")}
        assert 0 < len(new) <= 10
        want |= {k: (v, t) for k, v, t in batch if want.get(k, (None,))[0] != v}
        assert {r.k: (r.v, r.last_seen) for r in ingest.current_version(spark, root, spec).collect()} == want
        assert len(ingest.manifests(spark, root)[2]) == 2
    held = ingest.read_manifest(spark, root, ingest.manifests(spark, root)[2][-1]).held
    assert {f"{v}/bucket={b}" for b, v in held.items()} <= files() and len(files()) <= 64 + 10
    few = ingest.current_version(spark, root, spec, ["k7", "new3", "absent"])
    assert sorted(r.k for r in few.collect()) == ["k7", "new3"] and len(few.inputFiles()) <= 3
    write(rows([]), 6)
    write(rows([(None, 1, "t")]), 7)
    assert len(ingest.manifests(spark, root)[2]) == 2 and ingest.current_version(spark, root, spec).count() == len(want)


def test_a_batch_that_stops_half_way_changes_nothing(spark, tmp_path, monkeypatch):
    spec = tables.TableSpec("t", "k", "k string, v int, last_seen string")
    root = f"file://{tmp_path}/out"
    write = ingest.merge_batch(root, spec, "last_seen", buckets=8)
    write(spark.createDataFrame([("a", 1, "t0"), ("b", 2, "t0")], spec.schema), 0)
    with monkeypatch.context() as m:
        m.setattr(ingest, "write_manifest", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            write(spark.createDataFrame([("a", 5, "t1")], spec.schema), 1)
    assert {r.k: r.v for r in ingest.current_version(spark, root, spec).collect()} == {"a": 1, "b": 2}
    write(spark.createDataFrame([("a", 5, "t1")], spec.schema), 1)
    assert {r.k: r.v for r in ingest.current_version(spark, root, spec).collect()} == {"a": 5, "b": 2}


def test_an_empty_mart_replaces_the_old_one(spark, tmp_path):
    df = spark.range(3)
    assert tables.write_marts({"m": df}, f"file://{tmp_path}") == {"m": 3}
    assert tables.write_marts({"m": df.filter("id > 9")}, f"file://{tmp_path}") == {"m": 0}
    assert spark.read.parquet(f"{tmp_path}/m").count() == 0


def test_configuration(spark, tmp_path):
    from fiscalis.sources import config

    (tmp_path / "h.json").write_text(json.dumps({"news_archives": [{"url": "n", "enabled": False}], "reference_pages": [], "known_audits": [{"url": "https://x/buscadorpdf/auditoria/" + "a" * 32 + "/html"}, {"url": "bad"}]}))
    got = config.history(spark, f"file://{tmp_path}/h.json")
    assert got["news_archives"].count() == 0 and [(r.channel, r.source) for r in got["known_audits"].collect()] == [("KNOWN_SEED", "CONFIG")]
    assert all(df.count() == 0 for df in config.history(spark, f"file://{tmp_path}/none.json").values())
    (tmp_path / "s.json").write_text(json.dumps({"sources": [{"id": "cgr_semaforo", "url": "u"}, {"id": "b", "url": "v", "collector": "news_index"}, {"id": "c", "enabled": False}]}))
    assert sorted((r.id, r.reader) for r in config.sources(spark, f"file://{tmp_path}/s.json").collect()) == [("b", "NEWS"), ("cgr_semaforo", "MUNICIPAL")]
    (tmp_path / "a.json").write_text(json.dumps({"audits": [{"url": "u1"}, {"url": "u2", "enabled": False}]}))
    assert [r.url for r in config.seed_audits(spark, f"file://{tmp_path}/a.json").collect()] == ["u1"]


def test_fetching_gives_rows_for_errors(spark):
    import http.server
    import threading

    from fiscalis.sources.http import FetchParams, fetch_pages

    class Handler(http.server.BaseHTTPRequestHandler):
        tries = 0

        def do_GET(self):
            Handler.tries += self.path == "/later"
            status = 200 if self.path == "/ok" or Handler.tries > 1 and self.path == "/later" else 503 if self.path == "/later" else 404
            self.send_response(status)
            self.end_headers()
            self.wfile.write("año".encode())

        def log_message(self, *a):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    at = f"http://127.0.0.1:{server.server_port}"
    df = spark.createDataFrame([(f"{at}/ok",), (f"{at}/none",), (f"{at}/later",), ("nonsense",), (f"{at}/ok",)], "url string")
    got = {r.requested.rpartition("/")[2]: r for r in fetch_pages(df, FetchParams(timeout=5, backoff=0.01)).collect()}
    server.shutdown()
    assert (got["ok"].html, got["ok"].http_status, got["ok"].error) == ("año", 200, "")
    assert (got["none"].http_status, got["none"].error) == (404, "HTTPError: 404") and got["later"].html == "año"
    assert got["nonsense"].error.startswith("ValueError") and len(got) == 4
