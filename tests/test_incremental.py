"""Derivation over changes against a full one, and publication under a manifest."""

import json

import pytest
from pyspark.sql import functions as F

from fiscalis.plans.derive import derive
from fiscalis.plans.incremental import by_group, derive_changes, finding_changes, group_sums
from fiscalis.sources import publication, scratch

DOCS = "document_id string, title string, raw_text string, document_date string, region string, unit_cgr string"
FINDS = "finding_id string, document_id string, description string, amount_clp long"
BODIES = ("MUNICIPALIDAD DE LOS LAGOS", "MUNICIPALIDAD DE PICA", "HOSPITAL DE CURICÓ", "SERVICIO DE SALUD NORTE")
FIRMS = ("Constructora Los Robles Ltda.", "Aridos Norte SpA", "Obras Sur Ltda.", "Fundación Nueva Vida", "Transportes Pica SpA")


def document(i, year=2019):
    return (f"D{i}", f"INFORME {BODIES[i % 4]} AUDITORÍA", f"OBJETIVO pagos durante el año {year} CONCLUSIONES x", f"05-03-20{10 + i % 9}", "Región de Los Lagos" if i % 3 else "", "u")


def finding(i, doc, more=""):
    kinds = (f"Pagos improcedentes a {FIRMS[i % 5]} Se formulará reparo", f"Fondos para fines distintos, pagó el día {1 + i % 27} de abril de 2020", f"Licitación con {FIRMS[(i * 3) % 5]}, don Pedro Soto, alcalde", "Sin observaciones")
    return (f"F{i}", f"D{doc}", kinds[i % 4] + more, 1_000_000 * i if i % 3 else None)


def plain(df):
    return sorted(json.dumps(r, sort_keys=True, default=str) for r in (x.asDict(recursive=True) for x in df.collect()))


def test_incremental_equals_full(spark, tmp_path):
    root = f"file://{tmp_path}/gold"
    watch = spark.createDataFrame([("W1", "Auditoría municipalidad lagos informe", "a", "b")], "watch_id string, title string, first_seen string, last_seen string")
    docs, finds = {i: document(i) for i in range(10)}, {i: finding(i, i % 10) for i in range(40)}
    tables = lambda: (spark.createDataFrame(list(docs.values()), DOCS), spark.createDataFrame(list(finds.values()), FINDS), watch)
    assert derive_changes(*tables(), root)["findings_derived"] == 40
    docs.pop(7)
    docs[2] = document(2, 2015)  # its findings take the year over
    finds = {i: f for i, f in finds.items() if f[1] != "D7"} | {100: finding(101, 3, " y otro"), 5: finding(5, 5, " por 3 millones")}
    stats = derive_changes(*tables(), root)
    assert [stats[f"findings_{k}"] for k in ("inserted", "updated", "unchanged", "deleted", "derived")] == [1, 5, 31, 4, 6]
    got, want = publication.read_published(spark, root), derive(*tables(), work=f"file://{tmp_path}/full")
    for name in ("finding_enrichment", "organization_profiles", "provider_profiles", "relationships", "enforcement_events", "kpis"):
        df = want[name]
        assert plain(got[name].select(*df.columns)) == plain(df), name


def test_changes_of_findings(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "finding_id string, v int")
    new = spark.createDataFrame([("a", 1), ("b", 5), ("d", 4)], "finding_id string, v int")
    then = finding_changes(old, None)
    assert {r.change for r in then.collect()} == {"inserted"}
    assert {r.finding_id: r.change for r in finding_changes(new, then).collect()} == {"a": "unchanged", "b": "updated", "c": "deleted", "d": "inserted"}


def test_groups_that_are_not_touched_stay(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4), (None, 9)], "g string, v int")
    then = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5), ("d", 6)], "g string, v int")
    asked = []

    def of(df):
        def compute(groups):
            asked.append(sorted(r.g for r in groups.collect()))
            return df.join(groups, "g", "left_semi").groupBy("g").agg(F.sum("v").alias("s"))

        return compute

    old_sums = scratch.written(group_sums("g", rows), "sums")
    old = by_group("g", old_sums, None, None, of(rows))
    new = by_group("g", group_sums("g", then), old_sums, old, of(then))
    assert {r.g: r.s for r in new.collect()} == {"a": 3, "b": 5, "d": 6} and asked == [["a", "b", "c"], ["b", "d"]]


def test_publication_is_all_or_nothing(spark, tmp_path):
    root = f"file://{tmp_path}/out"
    one = {"a": spark.range(5), "b": spark.range(2).withColumn("x", F.lit("y"))}
    assert publication.read_published(spark, root) == {}
    assert publication.publish(one, root) == {"a": 5, "b": 2}
    broken = spark.range(3).withColumn("x", F.raise_error(F.lit("half way")))
    with pytest.raises(Exception, match="half way"):
        publication.publish({"a": spark.range(50), "b": broken}, root)
    assert {k: v.count() for k, v in publication.read_published(spark, root).items()} == {"a": 5, "b": 2}
    for n in (7, 8):
        publication.publish({"a": spark.range(n)}, root)
    assert {k: v.count() for k, v in publication.read_published(spark, root).items()} == {"a": 8}
    assert len([x for x in (tmp_path / "out").iterdir() if x.name.startswith("v")]) == 2  # what broke off is gone as well
    assert publication.verify(spark, root) == {"a": True}
    version = publication.newest(spark, root)["a"]["path"]
    spark.range(3, 11).write.mode("overwrite").parquet(f"{root}/{version}")
    assert publication.verify(spark, root) == {"a": False}
