"""Every query with SQL against DuckDB on the small tables."""

import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from fiscalis import queries as audit

MAY_BE_EMPTY = {"anti_join_quality_gate"}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return ("decimal", v)
    return v


@pytest.mark.parametrize("name", sorted(audit.SQL))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = audit.QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    sql = audit.SQL[name]
    assert sorted(duck.sql(sql).columns) == cols
    want = sorted((tuple(plain(v) for v in r) for r in duck.sql(f"select {', '.join(cols)} from ({sql})").fetchall()), key=str)
    assert got == want and (got or name in MAY_BE_EMPTY)


@pytest.mark.parametrize("partitions", ["1", "4", "200"])
@pytest.mark.parametrize("name", ["organization_details", "provider_details", "region_details", "penal_case_list", "alerts_list", "token_overlap_best", "relationship_promotion"])
def test_plans_that_use_a_table_twice_agree_in_every_layout(spark, sf_dir, duck, name, partitions):
    """Without adaptive execution, which would merge the partitions again."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        df = audit.QUERIES[name](spark, sf_dir)
        cols = sorted(df.columns)
        got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert got == sorted((tuple(plain(v) for v in r) for r in duck.sql(f"select {', '.join(cols)} from ({audit.SQL[name]})").fetchall()), key=str)


@pytest.mark.parametrize("name", ["occurrence_cascade", "temporal_precision", "temporal_years"])
def test_dates_equal_sql_on_the_larger_table(spark, name):
    """Ranges that are refused and leave a single day occur from this size on."""
    larger = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view orders as select * from '{larger}/orders.parquet'")
    df = audit.QUERIES[name](spark, larger)
    cols = ", ".join(sorted(df.columns))
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*sorted(df.columns)).collect()), key=str)
    assert got == sorted((tuple(plain(v) for v in r) for r in con.sql(f"select {cols} from ({audit.SQL[name]})").fetchall()), key=str)


@pytest.mark.parametrize("name", sorted(set(audit.QUERIES) - set(audit.SQL)))
def test_query_without_sql_has_rows(spark, sf_dir, name):
    assert audit.QUERIES[name](spark, sf_dir).count() > 0


def test_entry_points(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
