"""What only larger tables or repeated urls show, on small inputs."""

import duckdb
import pytest

import __spark_entry__ as entry


def test_municipal_snapshot_broadcasts_nothing(spark, sf_dir):
    """A table with a row per page was sent to the driver and did not fit there at 900,000 pages."""
    df = entry.queries()["municipal_snapshot"](spark, sf_dir)
    assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_municipal_snapshot_reads_days_of_the_largest_table_only(spark):
    from fiscalis.operators.publications import municipal_snapshot

    head = [(1, 1, r, i, True, f"x ({10 + i:02d}/{1 + r:02d})") for r in range(3) for i in range(8)]
    data = [(1, 1, r, 8 + i, False, f"c{r}" if i == 0 else "v") for r in range(3) for i in range(10)]
    other = [(1, 0, 0, i, i < 8, "(01/01)") for i in range(18)] + [(2, 0, 0, i, False, "w") for i in range(10)]
    cells = spark.createDataFrame(head + data + other, "page int, table int, row int, cell int, is_header boolean, text string")
    got = {(r.commune, r.indicator_code): r.indicator_as_of_ddmm for r in municipal_snapshot(cells, "2024-01-01").collect()}
    assert len(got) == 32 and {c for c, _ in got} == {"c0", "c1", "c2", "w"}
    # 24 days stand in pairs: every other of the first sixteen
    assert sorted(v for (c, _), v in got.items() if c == "c1") == sorted(["10/01", "12/01", "14/01", "16/01", "10/02", "12/02", "14/02", "16/02"])
    assert {v for (c, _), v in got.items() if c == "w"} == {""}


def test_equal_counts_of_labels_rank_as_in_the_sql(spark):
    """Of F-1 and F-10 the SQL, which compares ids that end with a bar, meets F-10 first."""
    from fiscalis.plans.dashboard import ranked_labels

    rows = spark.createDataFrame([("g", "F-1", ["a"]), ("g", "F-10", ["b"]), ("g", "F-2", [f"x{i:02d}" for i in range(11)])], "g string, finding_id string, labels array<string>")
    (r,) = ranked_labels(rows, "g", "labels", 20).collect()
    assert [x["name"] for x in r.top_labels] == ["b", "a", *[f"x{i:02d}" for i in range(11)]]


@pytest.fixture(scope="module")
def repeated(spark, tmp_path_factory):
    """Thirty pages of seven urls, one of them missing."""
    folder = str(tmp_path_factory.mktemp("repeated"))
    rows = [(i, f"https://h/{i % 7}" if i % 7 < 6 else None, f"<h1>{i}</h1>") for i in range(30)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    return folder


def equals_sql(spark, folder, name):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{folder}/pages.parquet/*.parquet'")
    df = entry.queries()[name](spark, folder)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)
    want = con.execute(f"select {', '.join(cols)} from ({entry.oracle_sql()[name]})").fetchall()
    assert got == sorted(want, key=str) and got


@pytest.mark.parametrize("name", ["registered_hashes", "searched_hashes", "synced_documents"])
def test_pages_that_share_a_url_are_rows_of_their_own(spark, repeated, name):
    equals_sql(spark, repeated, name)


def test_registry_keeps_every_state_of_a_url(spark, tmp_path):
    rows = [(i, f"https://h/{i % 7}", "") for i in range(30)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    equals_sql(spark, str(tmp_path), "registry_sync_full_outer")


def test_page_headings_decode_what_the_sql_decodes(spark, tmp_path):
    odd = ["a &amp;&amp", "x &quot;y&quot; &quo", "&amp;lt; &lt;b&gt; &#39;", " two \t\r\f blanks ", "R & D &copy; &#60; &nbsp;x", ""]
    pages = [f"<p>&lt;h1&gt;</p><h1>{h}</h1><h1>next</h1>" for h in odd] + ["<h2>second</h2>", "", None]
    spark.createDataFrame([(i, "u", h) for i, h in enumerate(pages)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    equals_sql(spark, str(tmp_path), "page_headings")


def test_headings_of_the_reader_decode_as_html_does(spark):
    from fiscalis.sources import html as H

    df = spark.createDataFrame([("<h2 id='i'>a &quot;b&quot; &amp</h2><h1>c</h1>",)], "html string")
    found = H.parts(df.html, "headings")["headings"]
    assert df.select(H.first_heading(found, "h1", "h2", "h3"), H.first_heading(found, "h1"), H.first_heading(found, "h4")).first() == ('a "b" &', "c", "")
