"""Landing: one reading of a page, walks over an archive, links in linear time."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from fiscalis.operators import landing
from fiscalis.queries import landing as queries
from fiscalis.sources import html, scratch


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["landing_rows", "article_rows", "audit_links", "page_headings", "reference_batches"])
def test_a_page_is_read_once(spark, sf_dir, name):
    assert len(re.findall(r"(?:ArrowEvalPython|BatchEvalPython|MapInPandas)", plan_of(queries.QUERIES[name](spark, sf_dir)))) == 1


def test_parts_of_a_page(spark):
    page = '<h2>Uno <b>dos</b></h2><script>no</script><p>a <a href="/x">y</a></p><table><tr><th>A</th></tr><tr><td> b  c</td></tr></table><li>z</li>'
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "i int, html string")
    names = list(html.PARTS)
    one, *rest = df.select("i", html.parts(F.col("html"), *names).alias("p")).orderBy("i").select("p.*").collect()
    assert one.links == [("/x", "y")] and one.headings == [("h2", "Uno dos")] and one.text.split("\n")[:2] == ["Uno", "dos"]
    assert one.cells == [(0, 0, 0, True, "A"), (0, 1, 0, False, "b c")] and [b.tag for b in one.blocks] == ["h2", "p", "a", "tr", "tr", "li"]
    assert all(not r[n] for r in rest for n in names)
    assert [tuple(r) for r in html.table_cells(df, "i").collect()] == [(1, 0, 0, 0, True, "A"), (1, 0, 1, 0, False, "b c")]


def test_official_links_of_a_page_with_very_many(spark):
    n = 20_000
    anchors = [("https://www.contraloria.cl/p%d" % (i % (n // 2)), f"t{i}", "h") for i in range(n)]
    df = spark.createDataFrame([(anchors,)], "anchors array<struct<url:string,text:string,href:string>>")
    began = time.perf_counter()
    (row,) = df.select(landing.official_links(F.col("anchors"), 80).alias("l")).collect()
    assert [tuple(x) for x in row.l] == [(f"https://www.contraloria.cl/p{i}", f"t{i}") for i in range(80)]
    assert time.perf_counter() - began < 20


def walk(after, articles, start, max_pages, max_articles):
    visited, frontier = [], [start]
    while frontier and len(visited) < max_pages:
        frontier = frontier[: max_pages - len(visited)]
        visited += frontier
        seen = set(visited)
        frontier = [u for u in dict.fromkeys(u for page in frontier for u in after.get(page, ())) if u not in seen]
    return visited, sorted({a for u in visited for a in articles.get(u, ())})[:max_articles]


def archive(seed, n=60):
    rng = random.Random(seed)
    after = {f"p{i}": [f"p{rng.randrange(n + 8)}" for _ in range(rng.randrange(4))] for i in range(n)}
    after["p0"] = ["p3", "p1", "p3", "p0", "p2"]
    return after, {u: [f"a{rng.randrange(40)}" for _ in range(2)] for u in after}


def in_order(visited):
    return [r.url for r in visited.orderBy("level", "seq").collect()]


@pytest.mark.parametrize(("seed", "most"), [(1, 500), (2, 17), (3, 1), (4, 30)])
def test_crawl_equals_a_walk_in_memory(spark, seed, most):
    after, articles = archive(seed)
    pages = spark.createDataFrame([(u, after[u], articles[u]) for u in after], "source_url string, next array<string>, articles array<string>").repartition(4)
    visited, found = landing.crawl(pages, "p0", most, 9)
    want = walk(after, articles, "p0", most, 9)
    assert in_order(visited) == want[0] and [r.url for r in found.orderBy("url").collect()] == want[1]


def test_crawl_goes_on_after_a_stop(spark):
    after, articles = archive(5)
    asked = []

    def fetched(frontier):
        urls = [r.url for r in frontier.collect()]
        if len(asked) == 2 and not stopped:
            stopped.append(True)
            raise ConnectionError("the driver is lost")
        asked.append(urls)
        return spark.createDataFrame([(u, after[u], articles[u]) for u in urls if u in after], "source_url string, next array<string>, articles array<string>")

    stopped = []
    state = scratch.fresh_path(spark, "crawl-test")
    with pytest.raises(ConnectionError):
        landing.crawl(fetched, "p0", 40, 500, state, spark)
    visited, found = landing.crawl(fetched, "p0", 40, 500, state, spark)
    want = walk(after, articles, "p0", 40, 500)
    assert in_order(visited) == want[0] and [r.url for r in found.orderBy("url").collect()] == want[1]
    flat = [u for urls in asked for u in urls]
    assert len(flat) == len(set(flat))  # no page is fetched twice
