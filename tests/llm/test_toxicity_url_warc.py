import hashlib
from zlib import crc32

import duckdb
import numpy as np
import pytest

from fiscalis.llm.toxicity import FactorizationMachine, ToxicityParams, fit_fm, interacting, op9_toxicity_fm, term_slots, toxicity, word_slots
from fiscalis.llm.urlfilter import LABELLED_URLS, Rule, filter_urls, op7_url_filter, train_urls
from fiscalis.llm.warc import SQL_OP10, op10_warc_revisits, read_archives, resolve_read, write_archives


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in op9_toxicity_fm(spark, sf).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 for i, r in rows.items())
    assert all(r.predicted == int(r.score >= 0.3) for r in rows.values())
    held = [(rows[i].predicted, y) for i, y in labels.items() if rows[i].held_out]
    hits = sum(p and y for p, y in held)
    assert hits / sum(p for p, _ in held) > 0.85 and hits / sum(y for _, y in held) > 0.7
    scores = [(rows[i].score, y) for i, y in labels.items() if rows[i].held_out]
    bad, good = [s for s, y in scores if y], [s for s, y in scores if not y]
    assert np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good]) > 0.95


def test_scores_equal_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    fm = FactorizationMachine(np.array([3, 5, 9, 11]), 0.3, rng.normal(size=4), rng.normal(size=(4, 3)))
    for row in ([], [3], [5, 9], [3, 4, 5, 9, 11, 12]):
        at = [i for i, s in enumerate(fm.slots.tolist()) if s in row]
        want = 0.3 + sum(fm.w[i] for i in at) + sum(float(fm.v[i] @ fm.v[j]) for i in at for j in at if i < j)
        assert abs(fm.margins([np.array(row, np.int64)])[0] - want) < 1e-9


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_toxicity_learns_an_interaction_that_is_not_additive(seed):
    rng = np.random.default_rng(seed)
    p = ToxicityParams()
    a, b = term_slots(b"aaaa", p.bits), term_slots(b"bbbb", p.bits)
    fill = [term_slots(f"word{i}".encode(), p.bits) for i in range(3)]
    rows, y = [], []
    for i in range(1200):
        x, z = (rng.random(2) < 0.5).tolist()
        parts = [a] * x + [b] * z + [fill[i % 3]]
        rows.append(np.unique(np.concatenate(parts)))
        y.append(float(x == z if seed % 2 else x != z))
    fm = fit_fm(rows, np.array(y), p)
    assert ((fm.scores(rows) >= 0.5) == np.array(y, bool)).mean() > 0.95


@pytest.mark.parametrize("others", [100, 4000])
def test_an_interaction_among_more_frequent_terms(others):
    """Two terms in 30 % of the rows that tell nothing alone, among terms in 45 % of them; default parameters."""
    rng = np.random.default_rng(others)
    n = 5000
    pair, rest = rng.random((n, 2)) < 0.3, rng.random((n, others)) < 0.45
    slots = rng.permutation(1 << 20)[: others + 2]
    rows = [np.sort(slots[np.flatnonzero(np.append(a, b))]) for a, b in zip(pair, rest, strict=True)]
    y = (rng.random(n) < np.where(pair.all(axis=1), 0.95, 0.05)).astype(float)
    fm = fit_fm(rows, y, ToxicityParams())
    scores = fm.scores(rows)
    assert set(slots[:2]) <= set(fm.slots.tolist())
    assert scores[pair.all(axis=1)].mean() > 0.85 and scores[~pair.all(axis=1)].mean() < 0.15
    if others > 100:
        return
    odd = (rng.random(n) < np.where(pair[:, 0] == pair[:, 1], 0.05, 0.95)).astype(float)
    assert ((fit_fm(rows, odd, ToxicityParams()).scores(rows) >= 0.5) == odd.astype(bool)).mean() > 0.9


def test_interacting_pairs_equal_the_dense_score_test():
    rng = np.random.default_rng(8)
    n, p = 640, ToxicityParams(min_pair=6.0)
    x = rng.random((n, 90)) < np.append(rng.random(30) * 0.5, rng.random(60) * 0.06)
    y = (rng.random(n) < 0.1 + 0.6 * (x[:, 0] & x[:, 1]) + 0.5 * (x[:, 2] & x[:, 50])).astype(float)
    rows = [np.flatnonzero(r) * 7 for r in x]
    a, b, z = interacting(rows, y, p)
    got = {(min(i, j), max(i, j)): s for i, j, s in zip(a.tolist(), b.tolist(), z.tolist(), strict=True)}
    c = x - x.mean(axis=0)
    want = {}
    for i in range(90):
        for j in range(i + 1, 90):
            if all(p.min_docs <= x[:, k].sum() <= n - p.min_docs for k in (i, j)) and (x[:, i] & x[:, j]).any():
                s = ((y - y.mean()) @ (c[:, i] * c[:, j])) / np.sqrt(((c[:, i] * c[:, j]) ** 2).sum() * y.var())
                if s * s >= p.min_pair:
                    want[(7 * i, 7 * j)] = s
    assert len(want) > 10 and set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-3 for k in want)
    assert [len(part) for part in interacting([], np.empty(0), p)] == [0, 0, 0]


def test_terms_hold_the_words():
    text = "Añejo vino, añejo VINO\n".encode()
    assert len(word_slots(text, 20)) == 2 and set(word_slots(text, 20)) <= set(term_slots(text, 20))
    assert len(term_slots(None, 20)) == 0 == len(word_slots(b"", 20))


def test_toxicity_nulls_repeats_and_clashing_columns(spark):
    docs = spark.createDataFrame(
        [(i, f"awful word{i}" if i % 2 else f"fine word{i}", 1, "z") for i in range(200)] + [(None, None, 2, "z"), (5, "", 3, "y"), (5, "", 3, "y")],
        "doc_id long, text string, score int, y string",
    )
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(3, 1), (None, 1), (9, None)], "doc_id long, toxic int")
    out = toxicity(docs, labels, ToxicityParams(min_chi2=5.0)).collect()
    assert len(out) == 203 and set(out[0].asDict()) == {"doc_id", "text", "score", "y"}
    assert np.mean([(r.score >= 0.5) == bool(r.doc_id % 2) for r in out if r.text and r.doc_id is not None]) > 0.95
    assert toxicity(docs.filter("false"), labels.filter("false")).count() == 0


def plain_rule(host, path, rules):
    best = None
    for verdict, h, p in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return best


def test_url_rules_equal_brute_force(spark, sf_dir):
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    urls = {r.page_id: r.url for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    rows = op7_url_filter(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(urls)
    for r in rows:
        rest = urls[r.page_id].split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        path = rest[cut:].split("?")[0].split("#")[0]
        host = rest[:cut].lower()
        assert (r.host, r.path) == (host, path)
        best = plain_rule(host, path, rules)
        assert r.rule == (best[0] if best else None)
        assert r.verdict == (best[1] if best else ("block" if r.score >= 0.5 else "allow"))


def test_url_edges(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "HTTP://A.NET"), (5, "x://b.net/?q=/"), (6, "http://evilnet/"), (7, "a://ÄB.example.NET/en/x#y?z"), (7, "u://c?d://e"), (8, "http://h/p\nq?r")]
    df = spark.createDataFrame([(i, u, "mine") for i, u in rows], "page_id int, url string, host string")
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in filter_urls(df).orderBy("page_id", "path").collect()]
    assert got[0][1:4] == got[1][1:4] == got[2][1:4] == ("", "", None) and got[0][4] == "allow"
    assert got[3][1:4] == ("a.net", "", None) and got[4][1:] == ("b.net", "/", "net/", "block")
    assert got[5][1:4] == ("evilnet", "/", None)
    assert {g[1:4] for g in got[6:8]} == {("Äb.example.net", "/en/x", "example.net/en/"), ("c", "", None)}
    assert got[8][1:3] == ("h", "/p\nq")
    assert filter_urls(df.filter("false"), rules=[Rule("block", "net", "/")]).count() == 0


def test_url_classifier_on_unseen_hosts():
    score = train_urls().scorer()
    assert all((score(*_parts(u)) >= 0.5) == bool(y) for u, y in LABELLED_URLS)
    assert score("blog.lucky-casino.example.org", "/en/1") >= 0.5 > score("river.example.org", "/en/1")


#: Written for this test; none is learned from, and the wanted ones share words with unwanted hosts.
WANTED = """
pharmacy-school.example.org/admissions adult-literacy-class.example.com/en/1 student-loans-help.example.org/faq
responsible-gambling.example.org/help sportsmuseum.example.com/en/4 casinohistory.example.org/1920 pokerclub-library.example.com/books
dating-safety-advice.example.org/en/5 drugresearch.example.com/trials money-museum.example.org/coins creditcounsel-charity.example.com/en/9
parcel-tracking-support.example.com/status betsy-ross-house.example.org/tour essex.example.org/council middlesex-hospital.example.com/en/2
videoarchive.example.org/1968 dietitians-association.example.com/members clickstream-research.example.org/papers
medicine-journal.example.com/vol/3 analytics-conference.example.org/2024 cockpit-museum.example.com/en/12 sussex-news.example.org/today
pillar-of-salt.example.com/de/8 loanwords-dictionary.example.org/en/77 bonusmarsch-geschichte.example.com/de/5
slotcar-racing-club.example.org/en/3 winchester-cathedral.example.com/visit freedom-of-press.example.org/fr/6
cheapside-history.example.com/en/44 hotel-school.example.org/courses
""".split()
UNWANTED = """
mega-casino-win.example.com/en/5 freeslots777.example.org/play online-poker-bonus.example.com/de/9 hotcams-live.example.org/fr/2
cheap-viagra-online.example.com/buy buypillsnow.example.org/en/3 instant-payday-loans.example.com/apply
replica-watches-deals.example.org/shop xxx-videos.example.com/en/81 best-bookmaker-bets.example.org/es/4 real-money-jackpot.example.com/en/6
adult-hookups.example.org/fr/71 vip-escorts-berlin.example.com/de/1 crypto-profit-now.example.org/en/10 warez-cracks-free.example.com/dl
buyfollowers4you.example.org/en/19 cheap-steroids.example.com/fr/3 freespins-casino.example.org/en/2 livecamsxxx.example.com/en/5
no-prescription-meds.example.org/order fast-cash-loan.example.com/en/7 win-big-slots.example.org/es/33 sexy-dating-tonight.example.com/en/12
popup-ads-network.example.org/en/1 seo-backlinks-cheap.example.com/fr/8 pokerstars-bonus.example.org/de/14
diet-pills-deals.example.com/en/15 hot-adult-chat.example.org/en/16 betting-tips-win.example.com/en/17 pornhd-tube.example.org/fr/18
""".split()


def test_url_classifier_on_held_out_hosts():
    score = train_urls().scorer()
    trained = {_parts(u)[0] for u, _ in LABELLED_URLS}
    assert not trained & {_parts("https://" + u)[0] for u in (*WANTED, *UNWANTED)}
    alarms = [u for u in WANTED if score(*_parts("https://" + u)) >= 0.5]
    found = [u for u in UNWANTED if score(*_parts("https://" + u)) >= 0.5]
    print("false alarms", len(alarms), "recall", len(found))
    assert len(alarms) <= 3 and len(found) >= 25


def _parts(url):
    rest = url.split("://")[1]
    host, _, path = rest.partition("/")
    return host, "/" + path.split("?")[0].split("#")[0]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_warc_round_trip_equals_sql(spark, sf):
    d = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{d}/pages.parquet'")
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    want = sorted(con.execute(f"select {', '.join(cols)} from ({SQL_OP10})").fetchall())
    assert sorted(tuple(r[c] for c in cols) for r in op10_warc_revisits(spark, d).collect()) == want


def test_warc_nulls_copies_and_blank_lines(spark, tmp_path):
    long = "x" * 60 + "\r\n\r\nWARC/1.1\r\n\r\n" + "é" * 60
    rows = [(5, "u", long, 1), (3, None, long, 1), (9, "a\r\nb: c", long, 1), (None, "n", long, 1), (4, "v", "short", 1), (6, "v", "short", 1), (7, "w", None, 1), (8, "w", "", 1), (5, "u", long, 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, payload int")
    path = f"file://{tmp_path}/warc"
    write_archives(df, path, file_bytes=500)
    back = read_archives(spark, path, with_payload=True)
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in resolve_read(back).collect()), key=str)
    n, digest = len(long.encode()), hashlib.sha256(long.encode()).hexdigest()
    want = [(5, "revisit", 3, n, digest)] * 2 + [(9, "revisit", 3, n, digest), (None, "revisit", 3, n, digest), (3, "response", None, n, digest)]
    for i, t in ((4, "short"), (6, "short"), (7, ""), (8, "")):
        want.append((i, "response", None, len(t), hashlib.sha256(t.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert {bytes(r.payload).decode() for r in back.filter("record_type = 'response'").collect()} == {long, "short", ""}
    write_archives(df.filter("false"), path + "-none")
    assert resolve_read(read_archives(spark, path + "-none")).count() == 0
