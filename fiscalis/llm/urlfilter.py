"""URL filters: written rules, and for other urls a logistic regression on hashed character n-grams of host and path.

The classifier is trained on the driver from a small labelled table (``LABELLED_URLS`` unless another is given); its
weights are a vector of fixed size. Urls are judged in one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (url, 1 if unwanted). Invented training examples, written one by one.
_WRITTEN_URLS: tuple[tuple[str, int], ...] = (
    ("http://casino-royal.example.com/en/201", 1), ("https://www.casino-jackpot.example.net/de/77", 1),
    ("https://m.best-casino.example.org/fr/9120", 1), ("http://blog.online-casino.example.com/es/4", 1),
    ("https://big-win-slots.example.net/en/31", 1), ("https://win-money.example.org/en/8812.html", 1),
    ("http://poker-win.example.com/de/555", 1), ("https://blog.free-poker.example.net/en/17", 1),
    ("https://sports-bets.example.org/en/2", 1), ("http://m.bets-online.example.com/fr/610", 1),
    ("https://free-spins.example.com/es/18/", 1), ("https://www.free-bonus.example.net/en/4410", 1),
    ("http://adult-cams.example.org/en/3", 1), ("https://adult-video.example.com/de/901", 1),
    ("https://blog.adult-dating.example.net/fr/2203", 1), ("http://xxx-tube.example.com/en/70", 1),
    ("https://m.x-rated.example.org/en/62", 1), ("https://hot-xxx.example.net/es/8#top", 1),
    ("https://cheap-meds.example.com/en/50", 1), ("http://www.cheap-viagra.example.net/en/12.html", 1),
    ("https://pills-online.example.org/de/3040", 1), ("https://diet-pills.example.com/fr/71", 1),
    ("http://blog.buy-pills.example.net/en/19", 1), ("https://cheap-replica.example.org/es/233", 1),
    ("https://spam-blast.example.com/en/5", 1), ("http://m.spam-mail.example.net/de/44", 1),
    ("https://link-farm.example.org/en/980", 1), ("https://seo-farm.example.com/fr/66", 1),
    ("http://ads-click.example.net/en/7", 1), ("https://www.ads-server.example.org/en/321", 1),
    ("https://track-click.example.com/de/15", 1), ("https://m.ad-track.example.net/es/909", 1),
    ("http://payday-loan.example.org/en/27", 1), ("https://fast-loan.example.com/en/640", 1),
    ("https://news.example.com/casino-bonus/free-bets/12", 1), ("http://shop.example.net/cheap-pills/order/5", 1),
    ("http://library.example.com/en/204", 0), ("https://www.theatre.example.net/de/78", 0),
    ("https://m.weather.example.org/fr/9121", 0), ("http://blog.garden.example.com/es/5", 0),
    ("https://university.example.net/en/32", 0), ("https://citynews.example.org/en/8813.html", 0),
    ("http://thenorth.example.com/de/556", 0), ("https://blog.cooking.example.net/en/18", 0),
    ("https://museum.example.org/en/3", 0), ("http://m.thering.example.com/fr/611", 0),
    ("https://station.example.com/es/19/", 0), ("https://www.thought.example.net/en/4411", 0),
    ("http://nation.example.org/en/4", 0), ("https://thunder.example.com/de/902", 0),
    ("https://blog.another.example.net/fr/2204", 0), ("http://heather.example.com/en/71", 0),
    ("https://m.tension.example.org/en/63", 0), ("https://thatch.example.net/es/9#top", 0),
    ("https://science.example.com/en/51", 0), ("http://www.history.example.net/en/13.html", 0),
    ("https://thermal.example.org/de/3041", 0), ("https://motion.example.com/fr/72", 0),
    ("http://blog.thinker.example.net/en/20", 0), ("https://method.example.org/es/234", 0),
    ("https://anthem.example.com/en/6", 0), ("http://m.section.example.net/de/45", 0),
    ("https://theory.example.org/en/981", 0), ("https://option.example.com/fr/67", 0),
    ("http://ethics.example.net/en/8", 0), ("https://www.health.example.org/en/322", 0),
    ("https://action.example.com/de/16", 0), ("https://m.mathson.example.net/es/910", 0),
    ("http://thread.example.org/en/28", 0), ("https://author.example.com/en/641?page=2&ref=x", 0),
    ("https://news.example.com/region/report/12?utm_source=feed", 0), ("http://shop.example.net/books/order/5", 0),
)


_SUBJECTS = ("adult", "pharmacy", "loans", "student-loan", "sports", "betting", "gambling", "poker", "dating", "drug", "pills", "money", "credit", "tracking", "casino", "video", "medicine", "bonus", "click", "diet")
_PLACES = ("education", "school", "library", "museum", "help", "university", "clinic", "research", "council", "association", "safety", "history", "institute", "news", "support", "advice", "journal", "club", "community", "hospital", "learning", "college", "charity", "forum")
_GOODS = ("casino", "slots", "poker", "jackpot", "bets", "bookmaker", "cams", "xxx", "porn", "escorts", "hookups", "viagra", "pills", "steroids", "replica-watches", "payday-loans", "loans", "crypto-profit", "warez", "cracks", "followers", "backlinks", "popups", "adult-videos")
_BAITS = ("win", "free", "cheap", "best", "online", "hot", "fast", "instant", "buy", "real-money", "vip", "no-prescription", "live", "sexy", "now", "deals", "bonus", "4you")


_SYLLABLES = ("ba", "ne", "ri", "to", "lu", "mar", "sen", "kol", "wick", "ham", "ton", "berg", "ville", "the", "tha", "ster", "tion", "ous", "ing", "er", "es", "th", "st", "an")


def _made_urls() -> Iterator[tuple[str, int]]:
    """Subjects that unwanted hosts share with the places that write about them, goods with their baits, plain names."""
    shape = ("{}-{}.example.com/en/{}", "{}{}.example.org/{}", "www.{}-{}.example.net/fr/{}.html", "{}.{}.example.com/de/{}")
    for i, subject in enumerate(_SUBJECTS):
        for k in range(4):
            place = _PLACES[(5 * i + 7 * k) % len(_PLACES)]
            yield "https://" + shape[(i + k) % 4].format(subject, place, 31 * i + k), 0
    for i, goods in enumerate(_GOODS):
        for k in range(4):
            bait = _BAITS[(7 * i + 5 * k) % len(_BAITS)]
            pair = (bait, goods) if (i + k) % 3 else (goods, bait)
            yield "https://" + shape[(i + 2 * k) % 4].format(*pair, 29 * i + k), 1
    for i in range(32):
        parts = [_SYLLABLES[(i * m + m) % len(_SYLLABLES)] for m in (1, 7, 11)]
        yield f"https://{('', 'www.', 'blog.', 'm.')[i % 4]}{''.join(parts[: 2 + i % 2])}.example.{('com', 'net', 'org')[i % 3]}/en/{i}", 0
    for i, place in enumerate(_PLACES):
        yield f"https://{place}.example.{('com', 'net', 'org')[i % 3]}/en/{i}", 0


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for a host with its subdomains and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


#: The rules that the query applies.
QUERY_RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


@dataclass(frozen=True)
class UrlParams:
    """``2 ** bits`` bounds the weights; ``prior`` is the score of a url without any n-grams."""

    bits: int = 16
    sizes: tuple[int, ...] = (3, 4, 5)
    steps: int = 2000
    rate: float = 2.0
    l2: float = 1e-4
    threshold: float = 0.5
    prior: float = 0.1


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z, nothing else."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path: after the first ``://`` up to ``/ ? #``, A-Z lower-cased, then up to ``? #``; else both empty."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.substring(rest, F.length(host) + 1, F.length(rest))
    return ascii_lower(host), F.regexp_extract(path, r"^([^?#]*)", 1)


def rule_column(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null without one; equal lengths: the first by name."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), [-ord(c) for c in r.name])):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, F.lit(r.name)).otherwise(name)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


_DIGITS = re.compile("[0-9]+")


def _grams(text: str, kind: str, p: UrlParams) -> np.ndarray:
    marked = f"^{_DIGITS.sub('0', text)}$" if text else ""
    found = {kind + marked[i : i + n] for n in p.sizes for i in range(len(marked) - n + 1)}
    return np.fromiter((crc32(g.encode()) for g in sorted(found)), np.int64, len(found)) & ((1 << p.bits) - 1)


@dataclass
class UrlModel:
    """Weights over hashed n-grams; the n-grams of the host and of the path each weigh one in all."""

    bias: float
    w: np.ndarray
    p: UrlParams

    def part(self, text: str, kind: str) -> float:
        g = _grams(text, kind, self.p)
        return float(self.w[g].sum() / len(g) ** 0.5) if len(g) else 0.0

    def scorer(self):
        hosts = lru_cache(maxsize=1 << 16)(lambda host: self.part(host, "h"))
        return lambda host, path: float(1 / (1 + np.exp(-(self.bias + hosts(host) + self.part(path, "p")))))


#: What the default model learns from: the written rows, which count twice, and a few hundred made by rule.
LABELLED_URLS: tuple[tuple[str, int], ...] = (*_WRITTEN_URLS, *_WRITTEN_URLS, *_made_urls())


def _split(url: str) -> tuple[str, str]:
    rest = url.partition("://")[2]
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    path = rest[cut:]
    end = min((i for i in map(path.find, "?#") if i >= 0), default=len(path))
    return rest[:cut].lower(), path[:end]


def train_urls(labelled: Sequence[tuple[str, int]] = LABELLED_URLS, p: UrlParams = UrlParams()) -> UrlModel:
    """Full-batch gradient descent on the log loss; an empty table gives a model that blocks nothing."""
    w, bias = np.zeros(1 << p.bits), float(np.log(p.prior / (1 - p.prior)))
    if not labelled:
        return UrlModel(bias, w, p)
    rows = []
    for url, _ in labelled:
        for text, kind in zip(_split(url), "hp", strict=True):
            rows.append(_grams(text, kind, p))
    y = np.array([v for _, v in labelled], float)
    idx = np.concatenate(rows)
    one = np.repeat(np.arange(len(rows)) // 2, [len(r) for r in rows])
    x = np.repeat([len(r) ** -0.5 if len(r) else 0.0 for r in rows], [len(r) for r in rows])
    for _ in range(p.steps):
        err = 1 / (1 + np.exp(-(bias + np.bincount(one, w[idx] * x, len(y))))) - y
        w -= p.rate * (np.bincount(idx, err[one] * x, len(w)) / len(y) + p.l2 * w)
    return UrlModel(bias, w.astype(np.float32), p)


def filter_urls(df: DataFrame, url_col: str = "url", rules: Sequence[Rule] = QUERY_RULES, model: UrlModel | None = None) -> DataFrame:
    """``df`` with ``host, path, rule, score, verdict`` (columns of these names are replaced).

    Null urls and urls without ``://`` have an empty host and path, no rule, and the classifier's verdict on no
    n-grams. One row per row, repeated rows too; urls of any length count whole; an empty table gives no rows.
    """
    model = model or train_urls()
    own = {"host", "path", "rule", "score", "verdict"}
    host, path = url_parts(F.col(f"`{url_col}`"))
    keep = [c for c in df.columns if c.lower() not in own]
    out = df.select(*[F.col(f"`{c}`") for c in keep], host.alias("host"), path.alias("path"))
    name, verdict = rule_column(F.col("host"), F.col("path"), rules)
    out = out.withColumn("rule", name).withColumn("score", F.lit(0.0)).withColumn("verdict", verdict)
    shared = df.sparkSession.sparkContext.broadcast(model)
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        score = m.scorer()
        for batch in batches:
            hosts, paths, ruled = (batch.column(i).to_pylist() for i in (n, n + 1, n + 4))
            scores = [score(h, q) for h, q in zip(hosts, paths, strict=True)]
            found = [v or ("block" if s >= m.p.threshold else "allow") for v, s in zip(ruled, scores, strict=True)]
            cols = [batch.column(i) for i in range(n + 3)] + [pa.array(scores, pa.float64()), pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, batch.schema.names)

    return out.mapInArrow(run, out.schema)


def op7_url_filter(spark, sf_dir: str) -> DataFrame:
    """Verdict on every url of ``pages``."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "score")
