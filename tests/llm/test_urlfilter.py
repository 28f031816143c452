"""Operator 11 against brute force, its SQL, and its edge cases."""

import random
import re

import duckdb
from pyspark.sql import functions as F

from carewatch.llm import registry, urlfilter

LOWER = str.maketrans(urlfilter.UPPER, urlfilter.LOWER)
COLS = ["page_id", "host", "path", "rule", "verdict"]


def parts(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return host.translate(LOWER), path, rest


def canon(url):
    host, path, rest = parts(url)
    if rest is None:
        return None
    host = host.rsplit("@", 1)[-1]
    host = re.sub(r":(80|443)?\Z", "", host).rstrip(".") if re.search(r":(80|443)?\Z", host) else host.rstrip(".")
    host = host.removeprefix("www.")
    path = path.rstrip("/")
    for page in ("/index.html", "/index.htm"):
        path = path.removesuffix(page) if path.endswith(page) else path
    path = path.rstrip("/")
    query = rest.split("#", 1)[0]
    query = query.split("?", 1)[1] if "?" in query else ""
    kept = sorted(p for p in query.split("&") if p and not (
        p.split("=", 1)[0].startswith("utm_") or p.split("=", 1)[0] in ("ref", "fbclid", "gclid")))
    return host + path + ("?" + "&".join(kept) if kept else "")


def judge(url, rules, listed):
    host, path, _ = parts(url)
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if None not in (h, p, v)
           and (host == h.translate(LOWER) or host.endswith("." + h.translate(LOWER))) and path.startswith(p) and host]
    if fit:
        return host, path, max(fit)[2], max(fit)[3]
    return host, path, None, "block" if canon(url) is not None and canon(url) in listed else "allow"


def test_query_equals_brute_force_and_sql(spark):
    sf = "/root/testdata/sf0.01"
    pages = [(r.page_id, r.url) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    listed = {canon(u) for _, u in pages if re.search(registry.LISTED_HOSTS, parts(u)[0])}
    have = sorted(tuple(r) for r in registry.QUERIES["op11_url_filter"](spark, sf).select(*COLS).collect())
    assert have == sorted((i, *judge(u, registry.URL_RULES, listed)) for i, u in pages)
    assert {r[4] for r in have if r[3] is None} == {"allow", "block"}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet')")
    assert sorted(con.execute(f"SELECT {', '.join(COLS)} FROM ({registry.OP11_SQL})").fetchall()) == have


URLS = [None, "", "no host", "://", "http://", "http:///only/path", "HTTP://COM/", "http://com", "http://com?x#y",
        "http://notcom/", "http://.com/a", "http://a..com/a", "http://com./a", "https://u:p@a.Com:443/x", "http://a.net:80/es/1",
        "http://a.net/es/1?u=http://b.com/en/", "x://ÄB.net/fr/", "http://Example.com/en/#t", "http://www.example.com/en/",
        "http://m.www.example.com/en/ü?b=2&a=1&utm_x=3&ref&ref=4&&", "http://q.org/en/index.html", "http://www.q.org/en//",
        "https://q.org/en?gclid=1", "http://q.org/enn", "http://q.org/en?b=2&a=1", "http://q.org./en?a=1&b=2#z",
        "http://q.org:80/EN", "http://tie.a.b/x/", "http://long.org/" + "a/" * 30_000, "http://" + "l." * 5_000 + "com/"]


def test_edges(spark):
    rules = [*registry.URL_RULES, ("NET", "/es/", "allow"), ("net", "/fr/", "block"), (None, "/", "block"), ("org", None, "block"),
             ("org", "/", None), ("a.b", "/x/", "allow"), ("b", "/x/", "allow"), ("tie.a.b", "", "block")]
    listed = ["http://www.q.org/en", "ftp://q.org/en?a=1&b=2", None, "q.org/none", "http://q.org/en/"]
    rows = [(k, u) for k, u in enumerate(URLS)] + [(k % 3, URLS[k % len(URLS)]) for k in range(300)] + [(None, URLS[3])]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("Host", F.lit("old")).withColumn("bits0", F.lit(1))
    rdf = spark.createDataFrame(rules, "host string, path string, verdict string")
    ldf = spark.createDataFrame([(u,) for u in listed], "url string")
    out = urlfilter.filter_urls(df, rdf, ldf)
    assert out.columns == ["page_id", "url", "bits0", *urlfilter.OUTPUTS]
    key = lambda r: tuple(map(repr, r))
    have = sorted((tuple(r) for r in out.select(*COLS).collect()), key=key)
    names = {canon(u) for u in listed}
    low = [(h and h.translate(LOWER), p, v) for h, p, v in rules]
    assert have == sorted(((i, *judge(u, low, names)) for i, u in rows), key=key)
    assert out.where("canonical = 'q.org/en'").count() >= 4
    # no rules, no list, no pages
    none = urlfilter.filter_urls(df, rdf.limit(0), ldf.limit(0))
    assert none.count() == len(rows) and none.where("verdict = 'block' or rule is not null").count() == 0
    assert urlfilter.filter_urls(df.limit(0), rdf, ldf).count() == 0


def test_filter_has_no_misses_and_few_false_hits(spark):
    rng = random.Random(1)
    inside = [(f"site{rng.random()}/{k}",) for k in range(20_000)]
    outside = [(f"other{rng.random()}/{k}",) for k in range(20_000)]
    keys = spark.createDataFrame(inside, "canonical string")
    table, blocks = urlfilter.bloom_blocks(keys, "canonical", len(inside))
    assert blocks == 1250 and table.count() <= blocks
    assert urlfilter.possible_hits(keys, "canonical", table, blocks).count() == len(inside)
    false = urlfilter.possible_hits(spark.createDataFrame(outside, "canonical string"), "canonical", table, blocks).count()
    assert 0 < false < 100  # the exact join has something to remove, and little
