import re
from collections import Counter, defaultdict

import numpy as np

from llm.linkgraph import host_and_path, judge_urls, propagate
from llm.queries import URL_RULES
from pyspark.sql import functions as F

DOWN = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return host.translate(DOWN), re.match(r"[^?#]*", rest[len(host):]).group()


def rule_of(host, path, rules):
    fit = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def brute(pages, rules, damping=0.85):
    at = [(i, *parts(u), h) for i, u, h in pages]
    shares = defaultdict(list)
    links = Counter()
    for _, host, path, html in at:
        if host:
            shares[host].append(rule_of(host, path, rules)[1])
            found = set(re.findall(r"""(?:href|src)\s*=\s*["']?\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#"'\s<>]+)""", html or "", re.I))
            for f in {x for x in found}:
                if f.translate(DOWN) != host:
                    links[host, f.translate(DOWN)] += 1
    hosts = sorted(set(shares) | {h for e in links for h in e})
    n = {h: i for i, h in enumerate(hosts)}
    forward, backward = np.zeros((len(n), len(n))), np.zeros((len(n), len(n)))
    for (a, b), c in links.items():
        forward[n[a], n[b]] = c
        backward[n[b], n[a]] = c
    norm = lambda m: m / np.maximum(m.sum(1, keepdims=True), 1)
    out = []
    for m, v in ((forward, "allow"), (backward, "block")):
        seed = np.array([bool(shares[h]) and shares[h].count(v) / len(shares[h]) >= 0.5 for h in hosts], float)
        x = np.linalg.solve(np.eye(len(n)) - damping * norm(m).T, (1 - damping) * seed) if n else seed
        out.append(dict(zip(hosts, x, strict=True)))
    rows = Counter()
    for i, host, path, _ in at:
        rule, v = rule_of(host, path, rules)
        d, t = out[1].get(host, 0), out[0].get(host, 0)
        rows[i, host, path, rule, v or ("block" if d >= 0.01 and d > t else "allow")] += 1
    return rows


def link(*hosts):
    return "".join(f'<a HREF = "https://{h}/x">t</a><a href="/rel">r</a>' for h in hosts)


PAGES = [(1, "http://good.com/en/1", link("friend.org", "friend.org", "FRIEND2.org:80")), (2, "https://friend.org/", link("third.org")),
         (3, "http://bad.net/es/1", link("victim.org")), (4, "http://bad.net/fr/2", None), (5, "http://bad.net/en/", ""),
         (6, "http://spam.org/a", link("bad.net", "spam2.org")), (7, "http://spam2.org", '<img src=//bad.net/x.png>'),
         (8, "http://victim.org/x?y#z", ""), (9, "HTTP://WWW.Example.com/en/x", ""), (10, "http://a.example.com/en/x", ""),
         (11, None, link("x.org")), (12, "no scheme", None), (12, "http://both.org?q=1/2", link("bad.net", "good.com")), (None, "x://É.NET/es/", None),
         (13, "http://xcom/", None), (14, "http://com/", None), (15, "http://third.org#/", None), (16, "http://a.com", "<a href='//b.org'>")]


def test_equals_brute_force(spark, frame):
    df = frame([(*p, 1) for p in PAGES], "page_id long, url string, html string, host int")
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in judge_urls(df, URL_RULES).collect())
    assert got == brute(PAGES, URL_RULES)
    verdict = {r[0]: r[4] for r in got}
    assert verdict[6] == verdict[7] == "block" and verdict[8] == verdict[2] == "allow"


def test_given_pages(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    pages = [(r.page_id, r.url, r.html) for r in df.collect()]
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in judge_urls(df, URL_RULES).collect())
    assert got == brute(pages, URL_RULES)


def test_empty_table_and_no_edges(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert judge_urls(df, URL_RULES).count() == 0
    seeds = spark.createDataFrame([("a", True, False)], "host string, trusted boolean, blocked boolean")
    edges = spark.createDataFrame([], "src string, dst string, links long")
    assert [(r.host, r.trust, r.distrust) for r in propagate(seeds, edges).collect()] == [("a", 0.15, 0.0)]


def test_url_parts(spark, frame):
    urls = ["a://b", "a://b/c?d", "x://", "://h/p", "a://b://c/d", "a://B\n/x\ny?z", "", None]
    h, p = host_and_path(F.col("u"))
    for r in frame([(u,) for u in urls], "u string").select("u", h.alias("h"), p.alias("p")).collect():
        assert (r.h, r.p) == parts(r.u)
