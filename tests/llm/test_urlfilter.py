import random
import re

from salesmart.llm import urlfilter


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        raw = re.match("[^/?#]*", rest).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
        path = re.match("[^?#]*", rest[len(raw):]).group()
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules
            if h and host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[2] if best else None, best[3] if best else default


def run(spark, urls, rules, **more):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = urlfilter.judge(pages, urlfilter.rule_table(spark, rules), **more).collect()
    assert len(out) == len(urls)
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out}


def test_random_rules(spark):
    rng = random.Random(6)
    hosts = ["com", "a.com", "b.a.com", "c.b.a.com", "xa.com", "net", "z.net", "a.net", "com.net"]
    paths = ["", "/", "/e", "/en", "/en/", "/en/x", "/fr/", "/en/x/y"]
    rules = sorted({(h, p): (h, p, rng.choice(["allow", "block"])) for h, p in
                    [(rng.choice(hosts), rng.choice(paths)) for _ in range(25)]}.values())
    urls = []
    for _ in range(400):
        h = rng.choice(["", "w.", "W.v."]) + rng.choice(hosts + ["org", "aa.com"])
        urls.append(rng.choice(["http://", "https://", "HTTP://"]) + h + rng.choice(paths + ["/en/xx", "/zz"])
                    + rng.choice(["", "?q=/en/", "#f", "?a#b"]))
    got = run(spark, urls, rules)
    for i, u in enumerate(urls):
        assert got[i] == brute(u, rules), u


def test_edges(spark):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), (None, "/", "block"), ("", "/", "block")]
    urls = [None, "", "no scheme", "://", "http://", "http:///p", "http://EXAMPLE.com", "http://example.com/en/", "http://É.com/",
            "http://example.com:80/en/", "a://b://c.com/", "http://x.com/" + "p" * 20_000, "http://example.com/en/\nx", "http://.com/",
            "http://example.com/en/", "http://a..com/x"]
    got = run(spark, urls, rules, default="block")
    for i, u in enumerate(urls):
        assert got[i] == brute(u, [r for r in rules if r[0]], "block"), u


def test_empty_and_clashes(spark):
    rules = urlfilter.rule_table(spark, [("com", "/", "block")])
    pages = spark.createDataFrame([(1, "http://a.com/", "old", "x")], "page_id long, url string, host string, verdict string")
    row = urlfilter.judge(pages, rules).first()
    assert (row["host"], row["verdict"]) == ("a.com", "block")
    assert urlfilter.judge(pages.limit(0), rules).count() == 0
    assert urlfilter.judge(pages, rules.limit(0)).first()["verdict"] == "allow"


def test_hot_url_and_many_ranges(spark):
    rules = [(f"h{i}.com", "/", "block") for i in range(0, 60, 3)]
    urls = ["http://h3.com/x"] * 500 + [f"http://s.h{i}.com/{i}" for i in range(60)]
    got = run(spark, urls, rules)
    for i, u in enumerate(urls):
        assert got[i] == brute(u, rules)
