import fixtures as fx  # noqa: F401

from corpuslab.llm import op2_url as u


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    rest = rest.split("?")[0].split("#")[0]
    host, slash, path = rest.partition("/")
    host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p) and host]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


URLS = [None, "", "no scheme/x", "http://", "http:///en/", "http://com/", "http://com", "http://a.com?x=/en/", "HTTP://WWW.Example.COM/en/x?q#f",
        "https://example.com/en/", "https://example.com/en", "https://notexample.com/en/x", "https://m.example.com/en/x", "https://a.www.example.com/en/x#y",
        "https://x.net/es/1", "https://x.net/fr", "https://x.net/fr/", "http://net/es/", "http://x.org/es/", "http://a.b.c.d.e.f.example.com/en/z", "http://u@x.com:80/p",
        "http://ÄB.com/É", "http://x.com/" + "p/" * 4000, "http://" + "a." * 300 + "net/es/x", "q?u=http://example.com/en/", "http://example.com/en/x", "http://example.com/en/x"]


def check(spark, rules, table):
    rows = [(i, x, "html") for i, x in enumerate(URLS)] + [(None, URLS[9], ""), (0, None, "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS host", "2 AS rule", "3 AS salt", "4 AS key")
    got = sorted(map(tuple, u.judge(pages, table).collect()), key=str)
    assert got == sorted(((p, *brute(x, rules)) for p, x, _ in rows), key=str)


def test_equals_brute_force(spark):
    check(spark, u.RULES, None)


def test_nested_rules_and_empty_paths(spark):
    rules = [("com", "", "allow"), ("example.com", "", "block"), ("example.com", "/en/", "allow"), ("example.com", "/en/x", "block"),
             ("example.com", "/e", "block"), ("c.d.e.f.example.com", "/en/z", "allow"), ("net", "/", "block")]
    check(spark, rules, u.rule_table(spark, rules))


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string")
    assert u.judge(pages).count() == 0
    one = spark.createDataFrame([(1, "http://a.com/")], "page_id bigint, url string")
    assert u.judge(one, u.rule_table(spark, ()).limit(0)).collect()[0].verdict == "allow"
