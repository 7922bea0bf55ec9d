import random

from starglean.llm import urlrules


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut], rest[cut:]
    for c in "?#":
        path = path.split(c)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = {}
    for action, h, p in rules:
        h = h and "".join(c.lower() if "A" <= c <= "Z" else c for c in h)
        if action in ("allow", "block") and h and p and (host == h or host.endswith("." + h)) and path.startswith(p):
            fits[h, p] = max(action, fits.get((h, p), ""))
    if not fits:
        return host, path, None, "allow"
    h, p = max(fits, key=lambda k: (len(k[0]) + len(k[1]), len(k[0])))
    return host, path, h + p, fits[h, p]


def check(spark, urls, rules):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id bigint, url string").selectExpr(
        "page_id", "url", "'x' AS host", "'y' AS path", "1 AS part", "2 AS depth")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlrules.judge(pages, spark.createDataFrame(rules, urlrules.RULES)).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_random_rules(spark):
    draw = random.Random(2)
    labels, parts = ["com", "net", "a", "b-c", "b", "EX", "x--y"], ["", "/", "/en", "/en/", "/e", "/de/x", "/en/us/"]
    host = lambda: ".".join(draw.choice(labels) for _ in range(draw.randint(1, 5)))
    rules = [(draw.choice(["allow", "block"]), host(), draw.choice(parts)) for _ in range(150)]
    urls = [f"http://{host()}{draw.choice(parts)}{draw.choice(['', 'z', '?q=/en/', '#t', '/more'])}" for _ in range(1500)]
    check(spark, urls, rules)


def test_odd_urls(spark):
    urls = [None, "", "no scheme", "://", "http://", "http://?q", "http://www.EXAMPLE.com", "http://www.Example.com/en/", "x://y://example.com/en/",
            "http://example.com:80/en/", "http://example.com./en/", "http://notexample.com/en/", "http://net/es/", "http://com/", "http://a..com/x",
            "http://ÄÖ.com/é", "http://net/" + "es/" * 5000, "http://com/", "http://com/"]
    check(spark, urls, list(urlrules.EXAMPLE_RULES) + [("allow", None, "/"), ("block", "", "/"), ("odd", "com", "/"), ("block", "net", None), ("allow", "net", "/es/")])


def test_no_rules_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.com/"), (None, None), (1, "http://a.com/")], "page_id bigint, url string")
    none = spark.createDataFrame([], urlrules.RULES)
    assert [r.verdict for r in urlrules.judge(pages, none).collect()] == ["allow"] * 3
    assert urlrules.judge(pages.limit(0), urlrules.example_rules(spark)).collect() == []


def test_only_dataframe_operations(spark, sf):
    from starglean.llm.queries import QUERIES

    plan = QUERIES["op2_url_rules"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "SinglePartition" not in plan
