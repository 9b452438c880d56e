from pyspark.sql import functions as F

from depthframe.llm import urls

CASES = {
    "http://a.example.net/en/1": ("a.example.net", "/en/1", "example.net/en/", "allow"),
    "https://EXAMPLE.net/fr?x#y": ("example.net", "/fr", "net/", "block"),
    "http://x.example.com/de/": ("x.example.com", "/de/", "example.com/de/", "block"),
    "http://x.example.com/dev": ("x.example.com", "/dev", None, "allow"),
    "http://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
    "http://h.org/fr/": ("h.org", "/fr/", "org/fr/", "allow"),
    "http://spam-farm.example.org/fr/x": ("spam-farm.example.org", "/fr/x", "org/fr/", "allow"),
    "http://m.casino-win.example.com/en": ("m.casino-win.example.com", "/en", None, "block"),
    "http://casinos.example.com/casino": ("casinos.example.com", "/casino", None, "allow"),
    "http://net": ("net", "", None, "allow"),
    "net/": ("", "", None, "allow"),
    "http://?q=a://b.net/": ("", "", None, "allow"),
    "://é.net/ü/" + "x" * 5000: ("é.net", "/ü/" + "x" * 5000, "net/", "block"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
}


def test_cases_with_repeats_and_clashing_columns(spark):
    rows = [(i, u) for i, u in enumerate(CASES)] + [(100, "http://net"), (100, "http://net"), (None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("token", F.lit("kept")).withColumn("regex", F.lit(1))
    out = urls.filter_urls(pages, urls.LISTED + urls.PATTERNS)
    got = out.collect()
    assert len(got) == len(rows) and {"token", "regex"} <= set(out.columns)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == CASES[r.url]


def test_no_rules_match_and_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urls.filter_urls(pages, urls.LISTED).count() == 0
    one = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert urls.filter_urls(one, urls.LISTED, default="review").first().verdict == "review"


def test_native_plan(spark):
    one = spark.createDataFrame([(1, "http://a.net/c")], "page_id long, url string")
    plan = urls.filter_urls(one, urls.LISTED)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan
