from voltlake.llm.queries import URL_RULES
from voltlake.llm.url_filter import judge_urls

CASES = [
    ("http://a.org/x", "a.org", "/x", "org/", "allow"),
    ("https://Www.EXAMPLE.org/es/1?q#f", "www.example.org", "/es/1", "example.org/es/", "block"),
    ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
    ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("http://a.com/de/", "a.com", "/de/", "com/de/", "block"),
    ("http://a.com/de", "a.com", "/de", None, "allow"),
    ("http://org", "org", "", None, "allow"),
    ("http://a.org?x=http://b.com/de/", "a.org", "", None, "allow"),
    ("http://a.org#/x", "a.org", "", None, "allow"),
    ("x\n://a.org/\ny", "a.org", "/\ny", "org/", "allow"),
    ("http://É.org/", "É.org", "/", "org/", "allow"),
    ("a.org/x", "", "", None, "allow"),
    ("://", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
]
RULES = "host string, path string, verdict string"


def test_hosts_paths_and_precedence(spark):
    rules = spark.createDataFrame(URL_RULES, RULES)
    rows = [(i, c[0], "old") for i, c in enumerate(CASES)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    got = sorted(judge_urls(pages, rules).collect(), key=lambda r: r["page_id"])
    assert [tuple(r) for r in got[::2]] == [
        (i, url, host, path, rule, verdict) for i, (url, host, path, rule, verdict) in enumerate(CASES)
    ]
    assert got[::2] == got[1::2]


def test_conflicting_incomplete_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c/" + "d" * 100_000)], "page_id long, url string")
    rules = [("a.b", "/", "allow"), ("a.b", "/", "block"), (None, "/c/", "allow"), ("b", "/c", "allow")]
    row = judge_urls(pages, spark.createDataFrame(rules, RULES), default="block").first()
    # Equally long rules: that with the longer host wins.
    assert (row["rule"], row["verdict"]) == ("a.b/", "block")
    row = judge_urls(pages, spark.createDataFrame([], RULES), default="block").first()
    assert (row["rule"], row["verdict"], row["host"]) == (None, "block", "a.b")
    assert judge_urls(pages.limit(0), spark.createDataFrame(rules, RULES)).collect() == []


def test_thousands_of_shapes_make_no_larger_plan(spark):
    rules = [("a." * k + "org", "/" + "x" * length, "block") for k in range(5) for length in range(1000)]
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    urls = [(k, f"http://a.a.org/{'x' * (20 * k)}y") for k in range(50)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    got = judge_urls(pages, table)
    assert len(got._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    rows = {r["page_id"]: r["rule"] for r in got.collect()}
    assert rows == {k: "a.a.org/" + "x" * min(20 * k, 999) for k in range(50)}
