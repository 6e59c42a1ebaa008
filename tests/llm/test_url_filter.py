from addrlink.llm import url_filter as u

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]
URLS = {
    "http://Example.ORG/es/x?q=/de/": ("example.org", "/es/x", "example.org/es/", "block"),
    "https://a.b.example.org/en/12#t": ("a.b.example.org", "/en/12", "example.org/en/1", "block"),
    "https://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
    "https://badexample.org/es/": ("badexample.org", "/es/", "org/", "allow"),
    "http://x.com/de/": ("x.com", "/de/", "com/de/", "block"),
    "http://x.com/d": ("x.com", "/d", None, "allow"),
    "http://org": ("org", "", None, "allow"),
    "http://org?/x://y/": ("org", "", None, "allow"),
    "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
    "http://.org/": (".org", "/", "org/", "allow"), "http://a..org/É?": ("a..org", "/É", "org/", "allow"),
    "x://y.org/" + "p" * 50_000: ("y.org", "/" + "p" * 50_000, "org/", "allow"),
}


def judged(spark, urls, rules=RULES):
    pages = spark.createDataFrame([(i, x, "extra", "html") for i, x in enumerate(urls)],
                                  "page_id long, url string, host string, rule string")
    rules = spark.createDataFrame(rules, "host string, path string, verdict string")
    return [(r["host"], r["path"], r["rule"], r["verdict"])
            for r in u.judge(pages, rules).orderBy("page_id").collect()]


def test_cases(spark):
    assert judged(spark, URLS) == list(URLS.values())


def test_repeated_rows_and_empty_tables(spark):
    assert judged(spark, ["http://a.org/"] * 5) == [("a.org", "/", "org/", "allow")] * 5
    assert judged(spark, []) == []
    assert judged(spark, ["http://a.org/"], []) == [("a.org", "/", None, "allow")]


def test_precedence(spark):
    rules = [("a.org", "/x", "allow"), ("org", "/x/y", "block"), ("org", "/z", "allow"), ("org", "/z", "block"),
             (None, "/x", "block"), ("b.org", None, "block")]
    assert judged(spark, ["http://a.org/x/yy", "http://b.org/zz", "http://c.org/zz", "http://b.org"], rules) == [
        ("a.org", "/x/yy", "a.org/x", "allow"),  # as long as org/x/y: the longer host
        ("b.org", "/zz", "b.org", "block"), ("c.org", "/zz", "org/z", "block"), ("b.org", "", "b.org", "block")]


def test_no_python_and_no_cross_join_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    plan = u.judge(pages, rules)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "NestedLoop", "Cartesian"))
