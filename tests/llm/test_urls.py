from pyspark.sql import functions as F

from vigil.llm import urls

CASES = [
    ("https://a.example.com/en/71?x#y", "a.example.com", "/en/71", "example.com/en/7", "allow"),
    ("https://EXAMPLE.com/en/8", "example.com", "/en/8", "com/en/", "block"),
    ("http://x.example.net/de/8", "x.example.net", "/de/8", "example.net/de/8", "block"),
    ("http://x.example.net/de/9", "x.example.net", "/de/9", "net/de/", "allow"),
    ("http://notcom/en/7", "notcom", "/en/7", None, "allow"),
    ("http://com?/en/", "com", "", None, "allow"),
    ("x://org/es/#", "org", "/es/", "org/es/", "block"),
    ("no scheme", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("a://b://org/es/", "b:", "//org/es/", None, "allow"),
]


def test_cases(spark):
    df = spark.createDataFrame([(i, c[0], "mine", "theirs") for i, c in enumerate(CASES)], "page_id long, url string, host string, __note string")
    got = {r.page_id: r for r in urls.judge(df).collect()}
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(len(CASES))] == [c[1:] for c in CASES]
    assert urls.judge(df.limit(0)).count() == 0
    assert urls.judge(df, rules=()).where("verdict <> 'allow' or rule is not null").count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), (F.col("id") % 15_000)).alias("key"))
    listed = spark.range(0, 15_000, 97).select(F.concat(F.lit("k"), "id").alias("key"))
    cascade = urls.Cascade(spark, listed, listed.count(), universe, 15_000)
    assert len(cascade.levels) > 1
    got = {r.key for r in universe.where(cascade.has(F.col("key"))).distinct().collect()}
    assert got == {r.key for r in listed.collect()}


def test_plan_has_no_join_or_python(spark):
    df = urls.judge(spark.createDataFrame([(1, "http://a.com/en/")], "page_id long, url string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and "Exchange" not in plan


def test_repeated_rows_long_urls_and_many_rules(spark):
    rules = [(f"h{i}.org", f"/{i % 7}", "block" if i % 2 else "allow") for i in range(3000)]
    long = "/7" + "x" * 200_000
    asked = [(f"https://a.h{i}.org/{i % 7}/z", "block" if i % 2 else "allow", f"h{i}.org/{i % 7}") for i in range(0, 3000, 50)] + [("https://h8.org" + long, "allow", None), ("https://h3.org/3" + long, "block", "h3.org/3")]
    df = spark.createDataFrame([(u, v, r) for u, v, r in asked * 2], "url string, want string, known string")
    got = urls.judge(df, rules=rules).collect()
    assert len(got) == 2 * len(asked) and all((r.verdict, r.rule) == (r.want, r.known) for r in got)


def test_a_poor_estimate_of_the_universe_is_mended(spark):
    universe = spark.range(60_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("key in ('k1', 'k2')")
    cascade = urls.Cascade(spark, listed, 2, universe, 2)
    assert {r.key for r in universe.where(cascade.has(F.col("key"))).collect()} == {"k1", "k2"}
