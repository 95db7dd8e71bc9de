import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil.functions import hashing, text, urls
from vigil.functions.similarity import indel_ratio, jaro_winkler, token_set_ratio


@settings(max_examples=200, deadline=None)
@given(st.text("abcde", max_size=10), st.text("abcde", max_size=10))
def test_jaro_winkler_equals_duckdb(a, b):
    want = duckdb.execute("select jaro_winkler_similarity(?, ?)", [a, b]).fetchone()[0]
    if a or b:
        assert jaro_winkler(a, b) == pytest.approx(want, abs=1e-9)


def test_jaro_winkler_known_values():
    for host, domain, want in (("16fintech.com", "kfintech.com", 0.9209), ("airtelbox.com", "airtel.in", 0.8632), ("airtiz.net", "airtel.in", 0.9128), ("art-axis.art", "axismf.com", 0.6389), ("axis-fluxrad.com", "axismf.com", 0.8925)):
        assert round(jaro_winkler(host, domain), 4) == want


def test_ratios():
    assert indel_ratio("abcd", "abxd") == pytest.approx(75.0)
    assert indel_ratio("", "") == 100.0
    assert token_set_ratio("red widget", "widget red") == 100.0
    assert token_set_ratio("red widget", "red ring") < 100.0


def test_hosts(spark):
    rows = [("HTTP://User@Www.Example.COM:80/p?q#f",), ("sub_x.example.org/a",), ("https://a.bank.in",), ("",)]
    got = spark.createDataFrame(rows, "url string").select(urls.hostname(F.col("url")).alias("h")).withColumn("r", urls.registrable(F.col("h"))).collect()
    assert [r.h for r in got] == ["www.example.com", "sub_x.example.org", "a.bank.in", ""]
    assert [r.r for r in got][:3] == ["example.com", "example.org", "a.bank.in"]


def test_deceptive_embedding(spark):
    rows = [("dcc.crsorgi.gov.in.crsor.info", "crsorgi.gov.in", True), ("login.crsorgi.gov.in", "crsorgi.gov.in", False), ("crsor.info", "crsorgi.gov.in", False)]
    got = spark.createDataFrame(rows, "host string, legit string, want boolean").select(urls.deceptive_embedding(F.col("host"), F.col("legit")).alias("d"), "want").collect()
    assert all(r.d == r.want for r in got)


def test_hamming(spark):
    rows = [("ffffffffffffffff", "ffffffffffffffff", 0), ("ffffffffffffffff", "0000000000000000", 64), ("zz", "0000000000000000", None)]
    got = spark.createDataFrame(rows, "a string, b string, want int").select(hashing.distance(hashing.bits(F.col("a")), hashing.bits(F.col("b"))).alias("d"), "want").collect()
    assert all(r.d == r.want for r in got)


def test_sentinels(spark):
    rows = [("NA", False), (" ", False), (None, False), ("x", True), ("na ", False)]
    assert all(r.p == r.want for r in spark.createDataFrame(rows, "c string, want boolean").select(text.present(F.col("c")).alias("p"), "want").collect())
    got = spark.createDataFrame([(" b.xlsx|a.xlsx| b.xlsx||",)], "c string").select(text.pipe_list(F.col("c")).alias("p")).first()
    assert got.p == ["b.xlsx", "a.xlsx"]


def test_evidence_ratios_equal_brute_force(spark):
    from functools import cache

    from vigil.plans.queries import QUERIES

    @cache
    def common(a, b):
        """Length of the longest common subsequence, by subsequences of the shorter text that the longer one holds, longest first."""
        if not a or not b:
            return 0
        return 1 + common(a[1:], b[1:]) if a[0] == b[0] else max(common(a[1:], b), common(a, b[1:]))

    ratio = lambda a, b: 100.0 if not a and not b else 200.0 * common(a, b) / (len(a) + len(b))

    def sets(a, b):
        x, y = set(a.split()), set(b.split())
        both, left, right = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
        full = [" ".join(filter(None, [both, s])) for s in (left, right)]
        return 100.0 if both and (not left or not right) else max([ratio(*full), *([ratio(both, f) for f in full] if both else [])])

    rows = QUERIES["q_evidence_ratios"](spark, "/root/testdata/sf0.001").collect()
    names = {i: e.lower() for i, e, _ in __import__("vigil.plans.catalogue", fromlist=["ENTITIES"]).ENTITIES}
    assert rows and all(abs(r.indel - ratio(r["name"], names[r.idx])) < 1e-5 and abs(r.token_set - sets(r["name"], names[r.idx])) < 1e-5 for r in rows[:60])


def test_best_of_a_list_equals_all_comparisons():
    import random

    from vigil.functions.similarity import best_jaro_winkler

    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randrange(0, 12)))
    for _ in range(400):
        a, others = word(), [word() for _ in range(rng.randrange(0, 8))]
        scores = [jaro_winkler(a, b) for b in others]
        best = max(scores, default=0.0)
        if a:
            assert best_jaro_winkler(a, others) == ((best, scores.index(best)) if best > 0 else (0.0, -1))


def test_failures_as_known(spark):
    from vigil.functions import signals

    rows = [("TimeoutError", "goto", "navigation", "navigation_timeout", True), ("TimeoutError", "goto", "screenshot", "screenshot_timeout", False), ("Error", "net::ERR_ABORTED", "navigation", "navigation_transient_browser_error", True), ("Error", "SSL protocol error", "navigation", "ssl_error", False), ("Error", "x", "content", "content_error", False)]
    df = spark.createDataFrame(rows, "name string, message string, stage string, kind string, again boolean").withColumn("f", signals.fetch_failure(F.col("name"), F.col("message"), F.col("stage")))
    assert all((r.f.kind, r.f.retryable) == (r.kind, r.again) for r in df.collect())


def test_certificates_as_they_come(spark):
    import datetime

    from vigil.functions import signals

    now = F.lit("2024-06-01 00:00:00").cast("timestamp")
    rows = [("Jan 15 00:00:00 2024 GMT", "Jan  5 12:00:00 2025 GMT", "CA", (1, 1, 218, "CA")), ("Jan 15 00:00:00 2024 GMT", "Feb 15 00:00:00 2024 GMT", None, (1, 0, 0, None)), ("soon", "later", "CA", (1, 0, -1, "CA")), (None, None, None, (0, 0, -1, None))]
    got = spark.createDataFrame([r[:3] for r in rows], "a string, b string, o string").select(signals.certificate(F.col("a"), F.col("b"), F.col("o"), now).alias("c"), signals.certificate_date(F.col("a")).alias("d")).collect()
    assert [tuple(r.c) for r in got] == [r[3] for r in rows] and got[0].d == datetime.datetime(2024, 1, 15)


def test_simhash_modes(spark):
    import hashlib

    def plain(counted):
        votes = [0] * 64
        for f in counted:
            d = int.from_bytes(hashlib.sha256(f.encode()).digest()[:8], "big")
            votes = [v + (1 if d >> (63 - i) & 1 else -1) for i, v in enumerate(votes)]
        return f"{int(''.join('01'[v >= 0] for v in votes), 2):016x}" if counted else None

    texts = ["Airtel Bank", "a", "", "the the cat", "x" * 40]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for mode, k in (("char3", 3), ("char5", 5)):
        got = [r.h for r in df.select(hashing.simhash_of(hashing.features(F.col("t"), mode)).alias("h")).collect()]
        assert got == [plain([f"^{t.lower()}$"[i : i + k] for i in range(max(1, len(t) + 3 - k))]) if t else None for t in texts]
    assert [r.h for r in df.select(hashing.simhash_of(hashing.features(F.col("t"), "word")).alias("h")).collect()] == [plain(t.lower().split()) for t in texts]
