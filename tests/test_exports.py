import datetime

import pytest
from pyspark.sql import functions as F

from vigil.operators import brands, features, infra, matching, outcomes, settings
from vigil.sources import exports, readers


def test_export_by_workbook(spark, tmp_path):
    df = spark.createDataFrame([("a.org", "a.xlsx| b.xlsx|a.xlsx", 1.5), ("b.org", " ", 2.0)], "domain string, source_workbook string, hash_score double")
    exports.hash_exports(df, str(tmp_path / "x"))
    back = spark.read.option("header", True).csv(str(tmp_path / "x"))
    assert back.columns == [*exports.HASHED, "export_stem"] and len(exports.HASHED) == 47 and len(exports.STAGE0) == 30
    assert sorted((r.domain, r.export_stem) for r in back.collect()) == [("a.org", "a"), ("a.org", "b"), ("b.org", "unknown_source")]


def test_publish_and_latest(spark, tmp_path):
    root = str(tmp_path)
    for run, n in (("r1", 2), ("r2", 3)):
        exports.publish(spark.range(n).select(F.col("id").cast("string").alias("id")), root, run, "rows")
    assert exports.latest(spark, root, "rows").count() == 3
    assert spark.read.option("header", True).csv(f"{root}/runs/r1/rows").count() == 2


def test_checkpoint_and_resume(spark, tmp_path):
    rows = spark.createDataFrame([("k2", "r1", "b", 2), ("k1", "r1", "a", 1), ("k1", "", "c", 3), ("k1", "r0", "z", 9)], "record_key string, run_id string, status string, pos int")
    exports.checkpoint({"results": (rows, ["record_key", "pos"])}, str(tmp_path / "c"), {"run_id": "r1"})
    assert exports.read_document(spark, str(tmp_path / "c/manifest")) == {"run_id": "r1", "rows": {"results": 4}}
    back = spark.read.option("header", True).csv(str(tmp_path / "c/results"))
    got = {r.record_key: r.status for r in readers.run_state([back], "r1", ["record_key"], ["pos"]).collect()}
    assert got == {"k1": "c", "k2": "b"}
    todo, again = outcomes.replayed(spark.createDataFrame([("k1",), ("k3",)], "record_key string"), back.where("status = 'c'"), ["record_key"])
    assert [r.record_key for r in todo.collect()] == ["k3"] and [r.status for r in again.collect()] == ["c"]


def test_small_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", "r", True, "accepted", "fetched", "x"), ("a", "r", False, "", "", ""), ("a", "s", True, "filtered", "", "x")], "url string, reason string, escalate_to_hashing boolean, dns_decision string, fetch_status string, escalate_reason string")
    exports.text_list(df, "url", str(tmp_path / "l"))
    assert [r.value for r in spark.read.text(str(tmp_path / "l")).collect()] == ["a", "b"]
    exports.subsets(df, str(tmp_path / "s"), {"r": F.col("reason") == "r"})
    assert spark.read.option("header", True).csv(str(tmp_path / "s/r")).count() == 2
    exports.method_artifacts(df, str(tmp_path / "m"))
    assert spark.read.option("header", True).csv(str(tmp_path / "m/deep_analysis")).first().asDict() == {"rows": "3", "deep_analysis_candidate": "2", "deep_analysis_dns_accepted": "1", "deep_analysis_attempted": "1"}
    assert spark.read.option("header", True).csv(str(tmp_path / "m/top_reasons")).first().n == "2"
    exports.review_queue(df.where("false"), str(tmp_path / "q"))
    assert spark.read.option("header", True).csv(str(tmp_path / "q")).columns in (list(exports.REVIEW), [])
    exports.stage0_table(df, str(tmp_path / "z"))
    assert spark.read.option("header", True).csv(str(tmp_path / "z")).columns == list(exports.STAGE0)


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Domain Name,x\nA.org,1\n")
    (tmp_path / "~$a.csv").write_text("lock")
    (tmp_path / "b.csv").write_text("first,second\nexample.org/x,1\nnot a url,2\n")
    assert [f.rsplit("/", 1)[1] for f in readers.discovered(spark, str(tmp_path))] == ["a.csv", "b.csv"]
    assert [f.rsplit("/", 1)[1] for f in readers.discovered(spark, str(tmp_path / "a.csv"))] == ["a.csv"]
    assert readers.discovered(spark, str(tmp_path / "none")) == []
    got = {r.url: r.source_workbooks for r in readers.candidates(spark, str(tmp_path)).collect()}
    assert got == {"a.org": ["a.csv"], "example.org/x": ["b.csv"], "not a url": ["b.csv"]}
    with pytest.warns(UserWarning, match="first"):
        assert readers.url_column(spark.createDataFrame([("x y",), ("z",)], "first string")) == "first"
    assert readers.has_columns(spark, str(tmp_path / "a.csv"), ["x", "Domain Name"]) and not readers.has_columns(spark, str(tmp_path / "a.csv"), ["y"]) and not readers.has_columns(spark, str(tmp_path / "no.csv"), [])
    (tmp_path / "m.json").write_text('{"b": {"y": 1, "x": 2}, "a": 1}')
    found = readers.manifest(spark, str(tmp_path / "m.json"))
    assert readers.compatible(found, {"b": {"x": 2, "y": 1}, "a": 3}, ["b"]) and not readers.compatible(found, {"a": 3}, ["a"])
    (tmp_path / "broken.json").write_text("{")
    assert readers.manifest(spark, str(tmp_path / "broken.json")) == readers.manifest(spark, str(tmp_path / "no.json")) == {}
    df = spark.createDataFrame([("NaN", " x "), ("null", None)], "a string, b string")
    assert [tuple(r) for r in readers.replayed_text(df, ["a", "b"]).collect()] == [("", "x"), ("", "")]
    assert [r.url for r in readers.text_lines(spark, str(tmp_path / "a.csv")).orderBy("url").collect()] == ["a.org,1", "domain name,x"]
    assert exports.newest_file(spark, str(tmp_path), ".zip") is None and exports.newest_file(spark, str(tmp_path), ".json").endswith(".json")
    with pytest.raises(ValueError, match="domain"):
        readers.require(df, "domain")


def test_url_like(spark):
    rows = [("example.org", True), ("HTTP://a-b.Example.org:80/x?y", True), ("10.0.0.1", False), ("localhost", False), ("a b.org", False), ("x.c", False), ("", False), (None, False), ("a..org", False), ("ä.org", False)]
    assert all(r.ok == r.want for r in spark.createDataFrame(rows, "u string, want boolean").select(readers.url_like(F.col("u")).alias("ok"), "want").collect())


def test_settings():
    assert settings.Scoring(weights={"ssl": 0}).weights["ssl"] == 0.0 and settings.Scoring().weights == settings.WEIGHTS
    for bad in ({"weights": {"x": 1}}, {"weights": {"ssl": -1}}, {"weights": dict.fromkeys(settings.WEIGHTS, 0)}, {"domain_similarity": 1.1}, {"high_confidence": 10}, {"typo_top_k": 0}, {"lexical_pass": "a"}):
        with pytest.raises(ValueError):
            settings.Scoring(**bad)
    assert settings.one_of("mode", " All ", settings.SMOKE_TESTS) == "all"
    with pytest.raises(ValueError):
        settings.whole("n", 1.5)


def test_skeletons_and_typosquats(spark):
    rows = [("аірtе1.іn", "airtel.in"), ("paypa1.com", "paypal.com"), ("abc.org", "xyz.org"), ("", "a.org")]
    df = brands.typosquat(spark.createDataFrame(rows, "a string, b string").withColumn("s", brands.skeleton(F.col("a"))).withColumn("u", brands.skeleton_url(F.col("a"))), "a", "b", "like")
    got = df.collect()
    assert got[1].s == "paypal.com" and got[1].like == 1.0 and got[3].like == 0.0 and got[1].u == "https://paypal.com"
    assert got[0].s == "airtel.in".replace("r", "p") or got[0].like > 0.6
    assert got[2].like == pytest.approx(0.03, abs=0.31) and got[2].like < 0.6


def test_first_similar(spark):
    left = spark.createDataFrame([(1, "airtel", "https://airtel.xyz"), (2, "airtel", "https://airtel.in"), (3, "nothing", "https://n.org"), (4, "red widget", "https://w.org")], "id int, label string, url string")
    right = spark.createDataFrame([(2, "airtell", "https://b.org"), (1, "airtel", "https://airtel.in"), (3, "widget red", "https://c.org")], "pos int, legit_label string, legit_url string")
    got = {r.id: (r.pos, r.legit_url) for r in matching.similar_first(left, right).collect()}
    assert got == {1: (1, "https://airtel.in"), 2: (2, "https://b.org"), 3: (None, None), 4: (3, "https://c.org")}


def test_joins_on_sets(spark):
    hashes = spark.createDataFrame([(1, "0xAB"), (2, "cd"), (3, "zz")], "id int, hash string")
    refs = spark.createDataFrame([("e", "ab"), ("f", "AB"), ("f", "zz")], "entity string, hash string")
    assert sorted((r.id, r.entity) for r in matching.exact_hits(hashes, refs).collect()) == [(1, "e"), (1, "f")]
    catalogue = spark.createDataFrame([("e", "b.org"), ("e", "A.org "), ("f", "c.org")], "entity string, domain string")
    assert [(r.entity, r.domains) for r in matching.unprocessed(catalogue, spark.createDataFrame([("C.ORG",)], "domain string")).collect()] == [("e", ["a.org", "b.org"])]
    hosts = spark.createDataFrame([("a.shop.co.jp",), ("x.y.org",), ("co.jp",), ("one",), ("a.b.c.jp",)], "host string")
    got = {r.host: r.registrable for r in matching.registrable_by(hosts, spark.createDataFrame([("jp",), ("co.jp",), ("org",)], "suffix string")).collect()}
    assert got == {"a.shop.co.jp": "shop.co.jp", "x.y.org": "y.org", "co.jp": "co.jp", "one": "one", "a.b.c.jp": "c.jp"}


def test_model_rows(spark):
    df = spark.createDataFrame([("3", None, "CA")], "a string, b string, issuer string")
    assert features.model_row(df, ["a", "b", "c", "ssl_issuer_CA", "ssl_issuer_X"], F.col("issuer")).first().asDict() == {"a": 3.0, "b": 0.0, "c": 0.0, "ssl_issuer_CA": 1.0, "ssl_issuer_X": 0.0}
    top = features.top_features(spark.createDataFrame([("a", 0.1), ("b", 0.9), ("c", 0.9)], "feature string, importance double"), 2)
    assert [r.feature for r in top.collect()] == ["b", "c"]


def test_cached_lookups_cool_down(spark):
    at = datetime.datetime(2024, 1, 1, 0, 0, 0)
    cache = spark.createDataFrame([("a", True, at), ("b", False, at), ("c", False, at - datetime.timedelta(seconds=91))], "host string, ok boolean, at timestamp")
    hosts = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), ("d",)], "host string")
    got = {r.host: r.action for r in infra.looked_up_with_cache(hosts, cache, F.lit("2024-01-01 00:00:30").cast("timestamp")).collect()}
    assert got == {"a": "cached", "b": "cooling", "c": "ask", "d": "ask"}


def test_csv_of_strings_and_json(spark, tmp_path):
    from pyspark.sql import types as T

    from vigil.sources import writers

    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    assert readers.csv_text(spark, str(tmp_path / "no.csv"), schema).columns == ["a", "b"] and readers.csv_text(spark, str(tmp_path / "no.csv")).count() == 0
    (tmp_path / "x.csv").write_text("a,b\n007,\n")
    assert [tuple(r) for r in readers.csv_text(spark, str(tmp_path / "x.csv")).collect()] == [("007", None)]
    writers.write_json(spark.createDataFrame([("x", 1)], "a string, b int"), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first().asDict() == {"a": "x", "b": 1}


def test_only_the_days_folder_is_read(spark, tmp_path):
    from vigil.streaming import streams

    for day, n in (("2024-01-01", 2), ("2024-01-02", 3)):
        spark.range(n).write.parquet(str(tmp_path / "in" / day))
    stream = streams.dated_stream(spark, str(tmp_path / "in"), "id long", "2024-01-02")
    assert streams.drained_table(stream, str(tmp_path / "out")).count() == 3
