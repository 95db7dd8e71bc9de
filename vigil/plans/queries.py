"""The reference queries over the driver's tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions import hashing, signals, text, urls
from vigil.functions.similarity import indel_ratio_udf, jaro_winkler_udf, token_set_ratio_udf
from vigil.operators import brands as brands_of
from vigil.operators import control, features, infra, lexical, matching, monitor, outcomes, policy, reports, scoring, state
from vigil.plans.catalogue import BRAND_TABLE, BRANDS, CERTIFICATES, ENTITIES, FAILED, GEO, HASHES, JUDGED, ORGANISATIONS, PROTECTED, REGISTRATIONS, SALE_RULES, SECTOR_RULES, SECTORS, SHOWN
from vigil.sources import readers
from vigil.streaming import streams

QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _hosts(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "pages").select(urls.hostname(F.col("url")).alias("host")).where("host <> ''").distinct()


def _ent(spark: SparkSession) -> DataFrame:
    return lexical.entities(spark, ENTITIES)


@query
def q_lexical_gate(spark, d):
    """Flagship: each distinct host against the catalogue, gated; rejected hosts stay with their reason."""
    return lexical.gate(lexical.scored(_hosts(spark, d), _ent(spark)))


@query
def q_protected_gate(spark, d):
    """Known hosts against a catalogue with several domains and brand tokens an entity."""
    hosts = spark.createDataFrame([(h,) for h in JUDGED], "host string")
    return lexical.gate(lexical.scored(hosts, lexical.entities(spark, PROTECTED)))


@query
def q_lexical_candidates(spark, d):
    """The candidate entities of each host; where no rule hits, the two best as fallback."""
    found = lexical.candidates(lexical.scored(_hosts(spark, d), _ent(spark)), 2)
    return found.select("host", "idx", F.round("lexical_score", 6).alias("lexical_score"), "rule_hit", "fallback")


@query
def q_brand_index(spark, d):
    return lexical.brand_index(lexical.entities(spark, PROTECTED))


@query
def q_jw_whitelist_topk(spark, d):
    """The three most similar entities of each host by their best domain, ties to the first entity."""
    from pyspark.sql import Window

    best = lexical.similar_domains(_hosts(spark, d), _ent(spark)).withColumn("similarity", F.round("similarity", 6))
    w = Window.partitionBy("host").orderBy(F.desc("similarity"), "idx")
    return best.withColumn("rank", F.row_number().over(w)).where("rank <= 3").select("host", "idx", "domain", "similarity", "rank")


@query
def q_brand_token_hits(spark, d):
    return lexical.brand_hits(_hosts(spark, d), lexical.brand_index(_ent(spark))).select("host", "idx", F.array_join("hits", "|").alias("hits"), F.size("hits").cast("long").alias("n_hits"))


@query
def q_token_band_join(spark, d):
    """Distinct words of part names against brand tokens of nearly the same length."""
    words = _t(spark, d, "part").select(F.explode(text.tokens(F.col("p_name"))).alias("word")).distinct()
    near = words.join(lexical.small(lexical.brand_index(_ent(spark))), F.abs(F.length("word") - F.length("token")) <= 2)
    return near.select("word", "token", "idx", F.round(jaro_winkler_udf("word", "token"), 6).alias("similarity"))


@query
def q_url_features(spark, d):
    u = F.col("url")
    p = _t(spark, d, "pages").select("page_id", "url").withColumn("host", urls.hostname(u)).withColumn("path", urls.path_of(u))
    count = lambda pattern: F.regexp_count(u, F.lit(pattern)).cast("long")
    return p.select(
        "page_id", F.length("url").cast("long").alias("url_length"), F.length("host").cast("long").alias("host_length"), F.length("path").cast("long").alias("path_length"),
        count(r"\.").alias("n_dots"), count("-").alias("n_hyphens"), count("[0-9]").alias("n_digits"), count("/").alias("n_slashes"), count("[^A-Za-z0-9]").alias("n_special"),
        u.rlike("00|11|22|33|44|55|66|77|88|99").alias("repeated_digits"), F.contains(u, F.lit("?")).alias("has_query"), F.contains(u, F.lit("#")).alias("has_anchor"), u.startswith("https://").alias("is_https"),
        F.size(urls.labels(F.col("host"))).cast("long").alias("n_labels"), F.round(urls.entropy(u), 6).alias("entropy_url"), F.round(urls.entropy(F.col("host")), 6).alias("entropy_host"),
    )


@query
def q_host_normalise(spark, d):
    u = F.col("url")
    return _t(spark, d, "pages").select("page_id", urls.with_scheme(u).alias("normalized_url"), urls.netloc(u).alias("netloc"), urls.hostname(u).alias("host"), F.array_join(urls.words(urls.hostname(u)), "|").alias("parts"))


@query
def q_registrable_domain(spark, d):
    host = urls.hostname(F.col("url"))
    reg = urls.registrable(host)
    return _t(spark, d, "pages").select("page_id", reg.alias("registrable"), F.split_part(reg, F.lit("."), F.lit(1)).alias("label"), F.substring(reg, F.locate(".", reg) + 1, F.length(reg)).alias("suffix"))


@query
def q_url_dedupe_sources(spark, d):
    """Distinct paths with the hosts ('workbooks') that hold them, in order of appearance."""
    rows = _t(spark, d, "pages").select(urls.path_of(F.col("url")).alias("url"), urls.hostname(F.col("url")).alias("workbook"), F.col("page_id").alias("pos")).where("url <> ''")
    return readers.dedupe_sources(rows).select("url", F.array_join("source_workbooks", "|").alias("source_workbooks"), F.size("source_workbooks").cast("long").alias("n"), "first_pos")


@query
def q_record_key(spark, d):
    return _t(spark, d, "pages").select("page_id", hashing.record_key(F.col("url"), urls.hostname(F.col("url"))).alias("record_key"), F.sha2("url", 256).alias("digest"))


def _kept(df: DataFrame) -> DataFrame:
    """df written once to the shared checkpoint folder, where it is used more than once."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(_folder(df.sparkSession))
    return df.checkpoint()


def _simhashes(spark, d, table, key):
    words = _t(spark, d, table).select(key, F.explode_outer(F.filter(F.split(F.lower("text"), "[^a-z0-9]+"), lambda x: x != "")).alias("w"))
    return hashing.simhash64(words, key, "w")


@query
def q_simhash64_docs(spark, d):
    return _simhashes(spark, d, "documents", "doc_id")


@query
def q_hamming_radius_pairs(spark, d):
    """Documents against the benchmark's hashes: the nearest, hits and anchors."""
    left = _simhashes(spark, d, "documents", "doc_id").select(F.col("doc_id").alias("a"), F.col("simhash").alias("x"))
    right = _simhashes(spark, d, "benchmark", "item_id").select(F.col("item_id").alias("b"), F.col("simhash").alias("y"))
    return matching.nearest_reference(left, right, 8, 4)


@query
def q_hash_bands_equijoin(spark, d):
    """Pairs of different documents whose hashes are at most three bits apart."""
    h = _kept(_simhashes(spark, d, "documents", "doc_id"))
    return matching.hamming_pairs(h.select(F.col("doc_id").alias("id"), F.col("simhash").alias("x")), 3).withColumn("similarity", hashing.similarity(F.col("distance")))


def _order_signals(spark, d):
    o = _t(spark, d, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("id"), (k % 3 == 0).alias("a_on"), (k % 5 != 0).alias("b_on"), (k % 7 < 4).alias("c_on"),
        ((k % 101) / 100.0).alias("a_sim"), ((k % 89) / 88.0).alias("b_sim"), ((k % 53) / 52.0).alias("c_sim"), (k % 11).cast("int").alias("dist"), "o_totalprice", "o_orderstatus", "o_orderpriority", "o_custkey",
    )


@query
def q_hash_anchor_score(spark, d):
    s = _order_signals(spark, d)
    score = scoring.weighted_score({"domain": (30, F.col("a_on"), F.col("a_sim")), "favicon": (14, F.col("b_on"), F.col("b_sim")), "keywords": (10, F.col("c_on"), F.col("c_sim"))})
    hits = [F.col("b_on") & (F.col("dist") <= 8), F.col("c_on") & (F.col("dist") <= 6)]
    return s.select("id", F.round(score, 4).alias("score"), scoring.anchor([F.col("b_on") & (F.col("dist") <= 3)], hits).alias("hash_anchor"), scoring.confidence_band(score).alias("band"), scoring.evidence_tier(F.col("o_orderstatus"), F.col("a_on"), F.col("b_on")).alias("tier"))


@query
def q_margin_second_best(spark, d):
    return scoring.margins(_t(spark, d, "lineitem").select("l_orderkey", "l_extendedprice", "l_linenumber"), "l_orderkey", "l_extendedprice", "l_linenumber")


@query
def q_admission_paths(spark, d):
    s = _order_signals(spark, d)
    k = F.col("id")
    out = scoring.admission(s, F.col("a_sim") * 100, 68, F.col("a_on"), F.col("c_on"), F.col("dist") <= 1, k % 4 == 0, k % 6 == 0, k % 9 == 0)
    return out.select("id", "admitted", "review_only", "admission_reason", "review_reason")


def _decision_inputs(s):
    k = F.col("id")
    return s.select(
        "id", "o_custkey", (k % 2 == 0).alias("fallback_only"), (k % 3 == 0).alias("strict"), (k % 5 < 3).alias("score_pass"), (F.col("o_orderstatus") != "P").alias("fetched"), (k % 17 == 0).alias("redirect_spoof"), (k % 13 == 0).alias("redirect_changed"),
        (k % 7 == 0).alias("parked"), (k % 4 == 1).alias("network"), (k % 11 == 0).alias("hash_anchor"), (k % 19 == 0).alias("tvc_strong"), (k % 23 == 0).alias("content_spoof"), (k % 29 == 0).alias("weak_tvc"), (k % 31 == 0).alias("brand_evidence"), (k % 37 == 0).alias("keyword_hit"), (k % 6 == 5).alias("weak_signal"),
        (F.col("o_totalprice") / 5000).alias("score"),
    )


@query
def q_classify_holdout(spark, d):
    """Rows of whitelisted customers, without those that are done, above the floor, decided and flagged."""
    holdout = _decision_inputs(_order_signals(spark, d))
    c = _t(spark, d, "customer")
    listed = c.where(F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD")).select(F.col("c_custkey").alias("o_custkey"))
    done = c.where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    kept = holdout.join(listed, "o_custkey", "left_semi").join(done, "o_custkey", "left_anti").where(policy.floor_gate(F.col("score"), 25, F.col("strict"), F.col("hash_anchor")))
    return policy.decide(kept, flagged=True).select("id", "classification", "reason", "corroboration")


@query
def q_decision_truth_table(spark, d):
    """All 2^15 inputs of the policy."""
    bits = spark.range(1 << len(policy.INPUTS)).select("id", *[(F.shiftright("id", i) % 2 == 1).alias(n) for i, n in enumerate(policy.INPUTS)])
    return policy.decide(bits).groupBy("classification", "emit", "reason", "corroboration").agg(F.count("*").alias("n"), F.sum("id").alias("checksum"))


@query
def q_network_corroboration(spark, d):
    s, n = _t(spark, d, "supplier"), _t(spark, d, "nation")
    j = s.join(n, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    k = F.col("s_suppkey")
    isp, country = F.when(k % 3 == 0, "NA").when(k % 3 == 1, " ").otherwise(F.col("s_name")), F.when(k % 5 < 3, F.lit(None)).otherwise(F.col("n_name"))
    status = F.when(k % 7 == 0, "Failed").when(k % 7 == 1, "timeout").otherwise("fetched")
    detail, lookup = F.when(k % 11 == 0, "net::ERR_NAME_NOT_RESOLVED").otherwise(""), F.when(k % 13 == 0, "no_records").otherwise("ok")
    return j.select("s_suppkey", policy.network_corroborated([isp, country], status, detail, lookup).alias("corroborated"), text.present(isp).alias("has_isp"))


@query
def q_parked_rules(spark, d):
    """Parking rules over whole texts; the rules are a parameter, with words that these tables hold."""
    found = policy.parking(F.col("source"), F.col("text"), {"src19": "Nineteen"}, {"license": "License", "public": "Public"}, tuple(SALE_RULES))
    return _t(spark, d, "documents").withColumn("p", found).select("doc_id", "p.provider", "p.reason")


@query
def q_redirect_promotion(spark, d):
    """Each page redirected to the next one: effective host, promotion and deceptive embedding."""
    p = _t(spark, d, "pages").select("page_id", urls.hostname(F.col("url")).alias("host"))
    nxt = p.select((F.col("page_id") - 1).alias("page_id"), F.col("host").alias("final_host"))
    j = p.join(nxt, "page_id")
    spoof = urls.deceptive_embedding(F.concat_ws(".", "final_host", F.lit("info")), F.col("final_host"))
    nested = F.endswith("final_host", F.concat(F.lit("."), F.col("host"))) & (F.size(urls.labels(F.col("final_host"))) - F.size(urls.labels(F.col("host"))) >= 2)
    promoted = (F.col("final_host") != "") & (F.col("final_host") != F.col("host")) & ((urls.registrable(F.col("final_host")) != urls.registrable(F.col("host"))) | nested)
    return j.select("page_id", "host", "final_host", promoted.alias("promoted"), F.when(promoted, F.col("final_host")).otherwise(F.col("host")).alias("effective_host"), spoof.alias("deceptive"))


@query
def q_tvc_catalog_match(spark, d):
    texts = _t(spark, d, "documents").select(F.col("doc_id").alias("id"), text.tokens(F.col("text"), 2).alias("words"))
    aliases = spark.createDataFrame(BRANDS, "alias string, canonical string")
    return matching.alias_match(texts, aliases).select("id", "canonical", F.col("n_hits").cast("long").alias("n_hits"), F.col("longest").cast("long").alias("longest"))


@query
def q_suffix_catalog(spark, d):
    hosts = _t(spark, d, "pages").select("page_id", urls.hostname(F.col("url")).alias("host"))
    cat = _ent(spark).select(F.explode("domains").alias("domain"), "entity")
    return matching.suffix_match(hosts, cat).select("page_id", "host", F.col("domain").alias("brand_domain"), "entity")


@query
def q_keyword_overlap(spark, d):
    """Distinct words that each document shares with the benchmark, by document; the first-words list is exploded, not crossed."""
    words = _t(spark, d, "documents").select("doc_id", F.explode(text.tokens(F.col("text"), 4)).alias("w"))
    keys = _t(spark, d, "benchmark").select(F.explode(text.tokens(F.col("text"), 4)).alias("w")).distinct()
    n = words.join(keys, "w").groupBy("doc_id").agg(F.count("*").alias("overlap"))
    return n.select("doc_id", "overlap", F.least(F.col("overlap") / 5.0, F.lit(1.0)).alias("keyword_score"))


@query
def q_sector_mapping(spark, d):
    return policy.first_rule(_t(spark, d, "part").select("p_partkey", "p_type", "p_name"), F.lower(F.concat_ws(" ", "p_type", "p_name")), SECTORS, "Other", "sector").select("p_partkey", "sector")


@query
def q_geoip_range_join(spark, d):
    rows = _t(spark, d, "events").select("event_id", (F.col("user_id") * 1009 + F.col("event_id") % 97).alias("ip"))
    ranges = spark.createDataFrame(GEO, "low long, high long, asn string, country string")
    return matching.range_lookup(rows, "ip", ranges)


@query
def q_rdap_json_parse(spark, d):
    doc = F.concat(F.lit('{"entities":[{"role":"registrar","name":"'), F.col("event_type"), F.lit('"},{"role":"abuse","name":"x"}],"n":'), F.get_json_object("props", "$.k"), F.lit("}"))
    parsed = F.from_json(doc, "entities array<struct<role: string, name: string>>, n long")
    return _t(spark, d, "events").withColumn("r", parsed).select("event_id", F.get(F.filter("r.entities", lambda e: e["role"] == "registrar"), F.lit(0))["name"].alias("registrar"), F.col("r.n").alias("n"))


@query
def q_forward_fill(spark, d):
    e = _t(spark, d, "events").select("event_id", "user_id", F.when(F.col("event_type") == "purchase", F.col("value")).alias("last_purchase"))
    return state.forward_fill(e, ["user_id"], ["event_id"], "last_purchase")


@query
def q_latest_state_merge(spark, d):
    e = _t(spark, d, "events").select("user_id", "event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("stage"), F.col("value"), (F.col("event_type") == "error").alias("timeout_hit"))
    return state.merged(e, ["user_id"], ["event_id"], {"stage": F.col("stage").isNotNull(), "value": F.col("value") > 10}, ["timeout_hit"])


@query
def q_event_dedupe_keep_last(spark, d):
    e = _t(spark, d, "events").select("user_id", "event_type", "event_id", "value")
    return state.latest(e, ["user_id", "event_type"], ["event_id"])


@query
def q_dedupe_keep_first(spark, d):
    e = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return state.earliest(e, ["l_partkey", "l_suppkey"], ["l_orderkey", "l_linenumber"])


@query
def q_run_summary_grouping_sets(spark, d):
    return reports.run_summary(_t(spark, d, "orders"), "o_orderstatus", "o_orderpriority").select("o_orderstatus", "o_orderpriority", "n", F.col("level").cast("long").alias("level"))


@query
def q_funnel_counts(spark, d):
    docs, lab = _t(spark, d, "documents").select("doc_id", "lang"), _t(spark, d, "labels")
    j = matching.membership(docs, lab, "doc_id", "labelled").join(lab.withColumnRenamed("doc_id", "k"), F.col("doc_id") == F.col("k"), "left")
    return reports.funnel(j, {"n_all": F.lit(True), "n_labelled": F.col("labelled"), "n_good": F.col("quality") == 1, "n_kept": (F.col("quality") == 1) & (F.col("toxic") == 0), "n_kept_en": (F.col("quality") == 1) & (F.col("toxic") == 0) & (F.col("lang") == "en")})


@query
def q_rank_iterations(spark, d):
    per = _t(spark, d, "supplier").groupBy("s_nationkey").agg(F.count("*").alias("n"), F.round(F.sum("s_acctbal"), 2).alias("bal"), F.count_if(F.col("s_acctbal") < 0).alias("debtors"))
    return reports.ranked(per, [F.desc("n"), F.asc("debtors"), F.desc("bal"), F.asc("s_nationkey")]).withColumn("rank", F.col("rank").cast("long"))


@query
def q_pipe_list_explode(spark, d):
    lists = _t(spark, d, "documents").select("doc_id", F.concat_ws("|", "source", F.col("lang"), F.concat(F.lit(" "), F.col("source"))).alias("books"))
    return reports.exploded(lists, "books", "book").groupBy("book").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


@query
def q_debug_left_overlay(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
    late = _t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.round(F.sum("l_extendedprice"), 2).alias("price"), F.max("l_linestatus").alias("status"))
    return reports.overlay(o, late, "o_orderkey", ["price", "status"])


@query
def q_metric_window_5s(spark, d):
    m = monitor.tumbling(_t(spark, d, "events"), "ts", 3600, ["event_type"], "value")
    return m.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"), "greatest", "gauge")


@query
def q_latency_ring_256(spark, d):
    cents = _t(spark, d, "events").select("event_id", "event_type", F.round(F.col("value") * 100).cast("long").alias("cents"))
    return monitor.ring(cents, ["event_type"], "event_id", "cents").select("event_id", "ring_n", "ring_avg", "ring_max")


@query
def q_pressure_streaks(spark, d):
    e = _t(spark, d, "events").select("event_id", "user_id", "event_type")
    return monitor.streaks(e, ["user_id"], ["event_id"], F.col("event_type").isin("error", "view")).select("event_id", "streak")


@query
def q_stall_gaps(spark, d):
    return monitor.stalls(_t(spark, d, "events"), "user_id", "ts", 3 * 3600, 12 * 3600)


@query
def q_stall_sessions(spark, d):
    s = monitor.sessions(_t(spark, d, "events").select("user_id", "ts"), "user_id", "ts", 6 * 3600)
    fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return s.select("user_id", "n", F.date_format("first_ts", fmt).alias("first_ts"), F.date_format("last_ts", fmt).alias("last_ts"))


def _ticks(spark, d):
    k = F.col("event_id")
    return _t(spark, d, "events").select("event_type", "event_id", (k % 9 + 1).alias("processed"), (k % 5).alias("failed"), (k % 4).alias("timed_out"), (k % 50).alias("backlog"))


@query
def q_adaptive_limits(spark, d):
    return monitor.downshift(_ticks(spark, d), "event_type", "event_id", limit=400, floor=50, step=4, backlog_most=40)


@query
def q_fetch_limits(spark, d):
    """A limiter that moves both ways, by each run's totals and ratios."""
    k = F.col("event_id")
    t = _ticks(spark, d).withColumn("total", F.lit(1000)).withColumn("failed", F.when(k % 3 == 0, F.col("failed")).otherwise(0)).withColumn("timed_out", F.when(k % 4 == 0, F.col("timed_out") + 2).otherwise(0))
    return control.fetch_limits(t.select("event_type", "event_id", "total", "processed", "failed", "timed_out", ((k % 10) / 12.0).alias("queues"), ((k % 7) / 10.0).alias("files"), F.lit(0.2).alias("memory")), "event_type", "event_id", limit=64, most=96, floor=8, step=8)


@query
def q_stage_limits(spark, d):
    k = F.col("event_id")
    e = _t(spark, d, "events").select("event_id", (k % 300).cast("int").alias("now"), ((k % 11) / 10.0).alias("cpu"), ((k % 8) / 10.0).alias("ingress"), (k % 40).alias("depth"), (k % 13).cast("double").alias("rate"), ((k % 9) / 20.0).alias("late"))
    at = control.stage_limit(F.col("now"), F.lit(8), F.lit(256), F.col("ingress"), F.col("cpu"), F.col("depth"), F.col("rate"), F.col("late"), F.lit(0.3), F.lit(0.4))
    cap = control.backlog_cap(F.col("now"), F.lit(12), F.col("depth") / F.greatest(F.col("rate"), F.lit(1.0)), F.col("ingress"), F.col("cpu"), k % 17 == 0)
    ratio = control.pressure({"a": F.col("depth"), "b": k % 30}, {"a": F.lit(40), "b": F.lit(0)})
    return e.withColumn("x", at).select("event_id", "x.action", "x.next_limit", cap.cast("int").alias("cap"), F.round(ratio, 6).alias("pressure"))


@query
def q_in_flight(spark, d):
    k = F.col("event_id")
    t = _t(spark, d, "events").select("event_type", "event_id", (k % 8).cast("double").alias("free_cpu"), ((k % 5) * 2.0).alias("used_cpu"), ((k % 6) * 45.0).alias("lag_ms"), (k % 30 * 800).alias("pending_rows"), (k % 12).alias("queue"), (k % 4).alias("open_tasks"), (k % 3).alias("completed"))
    return control.in_flight(t, "event_type", "event_id", start=20, floor=4, cap=64)


@query
def q_window_rates(spark, d):
    """What cumulative counters gained since the last tick; they restart now and then."""
    e = _t(spark, d, "events").select("event_type", "event_id", (F.col("event_id") % 500).alias("done"), (F.col("event_id") % 70).alias("late"))
    return control.window_rates(e, "event_type", "event_id", "done", "late").select("event_id", "d_done", "d_late", F.round(control.share(F.col("d_late"), F.col("d_done")), 6).alias("late_share"))


@query
def q_stale_tasks(spark, d):
    tasks = _t(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("submitted"), (F.col("event_id") % 3).alias("attempts"))
    latest = F.lit("2024-01-16 00:00:00").cast("timestamp")
    return control.reaped(tasks, latest).select("event_id", "fate")


@query
def q_backlog(spark, d):
    stats = _t(spark, d, "events").select((F.col("value") >= 0).alias("ready"), F.col("user_id").alias("queue_depth"), (F.col("event_id") % 7).alias("batches"), (F.col("event_id") % 31).alias("items"))
    waiting = control.backlog({"orders": _t(spark, d, "orders"), "events": _t(spark, d, "events"), "nation": _t(spark, d, "nation")})
    return waiting.crossJoin(F.broadcast(control.rolled_up(stats)))  # one row each


@query
def q_retention_newest_k(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return reports.newest(o, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 3).select("o_custkey", "o_orderkey", F.col("age_rank").cast("long").alias("age_rank"))


@query
def q_set_ops(spark, d):
    c, o = _t(spark, d, "customer").select(F.col("c_custkey").alias("k")), _t(spark, d, "orders").select(F.col("o_custkey").alias("k"))
    rich = _t(spark, d, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("k"))
    parts = {"union": c.union(o).distinct(), "intersect": rich.intersect(o), "except": c.exceptAll(o.distinct()), "union_all": c.unionByName(o.withColumn("extra", F.lit(1)), allowMissingColumns=True).select("k")}
    out = None
    for name, df in parts.items():
        one = df.agg(F.lit(name).alias("op"), F.count("*").alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("total"))
        out = one if out is None else out.union(one)
    return out


@query
def q_feature_matrix(spark, d):
    p = _t(spark, d, "part").select("p_partkey", "p_type", F.when(F.col("p_partkey") % 7 != 0, F.col("p_size")).alias("size"), F.col("p_retailprice").alias("price"))
    full = features.standardised(features.median_imputed(p, ["size", "price"]), ["price"])
    return features.one_hot(full, "p_type", ["ECONOMY", "PROMO", "LARGE"]).drop("p_type").withColumn("price", F.round("price", 5))


@query
def q_class_frequencies(spark, d):
    return features.frequent_classes(_t(spark, d, "part").select("p_partkey", "p_brand"), "p_brand").select("p_partkey", "p_brand", "class_n", F.col("class_id").cast("long").alias("class_id"))


@query
def q_topk_cosine_entities(spark, d):
    """Every hundredth vector against all vectors."""
    e = _t(spark, d, "embeddings")
    asked = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    return features.nearest_vectors(asked, e.select(F.col("vec_id").alias("ref"), F.col("embedding").alias("u")), 3).select("id", "ref", "cosine", F.col("rank").cast("long").alias("rank"))


@query
def q_evidence_ratios(spark, d):
    """Indel and token-set ratios of part names with the catalogue's names; SQL has neither."""
    names = _t(spark, d, "part").select(F.lower("p_name").alias("name")).distinct()
    e = lexical.small(_ent(spark).select("idx", F.lower("entity").alias("entity")))
    return names.crossJoin(e).select("name", "idx", F.round(indel_ratio_udf("name", "entity"), 6).alias("indel"), F.round(token_set_ratio_udf("name", "entity"), 6).alias("token_set"))


@query
def q_html_signals(spark, d):
    body = signals.page_text(F.col("html"))
    return _t(spark, d, "pages").select("page_id", signals.page_title(F.col("html")).alias("title"), F.length(body).cast("long").alias("text_length"), F.md5(body).alias("text_md5"), F.regexp_count("html", F.lit("<p[ >]")).cast("long").alias("n_paragraphs"), F.regexp_count("html", F.lit("<a ")).cast("long").alias("n_links"))


def _cases(spark, rows, schema):
    """Inline cases with their place."""
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"k int, {schema}")


@query
def q_failure_classes(spark, d):
    """Each event fails in one of the known ways, in one of two stages."""
    cases = F.broadcast(_cases(spark, FAILED, "name string, message string"))  # inline
    e = _t(spark, d, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, "navigation").otherwise("content").alias("stage"), (F.col("event_id") % 6).alias("i"))
    j = e.join(cases, F.col("event_id") % len(FAILED) == F.col("k"))
    name, message = F.col("name"), F.col("message")
    out = j.withColumn("f", signals.fetch_failure(name, message, F.col("stage"))).withColumn("t", signals.transient(name, message))
    return out.select("event_id", "f.kind", "f.detail", F.col("f.retryable").alias("fetch_retryable"), signals.lookup_failure(name, message).alias("lookup"), "t.retryable", "t.timeout", signals.backoff(F.col("i"), 0.5, 8).alias("wait"))


@query
def q_certificate_days(spark, d):
    """Certificates that end on the dates of orders, in the form that certificates have."""
    o = _t(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 10 == 0, "not a date").when(F.col("o_orderkey") % 11 != 0, F.date_format("o_orderdate", "MMM d HH:mm:ss yyyy 'GMT'")).alias("until"))
    o = o.withColumn("since", F.when(F.col("until").isNotNull(), "Jan  5 00:00:00 1995 GMT")).withColumn("by", F.when(F.col("until").isNotNull(), "Issuer Inc"))
    return o.withColumn("c", signals.certificate(F.col("since"), F.col("until"), F.col("by"), F.lit("1997-01-01 12:00:00").cast("timestamp"))).select("o_orderkey", "c.present", "c.valid", "c.days_to_expiry", "c.issuer")


@query
def q_infra_seed(spark, d):
    k = F.col("c_custkey")
    return _t(spark, d, "customer").select("c_custkey", infra.seed(F.when(k % 3 == 0, "NA").when(k % 3 == 1, " "), F.when(k % 2 == 0, F.col("c_mktsegment")), F.when(k % 5 == 0, F.col("c_name"))).alias("seed"))


@query
def q_lookup_fanout(spark, d):
    """Each distinct host is looked up once; hosts without an entry are 'no_records'."""
    p = _t(spark, d, "pages").select("page_id", urls.hostname(F.col("url")).alias("host"))
    answers = p.where("page_id % 3 = 0").groupBy("host").agg(F.min("page_id").alias("ip")).withColumn("status", F.lit("resolved"))
    return infra.looked_up(p, "host", answers, {"status": F.lit("no_records"), "ip": F.lit(-1)}).select("page_id", "host", "ip", "status")


@query
def q_registration_fields(spark, d):
    """Suppliers with registration documents of several makes."""
    docs = F.broadcast(_cases(spark, [(x,) for x in REGISTRATIONS], "doc string"))  # inline
    j = _t(spark, d, "supplier").join(docs, F.col("s_suppkey") % len(REGISTRATIONS) == F.col("k"))
    return j.select("s_suppkey", *[c.alias(n) for n, c in infra.registration(F.col("doc")).items()])


@query
def q_resume_remaining(spark, d):
    keys = _t(spark, d, "pages").select("page_id", hashing.record_key(F.col("url"), F.lit("book")).alias("record_key"))
    return infra.remaining(keys, keys.where("page_id % 2 = 0"), ["record_key"])


@query
def q_live_workers(spark, d):
    beats = _t(spark, d, "events").select("user_id", "event_id", "event_type")
    return infra.live_workers(beats, "user_id", "event_id", F.col("event_type") == "error")


@query
def q_parity_check(spark, d):
    o = _t(spark, d, "orders")
    left = o.where("o_orderkey % 10 <> 0").select("o_orderkey", "o_orderstatus", "o_custkey")
    right = o.where("o_orderkey % 11 <> 0").select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), F.when(F.col("o_orderkey") % 13 != 0, F.col("o_custkey")).alias("o_custkey"))
    return infra.differing(left, right, "o_orderkey", ["o_orderstatus", "o_custkey"])


@query
def q_filled_catalogue(spark, d):
    """A sheet whose regions stand at their first row only, filled downwards."""
    n = _t(spark, d, "nation").select("n_nationkey", "n_name", F.when(F.col("n_nationkey") % 4 == 0, F.col("n_regionkey").cast("string")).otherwise("").alias("region"))
    return readers.filled_catalogue(n, "region", "n_nationkey")


@query
def q_whitelist_first_match(spark, d):
    """Parts against suppliers' numbers: the first that the condition accepts, in order."""
    left = _t(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_size")
    right = _t(spark, d, "nation").select("n_nationkey", "n_name")
    return matching.first_match(left, right, (F.col("p_size") + F.col("n_nationkey")) % 7 == 0, "n_nationkey").select("id", "n_nationkey", "n_name")


@query
def q_compare_hashes(spark, d):
    """Hashes as they come, with prefixes, capitals and rubbish, to each other and to sets of references."""
    c = _cases(spark, HASHES, "a string, b string, refs array<string>")
    dist, best = hashing.distance(hashing.bits(F.col("a")), hashing.bits(F.col("b"))), hashing.best_of_set(F.col("a"), F.col("refs"))
    arrays = F.get(hashing.reference_arrays(F.col("a"), F.array("refs"), 8, 4), F.lit(0))
    return c.withColumn("x", best).withColumn("y", arrays).select("k", dist.alias("distance"), F.round(hashing.similarity(dist), 6).alias("similarity"), F.col("x.distance").alias("best_distance"), F.round("x.similarity", 6).alias("best_similarity"), F.col("y.distance").alias("filled"), "y.hit", "y.anchor")


@query
def q_domain_simhash(spark, d):
    return _hosts(spark, d).select("host", hashing.domain_simhash(F.col("host")).alias("simhash"))


@query
def q_certificate_identity(spark, d):
    pair = "array<struct<key: string, value: string>>"
    c = _cases(spark, CERTIFICATES, f"subject {pair}, issuer {pair}, names array<struct<kind: string, value: string>>")
    return c.select("k", hashing.certificate_identity(F.col("subject"), F.col("issuer"), F.col("names")).alias("identity"), hashing.certificate_simhash(F.col("subject"), F.col("issuer"), F.col("names")).alias("simhash"))


@query
def q_url_struct(spark, d):
    """All features of a URL; every seventh one is too long, every eleventh blank."""
    k = F.col("page_id")
    p = _t(spark, d, "pages").select("page_id", F.when(k % 7 == 0, F.concat("url", F.repeat(F.lit("x"), 2100))).when(k % 11 == 0, " ").when(k % 2 == 0, F.concat(F.col("url"), F.lit("/a_b-c?q=1&r=%20#top!"))).otherwise(F.regexp_replace("url", "^https?://", "")).alias("u"))
    return p.select("page_id", *[(F.round(c, 6) if n.startswith(("avg", "entropy")) else c).alias(n) for n, c in features.url_features(F.col("u")).items()])


def _targets(spark, d):
    """Each page lands on the next one, on a deeper host, or nowhere."""
    k = F.col("page_id")
    p = _t(spark, d, "pages").select("page_id", "url")
    j = p.join(p.select((k - 1).alias("page_id"), F.col("url").alias("next")), "page_id")
    landing = F.when(k % 5 == 0, "about:blank").when(k % 5 == 1, F.concat(F.lit("https://a.b."), urls.hostname(F.col("url")), F.lit("/x"))).when(k % 5 == 2, F.col("url")).otherwise(F.col("next"))
    return outcomes.with_target(j.withColumn("landing", landing).withColumn("trick", F.when(k % 3 == 0, "yes")), [F.when(k % 4 == 0, "javascript:void(0)").otherwise(F.col("url")), F.col("url")], F.col("landing"), F.col("trick"))


@query
def q_effective_target(spark, d):
    return _targets(spark, d).select("page_id", "original_host", "final_host", "redirect_promoted", "redirect_spoof", "effective_url", "effective_host")


@query
def q_output_remarks(spark, d):
    k = F.col("page_id")
    path = outcomes.passthrough(F.when(k % 8 == 0, F.lit("score_threshold| dns_not_mapped_lexical_passthrough ")), F.lit("x|"))
    label = F.when(k % 3 == 0, "Phishing").when(k % 3 == 1, "Suspected").otherwise("Legitimate")
    tier = scoring.evidence_tier(F.when(k % 9 == 0, "Strong_Evidence"), k % 2 == 0, k % 4 == 0)
    said = outcomes.remarks(path, F.when(k % 6 == 0, "10.0.0.1").otherwise("na"), F.col("redirect_spoof"), F.col("redirect_promoted"), F.col("effective_host"), label, tier)
    why = outcomes.review_reason(F.when(k % 5 == 0, "Failed").otherwise("fetched"), k % 2 == 0, k % 3 == 0, k % 7 == 0)
    domain = outcomes.export_domain(F.when(k % 2 == 0, " "), F.when(k % 3 == 0, "Shop.Example"), F.when(k % 5 == 0, F.col("url")), F.col("landing"))
    return _targets(spark, d).select("page_id", said.alias("remarks"), why.alias("review_reason"), domain.alias("export_domain"), outcomes.export_stem(F.concat(F.lit("dir/ "), F.col("page_id").cast("string"), F.lit(" b&c.v1.xlsx"))).alias("stem"))


@query
def q_preempted_decisions(spark, d):
    k = F.col("id")
    i = _decision_inputs(_order_signals(spark, d))
    status = F.when(~F.col("fetched"), "timeout").when(k % 12 == 0, "blocked").otherwise("fetched")
    out = outcomes.decided(i, status, F.when(k % 8 == 0, "not_registered"), k % 40 == 0)
    return out.select("id", "classification", "emit", "reason", "corroboration")


@query
def q_below_floor(spark, d):
    k = F.col("o_orderkey")
    o = _t(spark, d, "orders").withColumn("score", F.when(k % 9 == 0, "n/a").otherwise((k % 60).cast("string")))
    return outcomes.below_floor(o, F.col("score"), 25, k % 5 == 0, k % 7 == 0, {"Application_ID": F.lit("A"), "Identified Phishing/Suspected Domain Name": F.concat(F.lit("h"), k.cast("string")), "Critical Sector Entity Name": F.when(k % 2 == 0, " ").otherwise(F.col("o_orderpriority"))})


@query
def q_stage0_rows(spark, d):
    """Pages as inputs, each judged by its number: several have the same url."""
    p = _t(spark, d, "pages").select("page_id", F.col("url"))
    k = F.col("page_id")
    scores = p.where(k % 4 != 3).select("page_id", (k % 3 == 0).alias("strict"), (k % 100).alias("score"))
    decisions = p.where(k % 5 == 0).select("page_id", F.when(k % 2 == 0, "score_threshold").otherwise("").alias("admission_path"), F.lit("weak").alias("review_only_reason"), (k % 2 == 0).alias("admitted"), (k % 15 == 0).alias("review_only"), F.lit("fetched").alias("fetch_status"))
    return outcomes.stage0_rows(p.select(k.alias("pos"), "page_id", "url"), scores, decisions, p.where(k % 7 == 0), p.where(k % 6 == 0), "page_id")


@query
def q_stage1_rows(spark, d):
    """Orders as records after the first stage: where each ends, and which go to review, are excluded, or were analysed deeply."""
    k = F.col("o_orderkey")
    o = _t(spark, d, "orders").select(
        "o_orderkey", F.when(k % 5 == 0, "Timeout").when(k % 5 == 1, "failed").when(k % 5 == 2, "fetched_visual_missing").when(k % 5 == 3, "fetched").alias("fetch_status"), (k % 11 == 0).alias("admitted"), (k % 13 == 0).alias("kept"), F.when(k % 4 == 0, "p").otherwise(" ").alias("survival_path"),
        F.when(k % 6 == 0, "stage1_suspected_non_escalated").when(k % 6 == 1, "strict_lexical_below_holdout_threshold").otherwise("").alias("reason"), F.when(k % 3 == 0, "lexical_gate").otherwise("dns").alias("exclusion_stage"), (k % 2 == 0).alias("escalate_to_hashing"), F.when(k % 7 != 0, "Accepted").alias("dns_decision"),
    )
    r = outcomes.deep_analysis(outcomes.routed(outcomes.with_defaults(o, {"fetch_status": "", "visual_status": "not_attempted"})))
    r = r.withColumn("x", outcomes.terminal_outcome(F.col("admitted"), F.col("kept"), F.col("reason"), F.lit(""), F.col("fetch_status"), F.col("exclusion_stage")))
    review, out = outcomes.review_queue(o).select("o_orderkey", "review_reason"), outcomes.excluded(o).select("o_orderkey", F.lit(True).alias("is_excluded"))
    j = r.join(review, "o_orderkey", "left").join(out, "o_orderkey", "left")
    return j.select("o_orderkey", "queued", "metric", "visual_status", "deep_analysis_dns_accepted", "deep_analysis_attempted", "x.pipeline_status", "x.stage_status", "x.failure_reason", "review_reason", F.coalesce("is_excluded", F.lit(False)).alias("is_excluded"))


@query
def q_brand_consistency(spark, d):
    """Brands in recognised and page texts against the domains that show them."""
    brands = brands_of.catalogue(spark.createDataFrame(BRAND_TABLE, "brand string, aliases array<string>, spoof_aliases array<string>, domains array<string>"))
    rows = _cases(spark, SHOWN, "domain string, header string, full string, html string, cse string, cse_domain string").withColumnRenamed("k", "id")
    return brands_of.consistency(rows, brands)


@query
def q_page_alignment(spark, d):
    """How far pages speak of the entities that they are held against, and which hosts embed another one."""
    k = F.col("page_id")
    p = _t(spark, d, "pages").select("page_id", signals.headings_and_paragraphs(F.col("html")).alias("words"), urls.hostname(F.col("url")).alias("host"))
    e = lexical.small(_ent(spark)).select("idx", "entity", F.get("domains", F.lit(0)).alias("legit"))
    j = p.join(e, k % 6 == F.col("idx"))
    n = brands_of.aligned(F.col("words"), [F.col("host")], F.col("entity"), F.split(F.lower("entity"), " "), F.array(F.lit("license Public"), F.lit("work")))
    inside = F.when(k % 2 == 0, F.concat(F.col("legit"), F.lit(".evil.info"))).otherwise(F.concat(F.lit("www."), F.col("legit")))
    return j.select("page_id", n.alias("aligned"), F.array_join(F.array_sort(brands_of.host_tokens(F.col("host"))), "|").alias("host_tokens"), brands_of.deceptive(inside, F.col("legit")).alias("deceptive"), brands_of.signature(F.when(k % 3 == 0, "login.bank.in").otherwise(F.col("host"))).alias("signature"))


@query
def q_sector_precedence(spark, d):
    """Sectors by priority words, by parts of the domain, by words anywhere; and labels by lists of words."""
    c = _cases(spark, ORGANISATIONS, "entity string, domain string, registrar string, hoster string, dns string")
    label = outcomes.rule_label(F.col("registrar"), F.col("hoster"), F.col("dns"), F.col("domain"), F.lit(""), F.lit(False), ("sbi", "icici"), (("godaddy",), ("cloudflare",)), (("cheapnames",), ("bulletproof",)))
    return c.select("k", outcomes.sector(F.col("entity"), F.col("domain"), SECTOR_RULES, ("irctc", "nic", "sbi")).alias("sector"), label.alias("label"))


@query
def q_page_predicates(spark, d):
    k = F.col("page_id")
    p = _t(spark, d, "pages").select("page_id", "url", F.when(k % 9 == 0, F.lit(None)).when(k % 9 == 1, F.substring("html", 1, 60)).when(k % 9 == 2, F.concat("html", F.lit(" 403 Forbidden "))).otherwise(F.col("html")).alias("page"))
    title, shown = F.when(k % 4 == 0, " Index  of / ").when(k % 4 == 1, "").otherwise("Home"), F.when(k % 3 == 0, "").otherwise("some text")
    status, kind, detail = F.when(k % 5 == 0, "timeout").otherwise("failed"), F.when(k % 6 == 0, "TargetClosedError").otherwise(""), F.when(k % 7 == 0, "net::ERR_NAME_NOT_RESOLVED").when(k % 7 == 1, "boom").otherwise("")
    return p.select(
        "page_id", signals.block_page(F.col("page")).alias("blocked"), outcomes.delayed_redirect(k % 2 == 0, F.col("url"), F.when(k % 10 == 0, "https://x.org").otherwise(F.col("url")), title, shown).alias("look_again"), signals.uninformative(title, shown, F.lit(""), ("just a moment",)).alias("uninformative"),
        signals.suspicious_network(status, kind, detail).alias("suspicious"), outcomes.signal_seed(k % 20 == 0, k % 21 == 0, [k % 3 - 2, F.lit(0)], F.when(k % 22 == 0, "parked")).alias("seed"),
        outcomes.high_risk_seed(k % 5 == 0, k % 8 == 0, k % 9 == 0, (k % 100 / 100.0).cast("string"), (k % 90 / 90.0).cast("string")).alias("high_risk"),
    )


@query
def q_small_functions(spark, d):
    o, k = _t(spark, d, "orders"), F.col("o_orderkey")
    link = F.when(k % 3 == 0, F.concat(F.lit("https://t-my.sharepoint.com/:x:/g/personal/u"), k.cast("string"), F.lit("/TOK?e=1"))).when(k % 3 == 1, "https://t.sharepoint.com/a?b=1").otherwise(F.concat(F.lit("https://1drv.ms/x/s!"), k.cast("string")))
    word = lambda t, y, c: F.struct(F.lit(t).alias("text"), F.array(F.lit(float(y)), (k % 700).cast("double")).alias("ys"), F.lit(c).alias("confidence"))
    z = signals.zones(F.array(word("Bank", 10, 0.9), word(" login ", 500, 0.5), word("blur", 5, 0.2), word("(c) 2024", 890, 0.4), word(" ", 1, 1.0)), F.lit(900.0))
    return o.withColumn("z", z).select(
        "o_orderkey", signals.duration(F.col("o_totalprice") / 7).alias("duration"), signals.stable_json(F.create_map(F.lit("b"), F.col("o_orderstatus"), F.lit("a"), k.cast("string"))).alias("json"), signals.download_link(link).alias("link"),
        signals.evidence_name(F.when(k % 2 == 0, "State Bank of India (SBI)").otherwise("Airtel Ltd"), F.lit("x.example"), k).alias("evidence"), "z.header", "z.body", "z.footer", F.col("z.n").alias("n_words"),
    )


@query
def q_submission_package(spark, d):
    """The last row of each record in a run's log, if it is completed, as a submission's record, with the evidence that these name."""
    k = F.col("event_id")
    name = "Identified Phishing/Suspected Domain Name"
    record = F.to_json(F.create_map(F.lit(name), F.when(k % 5 == 0, "about:blank").otherwise(F.concat(F.lit("h"), k.cast("string"))), F.lit("Remarks"), F.when(k % 2 == 0, "r").otherwise(" "), F.lit("Evidence file name"), F.concat(F.lit("E\\x/f"), (k % 40).cast("string"), F.lit(".pdf"))))
    log = _t(spark, d, "events").select(F.col("user_id").cast("string").alias("record_key"), F.col("event_id").alias("pos"), F.when(k % 3 == 0, "failed").otherwise("completed").alias("status"), F.when(k % 10 == 0, "data:x").otherwise("raw.example").alias("raw_url"), F.lit("n.example").alias("normalized_url"), F.when(k % 7 == 0, "{broken").otherwise(record).alias("record"))
    records = outcomes.submission_records(log)
    files = spark.range(60).select(F.concat(F.lit("f"), F.col("id").cast("string"), F.lit(".pdf")).alias("name"))
    named = outcomes.referenced(files, records).agg(F.count("*").alias("n_files"))
    return records.select("record_key", F.col(name).alias("domain"), F.col("Remarks").alias("remarks"), F.col("Hosting IP").alias("ip"), F.col("Evidence file name").alias("evidence")).crossJoin(F.broadcast(named))  # one row


@query
def q_lookup_bundles(spark, d):
    """Addresses and records of hosts in order, whom to ask for a registration, and which hosts are asked at all."""
    k = F.col("page_id")
    p = _t(spark, d, "pages").select("page_id", urls.hostname(F.col("url")).alias("host")).where("host <> ''")
    answers = p.select("host", k.alias("pos"), F.when(k % 6 != 0, F.concat(F.lit("10.0.0."), (k % 4).cast("string"))).alias("ip"))
    records = p.select("host", F.element_at(F.array(*map(F.lit, ("MX", "A", "NS", "CNAME", "TXT"))), (k % 5 + 1).cast("int")).alias("kind"), F.when(k % 7 != 0, F.concat(F.lit("v"), (k % 3).cast("string"))).alias("value"))
    cache = p.where(k % 2 == 0).select("host", (k % 4 == 0).alias("ok"), F.timestamp_seconds(1000 + k).alias("at"))
    asked = infra.looked_up_with_cache(p, cache, F.timestamp_seconds(F.lit(1200)))
    joined = asked.join(infra.resolved_addresses(answers), "host", "left").join(infra.record_bundle(records), "host", "left")
    return joined.select("host", "action", F.array_join("ips", ",").alias("ips"), "dns_answer_count", "dns_records", infra.endpoint(F.col("host"), {"com": "https://com.example/", "org": "https://org.example/"}, "https://any.example/").alias("endpoint"))


@query
def q_registration_fallback(spark, d):
    """Registrations, with a second source where the first has nothing and the host resolves; and their ages."""
    k = F.col("s_suppkey")
    main = {"registrar": F.when(k % 3 == 0, "NA").when(k % 3 == 1, F.col("s_name")), "registered": F.when(k % 6 == 1, "2020-02-03T04:05:06Z")}
    other = {"registrar": F.when(k % 4 != 0, F.concat(F.lit(" W"), k.cast("string"))), "registered": F.when(k % 5 == 0, "2021-13-01").otherwise("2019-05-06")}
    out = infra.with_fallback(main, other, k % 2 == 0)
    return _t(spark, d, "supplier").select("s_suppkey", *[c.alias(n) for n, c in out.items()], infra.age_days(out["registered"], F.lit("2024-01-01").cast("date")).cast("long").alias("age"))


@query
def q_exact_hashes(spark, d):
    """Texts whose checksum stands in an entity's set, whatever form it is written in."""
    docs = _t(spark, d, "documents").select(F.col("doc_id").alias("id"), F.substring(F.md5("text"), 1, 16).alias("hash"))
    refs = docs.where("id % 7 = 0").select(F.concat(F.lit("e"), (F.col("id") % 3).cast("string")).alias("entity"), F.concat(F.lit("0x"), F.upper("hash")).alias("hash"))
    return matching.exact_hits(docs, refs)


@query
def q_unprocessed_domains(spark, d):
    pages = _t(spark, d, "pages").select("page_id", urls.hostname(F.col("url")).alias("domain"))
    catalogue = pages.select(urls.registrable(F.col("domain")).alias("entity"), "domain")
    return matching.unprocessed(catalogue, pages.where("page_id % 3 = 0").select("domain")).select("entity", F.array_join("domains", "|").alias("domains"))


@query
def q_registrable_by_table(spark, d):
    suffixes = spark.createDataFrame([("com",), ("org",), ("example.net",), ("net",)], "suffix string")
    return matching.registrable_by(_hosts(spark, d), suffixes)


@query
def q_array_sets(spark, d):
    """Unions, intersections, differences and subsets of lists, without nulls, and abbreviations in names."""
    o = _t(spark, d, "orders")
    k = F.col("o_orderkey")
    a = F.array_compact(F.array(F.lit("a"), F.when(k % 2 == 0, "b"), F.when(k % 3 == 0, "c"), F.when(k % 5 == 0, "a")))
    b = F.array_compact(F.array(F.when(k % 7 == 0, "b"), F.lit("d"), F.when(k % 4 == 0, "c")))
    flat = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), "|")
    names = F.transform(F.regexp_extract_all(F.concat(F.lit("Bank (SB"), (k % 3).cast("string"), F.lit(") of (x) India (BANK2)")), F.lit(r"\(([A-Za-z0-9]{2,})\)"), F.lit(1)), lambda x: F.lower(x))
    return o.select("o_orderkey", flat(F.array_union(a, b)).alias("both"), flat(F.array_intersect(a, b)).alias("common"), flat(F.array_except(a, b)).alias("rest"), (F.size(F.array_except(b, a)) == 0).alias("subset"), F.array_join(names, "|").alias("abbreviations"))


@query
def q_workbook_map(spark, d):
    """Records with the workbooks of their addresses; an address without any keeps its row."""
    pages = _t(spark, d, "pages").select("page_id", urls.path_of(F.col("url")).alias("url"), urls.hostname(F.col("url")).alias("workbook"), F.col("page_id").alias("pos"))
    books = readers.dedupe_sources(pages.where("page_id % 4 <> 0 AND url <> ''").select("url", "workbook", "pos")).select(F.col("url").alias("u"), F.array_join("source_workbooks", "|").alias("source_workbook"))
    return pages.join(books, F.col("url") == F.col("u"), "left").select("page_id", F.coalesce("source_workbook", F.lit("")).alias("source_workbook"))


@query
def q_lookup_speed(spark, d):
    """Mean and number of lookups that took any time, by kind; and the slowest kinds first, five at most."""
    e = _t(spark, d, "events").where("value > 0").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean"))
    return reports.ranked(e, [F.desc("mean"), F.asc("event_type")]).where("rank <= 5").withColumn("rank", F.col("rank").cast("long"))


@query
def q_holdout_rows(spark, d):
    """Rows as they are held out, scores to four places; every fourth for a host without an address."""
    k = F.col("o_orderkey")
    o = _t(spark, d, "orders").select("o_orderkey", F.when(k % 6 == 0, "x").otherwise((F.col("o_totalprice") / 7).cast("string")).alias("hash_score"), F.lit("High").alias("confidence_band"))
    kept = outcomes.holdout_row(o.where(k % 4 != 0), ["hash_score"]).select("o_orderkey", "hash_score", "confidence_band", F.lit("").alias("admission_path"))
    return kept.union(outcomes.unmapped_rows(o.where(k % 4 == 0)).select("o_orderkey", "hash_score", "confidence_band", "admission_path"))


@query
def q_workbook_outputs(spark, d):
    docs = _t(spark, d, "documents").select(F.col("doc_id").alias("url"), F.concat_ws("|", "source", "lang").alias("source_workbook"))
    out = docs.where("url % 3 = 0").select("url", F.when(F.col("source_workbook").startswith("src1"), F.col("source_workbook")).alias("source_workbook"))
    return matching.outputs_by_workbook(out, [docs.where("url % 2 = 0"), docs.where("url % 5 = 0")])


@query
def q_page_icons(spark, d):
    k = F.col("page_id")
    html = F.concat("html", F.when(k % 3 == 0, '<LINK href="/f.ico" rel="shortcut icon">').when(k % 3 == 1, "<link rel=icon href=https://x.org/i.png sizes=any>").otherwise('<link rel="stylesheet" href="s.css">'))
    hashed = hashing.image_distance(F.substring(F.md5("html"), 1, 16), F.when(k % 5 != 0, "00ff00ff00ff00ff").otherwise("zz"))
    return _t(spark, d, "pages").select("page_id", signals.favicon_link(html).alias("icon"), F.when(hashed == float("inf"), -1.0).otherwise(hashed).alias("distance"), scoring.keyword_part(k % 6).cast("int").alias("points"), signals.run_token(F.timestamp_seconds(k * 1000)).alias("token"))


@query
def q_upsert_state(spark, d):
    """A table of state with later patches over it, which also bring new rows."""
    k = F.col("c_custkey")
    c = _t(spark, d, "customer").select("c_custkey", F.lit(1).alias("version"), F.col("c_mktsegment").alias("stage"))
    old, new = c.where(k % 3 != 0), c.where(k % 2 == 0).withColumn("version", F.lit(2)).withColumn("stage", F.lower("stage"))
    return state.upsert_log(old, new, ["c_custkey"], ["version"])


@query
def q_funnel_pivot(spark, d):
    """Rows of each workbook in the stages, as columns; rows of several workbooks count in each."""
    docs = _t(spark, d, "documents").select("doc_id", F.concat_ws("|", "source", F.concat(F.lit(" "), F.col("lang"))).alias("books"), F.when(F.col("doc_id") % 3 == 0, "stage1").when(F.col("doc_id") % 3 == 1, "holdout").otherwise("review").alias("stage"))
    counted = reports.exploded(docs, "books", "book").groupBy("book").pivot("stage", ["stage1", "holdout", "review"]).agg(F.count(F.lit(1)))
    return counted.select("book", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("stage1", "holdout", "review")])


@query
def q_top_reasons(spark, d):
    return reports.top_reasons(_t(spark, d, "lineitem").select(F.concat_ws("_", "l_returnflag", "l_linestatus", (F.col("l_linenumber") % 3).cast("string")).alias("reason")), "reason", 5)


def _folder(spark: SparkSession) -> str:
    """The cluster's shared folder for stream checkpoints and outputs; one of our own where none is named and all runs on one machine."""
    sc = spark.sparkContext
    there = sc._jsc.sc().getCheckpointDir()
    named = there.get() if there.isDefined() else spark.conf.get("spark.checkpoint.dir", None)
    if not named and not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return named or tempfile.mkdtemp(prefix="vigil-stream-")


def _event_stream(spark, d):
    """All events in one trigger: between triggers, the watermark would drop events that are older than those already read."""
    path = f"{d}/events.parquet"
    schema = spark.read.parquet(path).schema
    return streams.file_stream(spark, f"{d}/events.parquet*", schema, None).withColumn("ts", F.col("ts").cast("timestamp"))


@query
def q_stream_events_watermark(spark, d):
    s = streams.windowed(_event_stream(spark, d), "ts", ["event_type"], "value", width="1 day", late="1 hour")
    out = streams.drained_table(s, _folder(spark), "complete")
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n", "total")


@query
def q_stream_dedupe(spark, d):
    s = streams.deduplicated(_event_stream(spark, d).select("event_id", "user_id", "event_type", "ts"), "ts", ["event_id"])
    return streams.drained_table(s, _folder(spark)).select("event_id", "user_id", "event_type")


@query
def q_stream_watchdog(spark, d):
    """Warnings and stalls of each event type from state that follows the stream."""
    s = streams.watchdog(_event_stream(spark, d).select(F.col("event_type").alias("kind"), "ts"), "kind", "ts", 3600, 4 * 3600)
    return streams.drained_table(s, _folder(spark), "update", ["kind"]).drop("silent")
