"""DuckDB SQL that gives the same rows as the queries."""

from __future__ import annotations

from vigil.functions.signals import BLOCKED, BROWSER_BROKEN, BROWSER_GONE, NETWORK_SUSPICIOUS, NO_SUCH_NAME, TLS_BROKEN, TRANSIENT
from vigil.operators.brands import DOMAIN_PARTS, KINDS, SERVICES
from vigil.operators.lexical import GENERIC_TOKENS, RISK_KEYWORDS, SUFFIX_HINTS
from vigil.operators.outcomes import SUBMISSION, WEAK
from vigil.operators.policy import INPUTS
from vigil.plans.catalogue import BRAND_TABLE, BRANDS, CERTIFICATES, ENTITIES, FAILED, GEO, HASHES, JUDGED, ORGANISATIONS, PROTECTED, REGISTRATIONS, SECTOR_RULES, SECTORS, SHOWN


def _values(rows) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'" for x in r) + ")" for r in rows)


_HOST = r"regexp_replace(lower(regexp_extract(trim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^:/?#]*)', 1)), '^\.+|\.+$', '', 'g')"
_PATH = r"regexp_extract(url, '^[^?#]*?://[^/?#]*([^?#]*)', 1)"


def _registrable(host: str) -> str:
    s = "('bank.in', 'co.in', 'co.uk', 'com.au', 'gov.in', 'net.in', 'org.in')"
    parts = f"string_split({host}, '.')"
    return f"CASE WHEN array_to_string({parts}[-2:], '.') IN {s} THEN array_to_string({parts}[-3:], '.') ELSE array_to_string({parts}[-2:], '.') END"


def _entropy(x: str) -> str:
    return f"CASE WHEN length({x}) = 0 THEN 0.0 ELSE coalesce(list_sum(list_transform(list_distinct(string_split({x}, '')), lambda c: -(length({x}) - length(replace({x}, c, ''))) / length({x}) * log2((length({x}) - length(replace({x}, c, ''))) / length({x})))), 0.0) END"


def _ent(rows) -> str:
    return "ent(idx, entity, domains) AS (VALUES " + ", ".join(f"({i}, '{e}', {d})" for i, e, d in rows) + ")"


_ENT = _ent(ENTITIES)
_HINTS = sorted({*RISK_KEYWORDS, *SUFFIX_HINTS})
_BEGINS = f"'^({'|'.join(_HINTS)})'"
_HOSTS = f"hosts AS (SELECT DISTINCT {_HOST} AS host FROM pages WHERE {_HOST} <> '')"
_FLAT = "regexp_replace(lower({0}), '[^a-z0-9]+', '', 'g')"
_TOKENS_OF = f"""
dom AS (SELECT idx, unnest(domains) AS domain, unnest(range(len(domains))) AS pos FROM ent),
tok AS (SELECT DISTINCT idx, token FROM (
    SELECT idx, {_FLAT.format(f"string_split({_registrable('domain')}, '.')[1]")} AS token, 3 AS least FROM dom
    UNION ALL SELECT idx, lower(unnest(regexp_extract_all(entity, '\\(([A-Za-z0-9]{{2,}})\\)', 1))), 3 FROM ent
    UNION ALL SELECT idx, unnest(regexp_extract_all(lower(entity), '[a-z0-9]{{3,}}')), 4 FROM ent)
  WHERE length(token) >= least AND token NOT IN {tuple(GENERIC_TOKENS)})"""
_HITS = f"""
labels AS (SELECT host, string_split({_registrable("host")}, '.')[1] AS label FROM hosts),
parts AS (SELECT host, list_filter(regexp_split_to_array(lower(label), '[^a-z0-9]+'), lambda x: x <> '') AS parts FROM labels),
one AS (SELECT host, parts, unnest(range(1, len(parts) + 1)) AS i FROM parts),
rules AS (
  SELECT host, idx, token, parts[i] AS part, i, parts FROM one, tok),
hits AS (
  SELECT host, idx, list_sort(list_distinct(list(token))) AS hits FROM rules
  WHERE CASE WHEN length(token) > 4 THEN starts_with(part, token) OR ends_with(part, token)
             WHEN part = token THEN len(list_filter(parts, lambda o, k: k <> i AND regexp_matches(o, {_BEGINS}))) > 0
             ELSE starts_with(part, token) AND regexp_matches(substr(part, length(token) + 1), {_BEGINS}) END
  GROUP BY host, idx)"""
_SCORED = f"""
sim AS (SELECT host, idx, domain, similarity FROM (SELECT *, row_number() OVER (PARTITION BY host, idx ORDER BY similarity DESC, pos) AS r FROM (SELECT host, idx, pos, domain, jaro_winkler_similarity(host, domain) AS similarity FROM hosts, dom)) WHERE r = 1),
flats AS (SELECT host, label, {_FLAT.format("label")} AS flat FROM labels),
key AS (SELECT host, idx, max(jaro_winkler_similarity(flat, token)) AS keyword_sim FROM flats, tok WHERE abs(length(flat) - length(token)) <= 6 GROUP BY host, idx),
prof2 AS (SELECT *, len(list_filter({_HINTS}, lambda k: contains(flat, k))) AS n_risk FROM flats),
full_ AS (
  SELECT p.*, ent.idx, entity, CASE WHEN coalesce(similarity, 0) > 0 THEN domain ELSE '' END AS domain, coalesce(similarity, 0.0) AS similarity, coalesce(keyword_sim, 0.0) AS keyword_sim, coalesce(hits, []) AS hits, coalesce(len(hits), 0) AS n_hits, {_entropy("label")} AS ent_bits
  FROM prof2 p CROSS JOIN ent LEFT JOIN sim ON sim.host = p.host AND sim.idx = ent.idx LEFT JOIN key ON key.host = p.host AND key.idx = ent.idx LEFT JOIN hits ON hits.host = p.host AND hits.idx = ent.idx),
j AS (SELECT *, n_risk > 0 AND keyword_sim >= 0.93 AS fuzzy FROM full_),
e AS (SELECT *, n_hits > 0 OR fuzzy AS evidence FROM j),
pts AS (SELECT *, CASE WHEN evidence THEN 0.35::DOUBLE * (CASE WHEN length(label) <= 8 THEN 4 WHEN length(label) <= 14 THEN 10 WHEN length(label) <= 20 THEN 18 ELSE 25 END) + 0.35::DOUBLE * least(greatest(ent_bits / 4.5::DOUBLE * 25, 0.0), 25.0) ELSE 0.0 END
    + CASE WHEN evidence AND n_risk > 0 THEN least(12, 6 + 3 * (n_risk - 1)) ELSE 0 END
    + CASE WHEN n_hits > 0 THEN least(32, 18 + 6 * (n_hits - 1)) WHEN fuzzy THEN 12 ELSE 0 END + least(25.0, 25 * keyword_sim) AS points FROM e),
t AS (SELECT *, CAST(least(greatest(round_even(points, 0), 0), 100) AS INTEGER) AS total FROM pts),
s AS (SELECT *, greatest(similarity, total / 100.0::DOUBLE) AS lexical_score, similarity >= 0.93 OR (total >= 40 AND evidence) AS rule_hit FROM t)"""


def _gate(ent: str, hosts: str) -> str:
    return f"""
WITH {ent}, {hosts}, {_TOKENS_OF}, {_HITS}, {_SCORED},
r AS (SELECT *, max(CAST(rule_hit AS INTEGER)) OVER (PARTITION BY host) AS any_hit, row_number() OVER (PARTITION BY host ORDER BY rule_hit DESC, lexical_score DESC, idx) AS k FROM s),
b AS (SELECT *, any_hit = 0 AND NOT rule_hit AS fallback_rank_only, lexical_score >= 0.85 AND any_hit = 1 AS lexical_score_pass FROM r WHERE k = 1)
SELECT host, entity, domain, round(similarity, 6) AS similarity, round(keyword_sim, 6) AS keyword_sim, round(lexical_score, 6) AS lexical_score, total, array_to_string(hits, '|') AS brand_hits,
  CASE WHEN similarity >= 0.93 THEN 'whitelist_similarity_match' WHEN total >= 40 AND evidence THEN 'score_threshold_match' ELSE 'no_match' END AS match_reason,
  CASE WHEN total >= 70 THEN 'high' WHEN total >= 40 THEN 'medium' ELSE 'low' END AS risk, rule_hit AND evidence AS brand_token_hit, rule_hit AS strict_lexical_hit, lexical_score_pass, fallback_rank_only,
  rule_hit OR lexical_score_pass AS gate
FROM b"""


def _decide(source: str) -> str:
    c = {n: f"coalesce({n}, false)" for n in INPUTS}
    n = lambda *x: "(" + " + ".join(f"CAST({c[k]} AS INTEGER)" for k in x) + ")"
    every = n("hash_anchor", "tvc_strong", "content_spoof", "weak_tvc", "brand_evidence", "keyword_hit", "weak_signal", "parked", "network")
    out = n("parked", "network")
    strong = "(hash_anchor OR tvc_strong OR content_spoof)"
    weak = f"({strong} OR weak_tvc OR brand_evidence OR keyword_hit OR weak_signal)"
    rules = [
        ("fallback_only AND NOT strict", "Legitimate", False, "fallback_rank_only_without_strict_lexical", "0"),
        ("NOT (strict OR score_pass)", "Legitimate", False, "no_lexical_gate", "0"),
        ("NOT fetched AND redirect_spoof", "Phishing", True, "redirected_cse_spoof_host", f"1 + {out}"),
        ("NOT fetched AND redirect_changed", "Suspected", True, "redirected_lexical_suspected", f"1 + {out}"),
        ("NOT fetched AND parked", "Suspected", True, "parked_sale_lexical_suspected", out),
        ("NOT fetched AND network AND strict", "Suspected", True, "strict_lexical_fetch_evidence_unavailable_suspected", out),
        ("NOT fetched AND network", "Suspected", True, "lexical_gate_plus_network_corroboration", out),
        ("NOT fetched", "Legitimate", False, "invalid_fetch_state_without_direct_evidence", "0"),
        ("redirect_spoof", "Phishing", True, "redirected_cse_spoof_host", f"greatest({every}, 1)"),
        ("redirect_changed", "Suspected", True, "redirected_lexical_suspected", f"greatest({every}, 1)"),
        (f"strict AND {strong}", "Phishing", True, "strict_lexical_plus_direct_evidence", every),
        (weak, "Suspected", True, "lexical_gate_plus_weak_direct_evidence", every),
        ("parked", "Suspected", True, "parked_sale_lexical_suspected", every),
        ("network", "Suspected", True, "lexical_gate_plus_network_corroboration", every),
        ("true", "Legitimate", True, "lexical_without_any_corroboration_legitimate_review", every),
    ]
    case = lambda i: "CASE " + " ".join(f"WHEN {r[0]} THEN {i(r)}" for r in rules) + " END"
    return f"""SELECT *, {case(lambda r: f"'{r[1]}'")} AS classification, {case(lambda r: str(r[2]).lower())} AS emit, {case(lambda r: f"'{r[3]}'")} AS reason, CAST({case(lambda r: r[4])} AS INTEGER) AS corroboration FROM {source}"""


_SIGNALS = """
sig AS (SELECT o_orderkey AS id, o_orderkey % 3 = 0 AS a_on, o_orderkey % 5 <> 0 AS b_on, o_orderkey % 7 < 4 AS c_on,
  (o_orderkey % 101) / 100.0::DOUBLE AS a_sim, (o_orderkey % 89) / 88.0::DOUBLE AS b_sim, (o_orderkey % 53) / 52.0::DOUBLE AS c_sim, CAST(o_orderkey % 11 AS INTEGER) AS dist, o_totalprice, o_orderstatus, o_custkey FROM orders)"""


def _simhash(table: str, key: str) -> str:
    """(key, simhash) of a table's texts; null without words."""
    return f"(SELECT {key}, simhash FROM {table} LEFT JOIN {_word_simhash(table, key)} USING ({key}))"


def _word_simhash(table: str, key: str) -> str:
    nibble = "(strpos('0123456789abcdef', substr(h, b // 4 + 1, 1)) - 1)"
    return f"""(
  SELECT {key}, string_agg(format('{{:x}}', v), '' ORDER BY d) AS simhash FROM (
    SELECT {key}, b // 4 AS d, CAST(sum(CASE WHEN votes >= 0 THEN 1 << (3 - b % 4) ELSE 0 END) AS INTEGER) AS v FROM (
      SELECT {key}, b, sum(CASE WHEN ({nibble} >> (3 - b % 4)) & 1 = 1 THEN n ELSE -n END) AS votes
      FROM (SELECT {key}, sha256(w) AS h, count(*) AS n FROM (
              SELECT {key}, unnest(list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '')) AS w FROM {table}) GROUP BY {key}, w),
           (SELECT unnest(range(64)) AS b)
      GROUP BY {key}, b) GROUP BY {key}, b // 4) GROUP BY {key})"""


def _popcount(a: str, b: str) -> str:
    """Bits in which two strings of 16 hex digits differ."""
    return f"CAST(bit_count(xor(CAST('0x' || substr({a}, 1, 8) AS BIGINT), CAST('0x' || substr({b}, 1, 8) AS BIGINT))) + bit_count(xor(CAST('0x' || substr({a}, 9, 8) AS BIGINT), CAST('0x' || substr({b}, 9, 8) AS BIGINT))) AS INTEGER)"


_TOKENS = "list_distinct(list_filter(regexp_split_to_array(lower({0}), '[^a-z0-9]+'), lambda x: length(x) >= {1}))"

ORACLES = {
    "q_lexical_gate": _gate(_ENT, _HOSTS),
    "q_protected_gate": _gate(_ent(PROTECTED), f"hosts(host) AS ({_values([(h,) for h in JUDGED])})"),
    "q_lexical_candidates": f"""
WITH {_ENT}, {_HOSTS}, {_TOKENS_OF}, {_HITS}, {_SCORED},
r AS (SELECT *, max(CAST(rule_hit AS INTEGER)) OVER (PARTITION BY host) = 0 AS fallback, row_number() OVER (PARTITION BY host ORDER BY lexical_score DESC, idx DESC) AS k FROM s)
SELECT host, idx, round(lexical_score, 6) AS lexical_score, rule_hit, fallback FROM r WHERE rule_hit OR (fallback AND k <= 2)""",
    "q_brand_index": f"WITH {_ent(PROTECTED)}, {_TOKENS_OF} SELECT idx, token FROM tok",
    "q_jw_whitelist_topk": f"""
WITH {_ENT}, {_HOSTS}, {_TOKENS_OF}, p AS (SELECT host, idx, pos, domain, jaro_winkler_similarity(host, domain) AS raw FROM hosts, dom),
b AS (SELECT host, idx, CASE WHEN raw > 0 THEN domain ELSE '' END AS domain, round(raw, 6) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY host, idx ORDER BY raw DESC, pos) AS r FROM p) WHERE r = 1)
SELECT host, idx, domain, similarity, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY similarity DESC, idx) AS rank FROM b) WHERE rank <= 3""",
    "q_brand_token_hits": f"WITH {_ENT}, {_HOSTS}, {_TOKENS_OF}, {_HITS} SELECT host, idx, array_to_string(hits, '|') AS hits, len(hits) AS n_hits FROM hits",
    "q_token_band_join": f"""
WITH {_ENT}, {_TOKENS_OF}, w AS (SELECT DISTINCT unnest({_TOKENS.format("p_name", 3)}) AS word FROM part)
SELECT word, token, idx, round(jaro_winkler_similarity(word, token), 6) AS similarity FROM w, tok WHERE abs(length(word) - length(token)) <= 2""",
    "q_url_features": f"""
SELECT page_id, length(url) AS url_length, length({_HOST}) AS host_length, length({_PATH}) AS path_length,
  len(regexp_extract_all(url, '\\.')) AS n_dots, len(regexp_extract_all(url, '-')) AS n_hyphens, len(regexp_extract_all(url, '[0-9]')) AS n_digits, len(regexp_extract_all(url, '/')) AS n_slashes, len(regexp_extract_all(url, '[^A-Za-z0-9]')) AS n_special,
  regexp_matches(url, '00|11|22|33|44|55|66|77|88|99') AS repeated_digits, contains(url, '?') AS has_query, contains(url, '#') AS has_anchor, starts_with(url, 'https://') AS is_https,
  len(list_filter(string_split({_HOST}, '.'), lambda x: x <> '')) AS n_labels, round({_entropy("url")}, 6) AS entropy_url, round({_entropy(_HOST)}, 6) AS entropy_host
FROM pages""",
    "q_host_normalise": f"""
SELECT page_id, CASE WHEN starts_with(url, 'http://') OR starts_with(url, 'https://') THEN url ELSE 'https://' || url END AS normalized_url,
  string_split(regexp_replace(lower(trim(url)), '^https?://', ''), '/')[1] AS netloc, {_HOST} AS host,
  array_to_string(list_filter(regexp_split_to_array({_HOST}, '[^a-z0-9]+'), lambda x: x <> ''), '|') AS parts FROM pages""",
    "q_registrable_domain": f"""
WITH h AS (SELECT page_id, {_HOST} AS host FROM pages), r AS (SELECT page_id, {_registrable("host")} AS registrable FROM h)
SELECT page_id, registrable, string_split(registrable, '.')[1] AS label, substr(registrable, strpos(registrable, '.') + 1) AS suffix FROM r""",
    "q_url_dedupe_sources": f"""
WITH r AS (SELECT {_PATH} AS url, {_HOST} AS workbook, page_id AS pos FROM pages WHERE {_PATH} <> ''), f AS (SELECT url, workbook, min(pos) AS pos FROM r GROUP BY ALL)
SELECT url, string_agg(workbook, '|' ORDER BY pos) AS source_workbooks, count(*) AS n, min(pos) AS first_pos FROM f GROUP BY url""",
    "q_record_key": f"SELECT page_id, sha1(lower(trim(url)) || '|' || trim({_HOST})) AS record_key, sha256(url) AS digest FROM pages",
    "q_simhash64_docs": f"SELECT doc_id, simhash FROM {_simhash('documents', 'doc_id')}",
    "q_hamming_radius_pairs": f"""
WITH a AS {_simhash("documents", "doc_id")}, b AS {_simhash("benchmark", "item_id")},
p AS (SELECT doc_id, item_id, {_popcount("a.simhash", "b.simhash")} AS distance FROM a, b),
m AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY distance, item_id) AS k FROM p)
SELECT doc_id AS a, item_id AS b, distance, round(1 - distance / 64.0::DOUBLE, 6) AS similarity, distance <= 8 AS hit, distance <= 4 AS anchor FROM m WHERE k = 1""",
    "q_hash_bands_equijoin": f"""
WITH h AS {_simhash("documents", "doc_id")}, p AS (SELECT x.doc_id AS a, y.doc_id AS b, {_popcount("x.simhash", "y.simhash")} AS distance FROM h x, h y WHERE x.doc_id < y.doc_id)
SELECT a, b, distance, round(1 - distance / 64.0::DOUBLE, 6) AS similarity FROM p WHERE distance <= 3""",
    "q_hash_anchor_score": f"""
WITH {_SIGNALS}, s AS (SELECT *,
    CASE WHEN a_on THEN 30.0::DOUBLE ELSE 0 END + CASE WHEN b_on THEN 14 ELSE 0 END + CASE WHEN c_on THEN 10 ELSE 0 END AS w,
    CASE WHEN a_on THEN 30 * a_sim ELSE 0 END + CASE WHEN b_on THEN 14 * b_sim ELSE 0 END + CASE WHEN c_on THEN 10 * c_sim ELSE 0 END AS x FROM sig),
t AS (SELECT *, CASE WHEN w > 1e-8 THEN 100 * x / w ELSE 0 END AS score FROM s)
SELECT id, round(score, 4) AS score, (b_on AND dist <= 3) OR CAST(b_on AND dist <= 8 AS INTEGER) + CAST(c_on AND dist <= 6 AS INTEGER) >= 2 AS hash_anchor,
  CASE WHEN score >= 78 THEN 'High' WHEN score >= 68 THEN 'Medium' ELSE 'Low' END AS band, CASE WHEN a_on AND b_on THEN 'strong_evidence' ELSE 'weak_evidence' END AS tier FROM t""",
    "q_margin_second_best": """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS k FROM lineitem),
m AS (SELECT l_orderkey, max(l_extendedprice) FILTER (k = 1) AS best, coalesce(max(l_extendedprice) FILTER (k = 2), 0.0) AS second FROM r GROUP BY l_orderkey)
SELECT *, round(best - second, 6) AS margin FROM m""",
    "q_admission_paths": f"""
WITH {_SIGNALS}, p AS (SELECT *, a_on OR c_on AS survivor, a_sim * 100 >= 68 AS t, dist <= 1 AS h, id % 4 = 0 AS w, id % 6 = 0 AS n, id % 9 = 0 AS k FROM sig),
q AS (SELECT *, list_filter([CASE WHEN t THEN 'score_threshold' END, CASE WHEN h THEN 'hash_bypass_hit' END, CASE WHEN survivor AND w THEN 'weak_direct_evidence' END, CASE WHEN survivor AND n THEN 'network_corroboration' END, CASE WHEN survivor AND k THEN 'parked_sale_signal' END], lambda x: x IS NOT NULL) AS paths FROM p)
SELECT id, len(paths) > 0 AS admitted, len(paths) = 0 AND survivor AS review_only, array_to_string(paths, '|') AS admission_reason,
  CASE WHEN len(paths) = 0 AND survivor AND a_on THEN 'strict_lexical_below_holdout_threshold' WHEN len(paths) = 0 AND survivor THEN 'lexical_score_pass_below_holdout_threshold' ELSE '' END AS review_reason FROM q""",
    "q_classify_holdout": f"""
WITH {_SIGNALS}, i AS (SELECT id, o_custkey, id % 2 = 0 AS fallback_only, id % 3 = 0 AS strict, id % 5 < 3 AS score_pass, o_orderstatus <> 'P' AS fetched, id % 17 = 0 AS redirect_spoof, id % 13 = 0 AS redirect_changed, id % 7 = 0 AS parked, id % 4 = 1 AS network,
  id % 11 = 0 AS hash_anchor, id % 19 = 0 AS tvc_strong, id % 23 = 0 AS content_spoof, id % 29 = 0 AS weak_tvc, id % 31 = 0 AS brand_evidence, id % 37 = 0 AS keyword_hit, id % 6 = 5 AS weak_signal, o_totalprice / 5000 AS score FROM sig),
k AS (SELECT * FROM i WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'HOUSEHOLD')) AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) AND (score >= 25 OR strict OR hash_anchor)),
d AS ({_decide("k")})
SELECT id, classification, reason, corroboration FROM d WHERE emit AND classification IN ('Phishing', 'Suspected')""",
    "q_decision_truth_table": f"""
WITH b AS (SELECT range AS id, {", ".join(f"(range >> {i}) % 2 = 1 AS {n}" for i, n in enumerate(INPUTS))} FROM range({1 << len(INPUTS)})), d AS ({_decide("b")})
SELECT classification, emit, reason, corroboration, count(*) AS n, CAST(sum(id) AS BIGINT) AS checksum FROM d GROUP BY ALL""",
    "q_network_corroboration": """
WITH j AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 3 = 0 THEN 'NA' WHEN s_suppkey % 3 = 1 THEN ' ' ELSE s_name END AS isp, CASE WHEN s_suppkey % 5 < 3 THEN NULL ELSE n_name END AS country FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)
SELECT k AS s_suppkey, (trim(isp) <> '' AND upper(trim(isp)) <> 'NA') OR coalesce(trim(country) <> '' AND upper(trim(country)) <> 'NA', false) OR k % 7 IN (0, 1) OR k % 11 = 0 OR k % 13 = 0 AS corroborated,
  trim(isp) <> '' AND upper(trim(isp)) <> 'NA' AS has_isp FROM j""",
    "q_parked_rules": """
SELECT doc_id, CASE WHEN contains(source, 'src19') THEN 'Nineteen' WHEN contains(lower(text), 'license') THEN 'License' WHEN contains(lower(text), 'public') THEN 'Public' ELSE '' END AS provider,
  CASE WHEN contains(source, 'src19') THEN 'provider_hosted_parking_redirect' WHEN contains(lower(text), 'license') OR contains(lower(text), 'public') THEN 'provider_branded_parking_template'
       WHEN contains(lower(text), 'work is licensed') OR contains(lower(text), 'this domain is for sale') THEN 'parking_or_sale_keywords' ELSE '' END AS reason FROM documents""",
    "q_redirect_promotion": f"""
WITH p AS (SELECT page_id, {_HOST} AS host FROM pages), j AS (SELECT a.page_id, a.host, b.host AS final_host FROM p a JOIN p b ON b.page_id - 1 = a.page_id),
k AS (SELECT *, final_host <> '' AND final_host <> host AND ({_registrable("final_host")} <> {_registrable("host")} OR (ends_with(final_host, '.' || host) AND len(string_split(final_host, '.')) - len(string_split(host, '.')) >= 2)) AS promoted FROM j)
SELECT page_id, host, final_host, promoted, CASE WHEN promoted THEN final_host ELSE host END AS effective_host, true AS deceptive FROM k""",
    "q_tvc_catalog_match": f"""
WITH w AS (SELECT doc_id AS id, unnest({_TOKENS.format("text", 2)}) AS alias FROM documents), b(alias, canonical) AS ({_values(BRANDS)}),
p AS (SELECT id, canonical, count(DISTINCT alias) AS n_hits, max(length(alias)) AS longest FROM w JOIN b USING (alias) GROUP BY ALL)
SELECT id, canonical, n_hits, longest FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n_hits DESC, longest DESC, canonical) AS r FROM p) WHERE r = 1""",
    "q_suffix_catalog": f"""
WITH {_ENT}, h AS (SELECT page_id, {_HOST} AS host FROM pages), m AS (SELECT h.*, domain, entity, row_number() OVER (PARTITION BY page_id ORDER BY length(domain) DESC NULLS LAST, domain DESC) AS k FROM h LEFT JOIN (SELECT unnest(domains) AS domain, entity FROM ent) ON host = domain OR ends_with(host, '.' || domain))
SELECT page_id, host, domain AS brand_domain, entity FROM m WHERE k = 1""",
    "q_keyword_overlap": f"""
WITH w AS (SELECT doc_id, unnest({_TOKENS.format("text", 4)}) AS w FROM documents), k AS (SELECT DISTINCT unnest({_TOKENS.format("text", 4)}) AS w FROM benchmark)
SELECT doc_id, count(*) AS overlap, least(count(*) / 5.0::DOUBLE, 1.0) AS keyword_score FROM w JOIN k USING (w) GROUP BY doc_id""",
    "q_sector_mapping": "SELECT p_partkey, CASE " + " ".join(f"WHEN contains(lower(p_type || ' ' || p_name), '{t}') THEN '{s}'" for t, s in SECTORS) + " ELSE 'Other' END AS sector FROM part",
    "q_geoip_range_join": f"""
WITH g(low, high, asn, country) AS ({_values(GEO)}), r AS (SELECT event_id, user_id * 1009 + event_id % 97 AS ip FROM events)
SELECT event_id, ip, asn, country FROM r LEFT JOIN g ON ip BETWEEN low AND high""",
    "q_rdap_json_parse": "SELECT event_id, event_type AS registrar, CAST(props->>'$.k' AS BIGINT) AS n FROM events",
    "q_forward_fill": "SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase FROM events",
    "q_latest_state_merge": """
SELECT user_id, arg_max(event_type, event_id) FILTER (event_type <> 'view') AS stage, arg_max(value, event_id) FILTER (value > 10) AS value,
  CAST(max(CAST(event_type = 'error' AS INTEGER)) AS INTEGER) AS timeout_hit, max(event_id) AS last_updated FROM events GROUP BY user_id""",
    "q_event_dedupe_keep_last": "SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id, event_type",
    "q_dedupe_keep_first": """
SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey, l_linenumber) AS k FROM lineitem) WHERE k = 1""",
    "q_run_summary_grouping_sets": "SELECT o_orderstatus, o_orderpriority, count(*) AS n, CAST(grouping(o_orderstatus, o_orderpriority) AS BIGINT) AS level FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())",
    "q_funnel_counts": """
SELECT count(*) AS n_all, count(l.doc_id) AS n_labelled, count(*) FILTER (quality = 1) AS n_good, count(*) FILTER (quality = 1 AND toxic = 0) AS n_kept, count(*) FILTER (quality = 1 AND toxic = 0 AND lang = 'en') AS n_kept_en
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "q_rank_iterations": """
WITH p AS (SELECT s_nationkey, count(*) AS n, round(sum(s_acctbal), 2) AS bal, count(*) FILTER (s_acctbal < 0) AS debtors FROM supplier GROUP BY s_nationkey)
SELECT *, row_number() OVER (ORDER BY n DESC, debtors, bal DESC, s_nationkey) AS rank FROM p""",
    "q_pipe_list_explode": "WITH b AS (SELECT doc_id, unnest(list_distinct([source, lang])) AS book FROM documents) SELECT book, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM b GROUP BY book",
    "q_debug_left_overlay": """
WITH l AS (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS price, max(l_linestatus) AS status FROM lineitem GROUP BY 1)
SELECT o_orderkey, coalesce(l.price, o_totalprice) AS price, coalesce(l.status, o_orderstatus) AS status FROM orders LEFT JOIN l ON o_orderkey = l_orderkey""",
    "q_metric_window_5s": """
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total, max(value) AS greatest, arg_max(value, ts) AS gauge FROM events GROUP BY 1, 2""",
    "q_latency_ring_256": """
SELECT event_id, count(c) OVER w AS ring_n, avg(c) OVER w AS ring_avg, max(c) OVER w AS ring_max FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS c FROM events) WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 255 PRECEDING AND CURRENT ROW)""",
    "q_pressure_streaks": """
WITH g AS (SELECT *, event_type IN ('error', 'view') AS p, sum(CASE WHEN event_type IN ('error', 'view') THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM events)
SELECT event_id, CAST(sum(CAST(p AS INTEGER)) OVER (PARTITION BY user_id, g ORDER BY event_id) AS BIGINT) AS streak FROM g""",
    "q_stall_gaps": """
WITH g AS (SELECT user_id, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts))) / 1000000.0::DOUBLE AS gap FROM events)
SELECT user_id, count(*) FILTER (gap >= 10800) AS warnings, count(*) FILTER (gap >= 43200) AS stalls, round(max(gap), 3) AS longest FROM g GROUP BY user_id""",
    "q_stall_sessions": """
WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS s FROM events),
i AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM g)
SELECT user_id, count(*) AS n, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_ts FROM i GROUP BY user_id, sid""",
    "q_retention_newest_k": "SELECT o_custkey, o_orderkey, age_rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS age_rank FROM orders) WHERE age_rank <= 3",
    "q_set_ops": """
WITH c AS (SELECT c_custkey AS k FROM customer), o AS (SELECT o_custkey AS k FROM orders), rich AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 5000)
SELECT 'union' AS op, count(*) AS n, CAST(coalesce(sum(k), 0) AS BIGINT) AS total FROM (SELECT k FROM c UNION SELECT k FROM o)
UNION ALL SELECT 'intersect', count(*), CAST(coalesce(sum(k), 0) AS BIGINT) FROM (SELECT k FROM rich INTERSECT SELECT k FROM o)
UNION ALL SELECT 'except', count(*), CAST(coalesce(sum(k), 0) AS BIGINT) FROM (SELECT k FROM c EXCEPT ALL SELECT DISTINCT k FROM o)
UNION ALL SELECT 'union_all', count(*), CAST(coalesce(sum(k), 0) AS BIGINT) FROM (SELECT k FROM c UNION ALL SELECT k FROM o)""",
    "q_feature_matrix": """
WITH p AS (SELECT p_partkey, p_type, CASE WHEN p_partkey % 7 <> 0 THEN p_size END AS size, p_retailprice AS price FROM part), m AS (SELECT median(size) AS ms, avg(price) AS a, stddev_pop(price) AS s FROM p)
SELECT p_partkey, coalesce(CAST(size AS DOUBLE), ms) AS size, round((price - a) / s, 5) AS price, CAST(p_type = 'ECONOMY' AS INTEGER) AS p_type_economy, CAST(p_type = 'PROMO' AS INTEGER) AS p_type_promo, CAST(p_type = 'LARGE' AS INTEGER) AS p_type_large FROM p, m""",
    "q_class_frequencies": """
WITH c AS (SELECT p_brand, count(*) AS class_n FROM part GROUP BY p_brand HAVING count(*) >= 5), d AS (SELECT *, dense_rank() OVER (ORDER BY p_brand) - 1 AS class_id FROM c)
SELECT p_partkey, p_brand, class_n, class_id FROM part JOIN d USING (p_brand)""",
    "q_topk_cosine_entities": """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS (SELECT a.vec_id AS id, b.vec_id AS ref, round(list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))), 6) AS cosine FROM e a, e b WHERE a.vec_id % 100 = 0)
SELECT id, ref, cosine, rank FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY cosine DESC, ref) AS rank FROM s) WHERE rank <= 3""",
    "q_stream_events_watermark": "SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    "q_stream_dedupe": "SELECT DISTINCT event_id, user_id, event_type FROM events",
    "q_stream_watchdog": """
WITH g AS (SELECT event_type AS kind, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY event_type ORDER BY ts))) / 1000000.0::DOUBLE AS gap FROM events)
SELECT kind, count(*) FILTER (gap >= 3600) AS warnings, count(*) FILTER (gap >= 14400) AS stalls FROM g GROUP BY kind""",
    "q_html_signals": r"""
WITH b AS (SELECT page_id, html, regexp_replace(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g') AS x FROM pages),
t AS (SELECT page_id, html, trim(regexp_replace(replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', ' '), '&amp;', '&'), '[ \t\n\r\f\x0B]+', ' ', 'g')) AS body FROM b)
SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>([^<]*)</title>', 1)) AS title, length(body) AS text_length, md5(body) AS text_md5, len(regexp_extract_all(html, '<p[ >]')) AS n_paragraphs, len(regexp_extract_all(html, '<a ')) AS n_links FROM t""",
    "q_infra_seed": "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment WHEN c_custkey % 5 = 0 THEN c_name ELSE 'NA' END AS seed FROM customer",
    "q_lookup_fanout": f"""
WITH p AS (SELECT page_id, {_HOST} AS host FROM pages), a AS (SELECT host, min(page_id) AS ip FROM p WHERE page_id % 3 = 0 GROUP BY host)
SELECT page_id, host, coalesce(ip, -1) AS ip, CASE WHEN ip IS NULL THEN 'no_records' ELSE 'resolved' END AS status FROM p LEFT JOIN a USING (host)""",
    "q_resume_remaining": """
WITH k AS (SELECT page_id, sha1(lower(trim(url)) || '|book') AS record_key FROM pages) SELECT record_key, page_id FROM k WHERE record_key NOT IN (SELECT record_key FROM k WHERE page_id % 2 = 0)""",
    "q_live_workers": "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id HAVING arg_max(event_type, event_id) <> 'error'",
    "q_parity_check": """
WITH l AS (SELECT * FROM orders WHERE o_orderkey % 10 <> 0), r AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS s, CASE WHEN o_orderkey % 13 <> 0 THEN o_custkey END AS c FROM orders WHERE o_orderkey % 11 <> 0),
j AS (SELECT coalesce(o_orderkey, k) AS o_orderkey, CASE WHEN k IS NULL THEN 'left_only' WHEN o_orderkey IS NULL THEN 'right_only'
  ELSE array_to_string(list_filter([CASE WHEN o_orderstatus IS DISTINCT FROM s THEN 'o_orderstatus' END, CASE WHEN o_custkey IS DISTINCT FROM c THEN 'o_custkey' END], lambda x: x IS NOT NULL), '|') END AS problem FROM l FULL JOIN r ON o_orderkey = k)
SELECT * FROM j WHERE problem <> ''""",
    "q_filled_catalogue": "SELECT n_nationkey, n_name, last_value(CASE WHEN n_nationkey % 4 = 0 THEN CAST(n_regionkey AS VARCHAR) END IGNORE NULLS) OVER (ORDER BY n_nationkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS region FROM nation",
    "q_whitelist_first_match": "SELECT id, n_nationkey, n_name FROM (SELECT p_partkey AS id, n_nationkey, n_name, row_number() OVER (PARTITION BY p_partkey ORDER BY n_nationkey) AS r FROM part, nation WHERE (p_size + n_nationkey) % 7 = 0) WHERE r = 1",
}


def _lit(x) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, list):
        return "[" + ", ".join(_lit(y) for y in x) + "]" + ("::VARCHAR[]" if not x else "")
    if isinstance(x, tuple):
        return f"{{'key': {_lit(x[0])}, 'value': {_lit(x[1])}}}"
    return str(x) if isinstance(x, int | float) else "'" + x.replace("'", "''") + "'"


def _cases(rows, columns: str) -> str:
    return f"c(k, {columns}) AS (VALUES " + ", ".join(f"({i}, {', '.join(_lit(x) for x in r)})" for i, r in enumerate(rows)) + ")"


def _pairs(rows) -> str:
    return "CAST([" + ", ".join(_lit(r) for r in rows) + "] AS STRUCT(key VARCHAR, value VARCHAR)[])"


def _any(text: str, markers) -> str:
    return "(" + " OR ".join(f"contains({text}, {_lit(m)})" for m in markers) + ")"


def _hash_bits(x: str) -> str:
    """16 hex digits of a hash as it comes; null if it isn't one."""
    clean = f"regexp_replace(lower(trim({x})), '^0x', '')"
    return f"CASE WHEN regexp_matches({clean}, '^[0-9a-f]{{1,16}}$') THEN lpad({clean}, 16, '0') END"


def _simhash_of(source: str, key: str, grams: str) -> str:
    """Like _simhash(), of a list of features."""
    nibble = "(strpos('0123456789abcdef', substr(h, b // 4 + 1, 1)) - 1)"
    return f"""(
  SELECT {key}, string_agg(format('{{:x}}', v), '' ORDER BY d) AS simhash FROM (
    SELECT {key}, b // 4 AS d, CAST(sum(CASE WHEN votes >= 0 THEN 1 << (3 - b % 4) ELSE 0 END) AS INTEGER) AS v FROM (
      SELECT {key}, b, sum(CASE WHEN ({nibble} >> (3 - b % 4)) & 1 = 1 THEN 1 ELSE -1 END) AS votes
      FROM (SELECT {key}, sha256(unnest({grams})) AS h FROM {source}), (SELECT unnest(range(64)) AS b) GROUP BY {key}, b) GROUP BY {key}, b // 4) GROUP BY {key})"""


_TICKS = "ticks AS (SELECT event_type, event_id, event_id % 9 + 1 AS processed, event_id % 5 AS failed, event_id % 4 AS timed_out, event_id % 50 AS backlog FROM events)"
_BLANK = "trim(coalesce(CAST({0} AS VARCHAR), ''))"
_PUBLIC = "(trim(coalesce({0}, '')) <> '' AND NOT regexp_matches(trim({0}), '(?i)^(about|javascript|data|file|blob|chrome|edge):'))"


def _host(x: str) -> str:
    return _HOST.replace("trim(url)", f"trim({x})")


_FAIL_TEXT = "lower(name || ': ' || detail)"
_TARGETS = f"""
p AS (SELECT page_id, url, {_HOST} AS host FROM pages),
j AS (SELECT a.page_id, a.url, b.url AS next, a.host FROM p a JOIN p b ON b.page_id - 1 = a.page_id),
l AS (SELECT *, CASE WHEN page_id % 5 = 0 THEN 'about:blank' WHEN page_id % 5 = 1 THEN 'https://a.b.' || host || '/x' WHEN page_id % 5 = 2 THEN url ELSE next END AS landing, page_id % 3 = 0 AS trick FROM j),
m AS (SELECT *, url AS original_url, CASE WHEN {_PUBLIC.format("landing")} THEN trim(landing) ELSE '' END AS there FROM l),
n AS (SELECT *, {_host("original_url")} AS original_host, CASE WHEN there = '' THEN '' ELSE {_host("there")} END AS final_host FROM m),
o AS (SELECT *, final_host <> '' AND final_host <> original_host AND ({_registrable("final_host")} <> {_registrable("original_host")} OR trick OR (ends_with(final_host, '.' || original_host) AND len(string_split(final_host, '.')) - len(string_split(original_host, '.')) >= 2)) AS redirect_promoted FROM n),
target AS (SELECT *, redirect_promoted AND trick AS redirect_spoof, CASE WHEN redirect_promoted OR original_url = '' THEN there ELSE original_url END AS effective_url, CASE WHEN redirect_promoted OR original_host = '' THEN final_host ELSE original_host END AS effective_host FROM o)"""
_INPUTS = f"""{_SIGNALS}, i AS (SELECT id, o_custkey, id % 2 = 0 AS fallback_only, id % 3 = 0 AS strict, id % 5 < 3 AS score_pass, o_orderstatus <> 'P' AS fetched, id % 17 = 0 AS redirect_spoof, id % 13 = 0 AS redirect_changed, id % 7 = 0 AS parked, id % 4 = 1 AS network,
  id % 11 = 0 AS hash_anchor, id % 19 = 0 AS tvc_strong, id % 23 = 0 AS content_spoof, id % 29 = 0 AS weak_tvc, id % 31 = 0 AS brand_evidence, id % 37 = 0 AS keyword_hit, id % 6 = 5 AS weak_signal FROM sig)"""


def _norm(x: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9]+', ' ', 'g'))"


def _plain(x: str) -> str:
    bare = f"regexp_replace({x}, '(?s)<[^>]*>', ' ', 'g')"
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&")):
        bare = f"replace({bare}, '{name}', '{char}')"
    return bare


def _named(x: str) -> str:
    """Words of a text that could name a brand, in order."""
    return f"list_distinct(list_filter(regexp_split_to_array(lower({x}), '[^a-z0-9]+'), lambda x: length(x) > 2 AND x NOT IN {tuple(sorted({*SERVICES, *DOMAIN_PARTS}))}))"


def _urlstruct() -> str:
    full, place = "f", "regexp_extract(f, '^https?://([^/?#]*)', 1)"
    count = lambda x, pattern: f"len(regexp_extract_all({x}, '{pattern}'))"
    twice = "'00|11|22|33|44|55|66|77|88|99'"
    whole = {
        "url_length": f"length({full})", "num_dots": count(full, r"\."), "has_repeated_digits": f"regexp_matches({full}, {twice})", "num_special_chars": count(full, "[^a-zA-Z0-9]"), "num_hyphens": count(full, "-"), "num_slashes": count(full, "/"), "num_underscores": count(full, "_"),
        "num_question_marks": count(full, r"\?"), "num_equal_signs": count(full, "="), "num_dollar_signs": count(full, r"\$"), "num_exclamations": count(full, "!"), "num_hashtags": count(full, "#"), "num_percent": count(full, "%"),
        "domain_length": f"length({place})", "num_hyphens_domain": count(place, "-"), "has_special_chars_domain": f"regexp_matches({place}, '[^a-zA-Z0-9.-]')", "num_special_chars_domain": count(place, "[^a-zA-Z0-9.-]"),
        "num_subdomains": "len(parts)", "avg_subdomain_length": "CASE WHEN len(parts) > 0 THEN round(list_avg(list_transform(parts, lambda x: length(x))), 6) ELSE 0.0 END", "subdomain_length": "length(front)", "subdomain_has_hyphen": "contains(front, '-')", "subdomain_has_repeated_digits": f"regexp_matches(front, {twice})",
        "path_length": "length(regexp_extract(f, '^https?://[^/?#]*([^?#]*)', 1))", "has_query": r"regexp_extract(f, '^[^?#]*\?([^#]*)', 1) <> ''", "has_fragment": "regexp_extract(f, '#(.*)$', 1) <> ''", "has_anchor": "contains(u, '#')",
        "entropy_url": f"round({_entropy('u')}, 6)", "entropy_domain": f"round({_entropy(place)}, 6)",
    }
    zero = lambda n: "false" if "has_" in n else "0.0" if n.startswith(("avg", "entropy")) else "0"
    cols = ", ".join(f"CASE WHEN ok THEN {c} ELSE {zero(n)} END AS {n}" for n, c in whole.items())
    return f"""
WITH p AS (SELECT page_id, CASE WHEN page_id % 7 = 0 THEN url || repeat('x', 2100) WHEN page_id % 11 = 0 THEN ' ' WHEN page_id % 2 = 0 THEN url || '/a_b-c?q=1&r=%20#top!' ELSE regexp_replace(url, '^https?://', '') END AS u FROM pages),
f AS (SELECT *, CASE WHEN regexp_matches(trim(u), '^https?://') THEN trim(u) ELSE 'https://' || trim(u) END AS f FROM p),
h AS (SELECT *, {_host("f")} AS host FROM f),
g AS (SELECT *, trim(u) <> '' AND length(trim(u)) <= 2048 AND host <> '' AS ok, regexp_replace(substr(host, 1, length(host) - length({_registrable("host")})), '\\.$', '') AS front FROM h),
x AS (SELECT *, list_filter(string_split(front, '.'), lambda y: y <> '') AS parts FROM g)
SELECT page_id, {cols} FROM x"""


ORACLES |= {
    "q_failure_classes": f"""
WITH {_cases(FAILED, "name, message")},
t AS (SELECT *, list_filter(list_transform(regexp_split_to_array(CASE WHEN contains(trim(message), chr(10) || 'Browser logs:') THEN rtrim(string_split(trim(message), chr(10) || 'Browser logs:')[1]) ELSE trim(message) END, '\\r\\n|\\r|\\n'), lambda x: trim(x)), lambda x: x <> '') AS lines FROM c),
u AS (SELECT *, coalesce(list_position(lines, 'Call log:'), 0) AS log_at FROM t),
f AS (SELECT *, CASE WHEN len(lines) = 0 THEN name ELSE lines[1] || CASE WHEN log_at > 0 AND len(lines) > log_at THEN ' | Call log: ' || array_to_string(lines[log_at + 1 : log_at + 3], ' | ') ELSE '' END END AS detail, lower(name || ': ' || message) AS raw FROM u),
e AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'navigation' ELSE 'content' END AS stage, event_id % 6 AS i, f.* FROM events JOIN f ON event_id % {len(FAILED)} = k)
SELECT event_id, CASE WHEN contains({_FAIL_TEXT}, 'timeout') THEN stage || '_timeout' WHEN {_any(_FAIL_TEXT, BROWSER_GONE)} THEN stage || '_transient_browser_error' WHEN {_any(_FAIL_TEXT, TLS_BROKEN)} THEN 'ssl_error' WHEN contains({_FAIL_TEXT}, 'net::err_connection_reset') THEN 'connection_reset' ELSE stage || '_error' END AS kind, detail,
  CASE WHEN contains({_FAIL_TEXT}, 'timeout') THEN stage = 'navigation' WHEN {_any(_FAIL_TEXT, BROWSER_GONE)} THEN true WHEN {_any(_FAIL_TEXT, TLS_BROKEN)} THEN false ELSE contains({_FAIL_TEXT}, 'net::err_connection_reset') END AS fetch_retryable,
  CASE WHEN {_any("raw", NO_SUCH_NAME)} THEN 'nxdomain' WHEN {_any("raw", ("noanswer", "no answer"))} THEN 'no_answer' WHEN {_any("raw", ("timeout", "lifetime"))} THEN 'timeout' ELSE 'error' END AS lookup,
  {_any("raw", TRANSIENT)} AS retryable, contains(raw, 'timeout') AS timeout, least(8.0::DOUBLE, 0.5::DOUBLE * pow(2, i)) AS wait FROM e""",
    "q_certificate_days": """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'not a date' WHEN o_orderkey % 11 <> 0 THEN strftime(o_orderdate, '%b %-d %H:%M:%S %Y GMT') END AS u FROM orders),
p AS (SELECT *, try_strptime(regexp_replace(u, ' [A-Z]+$', ''), '%b %d %H:%M:%S %Y') AS until, TIMESTAMP '1997-01-01 12:00:00' AS now FROM o)
SELECT o_orderkey, CAST(u IS NOT NULL AS INTEGER) AS present, CASE WHEN until IS NOT NULL AND now <= until THEN 1 ELSE 0 END AS valid,
  CASE WHEN until IS NULL THEN -1 ELSE CAST(greatest(0, floor((epoch_us(until) - epoch_us(now)) / 86400000000.0::DOUBLE)) AS INTEGER) END AS days_to_expiry, CASE WHEN u IS NOT NULL THEN 'Issuer Inc' END AS issuer FROM p""",
    "q_registration_fields": f"""
WITH {_cases([(x,) for x in REGISTRATIONS], "doc")}, d AS (SELECT k, CASE WHEN json_valid(doc) THEN doc::JSON ELSE '{{}}'::JSON END AS doc FROM c),
e AS (SELECT k, i, json_extract(doc, '$.entities[' || i || ']') AS e FROM d, range(0, 20) r(i) WHERE i < coalesce(json_array_length(doc, '$.entities'), 0)),
n AS (SELECT k, i, i AS outer_i, -1 AS inner_i, e FROM e UNION ALL SELECT k, i, i, j, json_extract(e, '$.entities[' || j || ']') FROM e, range(0, 20) r(j) WHERE j < coalesce(json_array_length(e, '$.entities'), 0)),
f AS (SELECT *, coalesce(contains(json_extract(e, '$.roles')::VARCHAR, '"registrar"'), false) AS is_registrar, coalesce(contains(json_extract(e, '$.roles')::VARCHAR, '"registrant"'), false) AS is_registrant,
  list_filter(from_json(coalesce(json_extract(e, '$.vcardArray[1]'), '[]'::JSON), '["JSON"]'), lambda x: json_extract_string(x, '$[0]') = 'fn')[1] AS fn_item, list_filter(from_json(coalesce(json_extract(e, '$.vcardArray[1]'), '[]'::JSON), '["JSON"]'), lambda x: json_extract_string(x, '$[0]') = 'adr')[1] AS adr_item FROM n),
v AS (SELECT *, json_extract_string(fn_item, '$[3]') AS fn, CASE json_type(adr_item, '$[3]') WHEN 'OBJECT' THEN json_extract_string(adr_item, '$[3]."country-name"') WHEN 'ARRAY' THEN nullif(json_extract_string(adr_item, '$[3][6]'), '') END AS country FROM f),
r AS (SELECT k, arg_max(fn, outer_i) FILTER (is_registrar AND inner_i = -1 AND fn IS NOT NULL) AS registrar, arg_max(fn, outer_i * 100 + inner_i + 1) FILTER (is_registrant AND fn IS NOT NULL) AS registrant, arg_max(country, outer_i) FILTER (is_registrant AND inner_i = -1 AND country IS NOT NULL) AS country FROM v GROUP BY k),
g AS (SELECT k, list_filter(from_json(coalesce(json_extract(doc, '$.events'), '[]'::JSON), '["JSON"]'), lambda x: json_extract_string(x, '$.eventAction') = 'registration')[1] AS reg, list_filter(from_json(coalesce(json_extract(doc, '$.events'), '[]'::JSON), '["JSON"]'), lambda x: json_extract_string(x, '$.eventAction') = 'expiration')[1] AS exp,
  array_to_string(list_filter(list_transform(from_json(coalesce(json_extract(doc, '$.nameservers'), '[]'::JSON), '["JSON"]'), lambda x: json_extract_string(x, '$.ldhName')), lambda x: x <> ''), ';') AS servers FROM d)
SELECT s_suppkey, coalesce(registrar, 'NA') AS registrar, coalesce(registrant, 'NA') AS registrant, coalesce(country, 'NA') AS country, coalesce(json_extract_string(reg, '$.eventDate'), 'NA') AS registered, coalesce(json_extract_string(exp, '$.eventDate'), 'NA') AS expires, coalesce(nullif(servers, ''), 'NA') AS name_servers
FROM supplier JOIN g ON s_suppkey % {len(REGISTRATIONS)} = g.k LEFT JOIN r ON r.k = g.k""",
    "q_adaptive_limits": f"""
WITH {_TICKS}, p AS (SELECT *, sum(processed) OVER (PARTITION BY event_type ORDER BY event_id) AS total FROM ticks),
r AS (SELECT event_type, list({{l: 400, run: CAST(backlog <= 40 AND total >= 500 AND (timed_out / processed >= 0.35 OR (failed + timed_out) / processed >= 0.70) AS INTEGER), down: 0}} ORDER BY event_id) AS t FROM p GROUP BY event_type),
q AS (SELECT event_type, list_reduce(list_prepend({{l: 400, run: 0, down: 0}}, t), lambda s, x: CASE WHEN x.run = 1 AND s.run + 1 >= 2 AND s.l > 50 THEN {{l: greatest(50, s.l - 4), run: 0, down: s.down + 1}}
  ELSE {{l: s.l, run: CASE WHEN x.run = 1 THEN s.run + 1 ELSE 0 END, down: s.down}} END) AS z FROM r)
SELECT event_type, z.l AS next_limit, z.down AS downshifts FROM q""",
    "q_fetch_limits": f"""
WITH {_TICKS}, p AS (SELECT event_type, event_id, processed, CASE WHEN event_id % 3 = 0 THEN failed ELSE 0 END AS f, CASE WHEN event_id % 4 = 0 THEN timed_out + 2 ELSE 0 END AS t, (event_id % 10) / 12.0::DOUBLE AS q, (event_id % 7) / 10.0::DOUBLE AS files FROM ticks),
r AS (SELECT event_type, list({{l: 0, p: CAST(t / processed >= 0.35 OR (f + t) / processed >= 0.70 OR q >= 0.75 OR files >= 0.70 AS INTEGER), h: CAST(t / processed < 0.20 AND (f + t) / processed < 0.30 AND q < 0.40 AND files < 0.70 AS INTEGER), d: 0, u: 0}} ORDER BY event_id) AS t FROM p GROUP BY event_type),
z AS (SELECT event_type, list_reduce(list_prepend({{l: 64, p: 0, h: 0, d: 0, u: 0}}, t), lambda s, x: CASE
    WHEN x.p = 1 AND s.p + 1 >= 2 AND s.l > 8 THEN {{l: greatest(8, s.l - 8), p: 0, h: 0, d: s.d + 1, u: s.u}}
    WHEN x.p = 1 THEN {{l: s.l, p: s.p + 1, h: 0, d: s.d, u: s.u}}
    WHEN x.h = 1 AND s.h + 1 >= 2 AND s.l < 96 THEN {{l: least(96, s.l + 8), p: 0, h: 0, d: s.d, u: s.u + 1}}
    ELSE {{l: s.l, p: 0, h: CASE WHEN x.h = 1 THEN s.h + 1 ELSE 0 END, d: s.d, u: s.u}} END) AS z FROM r)
SELECT event_type, z.l AS "limit", z.p AS pressed, z.h AS healthy, z.d AS downs, z.u AS ups FROM z""",
    "q_stage_limits": """
WITH e AS (SELECT event_id, event_id % 300 AS raw, (event_id % 11) / 10.0::DOUBLE AS cpu, (event_id % 8) / 10.0::DOUBLE AS ingress, event_id % 40 AS depth, event_id % 13 AS rate, (event_id % 9) / 20.0::DOUBLE AS late FROM events),
f AS (SELECT *, greatest(8, least(256, raw)) AS now, depth / greatest(rate, 1.0::DOUBLE) AS backlog FROM e),
g AS (SELECT *, greatest(8, CAST(ceil(now * 0.5) AS INTEGER)) AS half, greatest(8, now - greatest(32, now // 4)) AS low, backlog > 2 OR cpu > 0.6 OR late >= 0.35 AS pressed, backlog < 1 AND ingress < 0.5 AND late < 0.2 AND now < 256 AS room FROM f)
SELECT event_id, CASE WHEN cpu >= 0.8 THEN CASE WHEN half < now THEN 'hard_clamp' ELSE 'hold' END WHEN pressed THEN CASE WHEN low < now THEN 'downshift' ELSE 'hold' END WHEN room THEN 'upshift' ELSE 'hold' END AS action,
  CAST(CASE WHEN cpu >= 0.8 THEN half WHEN pressed THEN low WHEN room THEN least(256, now + 32) ELSE now END AS INTEGER) AS next_limit,
  CAST(CASE WHEN event_id % 17 = 0 OR (backlog <= 0.5 AND ingress < 0.25 AND cpu < 0.25) THEN greatest(1, raw) WHEN backlog <= 1 AND ingress < 0.5 AND cpu < 0.5 THEN least(greatest(1, raw), greatest(least(greatest(1, raw), 12), 16)) ELSE least(greatest(1, raw), 12) END AS INTEGER) AS cap,
  round(greatest(depth / 40.0::DOUBLE, CAST(event_id % 30 AS DOUBLE)), 6) AS pressure FROM g""",
    "q_in_flight": """
WITH e AS (SELECT event_type, event_id, CAST(event_id % 8 AS DOUBLE) AS free, (event_id % 5) * 2.0::DOUBLE AS used, (event_id % 6) * 45.0::DOUBLE AS lag, event_id % 30 * 800 AS pending, event_id % 12 AS queue, event_id % 4 AS tasks, event_id % 3 AS done FROM events),
f AS (SELECT *, CASE WHEN free + used > 0 THEN used / (free + used) ELSE 0 END AS load FROM e),
g AS (SELECT *, list_filter([CASE WHEN free < 1 THEN 'cpu_headroom_low' END, CASE WHEN free < 2 AND load > 0.94 THEN 'cpu_utilization' END, CASE WHEN lag > 250 THEN 'event_loop_lag' END, CASE WHEN pending > 20000 THEN 'checkpoint_backlog' END, CASE WHEN queue > greatest(32, 2 * tasks) THEN 'ocr_backlog' END], lambda x: x IS NOT NULL) AS why FROM f),
h AS (SELECT *, CASE WHEN len(why) > 0 THEN 2 WHEN free > 4 AND load < 0.82 + 0.05 AND lag < 100 AND pending < 5000 AND queue < 8 AND (done > 0 OR tasks = 0) THEN 1 ELSE 0 END AS mood, array_to_string(why[1:3], ',') AS said FROM g),
r AS (SELECT event_type, list({n: 0, m: mood, a: '', w: said} ORDER BY event_id) AS t FROM h GROUP BY event_type),
z AS (SELECT event_type, list_reduce(list_prepend({n: 20, m: 0, a: 'hold', w: 'steady'}, t), lambda s, x: CASE
    WHEN x.m = 2 THEN {n: CASE WHEN s.n > 4 THEN greatest(4, s.n - 4) ELSE s.n END, m: 0, a: CASE WHEN s.n > 4 THEN 'downshift' ELSE 'hold' END, w: x.w}
    WHEN x.m = 1 THEN {n: CASE WHEN s.n < 64 THEN least(64, s.n + 12) ELSE s.n END, m: 0, a: CASE WHEN s.n < 64 THEN 'upshift' ELSE 'hold' END, w: CASE WHEN s.n < 64 THEN 'healthy_window' ELSE 'at_cap' END}
    ELSE {n: s.n, m: 0, a: 'hold', w: 'steady'} END) AS z FROM r)
SELECT event_type, z.n AS in_flight, z.a AS action, z.w AS reason FROM z""",
    "q_window_rates": """
WITH g AS (SELECT event_id, greatest(0, event_id % 500 - coalesce(lag(event_id % 500) OVER w, 0)) AS d_done, greatest(0, event_id % 70 - coalesce(lag(event_id % 70) OVER w, 0)) AS d_late FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id))
SELECT event_id, d_done, d_late, round(d_late / greatest(d_done, 1)::DOUBLE, 6) AS late_share FROM g""",
    "q_stale_tasks": "SELECT event_id, CASE WHEN epoch_us(TIMESTAMP '2024-01-16') - epoch_us(ts) < 180000000 THEN 'running' WHEN event_id % 3 >= 1 THEN 'classification_failed' ELSE 'retry' END AS fate FROM events",
    "q_backlog": """
WITH n AS (SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM events) AS events, (SELECT count(*) FROM nation) AS nation)
SELECT n.*, orders + events + nation AS pending_rows_total, s.* FROM n, (SELECT bool_and(value >= 0) AS ready, CAST(sum(user_id) AS BIGINT) AS queue_depth, CAST(sum(event_id % 7) AS BIGINT) AS batches, CAST(sum(event_id % 31) AS BIGINT) AS items FROM main.events) s""",
    "q_compare_hashes": f"""
WITH {_cases(HASHES, "a, b, refs")}, h AS (SELECT *, {_hash_bits("a")} AS x, {_hash_bits("b")} AS y FROM c),
d AS (SELECT k, {_popcount("x", "y")} AS distance FROM h WHERE x IS NOT NULL AND y IS NOT NULL),
u AS (SELECT k, x, {_hash_bits("r")} AS y FROM (SELECT k, x, unnest(refs) AS r FROM h)),
m AS (SELECT k, min({_popcount("x", "y")}) AS best FROM u WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY k)
SELECT c.k, distance, coalesce(round(1 - distance / 64.0::DOUBLE, 6), 0.0) AS similarity, best AS best_distance, coalesce(round(1 - best / 64.0::DOUBLE, 6), 0.0) AS best_similarity, coalesce(best, 64) AS filled, coalesce(best <= 8, false) AS hit, coalesce(best <= 4, false) AS anchor
FROM c LEFT JOIN d USING (k) LEFT JOIN m USING (k)""",
    "q_domain_simhash": f"""
WITH {_HOSTS}, p AS (SELECT host, '^' || regexp_replace(lower(host), '[^a-z0-9.-]+', '', 'g') || '$' AS t FROM hosts)
SELECT host, simhash FROM {_simhash_of("p", "host", "list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3))")}""",
    "q_certificate_identity": f"""
WITH c(k, subject, issuer, names) AS (VALUES {", ".join("(" + str(i) + ", " + ", ".join(_pairs(x) for x in r) + ")" for i, r in enumerate(CERTIFICATES))}),
l AS (SELECT k, {", ".join(f"list_sort(list_distinct(list_transform(list_filter({f}, lambda x: lower(trim(x.key)) = '{key}'), lambda x: lower(trim(x.value))))) AS {n}" for n, f, key in (("a", "subject", "commonname"), ("b", "subject", "organizationname"), ("cc", "issuer", "commonname"), ("dd", "issuer", "organizationname"), ("e", "names", "dns")))} FROM c),
i AS (SELECT k, array_to_string(list_filter([CASE WHEN len(a) > 0 THEN 'subject_cn=' || array_to_string(a, '|') END, CASE WHEN len(b) > 0 THEN 'subject_o=' || array_to_string(b, '|') END, CASE WHEN len(cc) > 0 THEN 'issuer_cn=' || array_to_string(cc, '|') END, CASE WHEN len(dd) > 0 THEN 'issuer_o=' || array_to_string(dd, '|') END, CASE WHEN len(e) > 0 THEN 'san=' || array_to_string(e, '|') END], lambda x: x IS NOT NULL), '||') AS identity FROM l)
SELECT i.k, identity, simhash FROM i LEFT JOIN {_simhash_of("i", "k", "regexp_extract_all(identity, '[a-z0-9]+')")} s ON s.k = i.k""",
    "q_url_struct": _urlstruct(),
    "q_effective_target": f"WITH {_TARGETS} SELECT page_id, original_host, final_host, redirect_promoted, redirect_spoof, effective_url, effective_host FROM target",
    "q_output_remarks": f"""
WITH {_TARGETS}, c AS (SELECT *, page_id % 8 = 0 AS path, CASE WHEN page_id % 3 = 0 THEN 'Phishing' WHEN page_id % 3 = 1 THEN 'Suspected' ELSE 'Legitimate' END AS label, CASE WHEN page_id % 9 = 0 OR page_id % 4 = 0 THEN 'strong_evidence' ELSE 'weak_evidence' END AS tier FROM target)
SELECT page_id, CASE WHEN path AND page_id % 6 <> 0 THEN 'not_mapped_to_ip; webpage rendering skipped because the domain did not resolve to an active IP.' WHEN redirect_spoof AND effective_host <> '' THEN 'redirect_target_spoofs_cse; redirected_to=' || effective_host || '.'
    WHEN redirect_promoted AND effective_host <> '' AND label <> 'Legitimate' THEN 'redirected_to=' || effective_host || '; lexical_redirect_suspected.' WHEN label = 'Legitimate' THEN 'non_aligned_or_weak_cse_similarity; NA values are due to privacy issues.'
    WHEN tier = 'weak_evidence' THEN 'weak_or_single_signal_match; NA values are due to privacy issues.' ELSE 'NA values are due to privacy issues.' END AS remarks,
  CASE WHEN page_id % 10 = 0 THEN 'fetch_failed_lexical_hit' WHEN page_id % 3 = 0 THEN 'low_confidence_hash_bypass' WHEN page_id % 2 = 0 THEN 'low_confidence_strict_lexical' WHEN page_id % 7 = 0 THEN 'low_confidence_lexical_score_pass' ELSE 'low_confidence_admitted' END AS review_reason,
  CASE WHEN page_id % 3 = 0 THEN 'shop.example' WHEN page_id % 5 = 0 THEN host ELSE {_host("landing")} END AS export_domain, page_id || '_b_c.v1' AS stem FROM c""",
    "q_preempted_decisions": f"""
WITH {_INPUTS}, e AS (SELECT *, (fetched AND id % 12 <> 0) OR id % 40 = 0 AS eligible FROM i), g AS (SELECT * REPLACE (eligible AND tvc_strong AS tvc_strong, eligible AND weak_tvc AS weak_tvc, eligible AND weak_signal AS weak_signal) FROM e), d AS ({_decide("g")})
SELECT id, CASE WHEN eligible AND id % 8 = 0 THEN 'Suspected' ELSE classification END AS classification, emit OR (eligible AND id % 8 = 0) AS emit, CASE WHEN eligible AND id % 8 = 0 THEN 'not_registered_domain_suspected' ELSE reason END AS reason, corroboration FROM d""",
    "q_below_floor": f"""
WITH o AS (SELECT *, CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE o_orderkey % 60 END AS score FROM orders)
SELECT {", ".join({"Application_ID": "'A'", "Identified Phishing/Suspected Domain Name": "'h' || o_orderkey", "Critical Sector Entity Name": "CASE WHEN o_orderkey % 2 = 0 THEN 'NA' ELSE o_orderpriority END", "Phishing/Suspected Domains (i.e. Class Label)": "'Suspected'", "Remarks": f"'{WEAK}'"}.get(c, "'NA'") + f' AS "{c}"' for c in SUBMISSION)}
FROM o WHERE score < 25 AND o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0""",
    "q_stage0_rows": """
WITH p AS (SELECT row_number() OVER (ORDER BY page_id) AS input_position, page_id AS k, url FROM pages)
SELECT input_position, url, CASE WHEN k % 4 <> 3 THEN k % 3 = 0 END AS strict, CASE WHEN k % 4 <> 3 THEN k % 100 END AS score, k % 7 <> 0 AND k % 4 <> 3 AS lexical_hit,
  CASE WHEN k % 7 = 0 THEN 'lexical_prefilter_rejected' WHEN k % 6 = 0 THEN 'dns_not_mapped_lexical_passthrough' WHEN k % 5 = 0 THEN CASE WHEN k % 2 = 0 THEN 'score_threshold' ELSE 'weak' END ELSE 'lexical_hit' END AS reason,
  CASE WHEN k % 7 = 0 THEN 'filtered_lexical_miss' WHEN k % 6 = 0 THEN 'dns_not_mapped_lexical_passthrough' WHEN k % 5 = 0 THEN CASE WHEN k % 2 = 0 THEN 'shortlisted' WHEN k % 15 = 0 THEN 'review_only' ELSE 'filtered_after_hash' END ELSE 'queued_for_hash' END AS final_status,
  CASE WHEN k % 7 = 0 THEN '' WHEN k % 6 = 0 THEN 'no_answer' ELSE 'resolved' END AS dns_status, CASE WHEN k % 7 = 0 THEN '' WHEN k % 6 = 0 THEN 'filtered' ELSE 'accepted' END AS dns_decision,
  CASE WHEN k % 7 = 0 THEN '' WHEN k % 6 = 0 THEN 'failed' WHEN k % 5 = 0 THEN 'fetched' ELSE '' END AS fetch_status, CASE WHEN k % 7 <> 0 AND k % 6 = 0 THEN 'dns_gate_no_answer' ELSE '' END AS fetch_error_type FROM p""",
    "q_stage1_rows": """
WITH o AS (SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN 'timeout' WHEN 1 THEN 'failed' WHEN 2 THEN 'fetched_visual_missing' WHEN 3 THEN 'fetched' ELSE '' END AS s, CASE o_orderkey % 6 WHEN 0 THEN 'stage1_suspected_non_escalated' WHEN 1 THEN 'strict_lexical_below_holdout_threshold' ELSE '' END AS r FROM orders)
SELECT k AS o_orderkey, s IN ('fetched', 'fetched_visual_missing') AS queued, CASE WHEN s IN ('fetched', 'fetched_visual_missing') THEN 'hashed_success' WHEN s = 'timeout' THEN 'fetch_timed_out' ELSE 'fetch_failed' END AS metric, 'not_attempted' AS visual_status,
  k % 2 = 0 AND k % 7 <> 0 AS deep_analysis_dns_accepted, k % 2 = 0 AND k % 7 <> 0 AND s <> '' AS deep_analysis_attempted,
  CASE WHEN k % 11 = 0 THEN 'holdout_ready' WHEN k % 13 = 0 THEN 'review_only' WHEN s IN ('failed', 'timeout') THEN 'hash_failed' WHEN k % 3 = 0 THEN 'filtered_lexical_miss' END AS pipeline_status,
  CASE WHEN k % 11 = 0 THEN 'admitted' WHEN k % 13 = 0 THEN 'review_only' WHEN s IN ('failed', 'timeout') THEN 'fetch_failed' WHEN k % 3 = 0 THEN 'filtered' ELSE 'pending' END AS stage_status,
  CASE WHEN k % 11 = 0 THEN '' WHEN k % 13 = 0 THEN 'stage1_review_only' WHEN s IN ('failed', 'timeout') THEN coalesce(nullif(r, ''), 'fetch_timeout_or_fetch_failed') WHEN k % 3 = 0 THEN coalesce(nullif(r, ''), 'filtered_lexical_miss') ELSE '' END AS failure_reason,
  nullif(r, '') AS review_reason, k % 11 <> 0 AND k % 4 <> 0 AS is_excluded FROM o""",
    "q_brand_consistency": f"""
WITH {_cases(SHOWN, "domain, header, full_, html, cse, cse_domain")}, bt(brand, aliases, spoofs, domains) AS (VALUES {", ".join("(" + ", ".join(_lit(x) for x in r) + ")" for r in BRAND_TABLE)}),
al AS (SELECT DISTINCT brand, a, domains FROM (SELECT brand, domains, {_norm("x")} AS a FROM (SELECT brand, domains, unnest(aliases) AS x FROM bt) UNION ALL SELECT brand, domains, replace({_norm("x")}, ' ', '') FROM (SELECT brand, domains, unnest(aliases) AS x FROM bt))),
sp AS (SELECT DISTINCT brand, a FROM (SELECT brand, {_norm("x")} AS a FROM (SELECT brand, unnest(spoofs) AS x FROM bt) UNION ALL SELECT brand, replace({_norm("x")}, ' ', '') FROM (SELECT brand, unnest(spoofs) AS x FROM bt)) WHERE a NOT IN ('axis', 'cloud', 'mail', 'myvi', 'nic')),
pts AS (SELECT c.k, bt.brand, greatest((SELECT max(length(d)) FROM (SELECT unnest(bt.domains) AS d) WHERE c.cse_domain = d OR ends_with(c.cse_domain, '.' || d)), CASE WHEN {_norm("c.cse")} <> '' AND EXISTS (SELECT 1 FROM al WHERE al.brand = bt.brand AND al.a IN ({_norm("c.cse")}, replace({_norm("c.cse")}, ' ', ''))) THEN length({_norm("c.cse")}) END) AS n FROM c, bt),
sl AS (SELECT k, arg_max(brand, n) AS short FROM pts WHERE n IS NOT NULL GROUP BY k),
su AS (SELECT k, domain, 'ocr_header_footer' AS surface, {_norm("header")} AS w, true AS shows, 3 AS pr FROM c UNION ALL SELECT k, domain, 'ocr_full', {_norm("full_")}, true, 2 FROM c UNION ALL SELECT k, domain, 'html', {_norm("html")}, false, 1 FROM c),
hit AS (SELECT su.k, surface, pr, shows, al.brand, al.a, length(al.a) AS n, CASE WHEN short IS NULL OR short = al.brand THEN 1 ELSE 0 END AS agrees, len(list_filter(al.domains, lambda d: su.domain = d OR ends_with(su.domain, '.' || d))) > 0 AS own, EXISTS (SELECT 1 FROM sp WHERE sp.brand = al.brand AND sp.a = al.a) AS proves
  FROM su JOIN al ON su.w <> '' AND contains(su.w, al.a) LEFT JOIN sl ON sl.k = su.k),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY agrees DESC, pr DESC, n DESC, a DESC, brand DESC) AS r FROM hit) WHERE r = 1),
worst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY agrees DESC, pr DESC, n DESC, a DESC, brand DESC) AS r FROM hit WHERE shows AND proves) WHERE r = 1)
SELECT c.k AS id, b.k IS NOT NULL AS detected, coalesce(b.brand, 'none') AS detected_brand, coalesce(b.own, false) AS domain_match, coalesce(w.agrees = 1 AND NOT w.own, false) AS spoofed, coalesce(w.surface, b.surface, 'none') AS surface, coalesce(w.a, b.a, '') AS alias
FROM c LEFT JOIN best b ON b.k = c.k LEFT JOIN worst w ON w.k = c.k""",
    "q_page_alignment": rf"""
WITH {_ENT}, p AS (SELECT page_id, {_HOST} AS host, lower(trim(regexp_replace({_plain(r"array_to_string(regexp_extract_all(html, '(?is)<(?:p|h[1-3]|title)(?:\s[^>]*)?>(.*?)</(?:p|h[1-3]|title)>', 1), ' ')")}, '[ \t\n\r\f\x0B]+', ' ', 'g'))) AS words FROM pages),
j AS (SELECT p.*, entity, domains[1] AS legit, {_registrable("host")} AS reg, CASE WHEN page_id % 2 = 0 THEN domains[1] || '.evil.info' ELSE 'www.' || domains[1] END AS inside FROM p JOIN ent ON page_id % 6 = idx),
t AS (SELECT *, {_named("words")} AS page, list_distinct({_named("host")} || {_named("string_split(reg, '.')[1]")}) AS hosts, list_distinct({_named("entity")} || ['license', 'public', 'work']) AS own FROM j),
k AS (SELECT *, list_filter(own, lambda x: x NOT IN {tuple(KINDS)} OR x IN ('license', 'public', 'work') OR list_contains(string_split(lower(entity), ' '), x)) AS mine FROM t)
SELECT page_id, len(list_intersect(list_distinct(page || hosts), mine)) AS aligned, array_to_string(list_sort({_named("host")}), '|') AS host_tokens,
  {_registrable("inside")} <> {_registrable("legit")} AND contains('.' || regexp_replace(inside, '\.[^.]*$', '') || '.', '.' || {_registrable("legit")} || '.') AS deceptive, CASE WHEN page_id % 3 = 0 THEN 'login.bank.in' ELSE reg END AS signature FROM k""",
    "q_sector_precedence": f"""
WITH {_cases(ORGANISATIONS, "entity, domain, registrar, hoster, dns")}, n AS (SELECT *, {_norm("entity")} AS name, list_filter(regexp_split_to_array(lower(domain), '[^a-z0-9]+'), lambda x: x <> '') AS parts FROM c),
r(pos, w, s) AS (VALUES {", ".join(f"({i}, '{w}', '{s}')" for i, (w, s) in enumerate(SECTOR_RULES))}), pri(pos, w) AS (VALUES (0, 'irctc'), (1, 'nic'), (2, 'sbi')),
a AS (SELECT k, (SELECT arg_min(r.s, pri.pos) FROM pri JOIN r ON r.w = pri.w WHERE contains(name, pri.w) OR list_contains(parts, pri.w)) AS one, (SELECT arg_min(r.s, i) FROM (SELECT unnest(parts) AS p, unnest(range(len(parts))) AS i) JOIN r ON r.w = p) AS two, (SELECT arg_min(r.s, r.pos) FROM r WHERE contains(name, r.w) OR contains(lower(domain), r.w)) AS three FROM n)
SELECT c.k, coalesce(one, two, three, 'Unknown') AS sector,
  CASE WHEN contains(domain, 'sbi') OR contains(domain, 'icici') THEN CASE WHEN (contains(lower(registrar), 'godaddy') OR contains(lower(hoster), 'cloudflare')) AND regexp_matches(lower(dns), 'ssl|tls') THEN 'Legitimate' ELSE 'Suspected' END
    WHEN contains(lower(registrar), 'cheapnames') OR contains(lower(hoster), 'bulletproof') OR (lower(registrar) = 'na' AND lower(hoster) = 'na') THEN 'Suspected' ELSE 'Legitimate' END AS label FROM c JOIN a USING (k)""",
    "q_page_predicates": f"""
WITH p AS (SELECT page_id AS k, url, CASE WHEN page_id % 9 = 0 THEN NULL WHEN page_id % 9 = 1 THEN substr(html, 1, 60) WHEN page_id % 9 = 2 THEN html || ' 403 Forbidden ' ELSE html END AS page, CASE WHEN page_id % 4 = 0 THEN 'index of /' WHEN page_id % 4 = 1 THEN '' ELSE 'home' END AS title, CASE WHEN page_id % 3 = 0 THEN '' ELSE 'some text' END AS shown,
  lower(trim(CASE WHEN page_id % 6 = 0 THEN 'TargetClosedError ' ELSE '' END || CASE WHEN page_id % 7 = 0 THEN 'net::ERR_NAME_NOT_RESOLVED' WHEN page_id % 7 = 1 THEN 'boom' ELSE '' END)) AS said FROM pages)
SELECT k AS page_id, page IS NULL OR length(page) < 100 OR {_any("lower(page)", BLOCKED)} AS blocked, k % 2 = 0 AND k % 10 <> 0 AND {_HOST} <> '' AND (title IN ('', 'index of /') OR shown = '') AS look_again, trim(title || ' ' || shown) = '' AS uninformative,
  CASE WHEN {_any("said", BROWSER_BROKEN)} THEN false WHEN said = '' THEN k % 5 = 0 ELSE {_any("said", NETWORK_SUSPICIOUS)} OR k % 5 = 0 END AS suspicious, k % 20 = 0 OR k % 21 = 0 OR k % 22 = 0 AS seed,
  k % 5 <> 0 AND (k % 8 = 0 OR k % 9 = 0 OR ((k % 90) / 90.0::DOUBLE >= 0.75 AND (k % 100) / 100.0::DOUBLE >= 0.75)) AS high_risk FROM p""",
    "q_small_functions": r"""
WITH o AS (SELECT *, o_orderkey AS k, CAST(round_even(o_totalprice / 7, 0) AS BIGINT) AS s FROM orders), z AS (SELECT *, (10 + k % 700) / 2.0::DOUBLE / 900 AS a, (500 + k % 700) / 2.0::DOUBLE / 900 AS b, (890 + k % 700) / 2.0::DOUBLE / 900 AS c FROM o)
SELECT o_orderkey, CASE WHEN s >= 3600 THEN format('{:02d}:{:02d}:{:02d}', s // 3600, s % 3600 // 60, s % 60) ELSE format('{:02d}:{:02d}', s // 60, s % 60) END AS duration, '{"a":"' || k || '","b":"' || o_orderstatus || '"}' AS json,
  CASE WHEN k % 3 = 0 THEN 'https://t-my.sharepoint.com/personal/u' || k || '/_layouts/15/download.aspx?share=TOK' WHEN k % 3 = 1 THEN 'https://t.sharepoint.com/a?b=1&download=1'
    ELSE 'https://api.onedrive.com/v1.0/shares/u!' || rtrim(replace(replace(base64(('https://1drv.ms/x/s!' || k)::BLOB), '+', '-'), '/', '_'), '=') || '/root/content' END AS link,
  CASE WHEN k % 2 = 0 THEN 'SBI' ELSE 'Airtel' END || '_x.example_' || k || '.pdf' AS evidence,
  array_to_string(list_filter([CASE WHEN a < 0.2 THEN 'Bank' END, CASE WHEN b < 0.2 THEN 'login' END, CASE WHEN c < 0.2 THEN '(c) 2024' END], lambda x: x IS NOT NULL), ' ') AS header,
  array_to_string(list_filter([CASE WHEN a BETWEEN 0.2 AND 0.8 THEN 'Bank' END, CASE WHEN b BETWEEN 0.2 AND 0.8 THEN 'login' END, CASE WHEN c BETWEEN 0.2 AND 0.8 THEN '(c) 2024' END], lambda x: x IS NOT NULL), ' ') AS body,
  array_to_string(list_filter([CASE WHEN a > 0.8 THEN 'Bank' END, CASE WHEN b > 0.8 THEN 'login' END, CASE WHEN c > 0.8 THEN '(c) 2024' END], lambda x: x IS NOT NULL), ' ') AS footer, 3 AS n_words FROM z""",
    "q_submission_package": r"""
WITH l AS (SELECT user_id, max(event_id) AS k FROM events GROUP BY user_id), r AS (SELECT CAST(user_id AS VARCHAR) AS record_key, CASE WHEN k % 5 <> 0 THEN 'h' || k WHEN k % 10 = 0 THEN 'n.example' ELSE 'raw.example' END AS domain, CASE WHEN k % 2 = 0 THEN 'r' ELSE 'NA' END AS remarks, 'NA' AS ip, 'E\x/f' || (k % 40) || '.pdf' AS evidence, k % 40 AS f FROM l WHERE k % 3 <> 0 AND k % 7 <> 0)
SELECT record_key, domain, remarks, ip, evidence, (SELECT count(DISTINCT f) FROM r) AS n_files FROM r""",
    "q_lookup_bundles": f"""
WITH p AS (SELECT page_id AS k, {_HOST} AS host FROM pages WHERE {_HOST} <> ''), h AS (SELECT DISTINCT host FROM p),
a AS (SELECT host, '10.0.0.' || (k % 4) AS ip, min(k) AS pos FROM p WHERE k % 6 <> 0 GROUP BY ALL), aa AS (SELECT host, string_agg(ip, ',' ORDER BY pos) AS ips, count(*) AS dns_answer_count FROM a GROUP BY host),
r AS (SELECT DISTINCT host, ['MX', 'A', 'NS', 'CNAME', 'TXT'][k % 5 + 1] AS kind, [2, 1, 3, 4, 9][k % 5 + 1] AS z, CASE WHEN k % 7 <> 0 THEN 'v' || (k % 3) END AS v FROM p),
rr AS (SELECT host, coalesce(string_agg(kind || ':' || v, ';' ORDER BY CASE kind WHEN 'A' THEN 1 WHEN 'NS' THEN 2 WHEN 'MX' THEN 3 WHEN 'CNAME' THEN 4 ELSE 9 END, kind, v), 'NA') AS dns_records FROM r GROUP BY host),
c AS (SELECT host, bool_or(k % 4 = 0) AS ok, max(k) FILTER (k % 4 <> 0) AS failed FROM p WHERE k % 2 = 0 GROUP BY host)
SELECT h.host, CASE WHEN ok THEN 'cached' WHEN failed IS NOT NULL AND 200 - failed < 90 THEN 'cooling' ELSE 'ask' END AS action, ips, dns_answer_count, dns_records,
  CASE WHEN ends_with(h.host, '.com') THEN 'https://com.example/' WHEN ends_with(h.host, '.org') THEN 'https://org.example/' ELSE 'https://any.example/' END || h.host AS endpoint FROM h LEFT JOIN c USING (host) LEFT JOIN aa USING (host) LEFT JOIN rr USING (host)""",
    "q_registration_fallback": """
WITH s AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 1 THEN s_name END AS r, CASE WHEN s_suppkey % 6 = 1 THEN '2020-02-03T04:05:06Z' END AS d, CASE WHEN s_suppkey % 4 <> 0 THEN 'W' || s_suppkey END AS r2, CASE WHEN s_suppkey % 5 = 0 THEN '2021-13-01' ELSE '2019-05-06' END AS d2 FROM supplier),
t AS (SELECT s_suppkey, CASE WHEN r IS NULL AND d IS NULL AND s_suppkey % 2 = 0 THEN coalesce(r2, 'NA') ELSE coalesce(trim(r), 'NA') END AS registrar, CASE WHEN r IS NULL AND d IS NULL AND s_suppkey % 2 = 0 THEN d2 ELSE coalesce(d, 'NA') END AS registered FROM s)
SELECT *, CASE WHEN TRY_CAST(substr(registered, 1, 10) AS DATE) IS NULL THEN -1 ELSE greatest(0, date_diff('day', TRY_CAST(substr(registered, 1, 10) AS DATE), DATE '2024-01-01')) END AS age FROM t""",
    "q_exact_hashes": """
WITH h AS (SELECT doc_id AS id, substr(md5(text), 1, 16) AS h FROM documents) SELECT DISTINCT a.id, 'e' || (b.id % 3) AS entity FROM h a JOIN h b ON a.h = b.h WHERE b.id % 7 = 0""",
    "q_unprocessed_domains": f"""
WITH p AS (SELECT page_id, {_HOST} AS domain FROM pages), o AS (SELECT DISTINCT {_registrable("domain")} AS entity, domain FROM p WHERE domain NOT IN (SELECT domain FROM p WHERE page_id % 3 = 0))
SELECT entity, string_agg(domain, '|' ORDER BY domain) AS domains FROM o GROUP BY entity""",
    "q_registrable_by_table": f"""
WITH {_HOSTS}, p AS (SELECT host, string_split(host, '.') AS l FROM hosts), s(suffix) AS (VALUES ('com'), ('org'), ('example.net'), ('net')),
m AS (SELECT host, any_value(l) AS l, max(len(string_split(suffix, '.'))) AS n FROM p LEFT JOIN s ON host = suffix OR ends_with(host, '.' || suffix) GROUP BY host)
SELECT host, array_to_string(l[-least(len(l), coalesce(n, 1) + 1):], '.') AS registrable FROM m""",
    "q_array_sets": """
WITH o AS (SELECT o_orderkey AS k, list_filter(['a', CASE WHEN o_orderkey % 2 = 0 THEN 'b' END, CASE WHEN o_orderkey % 3 = 0 THEN 'c' END], lambda x: x IS NOT NULL) AS a, list_filter([CASE WHEN o_orderkey % 7 = 0 THEN 'b' END, 'd', CASE WHEN o_orderkey % 4 = 0 THEN 'c' END], lambda x: x IS NOT NULL) AS b FROM orders)
SELECT k AS o_orderkey, array_to_string(list_sort(list_distinct(a || b)), '|') AS both, array_to_string(list_sort(list_intersect(a, b)), '|') AS common, array_to_string(list_sort(list_filter(a, lambda x: NOT list_contains(b, x))), '|') AS rest, false AS subset, 'sb' || (k % 3) || '|bank2' AS abbreviations FROM o""",
    "q_workbook_map": f"""
WITH p AS (SELECT page_id, {_PATH} AS url, {_HOST} AS workbook FROM pages), f AS (SELECT url, workbook, min(page_id) AS pos FROM p WHERE page_id % 4 <> 0 AND url <> '' GROUP BY ALL), b AS (SELECT url, string_agg(workbook, '|' ORDER BY pos) AS s FROM f GROUP BY url)
SELECT page_id, coalesce(s, '') AS source_workbook FROM p LEFT JOIN b USING (url)""",
    "q_lookup_speed": """
WITH e AS (SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean FROM events WHERE value > 0 GROUP BY event_type)
SELECT *, row_number() OVER (ORDER BY mean DESC, event_type) AS rank FROM e QUALIFY rank <= 5""",
    "q_holdout_rows": """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 OR o_orderkey % 6 = 0 THEN 0.0 ELSE round_even(o_totalprice / 7, 4) END AS hash_score, CASE WHEN o_orderkey % 4 = 0 THEN 'Low' ELSE 'High' END AS confidence_band,
  CASE WHEN o_orderkey % 4 = 0 THEN 'dns_not_mapped_lexical_passthrough' ELSE '' END AS admission_path FROM orders""",
    "q_workbook_outputs": """
WITH d AS (SELECT doc_id, unnest(list_distinct(list_filter([source, lang], lambda x: x IS NOT NULL))) AS w, source FROM documents), o AS (SELECT w, count(*) AS n FROM d WHERE doc_id % 3 = 0 AND starts_with(source, 'src1') GROUP BY w),
t AS (SELECT w, count(*) FILTER (doc_id % 3 = 0) AS n FROM d WHERE doc_id % 2 = 0 OR doc_id % 5 = 0 GROUP BY w)
SELECT coalesce(t.w, o.w) AS workbook, coalesce(o.n, t.n) AS n FROM t FULL JOIN o ON t.w = o.w""",
    "q_page_icons": f"""
WITH p AS (SELECT page_id, substr(md5(html), 1, 16) AS x, '00ff00ff00ff00ff' AS y FROM pages)
SELECT page_id, CASE page_id % 3 WHEN 0 THEN '/f.ico' WHEN 1 THEN 'https://x.org/i.png' ELSE '' END AS icon, CASE WHEN page_id % 5 = 0 THEN -1.0 ELSE CAST({_popcount("x", "y")} AS DOUBLE) END AS distance,
  CASE WHEN page_id % 6 = 0 THEN 0 ELSE least(25, 8 + 6 * CAST(page_id % 6 - 1 AS INTEGER)) END AS points, strftime(make_timestamp(page_id * 1000000000), '%Y%m%dT%H%M%SZ') AS token FROM p""",
    "q_upsert_state": "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 2 ELSE 1 END AS version, CASE WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS stage FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 <> 0",
    "q_funnel_pivot": """
WITH b AS (SELECT doc_id, unnest(list_distinct([source, lang])) AS book FROM documents)
SELECT book, count(*) FILTER (doc_id % 3 = 0) AS stage1, count(*) FILTER (doc_id % 3 = 1) AS holdout, count(*) FILTER (doc_id % 3 = 2) AS review FROM b WHERE book IS NOT NULL GROUP BY book""",
    "q_top_reasons": "SELECT l_returnflag || '_' || l_linestatus || '_' || (l_linenumber % 3) AS reason, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, reason LIMIT 5",
}
