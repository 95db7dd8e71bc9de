"""The decision policy and its predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.text import present

#: Hosts and texts that name parking providers, and phrases of domains for sale. The first match wins.
PARKING_HOSTS = {"hugedomains": "HugeDomains", "sedo": "Sedo", "afternic": "Afternic", "dan.com": "Dan", "undeveloped": "Dan", "bodis": "Bodis", "parkingcrew": "ParkingCrew", "smartname": "SmartName", "above.com": "Above.com"}
PARKING_TEXTS = {"hugedomains": "HugeDomains", "sedo": "Sedo", "afternic": "Afternic", "dan.com": "Dan", "bodis": "Bodis", "parkingcrew": "ParkingCrew", "smartname": "SmartName"}
SALE_PHRASES = ("buy this domain", "this domain is for sale", "domain is for sale", "purchase this domain", "make an offer", "inquire about this domain", "domain may be for sale", "own this domain", "get this domain")
#: States of a fetch or lookup that speak against a host.
BAD_FETCH = ("failed", "timeout")
BAD_LOOKUP = ("not_registered", "no_records", "unresolved", "connection_refused")
BAD_DETAIL = ("err_name_not_resolved", "err_connection_refused", "no_records", "nxdomain", "not_registered", "not registered")


def parked_text(title: Column, text: Column) -> Column:
    """What parking() looks in: a page's title and text."""
    return F.concat_ws(" ", *[F.when(F.trim(c) != "", F.trim(c)) for c in (title, text)])


def parked(provider: Column, reason: Column) -> Column:
    return present(provider) | present(reason)


def parking(host: Column, text: Column, hosts: dict[str, str] = PARKING_HOSTS, texts: dict[str, str] = PARKING_TEXTS, phrases: tuple[str, ...] = SALE_PHRASES) -> Column:
    """struct(provider, reason), the first of the ordered rules that matches; both empty without one."""
    low = F.lower(text)
    out = F.when(F.lit(False), F.struct(F.lit("").alias("provider"), F.lit("").alias("reason")))
    for hint, name in hosts.items():
        out = out.when(F.contains(host, F.lit(hint)), F.struct(F.lit(name).alias("provider"), F.lit("provider_hosted_parking_redirect").alias("reason")))
    for hint, name in texts.items():
        out = out.when(F.contains(low, F.lit(hint)), F.struct(F.lit(name).alias("provider"), F.lit("provider_branded_parking_template").alias("reason")))
    for phrase in phrases:
        out = out.when(F.contains(low, F.lit(phrase)), F.struct(F.lit("").alias("provider"), F.lit("parking_or_sale_keywords").alias("reason")))
    return out.otherwise(F.struct(F.lit("").alias("provider"), F.lit("").alias("reason")))


def network_corroborated(fields: list[Column], fetch_status: Column, fetch_detail: Column, lookup_status: Column) -> Column:
    """Any infrastructure field is there, or a fetch or lookup ended in a state that speaks against the host."""
    known = F.exists(F.array(*fields), present)
    low = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return known | low(fetch_status).isin(*BAD_FETCH) | F.exists(F.array(*map(F.lit, BAD_DETAIL)), lambda m: F.contains(low(fetch_detail), m)) | low(lookup_status).isin(*BAD_LOOKUP)


#: Columns of booleans (weak_tvc, brand_evidence, ... may be computed) that decide() reads.
INPUTS = ("fallback_only", "strict", "score_pass", "fetched", "redirect_spoof", "redirect_changed", "parked", "network", "hash_anchor", "tvc_strong", "content_spoof", "weak_tvc", "brand_evidence", "keyword_hit", "weak_signal")


def decide(df: DataFrame, flagged: bool = False) -> DataFrame:
    """df(INPUTS) with classification, emit, reason and corroboration; the first rule that holds decides, of 15.

    flagged: only what is emitted as phishing or suspected. That is asked of the rule's number, which a plan can push below joins as
    one CASE; a filter on the labels would be one for each label and rule.
    """
    own = {n: f"__{n}" for n in INPUTS}
    c = {n: F.col(x) for n, x in own.items()}
    survivor = c["strict"] | c["score_pass"]
    strong = c["hash_anchor"] | c["tvc_strong"] | c["content_spoof"]
    weak = strong | c["weak_tvc"] | c["brand_evidence"] | c["keyword_hit"] | c["weak_signal"]
    away = ~c["fetched"]
    count = lambda *names: sum((c[n].cast("int") for n in names), F.lit(0))
    outside, every = count("parked", "network"), count("hash_anchor", "tvc_strong", "content_spoof", "weak_tvc", "brand_evidence", "keyword_hit", "weak_signal", "parked", "network")
    # condition, label, emitted, reason, and how the corroboration counts
    rules = [
        (c["fallback_only"] & ~c["strict"], "Legitimate", False, "fallback_rank_only_without_strict_lexical", "none"),
        (~survivor, "Legitimate", False, "no_lexical_gate", "none"),
        (away & c["redirect_spoof"], "Phishing", True, "redirected_cse_spoof_host", "outside and redirect"),
        (away & c["redirect_changed"], "Suspected", True, "redirected_lexical_suspected", "outside and redirect"),
        (away & c["parked"], "Suspected", True, "parked_sale_lexical_suspected", "outside"),
        (away & c["network"] & c["strict"], "Suspected", True, "strict_lexical_fetch_evidence_unavailable_suspected", "outside"),
        (away & c["network"], "Suspected", True, "lexical_gate_plus_network_corroboration", "outside"),
        (away, "Legitimate", False, "invalid_fetch_state_without_direct_evidence", "none"),
        (c["redirect_spoof"], "Phishing", True, "redirected_cse_spoof_host", "every, at least 1"),
        (c["redirect_changed"], "Suspected", True, "redirected_lexical_suspected", "every, at least 1"),
        (c["strict"] & strong, "Phishing", True, "strict_lexical_plus_direct_evidence", "every"),
        (weak, "Suspected", True, "lexical_gate_plus_weak_direct_evidence", "every"),
        (c["parked"], "Suspected", True, "parked_sale_lexical_suspected", "every"),
        (c["network"], "Suspected", True, "lexical_gate_plus_network_corroboration", "every"),
        (F.lit(True), "Legitimate", True, "lexical_without_any_corroboration_legitimate_review", "every"),
    ]
    first = F.when(rules[0][0], 1)
    for i, r in enumerate(rules[1:], 2):
        first = first.when(r[0], i)
    of = lambda k: F.element_at(F.array(*[F.lit(r[k]) for r in rules]), F.col("__rule"))
    how = F.col("__how")
    return (
        df.withColumns({x: F.coalesce(F.col(n), F.lit(False)) for n, x in own.items()})
        .withColumn("__rule", first)
        .where(F.col("__rule").isin([i for i, r in enumerate(rules, 1) if r[2] and r[1] != "Legitimate"]) if flagged else F.lit(True))
        .withColumns({"classification": of(1), "emit": of(2), "reason": of(3), "__how": of(4), "__outside": outside, "__every": every})
        .withColumn("corroboration", F.when(how == "none", 0).when(how == "outside", F.col("__outside")).when(how == "outside and redirect", F.col("__outside") + 1).when(how == "every", F.col("__every")).otherwise(F.greatest("__every", F.lit(1))))
        .drop(*own.values(), "__rule", "__how", "__outside", "__every")
    )


def floor_gate(score: Column, floor: float, strict: Column, anchored: Column) -> Column:
    """Kept for the policy: a score (text that isn't a number is 0) at the floor, a strict hit or an anchor."""
    return (F.coalesce(score.cast("string").try_cast("double"), F.lit(0.0)) >= floor) | strict | anchored


def first_rule(df: DataFrame, text: Column, rules: list[tuple[str, str]], default: str, out: str) -> DataFrame:
    """df with the value of the first rule (token, value) whose token the text holds."""
    case = F.when(F.contains(text, F.lit(rules[0][0])), rules[0][1])
    for token, value in rules[1:]:
        case = case.when(F.contains(text, F.lit(token)), value)
    return df.withColumn(out, case.otherwise(default))
