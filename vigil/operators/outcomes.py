"""What becomes of a record: targets after redirects, terminal states, rows for reports, reviews and submissions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions import urls
from vigil.functions.text import flag, number, present
from vigil.operators import policy
from vigil.operators.reports import numbered

#: Fixed value: the path of records whose host has no address, and which go on for their name alone.
PASSTHROUGH = "dns_not_mapped_lexical_passthrough"
FETCHED = ("fetched", "fetched_visual_missing")
#: The columns of a submission's record.
SUBMISSION = (
    "Application_ID", "Source of detection", "Identified Phishing/Suspected Domain Name", "Corresponding CSE Domain Name", "Critical Sector Entity Name", "Phishing/Suspected Domains (i.e. Class Label)",
    "Domain Registration Date", "Registrar Name", "Registrant Name or Registrant Organisation", "Registrant Country", "Name Servers", "Hosting IP", "Hosting ISP", "Hosting Country", "DNS Records (if any)", "Evidence file name", "Remarks",
)
WEAK = "weak_or_single_signal_match; NA values are due to privacy issues."


def blank(c: Column) -> Column:
    return F.trim(F.coalesce(c.cast("string"), F.lit("")))


def public_url(*values: Column) -> Column:
    """The first that is there and that isn't of a browser's own kind (about:, data:, ...); empty without one."""
    own = r"(?i)^(about|javascript|data|file|blob|chrome|edge):"
    return F.coalesce(*[F.when((blank(v) != "") & ~blank(v).rlike(own), blank(v)) for v in values], F.lit(""))


def host_value(value: Column) -> Column:
    """The host of a URL, or of a bare host with path or port."""
    return F.when(F.contains(blank(value), F.lit("//")), urls.hostname(blank(value))).otherwise(F.lower(F.split_part(F.split_part(blank(value), F.lit("/"), F.lit(1)), F.lit(":"), F.lit(1))))


def with_target(df: DataFrame, original: Sequence[Column], landing: Column, deceptive: Column) -> DataFrame:
    """df with original_url, original_host, final_host, redirect_promoted, redirect_spoof, effective_url, effective_host.

    A redirect counts if it leads to another registrable domain, to a host that is made to deceive, or at least two labels
    deeper into the same host.
    """
    labels = lambda c: F.size(urls.labels(F.col(c)))
    nested = (F.col("original_host") != "") & F.endswith(F.col("final_host"), F.concat(F.lit("."), F.col("original_host"))) & (labels("final_host") - labels("original_host") >= 2)
    promoted = (F.col("final_host") != "") & (F.col("final_host") != F.col("original_host")) & ((urls.registrable(F.col("final_host")) != urls.registrable(F.col("original_host"))) | flag(deceptive) | nested)
    either = lambda a, b: F.when(F.col("redirect_promoted"), F.col(b)).otherwise(F.coalesce(F.nullif(F.col(a), F.lit("")), F.col(b)))
    return (
        df.withColumn("original_url", public_url(*original))
        .withColumn("__landing", public_url(landing))
        .withColumn("original_host", host_value(F.col("original_url")))
        .withColumn("final_host", host_value(F.col("__landing")))
        .withColumn("redirect_promoted", promoted)
        .withColumn("redirect_spoof", F.col("redirect_promoted") & flag(deceptive))
        .withColumn("effective_url", either("original_url", "__landing"))
        .withColumn("effective_host", either("original_host", "final_host"))
        .drop("__landing")
    )


def markers(*paths: Column) -> Column:
    """The distinct parts of lists joined by '|'."""
    return F.array_distinct(F.filter(F.transform(F.split(F.concat_ws("|", *paths), r"\|"), lambda x: F.trim(x)), lambda x: x != ""))


def passthrough(*paths: Column) -> Column:
    return F.array_contains(markers(*paths), PASSTHROUGH)


def remarks(path: Column, ip: Column, spoof: Column, promoted: Column, host: Column, label: Column, tier: Column) -> Column:
    """What a submission says about a record; the first of its cases that holds."""
    unmapped = F.upper(blank(ip)).isin("", "NA", "N/A", "NONE")
    return (
        F.when(path & unmapped, "not_mapped_to_ip; webpage rendering skipped because the domain did not resolve to an active IP.")
        .when(spoof & (host != ""), F.concat(F.lit("redirect_target_spoofs_cse; redirected_to="), host, F.lit(".")))
        .when(promoted & (host != "") & label.isin("Phishing", "Suspected"), F.concat(F.lit("redirected_to="), host, F.lit("; lexical_redirect_suspected.")))
        .when(label == "Legitimate", "non_aligned_or_weak_cse_similarity; NA values are due to privacy issues.")
        .when(tier == "weak_evidence", WEAK)
        .otherwise("NA values are due to privacy issues.")
    )


def review_reason(status: Column, strict: Column, anchored: Column, passed: Column) -> Column:
    """Why a classified record would be reviewed."""
    failed = F.lower(blank(status)).isin("failed", "timeout")
    return F.when(failed & strict, "fetch_failed_lexical_hit").when(anchored, "low_confidence_hash_bypass").when(strict, "low_confidence_strict_lexical").when(passed, "low_confidence_lexical_score_pass").otherwise("low_confidence_admitted")


#: Inputs of the policy that rest on the network, the page's text or a model: without a fetch there are none.
_FETCHED_ONLY = ("tvc_strong", "weak_tvc", "weak_signal")


def decided(df: DataFrame, status: Column, registration: Column, path: Column) -> DataFrame:
    """policy.decide() with its pre-emptions: records that weren't fetched, and don't go on for their name, are decided without what
    rests on a fetch; of the others those that aren't registered are suspected."""
    eligible = F.coalesce(F.lower(blank(status)).isin(*FETCHED) | path, F.lit(False))
    known = df.withColumn("__eligible", eligible).withColumns({n: F.col("__eligible") & F.coalesce(F.col(n), F.lit(False)) for n in _FETCHED_ONLY})
    out = policy.decide(known.withColumn("__unregistered", F.col("__eligible") & (F.lower(blank(registration)) == "not_registered")))
    over = {"classification": "Suspected", "reason": "not_registered_domain_suspected", "emit": True}
    return out.withColumns({c: F.when(F.col("__unregistered"), F.lit(v)).otherwise(F.col(c)) for c, v in over.items()}).drop("__eligible", "__unregistered")


def below_floor(df: DataFrame, score: Column, floor: float, strict: Column, anchored: Column, values: dict[str, Column]) -> DataFrame:
    """Submission records of the rows below the score floor: suspected, with what values gives and NA for the rest."""
    known = values | {"Phishing/Suspected Domains (i.e. Class Label)": F.lit("Suspected"), "Remarks": F.lit(WEAK)}
    rows = df.where(~policy.floor_gate(score, floor, strict, anchored))
    return rows.select(*[F.coalesce(F.nullif(blank(known[c]), F.lit("")), F.lit("NA")).alias(c) if c in known else F.lit("NA").alias(c) for c in SUBMISSION])


def rule_label(registrar: Column, hoster: Column, dns: Column, domain: Column, text: Column, spoofed: Column, brands: Sequence[str], trusted: tuple[Sequence[str], Sequence[str]], suspicious: tuple[Sequence[str], Sequence[str]]) -> Column:
    """A label from lists of words: trusted and suspicious are (registrars, hosters)."""
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    any_of = lambda c, words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(low(c), w)) if words else F.lit(False)
    either = lambda lists: any_of(registrar, lists[0]) | any_of(hoster, lists[1])
    brand = any_of(domain, brands) | any_of(text, brands)
    secure = any_of(dns, ("ssl", "tls"))
    unknown = (low(registrar) == "na") & (low(hoster) == "na")
    return F.when(spoofed, "Suspected").when(brand, F.when(either(trusted) & secure, "Legitimate").otherwise("Suspected")).when(either(suspicious) | unknown, "Suspected").otherwise("Legitimate")


def sector(entity: Column, domain: Column, rules: Sequence[tuple[str, str]], priority: Sequence[str], default: str = "Unknown") -> Column:
    """The sector of an entity: of the first priority word in its name or its domain's parts, else of the first part of the domain that
    is a word of the rules, else of the first rule whose word stands in name or domain."""
    name = F.trim(F.regexp_replace(F.lower(F.coalesce(entity, F.lit(""))), "[^a-z0-9]+", " "))
    parts = urls.words(F.coalesce(domain, F.lit("")))
    table = dict(rules)
    out = F.when(F.lit(False), F.lit(default))
    for w in priority:
        if w in table:
            out = out.when(F.contains(name, F.lit(w)) | F.array_contains(parts, w), table[w])
    known = F.create_map(*[F.lit(x) for r in rules for x in r])
    of_part = F.get(F.filter(F.transform(parts, lambda p: F.try_element_at(known, p)), lambda x: x.isNotNull()), F.lit(0))
    out = out.when(of_part.isNotNull(), of_part)
    for w, value in rules:
        out = out.when(F.contains(name, F.lit(w)) | F.contains(F.lower(F.coalesce(domain, F.lit(""))), F.lit(w)), value)
    return out.otherwise(default)


def stage0_rows(inputs: DataFrame, scores: DataFrame, decisions: DataFrame, rejected: DataFrame, unmapped: DataFrame, key: str = "url") -> DataFrame:
    """A row for each of inputs(pos, url): its place, what the lexical stage has of it, and how it ended.

    scores(url, ...) from the gate, decisions(url, admission_path, review_only_reason, admitted, review_only, fetch_status), and the
    urls that the gate rejected (rejected) or whose host has no address (unmapped). All are found by url, without blanks around it;
    where a url stands in several inputs that are judged apart, key names a column that tells them apart in all five tables. Of
    several scores or decisions of a key the greatest counts, so that no input is repeated.
    """
    found_by = F.trim("url") if key == "url" else F.col(key)

    def single(df: DataFrame, name: str, names: dict[str, str]) -> DataFrame:
        found = F.struct(F.lit(True).alias(f"__{name}"), *[F.col(c).alias(n) for c, n in names.items()])
        return df.groupBy(found_by.alias(f"__{name}_key")).agg(F.max(found).alias("m")).select(f"__{name}_key", "m.*")

    kept = [c for c in scores.columns if c not in ("url", key)]
    j = numbered(inputs, "pos", "input_position").withColumn("__key", found_by)
    for df, name, names in ((scores, "scored", {c: c for c in kept}), (decisions, "d", {c: f"__d_{c}" for c in decisions.columns if c not in ("url", key)}), (rejected, "rejected", {}), (unmapped, "unmapped", {})):
        j = j.join(single(df, name, names), F.col("__key") == F.col(f"__{name}_key"), "left")
    out, away, known = F.coalesce("__rejected", F.lit(False)), F.coalesce("__unmapped", F.lit(False)), F.col("__d").isNotNull()
    path = F.coalesce(F.nullif(F.col("__d_admission_path"), F.lit("")), F.col("__d_review_only_reason"), F.lit(""))
    end = F.when(F.col("__d_admitted"), "shortlisted").when(F.col("__d_review_only"), "review_only").otherwise("filtered_after_hash")
    return j.select(
        "input_position", "url", *kept,
        (~out & F.coalesce("__scored", F.lit(False))).alias("lexical_hit"),
        F.when(out, "lexical_prefilter_rejected").when(away, PASSTHROUGH).when(known, path).otherwise("lexical_hit").alias("reason"),
        F.when(out, "filtered_lexical_miss").when(away, PASSTHROUGH).when(known, end).otherwise("queued_for_hash").alias("final_status"),
        F.when(out, "").when(away, "no_answer").otherwise("resolved").alias("dns_status"),
        F.when(out, "").when(away, "filtered").otherwise("accepted").alias("dns_decision"),
        F.when(out, "").when(away, "failed").when(known, F.coalesce("__d_fetch_status", F.lit(""))).otherwise("").alias("fetch_status"),
        F.when(~out & away, "dns_gate_no_answer").otherwise("").alias("fetch_error_type"),
    )


def routed(payloads: DataFrame) -> DataFrame:
    """payloads(fetch_status, ...) with queued (goes on to be hashed) and metric (the counter that it raises)."""
    status = F.lower(blank(F.col("fetch_status")))
    done = status.isin(*FETCHED)
    return payloads.withColumn("queued", done).withColumn("metric", F.when(done, "hashed_success").when(status == "timeout", "fetch_timed_out").otherwise("fetch_failed"))


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """df with every column of a sink: missing and null ones hold its default."""
    return df.select(*[c for c in df.columns if c not in defaults], *[F.coalesce(F.col(c), F.lit(v)).alias(c) if c in df.columns else F.lit(v).alias(c) for c, v in defaults.items()])


#: What a row holds whose host has no address.
UNMAPPED = {"fetch_status": "failed", "visual_status": "not_attempted", "fetch_error_type": "dns_gate_no_answer", "fetch_error_detail": "domain not mapped to an active IP", "admission_path": PASSTHROUGH, "survival_path": PASSTHROUGH, "dns_status": "no_answer", "dns_decision": "filtered", "hash_score": 0.0, "confidence_band": "Low", "evidence_tier": "weak_evidence"}


def unmapped_rows(df: DataFrame) -> DataFrame:
    """df as rows whose host has no address: they go on for their name alone."""
    return with_defaults(df.drop(*UNMAPPED), UNMAPPED)


def holdout_row(df: DataFrame, scores: Sequence[str]) -> DataFrame:
    """df with the scores rounded to four places, half to even; what isn't a number is 0."""
    return df.select(*[F.bround(number(F.col(c)), 4).alias(c) if c in scores else F.col(c) for c in df.columns])


def terminal_outcome(admitted: Column, review_only: Column, reason: Column, review: Column, status: Column, stage: Column) -> Column:
    """struct(pipeline_status, stage_status, failure_reason) of a record after the first stage."""
    said = lambda c, default: F.coalesce(F.nullif(blank(c), F.lit("")), F.lit(default))
    of = lambda a, b, c: F.struct(F.lit(a).cast("string").alias("pipeline_status"), F.lit(b).alias("stage_status"), c.alias("failure_reason"))
    return (
        F.when(admitted, of("holdout_ready", "admitted", F.lit("")))
        .when(review_only, of("review_only", "review_only", said(review, "stage1_review_only")))
        .when(F.lower(blank(status)).isin("failed", "timeout"), of("hash_failed", "fetch_failed", said(reason, "fetch_timeout_or_fetch_failed")))
        .when(blank(stage).isin("stage1_http", "lexical_gate"), of("filtered_lexical_miss", "filtered", said(reason, "filtered_lexical_miss")))
        .otherwise(of(None, "pending", F.lit("")))
    )


def excluded(rows: DataFrame) -> DataFrame:
    """Rows that were neither admitted nor survived by any path."""
    return rows.where(~F.coalesce("admitted", F.lit(False)) & (blank(F.col("survival_path")) == ""))


#: Why a row of the first stage goes to review.
REVIEWED = ("strict_lexical_below_holdout_threshold", "generic_token_only_lexical_rejected", "stage1_suspected_non_escalated")


def review_queue(rows: DataFrame, keep_suspected: bool = False) -> DataFrame:
    """Rows that go to review, with review_reason; those only suspected don't where they are kept."""
    wanted = [r for r in REVIEWED if not (keep_suspected and r == "stage1_suspected_non_escalated")]
    return rows.where(F.col("reason").isin(*wanted)).withColumn("review_reason", F.col("reason"))


def deep_analysis(rows: DataFrame) -> DataFrame:
    """rows with the steps towards the deep analysis that each has taken: candidate, resolved, attempted."""
    candidate = F.coalesce("escalate_to_hashing", F.lit(False))
    accepted = candidate & (F.lower(blank(F.col("dns_decision"))) == "accepted")
    return rows.withColumn("deep_analysis_candidate", candidate).withColumn("deep_analysis_dns_accepted", accepted).withColumn("deep_analysis_attempted", accepted & ~F.lower(blank(F.col("fetch_status"))).isin("", "not_attempted"))


def export_domain(final_domain: Column, domain: Column, landing: Column, normalized: Column) -> Column:
    """The domain that an export names: the first that is there of these, or of the hosts of these URLs."""
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in (F.lower(blank(final_domain)), F.lower(blank(domain)), urls.hostname(blank(landing)), urls.hostname(blank(normalized)))], F.lit(""))


def export_stem(workbook: Column) -> Column:
    """A workbook's name as part of a file name."""
    base = F.regexp_replace(F.regexp_extract(blank(workbook), r"[^/]*$", 0), r"(?<=.)\.[^.]*$", "")
    safe = F.regexp_replace(F.regexp_replace(F.trim(base), "[^A-Za-z0-9._-]+", "_"), "^[._-]+|[._-]+$", "")
    return F.coalesce(F.nullif(safe, F.lit("")), F.lit("unknown_source"))


def delayed_redirect(survivor: Column, original: Column, landing: Column, title: Column, text: Column) -> Column:
    """Whether a page is worth a second look after a while: a survivor's own host that shows nothing yet."""
    collapsed = lambda c: F.lower(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " ")))
    host, there = urls.hostname(F.coalesce(original, F.lit(""))), urls.hostname(F.coalesce(landing, F.lit("")))
    return survivor & (host != "") & (host == there) & (collapsed(title).isin("", "index of /") | (collapsed(text) == "") | F.startswith(collapsed(text), F.lit("index of /")))


def signal_seed(candidates: Column, hard: Column, scores: Sequence[Column], parking: Column) -> Column:
    """Whether the first stage left anything to follow."""
    some = F.greatest(*[F.coalesce(s, F.lit(0)) for s in scores]) > 0
    return F.coalesce(candidates, F.lit(False)) | F.coalesce(hard, F.lit(False)) | some | (blank(parking) != "")


def high_risk_seed(fallback: Column, strict: Column, passed: Column, lexical: Column, typo: Column, *, typo_least: float = 0.75, passing: float = 0.85) -> Column:
    """Whether a host's name alone makes it worth a retry: a hit, a passing score, or a near one with a similar name."""
    near = (number(typo) >= typo_least) & (number(lexical) >= F.greatest(F.lit(0.70), F.lit(passing - 0.10)))
    return ~F.coalesce(fallback, F.lit(False)) & (F.coalesce(strict, F.lit(False)) | F.coalesce(passed, F.lit(False)) | near)


def submission_records(log: DataFrame) -> DataFrame:
    """The records of a run's log(record_key, pos, status, raw_url, normalized_url, record): of each key the last row, if it is completed and
    its JSON record can be read; an address that isn't public is replaced by the row's own."""
    last = log.where(blank(F.col("record_key")) != "").groupBy("record_key").agg(F.max(F.struct("pos", "status", "raw_url", "normalized_url", "record")).alias("x")).select("record_key", "x.*")
    read = last.where("status = 'completed'").withColumn("r", F.from_json("record", "map<string, string>")).where("r IS NOT NULL AND size(r) > 0")
    name = "Identified Phishing/Suspected Domain Name"
    url = F.coalesce(F.nullif(public_url(F.try_element_at("r", F.lit(name)), F.col("raw_url"), F.col("normalized_url")), F.lit("")), F.lit("NA"))
    return read.select("record_key", *[(url if c == name else F.coalesce(F.nullif(blank(F.try_element_at("r", F.lit(c))), F.lit("")), F.lit("NA"))).alias(c) for c in SUBMISSION])


def referenced(files: DataFrame, records: DataFrame, column: str = "Evidence file name") -> DataFrame:
    """The files(name) that a record names, whatever folder it names them in."""
    name = F.regexp_extract(F.replace(F.col(column), F.lit("\\"), F.lit("/")), r"[^/]*$", 0)
    return files.join(records.where(present(F.col(column))).select(name.alias("name")).distinct(), "name", "left_semi")


def replayed(rows: DataFrame, done: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(what a resumed run has still to do, what it has emitted already and emits again)."""
    return rows.join(done.select(*keys).distinct(), list(keys), "left_anti"), done.join(rows.select(*keys).distinct(), list(keys), "left_semi")
