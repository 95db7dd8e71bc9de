"""Signals of certificates, pages, failures and links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Markers in the text of failures.
BROWSER_GONE = ("targetclosederror", "target page, context or browser has been closed", "page was closed", "frame was detached", "net::err_aborted", "page is navigating", "navigation failed because page was closed")
TLS_BROKEN = ("net::err_ssl_protocol_error", "net::err_ssl_version_or_cipher_mismatch", "ssl protocol error", "ssl version or cipher mismatch")
NO_SUCH_NAME = ("nxdomain", "name does not exist", "err_name_not_resolved")
TRANSIENT = ("timeout", "tempor", "connection reset", "reset by peer", "server disconnected", "network is unreachable", "name or service not known", "try again", "429", "502", "503", "504")
BLOCKED = ("403 forbidden", "404 not found", "access denied", "page not found", "500 internal server error", "503 service unavailable", "blocked", "error page", "nginx")
BROWSER_BROKEN = (
    "targetclosederror", "browser_actor_failure_after_retry", "playwright is closed", "browser has been closed", "context has been closed", "page has been closed", "browsercontext.new_page", "browsertype.launch",
    "chrome-headless-shell", "error while loading shared libraries", "host system is missing dependencies", "libatk-1.0.so.0",
)
NETWORK_SUSPICIOUS = ("err_name_not_resolved", "err_connection_refused", "no_records", "no answer", "nxdomain", "not_registered", "not registered", "dns", "connection refused", "name or service not known", "network is unreachable")


def holds(text: Column, markers: Sequence[str]) -> Column:
    """Whether a text holds any of the markers."""
    out = F.lit(False)
    for m in markers:
        out = out | F.contains(text, F.lit(m))
    return out


def compact_message(name: Column, message: Column) -> Column:
    """The first line of an exception's message, and of a call log the first three steps; without a message the exception's name."""
    text = F.trim(F.coalesce(message, F.lit("")))
    text = F.when(F.contains(text, F.lit("\nBrowser logs:")), F.rtrim(F.split_part(text, F.lit("\nBrowser logs:"), F.lit(1)))).otherwise(text)
    lines = F.filter(F.transform(F.split(text, "\r\n|\r|\n"), lambda x: F.trim(x)), lambda x: x != "")
    at = F.array_position(lines, F.lit("Call log:")).cast("int")
    steps = F.slice(lines, F.greatest(at, F.lit(1)) + 1, 3)
    log = F.when((at > 0) & (F.size(steps) > 0), F.concat(F.lit(" | Call log: "), F.array_join(steps, " | "))).otherwise("")
    return F.when(F.size(lines) == 0, name).otherwise(F.concat(F.get(lines, F.lit(0)), log))


def failure_text(name: Column, detail: Column) -> Column:
    return F.lower(F.concat(name, F.lit(": "), F.coalesce(detail, F.lit(""))))


def fetch_failure(name: Column, message: Column, stage: Column) -> Column:
    """struct(kind, detail, retryable) of an exception by name and message in a stage of fetching; the first rule that holds."""
    detail = compact_message(name, message)
    text = failure_text(name, detail)

    def as_(kind: Column, retryable: Column) -> Column:
        return F.struct(kind.alias("kind"), detail.alias("detail"), retryable.alias("retryable"))

    of_stage = lambda suffix: F.concat(stage, F.lit(suffix))
    return (
        F.when(F.contains(text, F.lit("timeout")), as_(of_stage("_timeout"), stage == "navigation"))
        .when(holds(text, BROWSER_GONE), as_(of_stage("_transient_browser_error"), F.lit(True)))
        .when(holds(text, TLS_BROKEN), as_(F.lit("ssl_error"), F.lit(False)))
        .when(F.contains(text, F.lit("net::err_connection_reset")), as_(F.lit("connection_reset"), F.lit(True)))
        .otherwise(as_(of_stage("_error"), F.lit(False)))
    )


def lookup_failure(name: Column, message: Column) -> Column:
    """The status of a failed name lookup."""
    text = F.trim(failure_text(name, message))
    return F.when(holds(text, NO_SUCH_NAME), "nxdomain").when(holds(text, ("noanswer", "no answer")), "no_answer").when(holds(text, ("timeout", "lifetime")), "timeout").otherwise("error")


def transient(name: Column, message: Column) -> Column:
    """struct(retryable, timeout) of an exception; no exception is neither."""
    text = failure_text(name, message)
    return F.struct(F.coalesce(holds(text, TRANSIENT), F.lit(False)).alias("retryable"), F.coalesce(F.contains(text, F.lit("timeout")), F.lit(False)).alias("timeout"))


def suspicious_network(status: Column, kind: Column, detail: Column) -> Column:
    """Whether a fetch ended in a state that speaks against the host, and not against the browser."""
    said = F.lower(F.concat_ws(" ", F.when(F.trim(kind) != "", F.trim(kind)), F.when(F.trim(detail) != "", F.trim(detail))))
    timed_out = F.lower(F.trim(F.coalesce(status, F.lit("")))) == "timeout"
    return F.when(holds(said, BROWSER_BROKEN), False).when(said == "", timed_out).otherwise(holds(said, NETWORK_SUSPICIOUS) | timed_out)


def block_page(html: Column) -> Column:
    """Whether a page is too short to be one, or says that it is blocked or an error."""
    return html.isNull() | (F.length(html) < 100) | holds(F.lower(html), BLOCKED)


def uninformative(title: Column, excerpt: Column, html: Column, markers: Sequence[str]) -> Column:
    """Whether what a page shows (title, excerpt, the start of its source) is nothing, holds a marker, or is an error alone."""
    parts = [F.when(c != "", c) for c in (title, excerpt, F.substring(html, 1, 512))]
    surface = F.lower(F.trim(F.regexp_replace(F.concat_ws(" ", *parts), r"\s+", " ")))
    return (surface == "") | holds(surface, markers) | surface.isin("403", "forbidden", "index of")


def certificate_date(text: Column) -> Column:
    """A date such as 'Jan 05 10:00:00 2026 GMT', the form that certificates have; null if it isn't one."""
    return F.try_to_timestamp(F.regexp_replace(F.regexp_replace(F.trim(text), " +", " "), " [A-Z]+$", ""), F.lit("MMM d HH:mm:ss yyyy"))


def days_left(until: Column, now: Column) -> Column:
    """Whole days until a date, at least 0; -1 without one."""
    return F.when(until.isNull(), -1).otherwise(F.greatest(F.lit(0), F.floor((F.unix_micros(until) - F.unix_micros(now.cast("timestamp"))) / 86_400_000_000)))


def certificate(before: Column, after: Column, organisation: Column, now: Column) -> Column:
    """struct(present, valid, days_to_expiry, issuer) of a certificate's dates as text; all null: there is none."""
    since, until = certificate_date(before), certificate_date(after)
    present = before.isNotNull() | after.isNotNull() | organisation.isNotNull()
    dated = since.isNotNull() & until.isNotNull()
    return F.struct(
        present.cast("int").alias("present"),
        F.when(dated & now.cast("timestamp").between(since, until), 1).otherwise(0).alias("valid"),
        F.when(present & dated, days_left(until, now)).otherwise(-1).cast("int").alias("days_to_expiry"),
        F.when(present, organisation).alias("issuer"),
    )


def page_title(html: Column) -> Column:
    return F.trim(F.regexp_extract(html, "(?is)<title[^>]*>([^<]*)</title>", 1))


def favicon_link(html: Column) -> Column:
    """The address of a page's icon; empty without one."""
    tag = F.regexp_extract(html, r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?[^"'>]*\bicon\b)[^>]*>""", 0)
    return F.regexp_extract(tag, r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)""", 1)


def run_token(at: Column) -> Column:
    """A time as part of a run's name."""
    return F.date_format(at, "yyyyMMdd'T'HHmmss'Z'")


def plain(html: Column) -> Column:
    """Text of a piece of a page: tags go, the commonest entities are resolved."""
    bare = F.regexp_replace(html, r"(?s)<[^>]*>", " ")
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(name), F.lit(char))
    return bare


def page_text(html: Column) -> Column:
    """Visible text: scripts, styles and tags go, blanks collapse."""
    bare = plain(F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>", " "))
    return F.trim(F.regexp_replace(bare, r"[ \t\n\r\f\x0B]+", " "))


def headings_and_paragraphs(html: Column) -> Column:
    """Lower-cased text of a page's title, headings of the first three levels and paragraphs, in their order."""
    found = F.regexp_extract_all(html, F.lit(r"(?is)<(?:p|h[1-3]|title)(?:\s[^>]*)?>(.*?)</(?:p|h[1-3]|title)>"), F.lit(1))
    return F.lower(F.trim(F.regexp_replace(F.array_join(F.transform(found, plain), " "), r"[ \t\n\r\f\x0B]+", " ")))


def backoff(attempt: Column, base: float, cap: float, jitter: float = 0.0, seed: int | None = None) -> Column:
    """Seconds to wait before an attempt: doubled each time up to the cap, and a random part."""
    wait = F.least(F.lit(float(cap)), F.lit(float(base)) * F.pow(F.lit(2.0), attempt))
    return wait + F.rand(seed) * jitter if jitter else wait


def duration(seconds: Column) -> Column:
    """mm:ss, or hh:mm:ss from an hour on."""
    n = F.greatest(F.lit(0), F.bround(F.coalesce(seconds, F.lit(0.0)), 0).cast("long"))
    two = lambda c: F.lpad(c.cast("long").cast("string"), 2, "0")
    hours, rest = F.floor(n / 3600), n % 3600
    minutes = F.concat(two(F.floor(rest / 60)), F.lit(":"), two(rest % 60))
    long = F.when(hours < 100, two(hours)).otherwise(hours.cast("string"))
    return F.when(hours > 0, F.concat(long, F.lit(":"), minutes)).otherwise(minutes)


def download_link(url: Column) -> Column:
    """The address of a shared file itself. A link of a document site of the form /:x:/g/personal/user/token asks the user's
    download page for the token, other ones get download=1; other links go to the sharing service as encoded tokens."""
    parts = F.split(F.regexp_replace(F.regexp_extract(url, r"^[a-z]+://[^/?#]*([^?#]*)", 1), "^/+|/+$", ""), "/")
    root = F.regexp_extract(url, r"^[a-z]+://[^/?#]*", 0)
    direct = F.concat(root, F.lit("/"), F.array_join(F.slice(parts, 3, 2), "/"), F.lit("/_layouts/15/download.aspx?share="), F.get(parts, F.lit(4)))
    marked = F.concat(url, F.when(F.contains(url, F.lit("?")), "&").otherwise("?"), F.lit("download=1"))
    token = F.regexp_replace(F.translate(F.base64(url.cast("binary")), "+/\r\n", "-_"), "=+$", "")
    shared = F.concat(F.lit("https://api.onedrive.com/v1.0/shares/u!"), token, F.lit("/root/content"))
    return F.when(F.contains(F.lower(url), F.lit("sharepoint.com")), F.when(F.size(parts) >= 5, direct).otherwise(marked)).otherwise(shared)


def stable_json(entries: Column) -> Column:
    """JSON of a map with its keys in order."""
    return F.to_json(F.map_from_entries(F.sort_array(F.map_entries(entries))))


def zones(words: Column, height: Column, least: float = 0.40) -> Column:
    """struct(header, body, footer, n): the texts of recognised words(text, ys, confidence) by where the mean of their box stands:
    the upper and the lower fifth of the height. Words below the least confidence, and blank ones, go."""
    sure = F.filter(words, lambda w: (w["confidence"] >= least) & (F.trim(w["text"]) != ""))
    placed = F.transform(sure, lambda w: F.struct(F.trim(w["text"]).alias("text"), (F.aggregate(w["ys"], F.lit(0.0), lambda s, y: s + y) / F.size(w["ys"]) / height).alias("at")))

    def within(test) -> Column:
        return F.array_join(F.transform(F.filter(placed, test), lambda w: w["text"]), " ")

    return F.struct(within(lambda w: w["at"] < 0.2).alias("header"), within(lambda w: w["at"].between(0.2, 0.8)).alias("body"), within(lambda w: w["at"] > 0.8).alias("footer"), F.size(sure).alias("n"))


def evidence_name(entity: Column, domain: Column, serial: Column) -> Column:
    """The file name of a piece of evidence: the entity's abbreviation in brackets or first word, the domain and a number."""
    tag = F.regexp_extract(entity, r"\((.*?)\)", 1)
    return F.concat(F.when(tag != "", tag).otherwise(F.split_part(F.trim(entity), F.lit(" "), F.lit(1))), F.lit("_"), domain, F.lit("_"), serial.cast("string"), F.lit(".pdf"))
