"""Hosts, labels and structural features of URLs, as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Public suffixes of more than one label, and custom ones, that count as one; all others are the last label.
SUFFIXES = ("bank.in", "co.in", "co.uk", "com.au", "gov.in", "net.in", "org.in")


def with_scheme(url: Column) -> Column:
    """url, with https:// before it unless it has a scheme of HTTP."""
    return F.when(url.startswith("http://") | url.startswith("https://"), url).otherwise(F.concat(F.lit("https://"), url))


def netloc(url: Column) -> Column:
    """Lower-cased text between scheme and first slash; port and user stay."""
    return F.split_part(F.regexp_replace(F.lower(F.trim(url)), "^https?://", ""), F.lit("/"), F.lit(1))


def hostname(url: Column) -> Column:
    """Lower-cased host without user and port; surrounding dots, and the brackets of an IPv6 address, go. parse_url() loses hosts with
    underscores."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.trim(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?(\[[^\]]*\]|[^:/?#]*)", 1)), r"^[.\[]+|[.\]]+$", "")


def labels(host: Column) -> Column:
    return F.filter(F.split(host, r"\."), lambda x: x != "")


def registrable(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The last label before the public suffix with that suffix; hosts of one label stay."""
    parts = labels(host)
    n = F.size(parts)
    last2 = F.array_join(F.slice(parts, F.greatest(n - 1, F.lit(1)), F.lit(2)), ".")
    last3 = F.array_join(F.slice(parts, F.greatest(n - 2, F.lit(1)), F.lit(3)), ".")
    return F.when(last2.isin(*suffixes), last3).otherwise(last2)


def words(host: Column) -> Column:
    """Alphanumeric runs of a host."""
    return F.filter(F.split(F.lower(host), "[^a-z0-9]+"), lambda x: x != "")


def flat(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), "[^a-z0-9]+", "")


def entropy(text: Column) -> Column:
    """Shannon entropy of a text's characters in bits."""
    chars, n = F.split(text, ""), F.length(text).cast("double")

    def add(acc: Column, c: Column) -> Column:
        p = F.size(F.filter(chars, lambda x: x == c)) / n
        return acc - p * F.log2(p)

    return F.when(F.length(text) == 0, 0.0).otherwise(F.aggregate(F.array_sort(F.array_distinct(chars)), F.lit(0.0), add))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*?://[^/?#]*([^?#]*)", 1)


def deceptive_embedding(host: Column, legit: Column) -> Column:
    """Whether the labels of `legit` stand inside `host`, but not at its end."""
    return F.contains(host, F.lit(".")) & F.contains(F.concat(F.lit("."), host, F.lit(".")), F.concat(F.lit("."), legit, F.lit("."))) & ~F.endswith(F.concat(F.lit("."), host), F.concat(F.lit("."), legit))
