"""Keys, 64-bit SimHash and Hamming distance without Python."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def record_key(url: Column, workbook: Column) -> Column:
    return F.sha1(F.concat(F.lower(F.trim(url)), F.lit("|"), F.trim(workbook)).cast("binary"))


def plain_hex(value: Column) -> Column:
    """A hash as lower-case hex digits without 0x; null if it isn't up to 16 of them."""
    text = F.regexp_replace(F.lower(F.trim(value.cast("string"))), "^0x", "")
    return F.when(text.rlike("^[0-9a-f]{1,16}$"), text)


def bits(value: Column) -> Column:
    """Up to 64 bits of hex digits as a long; null if it isn't that."""
    return F.conv(plain_hex(value), 16, -10).cast("long")


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def similarity(distance_: Column) -> Column:
    """1 less the share of bits that differ; 0 where there is no distance."""
    return F.coalesce(1 - distance_ / 64.0, F.lit(0.0))


def image_distance(a: Column, b: Column) -> Column:
    """Bits in which two image hashes differ; infinite where one isn't valid."""
    return F.coalesce(distance(bits(a), bits(b)).cast("double"), F.lit(float("inf")))


def best_of_set(value: Column, references: Column) -> Column:
    """struct(distance, similarity) of the reference nearest to a hash; of references that aren't valid, or none, null and 0."""
    found = F.array_min(F.filter(F.transform(references, lambda r: distance(bits(value), bits(r))), lambda d: d.isNotNull()))
    return F.struct(found.alias("distance"), similarity(found).alias("similarity"))


def reference_arrays(value: Column, sets: Column, hit: int, anchor: int) -> Column:
    """For each of an array of reference sets: struct(distance, similarity, hit, anchor); without a valid reference 64, 0 and false."""

    def one(references: Column) -> Column:
        best = best_of_set(value, references)
        return F.struct(F.coalesce(best["distance"], F.lit(64)).alias("distance"), best["similarity"].alias("similarity"), F.coalesce(best["distance"] <= hit, F.lit(False)).alias("hit"), F.coalesce(best["distance"] <= anchor, F.lit(False)).alias("anchor"))

    return F.transform(sets, one)


def features(text: Column, mode: str) -> Column:
    """What a SimHash of a text counts, as an array with repeats: its words, or the runs of 3 or 5 characters of '^text$'."""
    low = F.lower(F.trim(F.coalesce(text, F.lit(""))))
    if mode == "word":
        return F.regexp_extract_all(low, F.lit("([a-z0-9]+)"), F.lit(1))
    k = {"char3": 3, "char5": 5}[mode]
    padded = F.concat(F.lit("^"), low, F.lit("$"))
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - k + 1, F.lit(1))), lambda i: F.substring(padded, i, F.lit(k)))
    return F.when(low == "", F.array().cast("array<string>")).otherwise(runs)


def simhash_of(counted: Column) -> Column:
    """SimHash of an array of features with repeats, without a shuffle: for short texts. Null without features."""
    halves = F.transform(counted, lambda f: F.struct(F.conv(F.substring(F.sha2(f.cast("binary"), 256), 1, 8), 16, 10).cast("long").alias("hi"), F.conv(F.substring(F.sha2(f.cast("binary"), 256), 9, 8), 16, 10).cast("long").alias("lo")))
    bit = lambda h, i: F.when(i < 32, F.call_function("shiftright", h["hi"], 31 - i)).otherwise(F.call_function("shiftright", h["lo"], 63 - i)).bitwiseAND(F.lit(1)).cast("int")
    ones = F.aggregate(halves, F.array_repeat(F.lit(0), 64), lambda acc, h: F.transform(acc, lambda n, i: n + bit(h, i)))
    digits = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda d: F.substring(F.lit("0123456789abcdef"), 1 + sum((F.when(2 * F.get(ones, 4 * d + j) >= F.size(counted), 1 << (3 - j)).otherwise(0) for j in range(4)), F.lit(0)), F.lit(1)))
    return F.when(F.size(counted) > 0, F.array_join(digits, ""))


def domain_simhash(domain: Column) -> Column:
    """SimHash of a domain's letters, digits, dots and hyphens by runs of three characters; null where there are none."""
    clean = F.regexp_replace(F.lower(F.trim(F.coalesce(domain, F.lit("")))), "[^a-z0-9.-]+", "")
    return F.when(clean != "", simhash_of(features(clean, "char3")))


def certificate_identity(subject: Column, issuer: Column, names: Column) -> Column:
    """The names in a certificate as one text: subject and issuer, arrays of (key, value), and names, an array of (kind, value).

    Lower-cased common names and organisations, then the DNS names, each sorted and distinct; parts without any go.
    """
    low = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    of = lambda entries, key: F.array_sort(F.array_distinct(F.filter(F.transform(F.filter(entries, lambda e: low(e["key"]) == key), lambda e: low(e["value"])), lambda v: v != "")))
    dns = F.array_sort(F.array_distinct(F.filter(F.transform(F.filter(names, lambda e: low(e["kind"]) == "dns"), lambda e: low(e["value"])), lambda v: v != "")))
    parts = [("subject_cn", of(subject, "commonname")), ("subject_o", of(subject, "organizationname")), ("issuer_cn", of(issuer, "commonname")), ("issuer_o", of(issuer, "organizationname")), ("san", dns)]
    return F.array_join(F.array_compact(F.array(*[F.when(F.size(v) > 0, F.concat(F.lit(f"{n}="), F.array_join(v, "|"))) for n, v in parts])), "||")


def certificate_simhash(subject: Column, issuer: Column, names: Column) -> Column:
    return simhash_of(features(certificate_identity(subject, issuer, names), "word"))


def simhash64(features_: DataFrame, key: str, feature: str) -> DataFrame:
    """(key, simhash) from a row for each feature: each bit by the sign of the features' weighted votes, ties to 1. A key with null
    features only has a null hash.

    Votes are counted with partial aggregation, two bits in each of 32 sums, so a key of any size, or a frequent feature, meets in
    no single task. A sum holds 2^31 features of a key.
    """
    digest = F.sha2(F.col(feature).cast("binary"), 256)
    halves = features_.select(key, feature, F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").alias("hi"), F.conv(F.substring(digest, 9, 8), 16, 10).cast("long").alias("lo"))
    both = lambda bit: F.shiftright("hi", bit).bitwiseAND(F.lit(1)) + F.shiftleft(F.shiftright("lo", bit).bitwiseAND(F.lit(1)), 32)
    votes = halves.groupBy(key).agg(F.count(feature).alias("n"), *[F.sum(both(b)).alias(f"v{b}") for b in range(31, -1, -1)])
    ones = {"hi": lambda b: F.col(f"v{b}").bitwiseAND(F.lit((1 << 32) - 1)), "lo": lambda b: F.shiftright(f"v{b}", 32)}
    text = F.concat(*[F.when(2 * ones[h](b) >= F.col("n"), "1").otherwise("0") for h in ("hi", "lo") for b in range(31, -1, -1)])
    return votes.select(key, F.when(F.col("n") > 0, F.lower(F.lpad(F.conv(text, 2, 16), 16, "0"))).alias("simhash"))
