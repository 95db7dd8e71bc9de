"""Brands in texts and hosts: tokens, skeletons, alignment and spoofing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions import urls
from vigil.functions.similarity import indel_ratio_udf, nfkc
from vigil.operators.lexical import small

#: Words that name a service or a kind of organisation, not a brand, and aliases too common to prove anything.
SERVICES = "mail cloud contents corp home homeloans loan loans login portal secure account service bank retail".split()
DOMAIN_PARTS = "com in gov org co net www io xyz app site online shop store info live club dev ai bank".split()
KINDS = "authority board centre center commission committee corporation council department directorate government india indian limited ltd ministry mission national office official online portal private public service services state states union".split()
COMMON_ALIASES = ("axis", "cloud", "mail", "myvi", "nic")
#: Letters and digits that look like others, and what they stand for.
CONFUSABLE = "аοеіѕрсυν０１５６７８９@$013578"
STANDS_FOR = "aoeispcuv0156789as" + "olestb"


def skeleton(label: Column) -> Column:
    """A label with look-alike characters replaced, after compatibility normalisation."""
    return F.translate(nfkc(F.lower(F.coalesce(label, F.lit("")))), CONFUSABLE, STANDS_FOR)


def skeleton_url(url: Column) -> Column:
    """A URL, with scheme, in which look-alike characters of Latin letters and digits are replaced."""
    low = F.lower(F.trim(url))
    full = F.when(low.rlike("^https?://"), low).otherwise(F.concat(F.lit("https://"), low))
    return F.when(low == "", "").otherwise(F.translate(nfkc(full), "аοеіѕрсυν1035@", "aoeispcuv" + "loes" + "a"))


def generic(token: Column) -> Column:
    return token.isin(*sorted({*SERVICES, *DOMAIN_PARTS}))


def page_tokens(text: Column) -> Column:
    """The distinct words of a text that could name a brand."""
    words = F.split(F.lower(F.trim(F.coalesce(text, F.lit("")))), "[^a-z0-9]+")
    return F.array_distinct(F.filter(words, lambda w: (F.length(w) > 2) & ~generic(w)))


def name_tokens(name: Column) -> Column:
    """The words of an entity's name without those that only say what kind of organisation it is."""
    return F.array_except(page_tokens(name), F.array(*map(F.lit, KINDS)))


def host_tokens(host: Column) -> Column:
    """The parts of a host that could name a brand, and its main label."""
    parts = F.filter(F.split(F.lower(F.coalesce(host, F.lit(""))), "[^a-z0-9]+"), lambda w: (F.length(w) > 2) & ~generic(w))
    label = F.split_part(urls.registrable(F.lower(F.coalesce(host, F.lit("")))), F.lit("."), F.lit(1))
    main = F.when((F.length(label) > 2) & ~generic(label), F.array(label)).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.array_union(parts, main))


def aligned(page: Column, hosts: Sequence[Column], name: Column, brands: Column, keywords: Column) -> Column:
    """How many words of a page and of the hosts it led to belong to an entity: its brand tokens, its name, its keywords."""
    surface = page_tokens(page)
    for h in hosts:
        surface = F.array_union(surface, host_tokens(h))
    own = F.array_union(F.array_union(F.filter(brands, lambda b: ~generic(b)), name_tokens(name)), F.array_distinct(F.flatten(F.transform(keywords, page_tokens))))
    return F.size(F.array_intersect(surface, own))


def signature(host: Column) -> Column:
    """What of a legitimate host would be embedded elsewhere: its registrable domain, unless that is all generic."""
    registered = urls.registrable(host)
    return F.when(F.exists(urls.labels(registered), lambda x: ~generic(x)), registered).otherwise(host)


def deceptive(final: Column, legitimate: Column) -> Column:
    """Whether a host holds the labels of a legitimate one, but not at its end, under another registrable domain."""
    own = signature(legitimate)
    inside = F.contains(F.concat(F.lit("."), final, F.lit(".")), F.concat(F.lit("."), own, F.lit(".")))
    # an occurrence that isn't the end: the host with its last label cut off still holds it
    cut = F.regexp_replace(final, r"\.[^.]*$", "")
    early = F.contains(F.concat(F.lit("."), cut, F.lit(".")), F.concat(F.lit("."), own, F.lit(".")))
    return (final != "") & (legitimate != "") & (urls.registrable(final) != urls.registrable(legitimate)) & inside & early


def typosquat(a: DataFrame, left: str, right: str, out: str) -> DataFrame:
    """a with the similarity (0 to 1) of two hosts with look-alikes resolved: of main labels, or of all before the suffix; a common suffix
    adds 0.03. Pairs are compared in Arrow batches."""
    reg = lambda c: urls.registrable(F.col(c))
    label = lambda c: F.split_part(reg(c), F.lit("."), F.lit(1))
    suffix = lambda c: F.expr("null") if False else F.substring(reg(c), F.length(label(c)) + 2, F.length(reg(c)))
    front = lambda c: F.when(suffix(c) != "", F.substring(F.col(c), F.lit(1), F.length(F.col(c)) - F.length(suffix(c)) - 1)).otherwise(F.col(c))
    rows = a.withColumns({"__p": skeleton(label(left)), "__q": skeleton(label(right)), "__x": skeleton(front(left)), "__y": skeleton(front(right)), "__same": (suffix(left) != "") & (suffix(left) == suffix(right))})
    best = F.greatest(indel_ratio_udf("__p", "__q"), indel_ratio_udf("__x", "__y")) / 100.0
    score = F.when((F.col("__p") == "") | (F.col("__q") == ""), 0.0).when(F.col("__p") == F.col("__q"), 1.0).when(F.col("__same"), F.least(F.lit(1.0), best + 0.03)).otherwise(best)
    return rows.withColumn(out, score).drop("__p", "__q", "__x", "__y", "__same")


def normalised(text: Column) -> Column:
    """Lower-cased words between single blanks."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " "))


def expanded(aliases: Column) -> Column:
    """Aliases as words, and without the blanks between them."""
    words = F.filter(F.transform(aliases, normalised), lambda x: x != "")
    return F.array_distinct(F.concat(words, F.transform(words, lambda x: F.replace(x, F.lit(" "), F.lit("")))))


def catalogue(brands: DataFrame) -> DataFrame:
    """brands(brand, aliases, spoof_aliases, domains) with the aliases expanded; those that prove nothing don't count as spoofing."""
    return brands.select("brand", expanded(F.col("aliases")).alias("aliases"), F.array_except(expanded(F.col("spoof_aliases")), F.array(*map(F.lit, COMMON_ALIASES))).alias("spoof_aliases"), "domains")


def of_family(domain: Column, family: Column) -> Column:
    return F.exists(family, lambda d: (domain == d) | F.endswith(domain, F.concat(F.lit("."), d)))


def shortlisted_brand(rows: DataFrame, brands: DataFrame) -> DataFrame:
    """rows(id, cse, cse_domain) with shortlist_brand, the brand that an entity's domain (the longest match) or name stands for."""
    name = normalised(F.col("cse"))
    compact = F.replace(name, F.lit(" "), F.lit(""))
    domain = F.lower(F.trim(F.coalesce("cse_domain", F.lit(""))))
    by_domain = F.array_max(F.transform(F.filter("domains", lambda d: (domain == d) | F.endswith(domain, F.concat(F.lit("."), d))), lambda d: F.length(d)))
    by_name = F.when((name != "") & (F.array_contains("aliases", name) | F.array_contains("aliases", compact)), F.greatest(F.length(name), F.length(compact)))
    pairs = rows.select("id", "cse", "cse_domain").join(small(brands), how="cross").withColumn("points", F.greatest(by_domain, by_name)).where("points IS NOT NULL")
    best = pairs.groupBy("id").agg(F.max_by("brand", F.struct("points", F.lit(0))).alias("shortlist_brand"))
    return rows.join(best, "id", "left")


def consistency(rows: DataFrame, brands: DataFrame) -> DataFrame:
    """(id, detected, detected_brand, domain_match, spoofed, surface, alias) for rows(id, domain, header, full, html, cse, cse_domain).

    The brand whose longest alias stands in the text best: first one that agrees with the shortlisted brand, then in the header, in
    all recognised text, in the page's text, then by the alias' length. It is spoofed if an alias that proves something
    stands in recognised text, the brand agrees with the shortlisted one, and the page's domain isn't of its family.
    Every text meets every brand: the catalogue is small, which is checked.
    """
    known = shortlisted_brand(rows, brands)
    surfaces = F.array(*[F.struct(F.lit(n).alias("surface"), normalised(F.col(c)).alias("words"), F.lit(s).alias("shows"), F.lit(p).alias("priority")) for n, c, s, p in (("ocr_header_footer", "header", True, 3), ("ocr_full", "full", True, 2), ("html", "html", False, 1))])
    longest = lambda c: F.array_max(F.transform(F.filter(c, lambda a: F.contains(F.col("words"), a)), lambda a: F.struct(F.length(a).alias("n"), a.alias("alias"))))
    pairs = known.select("id", "domain", "shortlist_brand", F.inline(surfaces)).where("words <> ''").join(small(brands), how="cross").withColumn("hit", longest("aliases")).where("hit IS NOT NULL")
    agrees = F.when(F.col("shortlist_brand").isNull() | (F.col("brand") == F.col("shortlist_brand")), 1).otherwise(0)
    judged = pairs.withColumn("agrees", agrees).withColumn("own", of_family(F.col("domain"), F.col("domains"))).withColumn("spoof", F.when(F.col("shows"), longest(F.filter("spoof_aliases", lambda a: F.array_contains(F.col("aliases"), a)))))
    rank = lambda h: F.struct("agrees", "priority", F.col(f"{h}.n"), F.col(f"{h}.alias"), "brand", "surface", "own")
    best = judged.groupBy("id").agg(F.max(rank("hit")).alias("best"), F.max(F.when(F.col("spoof").isNotNull(), rank("spoof"))).alias("worst"))
    wrong = F.coalesce((F.col("worst.agrees") == 1) & ~F.col("worst.own"), F.lit(False))
    return rows.select("id").join(best, "id", "left").select(
        "id", F.col("best").isNotNull().alias("detected"), F.coalesce("best.brand", F.lit("none")).alias("detected_brand"), F.coalesce("best.own", F.lit(False)).alias("domain_match"), wrong.alias("spoofed"),
        F.coalesce("worst.surface", "best.surface", F.lit("none")).alias("surface"), F.coalesce("worst.alias", "best.alias", F.lit("")).alias("alias"),
    )
