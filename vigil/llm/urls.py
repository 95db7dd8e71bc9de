"""URL filters as a cascade of Bloom filters, in DataFrame operations only."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import tables

#: (host, path, verdict) of the production filter.
RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))
#: Bits of all levels of a cascade at most: what a filter adds to each task is 8 MB at most.
MOST_BITS = 1 << 26
SEP = "\x00"


def with_parts(df: DataFrame, url_col: str) -> DataFrame:
    """df with __host and __path: the host is what follows the first '://' up to '/', '?', '#' or the end, with A-Z lower-cased;
    the path is what follows up to '?', '#' or the end. Both are empty for null and where there is no '://'."""
    rest = F.when(F.col(url_col).contains("://"), F.substring(F.col(url_col), F.locate("://", F.col(url_col)) + 3, F.length(url_col))).otherwise("")
    host = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*", 0)
    tail = F.substring(F.coalesce(rest, F.lit("")), F.length(host) + 1, F.length(url_col))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return df.withColumn("__host", F.translate(host, upper, lower)).withColumn("__path", F.coalesce(F.regexp_extract(tail, r"^[^?#]*", 0), F.lit("")))


def candidates(host: Column, path: Column, lengths: list[int]) -> Column:
    """The rules that could fit a host and path: each suffix of the host at a dot, with each prefix of the path of a length
    that some rule's path has; the longest rule first, and of equally long ones that with the longer host."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    hosts = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n - i + 1), "."))
    keys = F.flatten(F.transform(hosts, lambda h: F.array(*[F.when(F.length(path) >= m, F.struct((F.length(h) + m).alias("n"), F.length(h).alias("h"), F.concat(h, F.lit(SEP), F.substring(path, 1, m)).alias("key"))) for m in lengths])))
    return F.reverse(F.array_sort(F.array_compact(keys)))


class Level:
    """A Bloom filter: the set bits of `bits`, as 64-bit words in a literal array. MOST_BITS hold about a million keys at the lowest rate."""

    def __init__(self, spark: SparkSession, keys: DataFrame | list[str], n: int, rate: float, salt: int):
        self.probes = max(1, round(-math.log2(rate)))
        self.bits = max(64, 64 * math.ceil(n * -math.log(rate) / math.log(2) ** 2 / 64))
        if self.bits > MOST_BITS:
            raise ValueError(f"a level for {n} keys needs {self.bits} bits, more than {MOST_BITS}")
        self.salt = salt
        words = [0] * (self.bits // 64)
        # at most n * probes bits, and n is bounded by the rules and by the level before
        for r in keys.select(F.explode(self.places(F.col("key"))).alias("b")).distinct().toLocalIterator():
            words[r.b // 64] |= 1 << (r.b % 64)
        self.words = [w - (1 << 64) if w >> 63 else w for w in words]

    def places(self, key: Column) -> Column:
        """Double hashing: probe i is at h1 + i * h2."""
        h1, h2 = F.xxhash64(key, F.lit(2 * self.salt)), F.xxhash64(key, F.lit(2 * self.salt + 1))
        return F.array(*[F.pmod(F.shiftright(h1, 8) + F.lit(i) * F.shiftright(h2, 8), F.lit(self.bits)) for i in range(self.probes)])

    def has(self, key: Column) -> Column:
        table = F.array(*[F.lit(w) for w in self.words]) if len(self.words) <= 64 else F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        place = self.places(key)
        out = F.lit(True)
        for i in range(self.probes):
            word = F.element_at(table, (F.floor(place[i] / 64) + 1).cast("int"))
            out = out & (F.call_function("getbit", word, (place[i] % 64).cast("int")) == 1)
        return out


class Cascade:
    """Exact membership of a set over a known universe of keys, from Bloom filters alone.

    Level 0 holds the listed keys; level 1 the keys of the universe that level 0 takes for listed; level 2 the listed keys
    that level 1 takes for those; and so on until a level has no false positive. A key is listed if the first level
    that lacks it is an odd one. The rate of level 0 is set so that its false positives are about as many as the
    listed keys; each further level halves its input, so all levels together are in proportion to the list times
    the logarithm of the universe, whatever the corpus holds.
    """

    def __init__(self, spark: SparkSession, listed: DataFrame, n_listed: int, universe: DataFrame, n_universe: int):
        """listed: distinct `key`, n_listed of them. universe: `key`, may hold repeats and listed keys; n_universe: an upper
        bound of its distinct keys, used for the rate only."""
        self.levels: list[Level] = []
        if not n_listed:
            return
        mine = [r.key for r in listed.toLocalIterator()]
        # a level's false positives are about as many as the listed keys; where keys are repeated so unevenly that they are many more, at a lower rate
        rate, most = min(0.5, max(1e-9, n_listed / max(1, n_universe) / 2)), max(1000, 64 * n_listed)
        while True:
            first = Level(spark, listed, n_listed, rate, 0)
            # the only pass over the corpus: which of its keys level 0 takes for listed
            hits = universe.where(first.has(F.col("key"))).select("key").distinct().limit(most + n_listed + 1).collect()
            if len(hits) <= most + n_listed:
                break
            rate /= 64
        self.levels.append(first)
        wrong = sorted({r.key for r in hits} - set(mine))
        now, other = wrong, mine
        while now:
            keys = self.frame(spark, now)
            level = Level(spark, keys, len(now), 0.5 / max(1.0, len(other) / len(now)), len(self.levels))
            self.levels.append(level)
            taken = {r.key for r in self.frame(spark, other).where(level.has(F.col("key"))).toLocalIterator()}
            now, other = [k for k in other if k in taken], now

    @staticmethod
    def frame(spark: SparkSession, keys: list[str]) -> DataFrame:
        return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(keys)), "array<string>")).alias("key"))

    def has(self, key: Column) -> Column:
        out = F.lit(len(self.levels) % 2 == 1)
        for i, level in reversed(list(enumerate(self.levels))):
            out = F.when(~level.has(key), F.lit(i % 2 == 1)).otherwise(out)
        return out


def judge(pages: DataFrame, rules=RULES, *, url_col: str = "url", default: str = "allow") -> DataFrame:
    """pages with host, path, rule and verdict ('allow' or 'block').

    A rule (host, path, verdict) fits a URL of its host or a subdomain whose path starts with the rule's; the longest
    wins (host and path together; then the longer host). Without a rule the verdict is `default`.

    One cascade tells the rules among all (host suffix, path prefix) keys of the corpus, one the blocking rules among all
    rules; both are exact over every key asked for, so a URL is judged from the filters' bits in its own row, without a
    join or a shuffle. Building takes one pass over the corpus, for the first level's false positives.

    Null URLs and those without '://' have an empty host and path, and no rule. A URL of any length is judged whole; a host has as many
    keys as labels times lengths of the rules' paths. Repeated rows are judged alike; no rows give
    no rows; columns of pages stay, those named host, path, rule or verdict are replaced.
    """
    spark = pages.sparkSession
    base = with_parts(pages.drop("host", "path", "rule", "verdict"), url_col)
    listed = {f"{h}{SEP}{p}": v for h, p, v in rules}
    if not listed:
        return base.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default)).withColumnsRenamed({"__host": "host", "__path": "path"})
    lengths = sorted({len(p) for _, p, _ in rules})
    keyed = base.withColumn("__keys", F.transform(candidates(F.col("__host"), F.col("__path"), lengths), lambda x: x["key"]))
    universe = keyed.select(F.explode("__keys").alias("key"))
    n = universe.select(F.approx_count_distinct("key")).first()[0]
    blocked = [k for k, v in listed.items() if v == "block"]
    is_rule = Cascade(spark, Cascade.frame(spark, list(listed)), len(listed), universe, n)
    is_block = Cascade(spark, Cascade.frame(spark, blocked), len(blocked), Cascade.frame(spark, list(listed)), len(listed)) if blocked else None
    hit = keyed.withColumn("__rule", F.get(F.filter("__keys", is_rule.has), F.lit(0)))
    verdict = F.when(F.col("__rule").isNull(), F.lit(default)).when(is_block.has(F.col("__rule")) if is_block else F.lit(False), F.lit("block")).otherwise("allow")
    return hit.withColumn("rule", F.translate("__rule", SEP, "")).withColumn("verdict", verdict).withColumnsRenamed({"__host": "host", "__path": "path"}).drop("__keys", "__rule")


def op10(spark, sf_dir: str) -> DataFrame:
    return judge(tables(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


SQL = r"""
WITH rules(h, p, v) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
rest AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
hosts AS (SELECT page_id, r, regexp_extract(r, '^[^/?#]*') AS h0 FROM rest),
parts AS (SELECT page_id, translate(h0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(r, length(h0) + 1), '^[^?#]*') AS path FROM hosts),
hits AS (
  SELECT a.page_id, a.host, a.path, h || p AS rule, v,
         row_number() OVER (PARTITION BY a.page_id ORDER BY length(h || p) DESC NULLS LAST, length(h) DESC NULLS LAST) AS k
  FROM parts a LEFT JOIN rules ON (a.host = h OR ends_with(a.host, '.' || h)) AND starts_with(a.path, p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM hits WHERE k = 1
"""
