"""Lexical matching of hosts against protected entities: similarity, brand tokens, risk keywords, the gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.functions import urls
from vigil.functions.similarity import best_of_list, jaro_winkler_udf

#: Keywords of credential pages, and what short brand names are followed by.
RISK_KEYWORDS = ("login", "secure", "verify", "update", "account", "wallet", "signin")
SUFFIX_HINTS = (
    "account", "bank", "card", "cards", "gov", "kyc", "login", "netbanking", "online", "pay", "payment", "payments", "portal",
    "reward", "rewards", "secure", "service", "sewa", "upi", "verification", "verify", "wallet",
)
#: Words that name no brand.
GENERIC_TOKENS = """
account accounts api auth authority bank books branch care card cards centre center census co cloud com computer contents content
corp corporate corporation dev department digital direct education election exam exams express finance financial foundation fund
funds gov group help home health homeloans in identification india indian insurance institute informatics intranet invest
investment kerala language life library limited load login mail management market medical mf mutual national net nic official
online org payments portal prod research reserve registration retail sciences securelogin service services shop space state
support secure signin store system systems test tourism tracker uat unique update verify wallet web bharat coal catering civil
first income punjab rajasthan railway chandigarh odisha assam gujarat maharashtra tamilnadu karnataka telangana andhra bihar delhi
haryana westbengal bengal organisation organization board commission agency committee council ministry bhavan cats sac sedal pord
sparrow
""".split()
SAME_DOMAIN, FUZZY_BRAND, LEAST_SCORE, PASSING, FALLBACK = 0.93, 0.93, 40, 0.85, 10
#: Rows of the entity tables that are broadcast at most; a row is a name and a domain.
MOST_ENTITIES = 100_000


def entities(spark: SparkSession, rows: list[tuple[int, str, list[str]]]) -> DataFrame:
    """(idx, entity, domains) from a catalogue that is given with the query."""
    return spark.createDataFrame(rows, "idx int, entity string, domains array<string>")


def small(entity: DataFrame) -> DataFrame:
    """A broadcast of the catalogue, if it is as small as it should be; else it is joined by shuffle."""
    return F.broadcast(entity) if entity.limit(MOST_ENTITIES + 1).count() <= MOST_ENTITIES else entity


def brand_index(entity: DataFrame) -> DataFrame:
    """(idx, token): an entity's brand tokens, which are the first labels of its registrable domains (three letters at least),
    abbreviations in brackets in its name (three) and the name's words (four), without generic ones."""
    name = F.coalesce("entity", F.lit(""))
    label = lambda d: F.split_part(urls.registrable(urls.hostname(d)), F.lit("."), F.lit(1))
    kinds = (
        (F.transform(F.coalesce("domains", F.array().cast("array<string>")), label), 3),
        (F.regexp_extract_all(name, F.lit(r"\(([A-Za-z0-9]{2,})\)"), F.lit(1)), 3),
        (F.regexp_extract_all(F.lower(name), F.lit("([a-z0-9]{3,})"), F.lit(1)), 4),
    )

    def of_length(found: Column, least: int) -> Column:
        return F.filter(F.transform(found, urls.flat), lambda x: F.length(x) >= least)

    every = F.concat(*[of_length(found, least) for found, least in kinds])
    return entity.select("idx", F.explode(F.array_except(every, F.array(*map(F.lit, GENERIC_TOKENS)))).alias("token"))


def token_rule(part: Column, token: Column, others: Column) -> Column:
    """Whether a part of a label shows a brand token. Long tokens (over four) match a part that begins or ends with them; short
    ones match with a keyword or hint behind them, or as a whole part if another part begins with one."""
    hints = tuple(sorted({*RISK_KEYWORDS, *SUFFIX_HINTS}))
    begins = f"^({'|'.join(hints)})"
    long = F.length(token) > 4
    rest = F.substring(part, F.length(token) + 1, F.length(part))
    return F.when(long, F.startswith(part, token) | F.endswith(part, token)).when(part == token, F.exists(others, lambda o: o.rlike(begins))).otherwise(F.startswith(part, token) & rest.rlike(begins))


def first_label(host: Column) -> Column:
    """The first label of a host's registrable domain, which is what brand tokens are looked for in."""
    return F.split_part(urls.registrable(host), F.lit("."), F.lit(1))


def brand_hits(hosts: DataFrame, tokens: DataFrame) -> DataFrame:
    """(host, idx, hits): the tokens(idx, token) of each entity that a host's label shows, for pairs with at least one.

    Hits are found by distinct label and token, and fanned out to the entities that have the token.
    """
    parts = hosts.select("host", urls.words(first_label(F.col("host"))).alias("parts"))
    one = parts.select("host", "parts", F.posexplode("parts").alias("i", "part")).withColumn("others", F.filter("parts", lambda x, i: i != F.col("i")))
    shown = one.join(small(tokens.select("token").distinct()), token_rule(F.col("part"), F.col("token"), F.col("others"))).select("host", "token").distinct()
    return shown.join(small(tokens), "token").groupBy("host", "idx").agg(F.array_sort(F.collect_set("token")).alias("hits"))


def length_part(label: Column) -> Column:
    n = F.length(label)
    return F.when(n <= 8, 4).when(n <= 14, 10).when(n <= 20, 18).otherwise(25)


def similar_domains(hosts: DataFrame, entity: DataFrame) -> DataFrame:
    """(host, idx, similarity, domain): for each entity its domain that is most similar to the host; of equal ones the first."""
    listed = entity.select("idx", F.posexplode("domains").alias("pos", "domain"))
    pairs = hosts.select("host").join(small(listed.select("domain").distinct()), how="cross").withColumn("similarity", jaro_winkler_udf("host", "domain"))
    best = F.max(F.struct("similarity", (-F.col("pos")).alias("pos"), "domain"))
    return pairs.join(small(listed), "domain").groupBy("host", "idx").agg(best.alias("m")).select("host", "idx", "m.similarity", F.when(F.col("m.similarity") > 0, F.col("m.domain")).otherwise("").alias("domain"))


def scored(hosts: DataFrame, entity: DataFrame) -> DataFrame:
    """For each of hosts(host) and entities: host, idx, entity, domain, similarity, keyword_sim, n_hits, hits, total, lexical_score,
    evidence, rule_hit, n_risk.

    Every host meets every entity, with its lists of domains and tokens: the catalogue is small and broadcast, and hosts are distinct
    before this, so that this is one pass without a shuffle.
    """
    hints = tuple(sorted({*RISK_KEYWORDS, *SUFFIX_HINTS}))
    tokens = brand_index(entity).groupBy("idx").agg(F.array_sort(F.collect_list("token")).alias("tokens"))
    none = F.array().cast("array<string>")
    catalogue = entity.join(tokens, "idx", "left").select("idx", "entity", F.coalesce("domains", none).alias("domains"), F.coalesce("tokens", none).alias("tokens"))
    parts = urls.words(F.col("label"))
    profile = (
        hosts.select("host")
        .withColumn("label", first_label(F.col("host")))
        .withColumn("flat", urls.flat(F.col("label")))
        .withColumn("risks", F.filter(F.array(*map(F.lit, hints)), lambda k: F.contains(F.col("flat"), k)))
        .withColumn("n_risk", F.size("risks"))
        .withColumn("parts", parts)
        .withColumn("cases", F.transform("parts", lambda p, i: F.struct(p.alias("part"), F.filter("parts", lambda x, j: j != i).alias("others"))))
    )
    joined = (
        profile.join(small(catalogue), how="cross")
        .withColumn("own", best_of_list()("host", "domains"))
        .withColumn("key", best_of_list(6)("flat", "tokens"))
        .withColumn("similarity", F.col("own.similarity"))
        .withColumn("domain", F.coalesce(F.get("domains", F.col("own.place")), F.lit("")))
        .withColumn("keyword_sim", F.col("key.similarity"))
        .withColumn("hits", F.filter("tokens", lambda t: F.exists("cases", lambda c: token_rule(c["part"], t, c["others"]))))
        .withColumn("n_hits", F.size("hits"))
    )
    fuzzy = (F.col("n_risk") > 0) & (F.col("keyword_sim") >= FUZZY_BRAND)
    evidence = (F.col("n_hits") > 0) | fuzzy
    entropy_part = F.least(F.greatest(urls.entropy(F.col("label")) / 4.5 * 25, F.lit(0.0)), F.lit(25.0))
    points = (
        F.when(evidence, 0.35 * length_part(F.col("label")) + 0.35 * entropy_part).otherwise(0.0)
        + F.when(evidence & (F.col("n_risk") > 0), F.least(F.lit(12), 6 + 3 * (F.col("n_risk") - 1))).otherwise(0)
        + F.when(F.col("n_hits") > 0, F.least(F.lit(32), 18 + 6 * (F.col("n_hits") - 1))).when(fuzzy, 12).otherwise(0)
        + F.least(F.lit(25.0), 25 * F.col("keyword_sim"))
    )
    total = F.least(F.greatest(F.bround(points, 0), F.lit(0.0)), F.lit(100.0)).cast("int")
    return (
        joined.withColumn("evidence", evidence)
        .withColumn("total", total)
        .withColumn("lexical_score", F.greatest("similarity", F.col("total") / 100.0))
        .withColumn("rule_hit", (F.col("similarity") >= SAME_DOMAIN) | ((F.col("total") >= LEAST_SCORE) & F.col("evidence")))
        .select("host", "idx", "entity", "domain", "similarity", "keyword_sim", "n_hits", "hits", "total", "lexical_score", "evidence", "rule_hit", "n_risk")
    )


def candidates(scores: DataFrame, k: int = FALLBACK) -> DataFrame:
    """scores of a host's candidate entities with fallback: those with a rule hit, or where there is none, the k of greatest lexical
    score (of equal ones the greatest idx), as fallback only."""
    ranked = scores.withColumn("any_hit", F.max("rule_hit").over(Window.partitionBy("host"))).withColumn("r", F.row_number().over(Window.partitionBy("host").orderBy(F.desc("lexical_score"), F.desc("idx"))))
    return ranked.where(F.col("rule_hit") | (~F.col("any_hit") & (F.col("r") <= k))).withColumn("fallback", ~F.col("any_hit")).drop("any_hit", "r")


def gate(scores: DataFrame, floor: float = PASSING, k: int = FALLBACK) -> DataFrame:
    """Per host the best candidate entity (greatest lexical score, then least idx), its label, risk band and whether it passes.

    A host passes with a strict hit, or with a score at the floor that isn't the rank of a fallback alone.
    """
    top = candidates(scores, k).withColumn("r", F.row_number().over(Window.partitionBy("host").orderBy(F.desc("lexical_score"), "idx"))).where("r = 1")
    strict = F.col("rule_hit")
    fallback_only = F.col("fallback") & ~strict
    passed = (F.col("lexical_score") >= floor) & ~fallback_only
    return top.select(
        "host", "entity", "domain", F.round("similarity", 6).alias("similarity"), F.round("keyword_sim", 6).alias("keyword_sim"), F.round("lexical_score", 6).alias("lexical_score"), "total", F.array_join("hits", "|").alias("brand_hits"),
        F.when(F.col("similarity") >= SAME_DOMAIN, "whitelist_similarity_match").when((F.col("total") >= LEAST_SCORE) & F.col("evidence"), "score_threshold_match").otherwise("no_match").alias("match_reason"),
        F.when(F.col("total") >= 70, "high").when(F.col("total") >= 40, "medium").otherwise("low").alias("risk"),
        (strict & F.col("evidence")).alias("brand_token_hit"), strict.alias("strict_lexical_hit"), passed.alias("lexical_score_pass"), fallback_only.alias("fallback_rank_only"), (strict | (passed & ~fallback_only)).alias("gate"),
    )
