"""Feature rows for models, and vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions import urls


def median_imputed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """df with nulls replaced by the column's median; the medians are one row."""
    medians = df.agg(*[F.median(c).alias(f"__m_{c}") for c in columns])
    out = df.crossJoin(F.broadcast(medians))  # one row
    return out.select(*[F.coalesce(F.col(c).cast("double"), F.col(f"__m_{c}")).alias(c) if c in columns else F.col(c) for c in df.columns])


def one_hot(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.select("*", *[F.coalesce((F.col(column) == v).cast("int"), F.lit(0)).alias(f"{column}_{v.lower()}") for v in values])


def standardised(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    stats = df.agg(*[F.avg(c).alias(f"__a_{c}") for c in columns], *[F.stddev_pop(c).alias(f"__s_{c}") for c in columns])
    out = df.crossJoin(F.broadcast(stats))  # one row
    return out.select(*[F.when(F.col(f"__s_{c}") > 0, (F.col(c) - F.col(f"__a_{c}")) / F.col(f"__s_{c}")).otherwise(0.0).alias(c) if c in columns else F.col(c) for c in df.columns])


def frequent_classes(df: DataFrame, column: str, least: int = 5) -> DataFrame:
    """df with class_id, dense from 0 in the order of the labels, for labels with at least `least` rows."""
    kept = df.groupBy(column).agg(F.count("*").alias("class_n")).where(F.col("class_n") >= least).withColumn("class_id", F.dense_rank().over(Window.orderBy(column)) - 1)
    return df.join(kept, column)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def nearest_vectors(rows: DataFrame, references: DataFrame, k: int, block: int = 1_000) -> DataFrame:
    """(id, ref, cosine, rank): for each of rows(id, v) the k of references(ref, u) of greatest cosine, ties to the least ref.

    The rows asked for are broadcast in blocks of a bounded size, each of which reads the references once; of what a task has read
    it keeps k a row before anything is shuffled. A vector of zeros is like nothing (cosine 0).
    """
    asked = rows.withColumn("na", F.sqrt(dot(F.col("v"), F.col("v"))))
    blocks = max(1, -(-asked.count() // block))
    every = references.withColumn("nb", F.sqrt(dot(F.col("u"), F.col("u"))))
    cosine = F.when((F.col("na") > 0) & (F.col("nb") > 0), F.round(dot(F.col("v"), F.col("u")) / (F.col("na") * F.col("nb")), 6)).otherwise(0.0)
    w = Window.partitionBy("id").orderBy(F.desc("cosine"), "ref")
    found = None
    for at in range(blocks):
        mine = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == at)
        one = every.join(F.broadcast(mine), how="cross").select("id", "ref", cosine.alias("cosine")).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        found = one if found is None else found.union(one)
    return found.select("id", "ref", "cosine", "rank")


def url_features(url: Column) -> dict[str, Column]:
    """Counts and lengths of a URL with scheme, its host part, subdomain and path; zeros for what isn't a URL of up to 2048 characters."""
    full = F.when(F.trim(url).rlike("^https?://"), F.trim(url)).otherwise(F.concat(F.lit("https://"), F.trim(url)))
    host = urls.hostname(full)
    place = F.regexp_extract(full, r"^https?://([^/?#]*)", 1)
    path, query, fragment = F.regexp_extract(full, r"^https?://[^/?#]*([^?#]*)", 1), F.regexp_extract(full, r"^[^?#]*\?([^#]*)", 1), F.regexp_extract(full, "#(.*)$", 1)
    front = F.regexp_replace(F.substring(host, F.lit(1), F.length(host) - F.length(urls.registrable(host))), r"\.$", "")
    parts = F.filter(F.split(front, r"\."), lambda x: x != "")
    count = lambda text, pattern: F.regexp_count(text, F.lit(pattern)).cast("long")
    twice = "00|11|22|33|44|55|66|77|88|99"
    valid = (F.trim(url) != "") & (F.length(F.trim(url)) <= 2048) & (host != "")
    whole = {
        "url_length": F.length(full).cast("long"), "num_dots": count(full, r"\."), "has_repeated_digits": full.rlike(twice), "num_special_chars": count(full, "[^a-zA-Z0-9]"), "num_hyphens": count(full, "-"), "num_slashes": count(full, "/"),
        "num_underscores": count(full, "_"), "num_question_marks": count(full, r"\?"), "num_equal_signs": count(full, "="), "num_dollar_signs": count(full, r"\$"), "num_exclamations": count(full, "!"), "num_hashtags": count(full, "#"), "num_percent": count(full, "%"),
        "domain_length": F.length(place).cast("long"), "num_hyphens_domain": count(place, "-"), "has_special_chars_domain": place.rlike("[^a-zA-Z0-9.-]"), "num_special_chars_domain": count(place, "[^a-zA-Z0-9.-]"),
        "num_subdomains": F.size(parts).cast("long"), "avg_subdomain_length": F.when(F.size(parts) > 0, F.aggregate(parts, F.lit(0.0), lambda s, x: s + F.length(x)) / F.size(parts)).otherwise(0.0), "subdomain_length": F.length(front).cast("long"),
        "subdomain_has_hyphen": F.contains(front, F.lit("-")), "subdomain_has_repeated_digits": front.rlike(twice),
        "path_length": F.length(path).cast("long"), "has_query": query != "", "has_fragment": fragment != "", "has_anchor": F.contains(url, F.lit("#")), "entropy_url": urls.entropy(url), "entropy_domain": urls.entropy(place),
    }
    zero = lambda name: F.lit(False) if "has_" in name else F.lit(0.0) if name.startswith(("avg", "entropy")) else F.lit(0).cast("long")
    return {n: F.when(F.coalesce(valid, F.lit(False)), c).otherwise(zero(n)) for n, c in whole.items()}


def model_row(df: DataFrame, names: Sequence[str], issuer: Column) -> DataFrame:
    """df's features as a model was trained on: numbers, 0 where there is none, and the issuer's own column set."""
    value = lambda n: (issuer == n.removeprefix("ssl_issuer_")).cast("double") if n.startswith("ssl_issuer_") else F.col(n).cast("string").try_cast("double") if n in df.columns else F.lit(0.0)
    return df.select(*[F.coalesce(value(n), F.lit(0.0)).alias(n) for n in names])


def top_features(importances: DataFrame, k: int = 15) -> DataFrame:
    return importances.orderBy(F.desc("importance"), "feature").limit(k)


def top_class(probabilities: Column, classes: Sequence[str]) -> Column:
    """struct(label, p) of the greatest probability, the first of equal ones."""
    best = F.array_max(probabilities)
    return F.struct(F.element_at(F.array(*map(F.lit, classes)), F.array_position(probabilities, best).cast("int")).alias("label"), best.alias("p"))
