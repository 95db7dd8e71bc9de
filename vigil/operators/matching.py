"""Joins on hashes, ranges, suffixes and aliases."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.functions.hashing import bits, distance, plain_hex
from vigil.functions.similarity import jaro_winkler_udf, token_set_ratio_udf
from vigil.functions.text import pipe_list
from vigil.operators.lexical import small


#: Rows of one hash that are paired together with those of another.
TILE = 256


def _valid(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.select(key, bits(F.col(value)).alias("h")).where(F.col("h").isNotNull() & F.col(key).isNotNull())


def _groups(rows: DataFrame) -> DataFrame:
    """(h, n): each hash once; dealt out evenly however few they are, as each becomes many rows."""
    return rows.groupBy("h").agg(F.count("*").alias("n")).repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "h")


def _near(left: DataFrame, right: DataFrame, radius: int, blocks: int, ordered: bool) -> DataFrame:
    """(p, m, q, n, distance): hashes p of left(h, n), each once in m rows, and q of right(h, n) in n, at most `radius` bits apart. A pair is found
    in each choice of blocks that it agrees on and is taken from the first of them. ordered: p < q only."""
    n = max(radius + 1, blocks)
    edges = [64 * i // n for i in range(n + 1)]
    signed = lambda m: F.lit(m - (1 << 64) if m >> 63 else m)
    block = [((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in range(n)]
    choices = list(combinations(range(n), n - radius))
    cut = F.array(*[F.struct(F.lit(k).alias("band"), F.col("h").bitwiseAND(signed(sum(block[i] for i in chosen))).alias("key")) for k, chosen in enumerate(choices)])
    keyed = lambda df, value, count: df.select(F.col("h").alias(value), F.col("n").alias(count), F.inline(cut))
    differ = F.col("p").bitwiseXOR(F.col("q"))
    last = F.element_at(F.array(*[F.lit(chosen[-1]) for chosen in choices]), F.col("band") + 1)
    agreed = sum((F.when((F.lit(i) <= last) & (differ.bitwiseAND(signed(m)) == 0), 1).otherwise(0) for i, m in enumerate(block)), F.lit(0))
    found = keyed(left, "p", "m").join(keyed(right, "q", "n"), ["band", "key"])
    found = found.where("p < q") if ordered else found
    return found.where(F.bit_count(differ) <= radius).where(agreed == n - radius).select("p", "m", "q", "n", distance(F.col("p"), F.col("q")).alias("distance"))


def hamming_radius(left: DataFrame, right: DataFrame, radius: int, blocks: int | None = None) -> DataFrame:
    """(a, b, distance) of left(a, x) and right(b, y), hex hashes of 64 bits, at most `radius` bits apart.

    The 64 bits are cut into `blocks` (two more than the radius by default, more are allowed): hashes this near agree on all but `radius`
    of them, so an equi-join on the bits of each choice of the others finds all candidates without a cross join. Two blocks
    together are 25 bits or more, so that a key holds few of 10^9 hashes. Hashes are compared once, however many rows have them.
    Hashes that aren't valid match nothing.
    """
    own, other = _valid(left, "a", "x").distinct(), _valid(right, "b", "y").distinct()
    near = _near(_groups(own), _groups(other), radius, blocks or radius + 2, False).select("p", "q", "distance")
    return near.join(own.withColumnRenamed("h", "p"), "p").join(other.withColumnRenamed("h", "q"), "q").select("a", "b", "distance").distinct()


def hamming_pairs(rows: DataFrame, radius: int, blocks: int | None = None) -> DataFrame:
    """(a, b, distance) of rows(id, x), each id once: hamming_radius() of a table with itself, each pair once with a < b.

    There are three `blocks` more than the radius by default: of hashes of like texts, which share many bits, fewer meet by chance. Pairs
    of hashes are found first; rows are put in for them last, in tiles of about TILE rows of either hash, so that a
    hash of many rows isn't paired in one task, and pairs of rows are neither shuffled nor compared.
    """
    own = _valid(rows, "id", "x")
    groups = _groups(own)
    parts = lambda n: F.ceil(n / TILE).cast("int")
    many = F.col("m") > F.col("n")
    turned = lambda x, y: F.when(many, F.col(y)).otherwise(F.col(x))
    near = _near(groups, groups, radius, blocks or radius + 3, True).select(turned("p", "q").alias("p"), turned("m", "n").alias("m"), turned("q", "p").alias("q"), turned("n", "m").alias("n"), "distance")
    same = groups.where("n > 1").select(F.col("h").alias("p"), F.col("n").alias("m"), F.col("h").alias("q"), "n", F.lit(0).cast(near.schema["distance"].dataType).alias("distance"))
    up_to = lambda n: F.explode(F.sequence(F.lit(0), parts(F.col(n)) - 1))
    tiles = near.union(same).select("p", "q", "n", "distance", up_to("m").alias("i")).select("p", "q", "distance", "i", up_to("n").alias("j")).where("p <> q OR i <= j")
    dealt = own.join(groups, "h").select("h", "id", F.pmod(F.xxhash64("id"), parts(F.col("n"))).cast("int").alias("part"))
    first = tiles.join(dealt.select(F.col("h").alias("p"), F.col("part").alias("i"), F.col("id").alias("a")), ["p", "i"])
    both = first.join(dealt.select(F.col("h").alias("q"), F.col("part").alias("j"), F.col("id").alias("b")), ["q", "j"]).where("p <> q OR i < j OR a < b")
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "distance")


#: Reference hashes that are broadcast together: 20 bytes each.
REFERENCES = 100_000


def nearest_reference(left: DataFrame, right: DataFrame, hit: int, anchor: int) -> DataFrame:
    """(a, b, distance, similarity, hit, anchor): for each left hash the nearest reference hash, ties to the least b.

    References are broadcast in blocks of a bounded size, each of which reads the left side; minima are taken as they come.
    """
    few = right.withColumn("q", bits(F.col("y"))).where("q IS NOT NULL").select("b", "q")
    blocks = max(1, -(-few.count() // REFERENCES))
    d = distance(F.col("p"), F.col("q"))
    own = left.withColumn("p", bits(F.col("x"))).where("p IS NOT NULL")
    found = None
    for at in range(blocks):
        mine = few if blocks == 1 else few.where(F.pmod(F.xxhash64("b"), F.lit(blocks)) == at)
        one = own.join(F.broadcast(mine), how="cross").groupBy("a").agg(F.min(F.struct(d.alias("distance"), F.col("b"))).alias("m"))
        found = one if found is None else found.union(one)
    best = found if blocks == 1 else found.groupBy("a").agg(F.min("m").alias("m"))
    return best.select("a", "m.b", "m.distance", F.round(1 - F.col("m.distance") / 64.0, 6).alias("similarity"), (F.col("m.distance") <= hit).alias("hit"), (F.col("m.distance") <= anchor).alias("anchor"))


def range_lookup(rows: DataFrame, value: str, ranges: DataFrame, parts: int = 200) -> DataFrame:
    """rows with the attributes of the interval (low, high, ...) that holds `value`, null without one.

    Intervals don't overlap. Rows and starts of intervals are put in one order within parts that hold about as many rows each,
    and the last start before a row is carried forward, so that neither side has to be small. An interval stands in each
    part that it reaches into: in no more than there are parts, however long it is.
    """
    edges = sorted(set(rows.agg(F.percentile_approx(value, [i / parts for i in range(1, parts)], 10_000)).first()[0] or []))
    listed = F.array(*map(F.lit, edges)) if edges else F.array().cast("array<bigint>")
    part = lambda c: F.size(F.filter(listed, lambda e: e <= F.col(c)))
    begins = F.element_at(F.concat(F.array(F.lit(-(1 << 63))), listed.cast("array<bigint>")), F.col("block") + 1)
    attrs = [c for c in ranges.columns if c not in ("low", "high")]
    spread = ranges.withColumn("block", F.explode(F.sequence(part("low"), part("high"))))
    starts = spread.select("block", F.greatest(F.col("low"), begins).alias("at"), F.lit(0).alias("kind"), F.struct("high", *attrs).alias("hit"), *[F.lit(None).cast(rows.schema[c].dataType).alias(f"r_{c}") for c in rows.columns])
    points = rows.select(F.coalesce(part(value), F.lit(0)).alias("block"), F.col(value).alias("at"), F.lit(1).alias("kind"), F.lit(None).cast(starts.schema["hit"].dataType).alias("hit"), *[F.col(c).alias(f"r_{c}") for c in rows.columns])
    w = Window.partitionBy("block").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    carried = starts.union(points).withColumn("last", F.last("hit", ignorenulls=True).over(w)).where("kind = 1")
    return carried.select(*[F.col(f"r_{c}").alias(c) for c in rows.columns], *[F.when(F.col("at") <= F.col("last.high"), F.col(f"last.{a}")).alias(a) for a in attrs])


def suffix_match(hosts: DataFrame, catalogue: DataFrame) -> DataFrame:
    """hosts with the longest catalogue domain that equals the host or is a dotted suffix of it; an equi-join on all suffixes."""
    parts = F.split("host", r"\.")
    n = F.size(parts)
    suffixes = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(parts, i, n - i + 1), "."))
    found = hosts.select("host").distinct().select("host", F.explode(suffixes).alias("domain")).join(catalogue, "domain")
    best = found.groupBy("host").agg(F.max(F.struct(F.length("domain").alias("n"), *[c for c in catalogue.columns])).alias("m"))
    return hosts.join(best, "host", "left").select(*hosts.columns, *[F.col(f"m.{c}").alias(c) for c in catalogue.columns])


def alias_match(texts: DataFrame, aliases: DataFrame) -> DataFrame:
    """(id, canonical, n_hits, longest): per text the brand with the most aliases in it, then the longest alias, then the name.

    texts: id, words (array of distinct lower-cased words); aliases: alias, canonical. An equi-join on words.
    """
    hits = texts.select("id", F.explode("words").alias("alias")).join(aliases, "alias")
    per = hits.groupBy("id", "canonical").agg(F.count_distinct("alias").alias("n_hits"), F.max(F.length("alias")).alias("longest"))
    w = Window.partitionBy("id").orderBy(F.desc("n_hits"), F.desc("longest"), "canonical")
    return per.withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")


def first_match(left: DataFrame, right: DataFrame, condition, order: str, most: int = 100_000) -> DataFrame:
    """Each left row (key `id`) with the first right row, in `order`, that the condition accepts; right is a small catalogue, which is checked."""
    if right.count() > most:
        raise ValueError(f"more than {most} catalogue rows; give a blocking key")
    w = Window.partitionBy("id").orderBy(order)
    return left.join(F.broadcast(right), condition).withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")


def outputs_by_workbook(output: DataFrame, sources: list[DataFrame]) -> DataFrame:
    """(workbook, n): rows of output(url, source_workbook) of each workbook; where none names it, those whose url a source of that workbook has."""
    lists = lambda df: df.select("url", F.explode(pipe_list(F.coalesce("source_workbook", F.lit("")))).alias("workbook"))
    direct = lists(output).groupBy("workbook").agg(F.count("*").alias("direct"))
    every = lists(sources[0])
    for s in sources[1:]:
        every = every.union(lists(s))
    through = every.distinct().join(output.groupBy("url").agg(F.count("*").alias("rows")), "url", "left").groupBy("workbook").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("through"))
    return through.join(direct, "workbook", "full").select("workbook", F.coalesce("direct", "through").cast("long").alias("n"))


def similar_first(left: DataFrame, right: DataFrame) -> DataFrame:
    """Each left row (id, label, url) with the first right row (pos, legit_label, legit_url), by pos, whose label is like its own: Jaro-Winkler
    similarity of 0.85 or a token-set ratio of 90, for another URL. right is a small catalogue, which is checked; labels are compared as
    distinct pairs, in Arrow batches."""
    pairs = left.select("label").distinct().where("label <> ''").join(small(right.select("legit_label").distinct().where("legit_label <> ''")), how="cross")
    like = pairs.withColumn("jw", jaro_winkler_udf("label", "legit_label")).withColumn("sets", token_set_ratio_udf("label", "legit_label")).where("jw >= 0.85 OR sets >= 90").select("label", "legit_label")
    best = left.join(like, "label").join(small(right), "legit_label").where("url <> legit_url").groupBy("id").agg(F.min(F.struct("pos", "legit_label", "legit_url")).alias("m"))
    return left.join(best, "id", "left").select(*left.columns, "m.pos", "m.legit_label", "m.legit_url")


def exact_hits(hashes: DataFrame, references: DataFrame) -> DataFrame:
    """(id, entity) of hashes(id, hash) that stand in an entity's set references(entity, hash): an equi-join on normalised digits."""
    known = references.select("entity", plain_hex(F.col("hash")).alias("h")).where("h IS NOT NULL").distinct()
    return hashes.select("id", plain_hex(F.col("hash")).alias("h")).join(known, "h").select("id", "entity").distinct()


def unprocessed(catalogue: DataFrame, done: DataFrame) -> DataFrame:
    """(entity, domains): of each entity the distinct domains that aren't done, in order."""
    open_ = catalogue.select("entity", F.lower(F.trim("domain")).alias("domain")).distinct().join(done.select(F.lower(F.trim("domain")).alias("domain")).distinct(), "domain", "left_anti")
    return open_.groupBy("entity").agg(F.array_sort(F.collect_set("domain")).alias("domains"))


def registrable_by(hosts: DataFrame, suffixes: DataFrame) -> DataFrame:
    """hosts(host, ...) with registrable, by a table of public suffixes(suffix) of any size: the longest that the host ends in and the label
    before it; without one, the last label counts as suffix. An equi-join on all suffixes of distinct hosts."""
    parts = F.filter(F.split("host", r"\."), lambda x: x != "")
    tails = F.transform(F.sequence(F.lit(1), F.greatest(F.size("parts"), F.lit(1))), lambda i: F.struct(i.alias("i"), F.array_join(F.slice("parts", i, F.size("parts") - i + 1), ".").alias("suffix")))
    known = suffixes.select(F.lower("suffix").alias("suffix")).distinct()
    found = hosts.select("host").distinct().withColumn("parts", parts).select("host", "parts", F.inline(tails)).join(known, "suffix").groupBy("host").agg(F.min("i").alias("i"))
    at = F.greatest(F.coalesce("i", F.size("parts")) - 1, F.lit(1))
    return hosts.join(found, "host", "left").withColumn("parts", parts).withColumn("registrable", F.array_join(F.slice("parts", at, F.greatest(F.size("parts"), F.lit(1))), ".")).drop("parts", "i")


def membership(left: DataFrame, right: DataFrame, key: str, out: str) -> DataFrame:
    """left with a boolean: whether its key is among right's."""
    keys = right.select(F.col(key).alias("__k")).distinct()
    return left.join(keys, F.col(key) == F.col("__k"), "left").withColumn(out, F.col("__k").isNotNull()).drop("__k")
