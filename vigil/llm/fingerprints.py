"""SpotSigs fingerprints, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import partitions, tables

#: Common words of English, French, German and Spanish that anchor signatures.
ANCHORS = """
a an and are as at be by for from had has have he in is it not of on or that the this to was were which with
au aux ce dans de des du elle en est et il la le les leur ne nous on par pas pour qu que qui sa se ses son sur un une vous
als am auch auf aus bei das dem den der die ein eine einem einen einer er es im ist mit nicht sein sich sie sind und von vor wie zu zum zur
al como con del el ella es esta ha las lo los más no o para pero por su sus una y ya
""".split()
_PATTERN = f" ({'|'.join(sorted(set(ANCHORS)))}) "
_MARK = "\x01"


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with the fingerprint of column `text`, which isn't null: its distinct signatures' hashes in order, joined by '-'.

    A signature is a common word (or a run of them) with the chain of the two content words that follow it, common words between
    these left out. Where four content words follow one another without a common word, as in lists and tables, the chain
    of the first two is a signature, too. A text without any has its whole self as its one signature.
    """
    words = F.trim(F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}\p{N}]+", " "))
    # each word between blanks of its own; then anchors lose theirs and stick to the next word
    spaced = F.concat(F.lit(" "), F.regexp_replace(words, " ", "  "), F.lit(" "))
    marked = F.replace(F.regexp_replace(spaced, _PATTERN, f"$1{_MARK}"), F.lit(f"{_MARK} "), F.lit(_MARK))
    tokens = F.split(F.trim(marked), " +")

    pairs = F.zip_with("__tokens", F.slice("__tokens", F.lit(2), F.greatest(F.size("__tokens") - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))

    def chain(pair: Column, later: Column) -> Column:
        first, second = F.substring_index(pair, " ", 1), F.substring_index(F.substring_index(pair, " ", -1), _MARK, -1)
        mark = F.lit(_MARK)
        return F.when(F.contains(first, mark), F.when(second != "", F.concat(first, F.lit(" "), second))).when(later.isNotNull() & ~F.contains(pair, mark) & ~F.contains(later, mark), pair)

    def short(x: Column) -> Column:
        return F.substring(F.md5(x), 1, 8)

    def there(x: Column) -> Column:
        return x.isNotNull()

    # filter and sort_array, not array_compact and array_sort: these bring lambdas of their own, different in each use of df, and then
    # Spark doesn't see that two joins of df could share one exchange
    chains = F.filter(F.zip_with("__pairs", F.slice("__pairs", F.lit(3), F.greatest(F.size("__pairs") - 2, F.lit(0))), chain), there)
    return (
        df.withColumn("__tokens", tokens)
        .withColumn("__pairs", F.filter(pairs, there))
        .withColumn("__chains", F.array_distinct(chains))
        .withColumn("__sigs", F.sort_array(F.array_distinct(F.transform("__chains", short))))
        .withColumn(out, F.when(F.size("__sigs") == 0, F.md5(F.col(text))).otherwise(F.array_join("__sigs", "-")))
        .drop("__tokens", "__pairs", "__chains", "__sigs")
    )


def likeness(a: str, b: str, floor: float = 0.0) -> Column:
    """Jaccard similarity of two fingerprints; where their lengths alone keep it below `floor`, 0 without a comparison."""
    x, y = F.split(F.col(a), "-"), F.split(F.col(b), "-")
    common = F.size(F.array_intersect(x, y))
    exact = common / (F.size(x) + F.size(y) - common)
    # signatures have a fixed width, so lengths of strings stand for lengths of sets
    shorter, longer = F.least(F.length(a), F.length(b)) + 1, F.greatest(F.length(a), F.length(b)) + 1
    return F.when(F.col(a).isNull() | F.col(b).isNull(), 0.0).when(F.col(a) == F.col(b), 1.0).when(shorter < longer * floor, 0.0).otherwise(exact)


def near_pairs(prints: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(a, b, likeness) of the pairs of distinct fingerprints in prints(fingerprint) that are at least `threshold` alike.

    Equal fingerprints are one class. Sets are partitioned by length: class k holds lengths from (1 / threshold)^k, so that
    partners are of the same or the next class. Within a class and the next, sets meet on their rarest signatures, as many as
    any partner must share one of; the lengths prune again, and the exact similarity decides.
    """
    sets = prints.select("fingerprint").distinct().withColumn("sigs", F.split("fingerprint", "-")).withColumn("n", F.size("sigs"))
    sets = sets.withColumn("k", F.floor(F.log(F.col("n")) / F.log(F.lit(1 / threshold)) + F.lit(1e-9)))
    items = sets.select("fingerprint", "n", "k", F.explode("sigs").alias("sig"))
    counts = items.groupBy("sig").agg(F.count("*").alias("c")).where("c > 1")
    # a signature of one set alone is the rarest: it uses up a place of the prefix without a partner
    shared = items.join(counts, "sig").groupBy("fingerprint", "n", "k").agg(F.sort_array(F.collect_list(F.struct("c", "sig"))).alias("x"))
    take = F.greatest(F.lit(0), F.col("n") - F.ceil(F.col("n") * F.lit(threshold) - F.lit(1e-9)) + 1 - (F.col("n") - F.size("x")))
    keys = shared.select("fingerprint", "n", "k", F.explode(F.slice("x", F.lit(1), take.cast("int"))).alias("x")).select("fingerprint", "n", "k", F.col("x.sig").alias("sig"))
    left = keys.select(F.col("fingerprint").alias("a"), F.col("n").alias("na"), "sig", F.explode(F.array(F.col("k"), F.col("k") + 1)).alias("k"))
    right = keys.select(F.col("fingerprint").alias("b"), F.col("n").alias("nb"), "sig", "k")
    fits = (F.least("na", "nb") >= F.greatest("na", "nb") * F.lit(threshold - 1e-9)) & ((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))))
    pairs = left.join(right, ["sig", "k"]).where(fits).select("a", "b").distinct()
    return pairs.withColumn("likeness", likeness("a", "b", threshold - 1e-9)).where(F.col("likeness") >= threshold - 1e-9)


#: Ranges of ids for each shuffle partition, and the edges of ranges at most: 8 bytes each in the plan.
RANGES, MOST_RANGES = 4, 20_000


def with_range(rows: DataFrame, edges: list[int], cells: int = 1024) -> DataFrame:
    """rows(doc_id, ...) with part, the number of edges up to doc_id: ranges of ids that hold about as many rows each.

    edges are sorted; a cell of equal width names the first edge that can count, so that a row looks at its own cell's edges only.
    """
    shift = 0
    while (edges[-1] >> shift) - (edges[0] >> shift) >= cells:
        shift += 1
    low = edges[0] >> shift
    starts = [0] * (cells + 1)
    for e in edges:
        starts[(e >> shift) - low + 1] += 1
    for i in range(cells):
        starts[i + 1] += starts[i]
    listed = F.split(F.lit(",".join(map(str, edges))), ",").cast("array<bigint>")
    firsts = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<int>")
    cell = F.least(F.shiftright("doc_id", shift) - F.lit(low), F.lit(cells - 1)).cast("int")
    first, last = F.element_at(firsts, cell + 1), F.element_at(firsts, cell + 2)
    return rows.withColumn("part", first + F.size(F.filter(F.slice(listed, first + 1, last - first), lambda e: e <= F.col("doc_id"))))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Each row of docs(doc_id, text) with its fingerprint, that of its edited text, and their likenesses.

    The edited text: the last floor(n_chars / 4) code points replaced by the first as many of the next document's, by ascending
    doc_id (after the last: the first). Texts are shuffled once, into ranges of ids; a window in each range finds the next
    document. The rows that open a range go to the range before it, too, as rows that are only looked at.

    Null text counts as empty; equal texts have equal fingerprints; of repeated rows with one doc_id the least text is the one that
    their predecessor gets. A row with null doc_id has no next document: its edited text is just cut, and near_next is 0. No rows give
    no rows; other columns are ignored. Rows of one doc_id meet in one range.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    named = plain.where("doc_id IS NOT NULL")
    n = partitions(docs.sparkSession)
    ranges = min(MOST_RANGES, RANGES * n)
    least, quantiles = named.agg(F.min("doc_id"), F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 4 * MOST_RANGES)).first()
    none = F.lit(None).cast("string")
    nameless = with_fingerprint(plain.where("doc_id IS NULL"), "text", "fingerprint").withColumns({"next_text": none, "next_fingerprint": none})
    if least is None:
        return _edited(nameless)
    # quantiles of great ids aren't ids; the least id of each range is
    ranged = with_range(named.select("doc_id"), sorted({least, *quantiles})).groupBy("part").agg(F.min("doc_id").alias("first"))
    edges = sorted(r["first"] for r in ranged.collect())  # MOST_RANGES at most
    opening = F.array_contains(F.split(F.lit(",".join(map(str, edges))), ",").cast("array<bigint>"), F.col("doc_id"))
    # lap: rows that come after the last document are those of the first one
    own = F.struct(F.col("part"), F.lit(0).alias("lap"), F.lit(True).alias("own"))
    before = F.struct(F.when(F.col("part") == 1, len(edges)).otherwise(F.col("part") - 1).alias("part"), F.when(F.col("part") == 1, 1).otherwise(0).alias("lap"), F.lit(False).alias("own"))
    dealt = with_range(named, edges).withColumn("x", F.explode(F.when(opening, F.array(own, before)).otherwise(F.array(own)))).select("doc_id", "text", "x.*")
    printed = with_fingerprint(dealt.repartition(n, "part"), "text", "fingerprint")
    # downwards, so that the row before is the next document's, and rows of one doc_id take what the first of them has found
    downwards = Window.partitionBy("part").orderBy(F.desc("lap"), F.desc("doc_id"), F.desc("text"))
    above = F.lag(F.struct("lap", "doc_id", "text", "fingerprint")).over(downwards)
    follower = F.when((F.col("above.lap") != F.col("lap")) | (F.col("above.doc_id") != F.col("doc_id")), F.col("above"))
    found = F.last(follower, ignorenulls=True).over(downwards.rowsBetween(Window.unboundedPreceding, 0))
    followed = printed.withColumn("above", above).withColumn("next", found).where("own").select("doc_id", "text", "fingerprint", F.col("next.text").alias("next_text"), F.col("next.fingerprint").alias("next_fingerprint"))
    return _edited(followed).union(_edited(nameless))


def _edited(rows: DataFrame) -> DataFrame:
    """The result for rows(doc_id, text, fingerprint, next_text, next_fingerprint)."""
    q = F.floor(F.col("n_chars") / 4).cast("int")
    joined = rows.withColumn("n_chars", F.length("text").cast("long"))
    edited = joined.withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - q).cast("int")), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), q))).drop("text", "next_text")
    done = with_fingerprint(edited, "edited", "edited_fingerprint")
    return done.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", likeness("fingerprint", "edited_fingerprint").alias("near_edited"), likeness("fingerprint", "next_fingerprint").alias("near_next")
    )


def op7(spark, sf_dir: str) -> DataFrame:
    return fingerprint_edits(tables(spark, sf_dir, "documents"))


def _sql_print(source: str, text: str, out: str) -> str:
    return f"""
  SELECT * EXCLUDE (tokens, sigs), CASE WHEN len(sigs) = 0 THEN md5({text}) ELSE array_to_string(sigs, '-') END AS {out} FROM (
    SELECT *, list_sort(list_distinct(list_filter(list_transform(range(1, len(tokens)), lambda i: CASE
        WHEN contains(tokens[i], chr(1)) THEN CASE WHEN string_split(tokens[i + 1], chr(1))[-1] <> '' THEN substr(md5(tokens[i] || ' ' || string_split(tokens[i + 1], chr(1))[-1]), 1, 8) END
        WHEN i + 3 <= len(tokens) AND NOT contains(array_to_string(tokens[i : i + 3], ' '), chr(1)) THEN substr(md5(tokens[i] || ' ' || tokens[i + 1]), 1, 8) END), lambda x: x IS NOT NULL))) AS sigs FROM (
      SELECT *, regexp_split_to_array(trim(replace(regexp_replace(
        ' ' || replace(trim(regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ', '  ') || ' ', '{_PATTERN}', '\\1' || chr(1), 'g'), chr(1) || ' ', chr(1))), ' +') AS tokens
      FROM {source}))"""


def _sql_like(a: str, b: str) -> str:
    x, y = f"string_split({a}, '-')", f"string_split({b}, '-')"
    return f"CASE WHEN {a} = {b} THEN 1.0 ELSE CAST(len(list_intersect({x}, {y})) AS DOUBLE) / (len({x}) + len({y}) - len(list_intersect({x}, {y}))) END"


SQL = f"""
WITH base AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars FROM documents),
printed AS ({_sql_print("base", "text", "fingerprint")}),
linked AS (
  SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS next_text,
         coalesce(lead(fingerprint) OVER (ORDER BY doc_id), first_value(fingerprint) OVER (ORDER BY doc_id)) AS next_fingerprint FROM printed),
edits AS (SELECT *, substr(text, 1, n_chars - n_chars // 4) || substr(next_text, 1, n_chars // 4) AS edited FROM linked),
both_printed AS ({_sql_print("edits", "edited", "edited_fingerprint")})
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, fingerprint, edited_fingerprint,
       CAST({_sql_like("fingerprint", "edited_fingerprint")} AS DOUBLE) AS near_edited, CAST({_sql_like("fingerprint", "next_fingerprint")} AS DOUBLE) AS near_next
FROM both_printed
"""
