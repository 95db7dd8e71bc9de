"""MinHash near-duplicates from bottom-k sketches of one hash function."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import U64, fold, freed, hashes, only, pair_hash, partitions, small_batches, stash, tables
from vigil.llm.components import components

#: Values that a sketch retains.
K = 64
#: Chance at which a link may have fewer common values than sketches are asked for.
MISS = 1e-8
#: Slots of a signature, documents of one block of a large group, partners of one task's owner.
SLOTS, BLOCK, PARTNERS = 64, 1024, 256
SETS = "doc_id long, n long, sid binary, sketch array<long>, sig binary"


def shingles(text: str | None, width: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; a text of fewer words is one shingle; without words, none."""
    words = hashes(fold(text))
    if not len(words):
        return words
    if len(words) < width:
        one = U64(len(words)) + words[:1]
        for w in words[1:]:
            one = pair_hash(one, np.array([w], U64))
        return one
    out = words
    for j in range(1, width):
        out = pair_hash(out[: len(words) - j], words[j:])
    return np.unique(out.view(np.int64)).view(U64)


def signature(values: np.ndarray) -> bytes:
    """One byte of the least value in each of the slots that the lowest bits name: a value more or less changes one slot."""
    out = np.zeros(SLOTS, np.uint8)
    slot = (values & U64(SLOTS - 1)).astype(np.int64)
    first = np.unique(slot, return_index=True)  # values are sorted: the first of a slot is its least
    out[first[0]] = (values[first[1]] >> U64(8)).astype(np.uint8) | 1
    return out.tobytes()


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """docs(doc_id, text) with the size, hash, bottom-k sketch and signature of each row's shingle set."""
    import xxhash

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, sid, sketch, sig = [], [], [], []
            for text in batch.column(1).to_pylist():
                values = shingles(text, width)
                n.append(len(values))
                sid.append(xxhash.xxh3_128_digest(values.tobytes()))
                sketch.append(values[:K].view(np.int64))
                sig.append(signature(values))
            offsets = np.cumsum([0, *map(len, sketch)]).astype(np.int32)
            flat = np.concatenate([np.empty(0, np.int64), *sketch])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(sid, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(sig, pa.binary())], names=["doc_id", "n", "sid", "sketch", "sig"])

    return docs.mapInArrow(work, SETS)


def least_overlap(k: int, t: float) -> int:
    """Common values that two sketches of k values hold at least if their sets' Jaccard similarity is t or more, but for a chance
    of MISS: the k least values of both sets together are drawn from the union, without replacement, and a value common to both sets
    that is among them is in both sketches; so the number of those is no less spread than binomial."""
    below, at = 0.0, 0
    while at < k and (below := below + math.comb(k, at) * t**at * (1 - t) ** (k - at)) <= MISS:
        at += 1
    return max(1, at)


def prefix_length(n: Column, t: float) -> Column:
    """So many of a sketch's rarest values make two sketches meet that hold the least overlap. Sets up to K * t values, and all
    their partners, are retained whole: there the bound is exact."""
    small = n - F.ceil(n * F.lit(t) - F.lit(1e-9)) + 1
    return F.when(n <= math.floor(K * t), small).otherwise(K - least_overlap(K, t) + 1)


def size_fits(a: Column, b: Column, t: float) -> Column:
    return F.least(a, b) >= F.greatest(a, b) * F.lit(t - 1e-9)


def alike(pairs: DataFrame, nodes: DataFrame, t: float) -> DataFrame:
    """pairs(a, b) whose signatures differ in no more slots than t allows, see fitting(): a tenth of a sketch is shipped for each."""
    side = lambda c, n, sig: only(nodes.select(F.col("node").alias(c), F.col("n").alias(n), F.col("sig").alias(sig)), c, pairs.select(c))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                a, b, m, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 3))
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, SLOTS) for i in (4, 5))
                fits = (x != y).sum(1) <= most_differing(m + n, t)
                yield pa.RecordBatch.from_arrays([pa.array(a[fits]), pa.array(b[fits])], names=["a", "b"])

    return pairs.join(side("a", "m", "x"), "a").join(side("b", "n", "y"), "b").select("a", "b", "m", "n", "x", "y").mapInArrow(work, "a long, b long")


def most_differing(both: np.ndarray, t: float) -> np.ndarray:
    """Slots in which the signatures of two sets may differ, by the sum of their sizes: as many as they can have values of their own,
    and no more than half of the slots but for a chance of about 1e-8."""
    return np.minimum(SLOTS // 2, np.floor(both * (1 - t) / (1 + t) + 1e-9))


def estimated(pairs: DataFrame, nodes: DataFrame, t: float) -> DataFrame:
    """pairs(a, b) whose Jaccard similarity, estimated on the union's bottom-k sketch, isn't far below t: of the least K values
    of both sets together, how many lie in both."""
    pairs = stash(alike(stash(pairs), nodes, t))
    left = only(nodes.select(F.col("node").alias("a"), F.col("sketch").alias("x")), "a", pairs.select("a"))
    right = only(nodes.select(F.col("node").alias("b"), F.col("sketch").alias("y")), "b", pairs.select("b"))
    union = F.slice(F.array_sort(F.array_union("x", "y")), 1, K)
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .withColumn("u", union)
        .where(F.size(F.array_intersect(F.array_intersect("u", "x"), F.col("y"))) >= F.element_at(F.array(*[F.lit(least_overlap(k, t)) for k in range(1, K + 1)]), F.size("u")))
        .select("a", "b")
    )


def verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """pairs(a, b) with 100 * intersection >= percent * union of the full sets, from the documents' texts.

    A pair's texts meet in the task of its owner a. An owner of many pairs is dealt over several tasks, each with its text
    once; a task holds two sets at a time.
    """
    pairs = stash(pairs)
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).alias("salts"))
    salted = stash(pairs.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).alias("salt")))
    asked = salted.select("a", "salt", F.lit(1).alias("part"), F.col("b").alias("want")).union(salted.select("a", "salt").distinct().select("a", "salt", F.lit(0).alias("part"), F.col("a").alias("want")))
    texts = asked.join(only(docs, "doc_id", asked.select("want")), F.col("want") == F.col("doc_id")).select("a", "salt", "part", "want", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, own = None, None
        for batch in batches:
            out = []
            for a, salt, part, want, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                values = shingles(text, width)
                if not part:
                    owner, own = (a, salt), values
                elif owner == (a, salt):
                    # both are sorted as signed numbers
                    small, large = (values, own) if len(values) < len(own) else (own, values)
                    at = np.searchsorted(large.view(np.int64), small.view(np.int64))
                    common = int((large[np.minimum(at, len(large) - 1)] == small).sum()) if len(small) else 0
                    if common and 100 * common >= percent * (len(values) + len(own) - common):
                        out.append((a, want))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["u", "v"])

    return texts.repartition(partitions(docs.sparkSession), "a", "salt").sortWithinPartitions("a", "salt", "part").mapInArrow(work, "u long, v long").distinct()


def in_blocks(rows: DataFrame, key: str, node: str, block: int) -> DataFrame:
    """rows with i, j and side: groups of equal key are dealt into blocks of about `block` rows by a hash of the node, and each row goes to
    the pairs of blocks (i <= j) that its own is part of (side 1: as the second), so that any two rows of a group meet in one of them."""
    sizes = rows.groupBy(key).agg(F.ceil(F.count("*") / block).cast("int").alias("__blocks")).withColumnRenamed(key, "__key")
    mine, other = F.col("__mine"), F.col("__other")
    dealt = rows.join(sizes, F.col(key) == F.col("__key")).withColumn("__mine", F.pmod(F.xxhash64(node), F.col("__blocks")).cast("int")).withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    return dealt.withColumn("i", F.least(mine, other)).withColumn("j", F.greatest(mine, other)).withColumn("side", (mine > other).cast("int")).drop("__key", "__blocks", "__mine", "__other")


def block_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[list[tuple]]]]:
    """((key, i, j), (rows of side 0, rows of side 1)) from rows (key, i, j, side, ...) in order."""
    now, sides = None, [[], []]
    for batch in batches:
        for key, i, j, side, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (key, i, j) != now:
                if now:
                    yield now, sides
                now, sides = (key, i, j), [[], []]
            sides[side].append(tuple(row))
    if now:
        yield now, sides


def fitting(n: np.ndarray, label: np.ndarray, sig: np.ndarray, left: int, t: float) -> Iterator[tuple[int, np.ndarray]]:
    """(row, rows that fit it): of different labels, of sizes and signatures that similarity t allows. With left > 0, only the
    first `left` rows are paired, and with those after them; else all with all.
    """
    for i in range(left or len(n)):
        rest = slice(left or i + 1, None)
        low, high = np.minimum(n[i], n[rest]), np.maximum(n[i], n[rest])
        fits = np.flatnonzero((label[rest] != label[i]) & (low >= high * (t - 1e-9)))
        if len(fits):
            differ = (sig[rest][fits] != sig[i]).sum(1)
            fits = fits[differ <= most_differing((low + high)[fits], t)]
            if len(fits):
                yield i, fits + rest.start


def suspects(grouped: DataFrame, t: float) -> DataFrame:
    """(hub, node, label): the rows of grouped(hub, i, j, side, node, n, label, sig) that fit another one of their group."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (hub, i, j), sides in block_groups(batches):
            both = sides[0] + sides[1]
            if len(both) > 1 and (i == j or (sides[0] and sides[1])):
                node, n, label = (np.array([r[k] for r in both]) for k in range(3))
                sig = np.frombuffer(b"".join(r[3] for r in both), np.uint8).reshape(len(both), SLOTS)
                hit = np.zeros(len(both), bool)
                for a, fits in fitting(n, label, sig, len(sides[0]) if i < j else 0, t):
                    hit[a] = hit[fits] = True
                out += [(hub, int(node[k]), int(label[k])) for k in np.flatnonzero(hit)]
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(3)], names=["hub", "node", "label"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(3)], names=["hub", "node", "label"])

    n = partitions(grouped.sparkSession)
    return grouped.select("hub", "i", "j", "side", "node", "n", "label", "sig").repartition(n, "hub", "i", "j").sortWithinPartitions("hub", "i", "j").mapInArrow(work, "hub long, node long, label long").distinct()


def common_counts(sets: list[np.ndarray], left: int) -> np.ndarray:
    """Sizes of the intersections of the first `left` sets with the others (left > 0) or of all with all, by products of membership
    matrices over the values that several sets hold, some columns at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((left or len(sets), len(sets) - left), np.float32)
    for low in range(0, int(shared.sum()), 2048):
        a, b = np.searchsorted(column, (low, low + 2048))
        member = np.zeros((len(sets), 2048), np.float32)
        member[owner[a:b], column[a:b] - low] = 1
        out += member[: left or len(sets)] @ member[left:].T
    return out


def linked(grouped: DataFrame, width: int, percent: int) -> DataFrame:
    """(u, v): links that connect what is linked in grouped(hub, i, j, side, node, label, text), by exact Jaccard on full sets.

    Of each pair of blocks only as many links leave the task as are needed to connect its rows.
    """
    t = percent / 100

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), sides in block_groups(batches):
            both = sides[0] + sides[1]
            if len(both) < 2 or (i < j and not (sides[0] and sides[1])):
                continue
            left = len(sides[0]) if i < j else 0
            node, label = (np.array([r[k] for r in both]) for k in range(2))
            sets = [shingles(r[2], width) for r in both]
            n = np.array([len(s) for s in sets])
            sig = np.frombuffer(b"".join(map(signature, sets)), np.uint8).reshape(len(both), SLOTS)
            pairs = [(a, fits) for a, fits in fitting(n, label, sig, left, t)]
            counts = common_counts(sets, left) if sum(len(f) for _, f in pairs) > 4 * len(both) else None
            root, out = list(range(len(both))), []

            def find(x: int, root: list[int] = root) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for a, fits in pairs:
                same = counts[a][fits - left] if counts is not None else np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for b in fits])
                for b in fits[100 * same.astype(np.int64) >= percent * (n[a] + n[fits] - same.astype(np.int64))]:
                    x, y = find(a), find(int(b))
                    if x != y:
                        root[x] = y
                        out.append((int(node[a]), int(node[b])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["u", "v"])

    n = partitions(grouped.sparkSession)
    return grouped.select("hub", "i", "j", "side", "node", "label", "text").repartition(n, "hub", "i", "j").sortWithinPartitions("hub", "i", "j").mapInArrow(work, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, *, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of docs: components of documents linked by Jaccard similarity.

    1. Each set is sketched: its K least values of one hash function. Rows with equal sets become one node, the least doc_id.
    2. The retained values' inverted lists give each value's length; of a sketch, only its rarest values are listed, as many as
       two sketches need to meet (prefix_length()). Lists are cut into classes of sizes that similarity allows. A list of one, and
       with it most values, falls away.
    3. In each list, all documents are paired with its hub, the one whose values lie in the longest lists: as many pairs as
       rows, and where thousands of near copies share their values, their source is the hub. Pairs that meet in one list only
       (of sets over 64 shingles) are left to (4). Signatures and union-sketch estimation filter the others, exact Jaccard on the full sets verifies them, and components are labelled.
    4. Lists with one hub make a group. Groups that still hold several labels are compared within themselves, but only across
       labels: by signatures that go with their rows, to find the documents that fit another one; then these by
       exact Jaccard on the full sets, of which only links that connect something leave the task. Large groups go in pairs of
       blocks, over many tasks.
    5. The components of all links give the result. No link between different sets is given up: beyond the chances of
       about 1e-8 a pair in (2), (3) and (4), only pairs that are already connected go unverified.

    Words are runs of characters other than blanks (U+0009 to U+000D, U+0020), with A-Z lower-cased; a text with fewer words than
    `width` is one shingle; null and blank texts have no shingles and are linked with nothing. Rows with equal
    doc_id are one node. A row with null doc_id is linked only with rows of an equal set; with no other, its component is null, and
    it is kept. No rows give no rows; other columns are ignored.
    """
    spark, t = docs.sparkSession, percent / 100
    small_batches(spark)
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    sets = stash(shingle_sets(base, width))
    own_sets = stash(sets.select("doc_id", "n", "sid"))
    # equal sets have equal sketches; the first is as good as any
    nodes = stash(sets.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("sig").alias("sig")).where("node IS NOT NULL"))
    del sets
    freed(spark)
    postings = nodes.select("node", "n", F.explode("sketch").alias("v"))
    lengths = postings.groupBy("v").agg(F.count("*").alias("c")).where("c > 1")
    held = postings.join(lengths, "v").select("node", "n", "c", "v").repartition("node")
    by_node = held.groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("c", "v"))).alias("values"), F.sum(F.log2("c")).alias("centre"))
    alone = F.least(F.col("n"), F.lit(K)) - F.size("values")  # values that no other sketch has are the rarest
    take = F.greatest(F.lit(0), prefix_length(F.col("n"), t) - alone).cast("int")
    listed_values = stash(by_node.select("node", "n", "centre", F.explode(F.slice("values", F.lit(1), take)).alias("x")).select("node", "n", "centre", "x.v"))
    freed(spark)
    # lists are cut by size: partners' sizes are of the same or the next class, so each row stands in its own and the next one's list
    size_class = F.floor(F.log(F.col("n")) / F.log(F.lit(1 / t)) + F.lit(1e-9))
    cut = listed_values.withColumn("class", F.explode(F.array(size_class, size_class + 1))).select("node", "n", "centre", F.xxhash64("v", "class").alias("v"))
    paired = cut.groupBy("v").agg(F.count("*").alias("c")).where("c > 1").select("v")
    prefix = stash(cut.join(paired, "v"))
    hubs = prefix.groupBy("v").agg(F.max(F.struct("centre", "node", "n")).alias("hub"))
    listed = stash(prefix.join(hubs, "v").groupBy(F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"), "node", "n").agg(F.count("*").alias("lists")))
    freed(spark)
    # near copies share more than one of their values' lists; the few that don't are left to step 4
    likely = (F.col("node") != F.col("hub")) & size_fits(F.col("n"), F.col("hub_n"), t) & ((F.col("lists") > 1) | (F.col("n") <= K))
    hubbed = listed.where(likely).select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    links = stash(verified(estimated(hubbed, nodes, t), base, width, percent))
    freed(spark)
    labels = components(links)
    labelled = listed.select("hub", "node", "n").join(labels.withColumnRenamed("node", "own"), F.col("node") == F.col("own"), "left").select("hub", "node", "n", F.coalesce("root", "node").alias("label"))
    labelled = stash(labelled)
    mixed = labelled.groupBy("hub").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("hub")
    grouped = stash(labelled.join(mixed, "hub"))
    signed = in_blocks(grouped, "hub", "node", BLOCK).join(only(nodes, "node", grouped.select("node")).select(F.col("node").alias("own"), "sig"), F.col("node") == F.col("own"))
    rest = stash(suspects(signed, t))
    blocks = in_blocks(rest, "hub", "node", BLOCK)
    full = blocks.join(only(base, "doc_id", rest.select("node")), F.col("node") == F.col("doc_id")).select("hub", "i", "j", "side", "node", "label", "text")
    more = stash(linked(full, width, percent))
    final = components(links.union(more))
    of_node = own_sets.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("node")).join(final.withColumnRenamed("node", "own"), F.col("node") == F.col("own"), "left").select(F.col("sid").alias("of"), F.coalesce("root", "node").alias("least"))
    own = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return own_sets.join(of_node, (F.col("sid") == F.col("of")) & (F.col("n") > 0), "left").select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), F.coalesce(F.col("doc_id") == own, own.isNull()).alias("kept"))


def op8(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(tables(spark, sf_dir, "documents"), width=2)


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_sort(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) END AS s FROM words),
nodes AS (SELECT min(doc_id) AS node, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s),
items AS (SELECT node, n, hash(unnest(s)) AS x FROM nodes),
freq AS (SELECT x, count(*) AS c FROM items GROUP BY x),
ranked AS (SELECT node, n, items.x, c, row_number() OVER (PARTITION BY node ORDER BY c, items.x) AS r FROM items JOIN freq ON items.x = freq.x),
listed AS (SELECT node, n, x FROM ranked WHERE c > 1 AND r <= n - ceil(0.8 * n - 1e-9) + 1),
pairs AS (SELECT DISTINCT a.node AS a, b.node AS b FROM listed a JOIN listed b ON a.x = b.x AND a.node < b.node AND least(a.n, b.n) * 100 >= greatest(a.n, b.n) * 80),
common AS (SELECT a, b, len(list_intersect(p.s, q.s)) AS k, p.n + q.n AS total FROM pairs JOIN nodes p ON p.node = a JOIN nodes q ON q.node = b),
links AS (SELECT a, b FROM common WHERE 100 * k >= 80 * (total - k)),
sym AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT node AS a, node AS b FROM nodes UNION SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a),
roots AS (SELECT a AS node, min(b) AS root FROM reach GROUP BY a)
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(root, sets.doc_id) AS component_id, coalesce(root, sets.doc_id) = sets.doc_id AS kept
FROM sets LEFT JOIN nodes ON sets.s = nodes.s LEFT JOIN roots USING (node)
"""
