"""K-d tree partitioning of rows into shards of near equal bytes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import stash, tables

#: Bins of one pass's histogram for each open node, at most and at least, and rows of all histograms that the driver gets at once, if
#: the least allows it.
BINS, LEAST_BINS, MOST_ROWS = 512, 8, 1 << 21
_HASH = (1 << 48) - 1


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND(F.lit(_HASH))


class Cut:
    """The search for one node's weighted median along a dimension; keys are (value, text hash, id hash) in that order."""

    def __init__(self, node: int, dim: int, low: int, high: int, weight: int, want: float, slack: float, bins: int):
        self.node, self.dim, self.weight, self.want, self.slack, self.bins = node, dim, weight, want, slack, bins
        self.prefix: list[int] = []
        self.low, self.high, self.before, self.key = low, high, 0, None

    def width(self) -> int:
        return (self.high - self.low) // self.bins + 1

    def narrow(self, bins: list[tuple[int, int, int]]) -> None:
        """bins: (weight, least, greatest value) of the bins that have rows, in order. Sets key, the exclusive upper bound of
        the left part, or narrows the search to the bin that holds the median."""
        at = self.before
        for weight, least, greatest in bins:
            if at + weight < self.want:
                at += weight
                continue
            last = len(self.prefix) == 2 and least == greatest
            left, right = self.want - at, at + weight - self.want
            if min(left, right) <= self.slack or last:
                self.key = [*self.prefix, least if left <= right else greatest + 1]
            elif least == greatest:
                self.prefix.append(least)
                self.before, self.low, self.high = at, 0, _HASH
            else:
                self.before, self.low, self.high = at, least, greatest
            return
        self.key = [*self.prefix, self.high + 1]


def kd_shards(points: DataFrame, dims: list[str], *, leaves: int | None = None, target_bytes: int | None = None, slack: float = 0.0005) -> DataFrame:
    """points with `shard`, the number of the k-d tree's leaf, from 0 in the tree's order.

    points: size long, text_hash and id_hash long (48 bits), and the dims, longs that aren't null. The tree splits each node at the
    weighted median of its bytes along the dimension that is widest there (its range over the whole table's range)
    until leaves have target_bytes, or there are `leaves` of them. Rows that are equal in the dimension are split by their
    text's hash, so that equal texts stay together, and only within a group of equal texts, by id, where a cut would otherwise
    miss the median by more than `slack` of the node's bytes.

    Medians are found for all nodes of a level together by histograms that close in on them: each pass sums at most
    512 bins a node with partial sums before the shuffle, so neither a hot value nor a large group meets in one task. With many
    open nodes a histogram has fewer bins, 8 at least, and there are more passes. The driver holds the cuts, a few numbers a
    leaf, and one pass's bins: 2 million rows, or 8 a leaf.
    """
    spark = points.sparkSession
    whole = points.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), *[f(d).alias(f"{n}_{d}") for d in dims for n, f in (("min", F.min), ("max", F.max))]).first()
    count = leaves or max(1, math.ceil(whole["bytes"] / target_bytes))
    tree = points.withColumn("__node", F.lit(0))
    parts, base = {0: count}, {0: 0}  # leaves below a node, and the number of its first leaf
    done: dict[int, int] = {}
    spread = [max(1, (whole[f"max_{d}"] or 0) - (whole[f"min_{d}"] or 0)) for d in dims]
    while True:
        for node in [n for n, k in parts.items() if k == 1]:
            done[node] = base[node]
            parts.pop(node)
        if not parts:
            break
        stats = tree.groupBy("__node").agg(F.sum("size").alias("bytes"), *[f(d).alias(f"{n}_{d}") for d in dims for n, f in (("min", F.min), ("max", F.max))]).collect()
        open_cuts, bins = {}, max(LEAST_BINS, min(BINS, MOST_ROWS // len(parts)))
        for r in stats:
            if (n := r["__node"]) in parts:
                wide = [(r[f"max_{d}"] - r[f"min_{d}"]) / spread[i] for i, d in enumerate(dims)]
                i = wide.index(max(wide))
                open_cuts[n] = Cut(n, i, r[f"min_{dims[i]}"], r[f"max_{dims[i]}"], r["bytes"], r["bytes"] * (parts[n] // 2) / parts[n], r["bytes"] * slack, bins)
        cuts = dict(open_cuts)
        while open_cuts:
            found: dict[int, list] = {n: [] for n in open_cuts}
            for r in _histogram(tree, dims, list(open_cuts.values())).collect():
                found[r["__node"]].append((r.bin, r.bytes, r.least, r.greatest))
            for n, c in list(open_cuts.items()):
                c.narrow([x[1:] for x in sorted(found[n])])
                if c.key is not None:
                    open_cuts.pop(n)
        table = [(n, c.dim, *(c.key + [-1, -1])[:3]) for n, c in cuts.items()]
        empty = [n for n in parts if n not in cuts]  # no rows: the halves are empty, too
        side = spark.createDataFrame(table, "c_node int, c_dim int, k0 long, k1 long, k2 long") if table else None
        if side is not None:
            value = F.when(F.col("c_dim") == 0, F.col(dims[0]))
            for i, d in enumerate(dims[1:], 1):
                value = value.when(F.col("c_dim") == i, F.col(d))
            left = (value < F.col("k0")) | ((value == F.col("k0")) & ((F.col("text_hash") < F.col("k1")) | ((F.col("text_hash") == F.col("k1")) & (F.col("id_hash") < F.col("k2")))))
            # a row of five numbers for each open node
            tree = tree.join(F.broadcast(side), F.col("__node") == F.col("c_node"), "left").withColumn("__node", F.when(F.col("c_node").isNull(), F.col("__node")).when(left, 2 * F.col("__node") + 1).otherwise(2 * F.col("__node") + 2)).drop("c_node", "c_dim", "k0", "k1", "k2")
        for n in [*cuts, *empty]:
            k, b = parts.pop(n), base[n]
            parts |= {2 * n + 1: k // 2, 2 * n + 2: k - k // 2}
            base |= {2 * n + 1: b, 2 * n + 2: b + k // 2}
    names = spark.createDataFrame(list(done.items()), "leaf int, shard int")
    return tree.join(F.broadcast(names), F.col("__node") == F.col("leaf")).drop("leaf", "__node")


def _histogram(tree: DataFrame, dims: list[str], cuts: list[Cut]) -> DataFrame:
    """Bytes, least and greatest value of each bin of each cut still open."""
    side = tree.sparkSession.createDataFrame([(c.node, c.dim, len(c.prefix), c.low, c.high, c.width(), *(c.prefix + [0, 0])[:2]) for c in cuts], "c_node int, c_dim int, depth int, low long, high long, width long, p0 long, p1 long")
    value = F.when(F.col("c_dim") == 0, F.col(dims[0]))
    for i, d in enumerate(dims[1:], 1):
        value = value.when(F.col("c_dim") == i, F.col(d))
    depth = F.col("depth")
    return (
        tree.join(F.broadcast(side), F.col("__node") == F.col("c_node"))
        .withColumn("d", value)
        .where((depth == 0) | ((F.col("d") == F.col("p0")) & ((depth == 1) | (F.col("text_hash") == F.col("p1")))))
        .withColumn("v", F.when(depth == 0, F.col("d")).when(depth == 1, F.col("text_hash")).otherwise(F.col("id_hash")))
        .where(F.col("v").between(F.col("low"), F.col("high")))
        .groupBy("__node", F.floor((F.col("v") - F.col("low")) / F.col("width")).alias("bin"))
        .agg(F.sum("size").alias("bytes"), F.min("v").alias("least"), F.max("v").alias("greatest"))
    )


def with_slots(sharded: DataFrame, *, rows_per_cell: int = 50_000) -> DataFrame:
    """sharded with `slot`, gapless from 0 within each shard.

    A shard's rows are numbered within cells of about rows_per_cell, dealt by hashes of id and text, and the cells' offsets are added: no
    task sees a whole shard, also where ids are null or repeated. Cells and offsets meet under the same partitioning, without a second shuffle of the rows.
    """
    n = sharded.count()
    cells = max(1, math.ceil(n / rows_per_cell))
    rows = sharded.withColumn("__cell", F.pmod(F.xxhash64("id_hash", "text_hash"), F.lit(cells)))
    sizes = rows.groupBy("shard", "__cell").agg(F.count("*").alias("n"))
    order = Window.partitionBy("shard").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "__cell", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("__offset"))
    numbered = rows.withColumn("slot", F.row_number().over(Window.partitionBy("shard", "__cell").orderBy("id_hash", "doc_id", "text_hash")))
    return numbered.join(offsets, ["shard", "__cell"]).withColumn("slot", (F.col("slot") - 1 + F.col("__offset")).cast("long")).drop("__cell", "__offset")


def shard_documents(docs: DataFrame, *, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of docs, under the law 'bytes': the shards' sizes are near equal.

    Dimensions: the language's hash and the logarithm of the size, which are metadata, and the text's checksum, which isn't: it is there
    so that a cut falls between texts. All are equal for equal texts of one language, so that copies share a shard unless a
    median falls inside a very large group of them.

    size is the text's bytes plus 1; null text has none and the checksum of the empty text. Null ids and languages
    count as empty; repeated rows get slots of their own; no rows give no rows; other columns are ignored. The texts are read
    once; a few numbers a row are written to the checkpoint folder and read by the passes.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    points = stash(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            text_hash(F.col(text_col)).alias("text_hash"),
            F.xxhash64(F.coalesce(F.col(id_col).cast("long"), F.lit(0)), F.lit("id")).bitwiseAND(F.lit(_HASH)).alias("id_hash"),
            F.crc32(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).cast("binary")).alias("by_lang"),
        ).withColumn("by_size", (F.log2("size") * 1000).cast("long"))
    )
    leaves = kd_shards(points, ["by_lang", "by_size", "text_crc32"], leaves=shards)
    return with_slots(leaves).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2(spark, sf_dir: str) -> DataFrame:
    return shard_documents(tables(spark, sf_dir, "documents"))
