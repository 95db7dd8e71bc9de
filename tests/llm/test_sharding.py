import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from vigil.llm import sharding


def test_law_and_slots(docs):
    rows = sharding.shard_documents(docs).collect()
    assert len(rows) == docs.count() and {r.law for r in rows} == {"bytes"}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert all(r["size"] == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))
    assert all(r.grown_shard is None for r in rows)


def test_balance_with_a_hot_group(spark):
    text = F.when(F.col("id") % 3 == 0, F.lit("copy " * 40)).otherwise(F.concat(F.lit("text "), F.repeat(F.sha1(F.col("id").cast("string").cast("binary")), 5)))
    df = spark.range(3000).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit(1).alias("shard"), F.lit(2).alias("size"))
    size = Counter()
    for r in sharding.shard_documents(df).collect():
        size[r.shard] += r["size"]
    assert max(size.values()) - min(size.values()) < 0.01 * sum(size.values()) / 8


def test_target_bytes_and_any_number_of_leaves(spark):
    df = spark.range(500).select(F.lit(10).cast("long").alias("size"), F.col("id").alias("text_hash"), F.col("id").alias("id_hash"), (F.col("id") % 7).alias("a"), (F.col("id") * 31 % 101).alias("b"))
    sizes = [r["count"] * 10 for r in sharding.kd_shards(df, ["a", "b"], target_bytes=700).groupBy("shard").count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 700
    assert sharding.kd_shards(df, ["a", "b"], leaves=5).select("shard").distinct().count() == 5


def test_no_rows(none):
    assert sharding.shard_documents(none).count() == 0


def plain_tree(rows, dims, leaves):
    """Shard of each row's id by a recursive k-d tree over rows (dicts), cut at the weighted median by (value, text, id)."""
    spread = [max(1, max(r[d] for r in rows) - min(r[d] for r in rows)) for d in dims]
    out = {}

    def split(part, k, base):
        if k == 1:
            out.update({r["id"]: base for r in part})
            return
        wide = [(max(r[d] for r in part) - min(r[d] for r in part)) / s for d, s in zip(dims, spread, strict=True)]
        dim = dims[wide.index(max(wide))]
        part = sorted(part, key=lambda r: (r[dim], r["text_hash"], r["id_hash"]))
        want, at = sum(r["size"] for r in part) * (k // 2) / k, 0
        for i, r in enumerate(part):
            if at + r["size"] >= want:
                cut = i if want - at <= at + r["size"] - want else i + 1
                break
            at += r["size"]
        split(part[:cut], k // 2, base)
        split(part[cut:], k - k // 2, base + k // 2)

    split(rows, leaves, 0)
    return out


def test_equals_a_plain_tree(spark, monkeypatch):
    import random

    rng = random.Random(6)
    rows = [{"id": i, "size": rng.randrange(1, 500), "text_hash": rng.getrandbits(47), "id_hash": rng.getrandbits(47), "a": rng.choice([5, 900, 2**31]), "b": int(rng.gauss(0, 1000))} for i in range(400)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "id long, size long, text_hash long, id_hash long, a long, b long")
    for leaves in (2, 5, 8):
        got = {r.id: r.shard for r in sharding.kd_shards(df, ["a", "b"], leaves=leaves, slack=0.0).collect()}
        assert got == plain_tree(rows, ["a", "b"], leaves), leaves
    # fewer bins for each node: more passes, the same tree
    monkeypatch.setattr(sharding, "MOST_ROWS", 16)
    assert {r.id: r.shard for r in sharding.kd_shards(df, ["a", "b"], leaves=8, slack=0.0).collect()} == got


def test_rows_without_ids(spark):
    df = spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("t"), F.col("id") % 1500).alias("text"), F.lit(None).cast("string").alias("lang"))
    slots = defaultdict(list)
    for r in sharding.shard_documents(df).collect():
        slots[r.shard].append(r.slot)
    assert sum(map(len, slots.values())) == 2000 and all(sorted(s) == list(range(len(s))) for s in slots.values())
