import math
import random
from collections import Counter

from pyspark.sql import functions as F

from vigil.llm import search
from vigil.llm.common import fold, stash


def brute(docs, queries, k):
    bags = [(d, Counter(fold(t))) for d, t in docs if d is not None]
    df = Counter(w for _, b in bags for w in b)
    n, sizes = len(bags), [sum(b.values()) for _, b in bags]
    mean = sum(sizes) / n
    idf = {w: math.log(1 + (n - c + 0.5) / (c + 0.5)) for w, c in df.items()}
    out = {}
    for q, text in queries:
        bag = Counter(fold(text))
        terms = [w for w in bag if w in idf]
        hits = [(-sum(idf[w] * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * s / mean)) for w in terms if w in b), d) for (d, b), s in zip(bags, sizes, strict=True) if any(w in b for w in terms)]
        out[q] = [(d, round(-s, 6)) for s, d in sorted((round(s, 9), d) for s, d in hits)[:k]]
    return out


def test_equals_brute_force(docs):
    df = docs.select("doc_id", "text", F.lit(1).alias("rank")).dropDuplicates(["doc_id"])
    queries = df.where("doc_id % 2 = 0").select(F.col("doc_id").alias("query_id"), "text")
    index = stash(search.build_index(df, shard_bytes=2000))
    got = {}
    for r in search.search(df, queries, k=5, index=index).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.doc_id, round(r.score, 6)))
    want = brute([(r.doc_id, r.text) for r in df.collect()], [(r.query_id, r.text) for r in queries.collect()], 5)
    assert got == {q: s for q, s in want.items() if s}


def test_op9_searches_by_all_terms(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(90)}" for _ in range(rng.choice([5, 30, 60]))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[100]) for i in range(15)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    asked = [(i, t) for i, t in rows if i % 100 == 0]
    got = {}
    for r in search.op9(spark, str(tmp_path)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.doc_id, r.score))
    assert got == brute(rows, asked, 10)
    assert [d for d, _ in got[100]] == [100, *range(1000, 1009)]
    monkeypatch.setattr(search, "TERMS", 60)
    again = search.op9(spark, str(tmp_path)).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.doc_id) for r in again] == [(q, d) for q in sorted(got) for d, _ in got[q]]


def test_blocks_hold_whole_queries(spark):
    sizes = {q: 1 + q * 7 % 40 for q in range(60)} | {60: 500}
    terms = spark.createDataFrame([(q, t, 1.0) for q, n in sizes.items() for t in range(n)], "query_id long, term long, weight double")
    blocks = [Counter(r.query_id for r in b.collect()) for b in search.blocks_of(terms, 200)]
    assert len(blocks) > 5 and sum(blocks, Counter()) == sizes and sum(map(len, blocks)) == len(sizes)
    assert all(b.total() <= 200 or 60 in b for b in blocks)


def test_no_rows(docs, none):
    assert search.search(none, none.select(F.col("doc_id").alias("query_id"), "text")).count() == 0
    assert search.search(docs, none.select(F.col("doc_id").alias("query_id"), "text")).count() == 0


def test_pruning_loses_nothing(spark, monkeypatch):
    """Many small shards of two vocabularies, small blocks and matrices, groups of copies, and queries of one to hundreds of words."""
    monkeypatch.setattr(search, "MATRIX", 4096)
    monkeypatch.setattr(search, "HELD", 512)
    rng = random.Random(8)
    word = lambda side: f"{side}{min(int(rng.paretovariate(0.6)), 400)}"
    texts = [" ".join(word(rng.choice("ab") if i % 10 == 0 else "ab"[i % 2]) for _ in range(rng.choice([1, 3, 20, 60, 300]))) for i in range(700)]
    texts += [texts[5]] * 60 + [texts[6]] * 9
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    index = stash(search.build_index(df, shard_bytes=4000))
    assert index.count() > 40
    got = {}
    for r in search.search(df, df.where("doc_id % 7 = 0").withColumnRenamed("doc_id", "query_id"), index=index).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.doc_id, round(r.score, 6)))
    assert got == brute(rows, [(i, t) for i, t in rows if i % 7 == 0], 10)
