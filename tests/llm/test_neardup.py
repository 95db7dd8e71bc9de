import random

from pyspark.sql import functions as F

from vigil.llm import neardup
from vigil.llm.common import fold
from vigil.llm.components import components


def brute(rows, width, percent):
    def shingles(text):
        w = fold(text)
        return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return {d: (len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)}


def texts(n=60, seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(n):
        words = rng.choices(vocabulary, k=rng.choice([1, 2, 5, 30, 60, 150, 400]))
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(words)
            for _ in range(rng.randrange(0, 1 + len(copy) // 15)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    return rows


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", b"y") for r in rows], "doc_id long, text string, n string, sid binary").repartition(3)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, **options).collect()}


def test_equals_brute_force(spark):
    rows = texts()
    assert run(spark, rows, width=2) == brute(rows, 2, 80)


def test_five_words_and_group_of_near_copies(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(120)]
    rows = [(0, " ".join(words))]
    for i in range(1, 80):
        copy = list(words)
        copy[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    assert run(spark, rows, width=5) == brute(rows, 5, 80)


def test_blocks_of_long_lists(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    rows = texts(25, 4)
    assert run(spark, rows, width=2) == brute(rows, 2, 80)


def test_edges(docs, none):
    got = neardup.near_duplicates(docs, width=2).collect()
    assert len(got) == docs.count()
    by = {r.doc_id: r for r in got}
    assert by[2].component_id == by[1].component_id == by[3].component_id == 1 and by[1].kept and not by[2].kept
    assert all(by[d].n_shingles == 0 and by[d].component_id == d and by[d].kept for d in (4, 5, 6))
    assert by[8].n_shingles == 1 and by[None].component_id is None and by[None].kept
    assert neardup.near_duplicates(none).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.range(1, 200).select(F.col("id").alias("u"), (F.col("id") - 1).alias("v"))
    got = components(edges.union(spark.createDataFrame([(1000, 1001), (5, 5)], "u long, v long"))).collect()
    assert {r.root for r in got if r.node < 200} == {0} and {r.node: r.root for r in got if r.node > 999} == {1000: 1000, 1001: 1000}
