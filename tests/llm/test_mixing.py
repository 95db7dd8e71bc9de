import re
from collections import Counter

from vigil.llm import mixing


def water_fill(sizes, limit=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > limit * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = limit * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_targets_and_copies(docs):
    rows = mixing.copies(docs).collect()
    assert len(rows) == docs.count()
    size = Counter()
    for r in docs.collect():
        size[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    want = water_fill(size)
    by_size = {size[s]: want[s] for s in size}
    assert all(abs(r.target - by_size[r.source_size]) < 1e-6 and r.taken == r["size"] * r.copies and r.copies <= 3 for r in rows)
    assert sorted(rows, key=str) == sorted(mixing.copies(docs.repartition(7)).collect(), key=str)


def test_taken_is_near_the_target(spark):
    rows = [(i, "w " * (1 + i * 37 % 50), "ab"[i % 5 == 0], 9) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    ratios = []
    for seed in range(6):
        taken, target, squares = Counter(), {}, Counter()
        for r in mixing.copies(df, seed=seed).collect():
            taken[r.source_size] += r.taken
            squares[r.source_size] += r["size"] ** 2
            target[r.source_size] = r.target
        # four standard deviations of independent draws
        assert all(abs(taken[s] - target[s]) <= 2 * squares[s] ** 0.5 for s in taken)
        ratios += [taken[s] / target[s] - 1 for s in taken]
    assert abs(sum(ratios)) / len(ratios) < 0.02


def test_draws_do_not_depend_on_other_documents(spark):
    rows = [(i, "w " * 5, "ab"[i % 2]) for i in range(400)]
    get = lambda x: {r.doc_id: r.copies for r in mixing.copies(spark.createDataFrame(x, "doc_id long, text string, source string")).collect()}
    first, second = get(rows), get([*rows, *((1000 + i, "w " * 5, "ab"[i % 2]) for i in range(400))])
    assert {d: second[d] for d in first} == first and len(set(first.values())) > 1
    # rows without id are drawn apart
    nameless = [(None, f"{i} w w w", "ab"[i % 2]) for i in range(400)]
    assert len({r.copies for r in mixing.copies(spark.createDataFrame(nameless, "doc_id long, text string, source string")).collect()}) > 1


def test_mix_emits_rows(docs):
    n = {(r.doc_id): r.copies for r in mixing.copies(docs).collect()}
    out = Counter(r.doc_id for r in mixing.mix(docs).collect())
    assert mixing.mix(docs).columns == docs.columns
    assert all(out[d] == k for d, k in n.items() if d not in (10,)) and set(out) <= set(n)


def test_no_rows_and_no_words(spark, none):
    assert mixing.copies(none).count() == 0 and mixing.mix(none).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {(r.target, r.taken) for r in mixing.copies(blank).collect()} == {(0.0, 0)}
