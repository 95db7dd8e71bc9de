import hashlib

from pyspark.sql import functions as F

from vigil.llm import fingerprints


def test_edits(docs):
    rows = fingerprints.fingerprint_edits(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])).orderBy("doc_id").collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for i, r in enumerate(rows):
        own, after = texts[r.doc_id], texts[rows[(i + 1) % len(rows)].doc_id]
        q = len(own) // 4
        assert r.n_chars == len(own)
        assert r.edited_sha256 == hashlib.sha256((own[: len(own) - q] + after[:q]).encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    got = {r.doc_id: r for r in rows}
    assert got[1].fingerprint == got[2].fingerprint and got[1].near_next == 1.0
    assert got[7].near_edited > 0.4


def test_repeated_null_and_no_rows(docs, none):
    rows = fingerprints.fingerprint_edits(docs).collect()
    assert len(rows) == docs.count() and len([r for r in rows if r.doc_id == 10]) == 2
    assert next(r for r in rows if r.doc_id is None).near_next == 0.0
    assert fingerprints.fingerprint_edits(none).count() == 0


def test_signatures(spark):
    df = spark.createDataFrame([("The cat of dogs runs",), ("the CAT, of: dogs runs!",), ("the cat runs",)], "t string")
    a, b, c = (r.f for r in fingerprints.with_fingerprint(df, "t", "f").collect())
    short = lambda x: hashlib.md5(x.encode()).hexdigest()[:8]
    assert a == b == "-".join(sorted([short("the\x01cat dogs"), short("of\x01dogs runs")])) and c != a


def test_near_pairs_equal_brute_force(spark):
    import itertools
    import random

    rng = random.Random(2)
    sets = []
    for _ in range(30):
        base = {f"{rng.getrandbits(32):08x}" for _ in range(rng.randrange(1, 30))}
        sets += [base, set(sorted(base)[:-1]) or base, base | {f"{rng.getrandbits(32):08x}"}]
    prints = sorted({"-".join(sorted(s)) for s in sets})
    got = {tuple(sorted((r.a, r.b))) for r in fingerprints.near_pairs(spark.createDataFrame([(p,) for p in prints], "fingerprint string")).collect()}
    sim = lambda x, y: len(x & y) / len(x | y)
    assert got == {(a, b) for a, b in itertools.combinations(prints, 2) if sim(set(a.split("-")), set(b.split("-"))) >= 0.8}


def test_likeness_prunes_by_length(spark):
    row = spark.createDataFrame([("a-b-c-d", "a")], "x string, y string").select(fingerprints.likeness("x", "y").alias("e"), fingerprints.likeness("x", "y", 0.5).alias("p")).first()
    assert (row.e, row.p) == (0.25, 0.0)
    assert spark.range(1).select(F.lit(None).cast("string").alias("x"), F.lit("a").alias("y")).select(fingerprints.likeness("x", "y").alias("l")).first().l == 0.0


def test_next_document_across_ranges(spark):
    import random

    rng = random.Random(4)
    ids = [-(1 << 63), (1 << 63) - 1, 0, 5, 1 << 40] + [rng.getrandbits(63) for _ in range(40)] + list(range(100, 160))
    rows = sorted((i, f"document {i} of the other things " * rng.randrange(1, 5)) for i in ids)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n_chars int, fingerprint string")
    got = {r.doc_id: r.edited_sha256 for r in fingerprints.fingerprint_edits(df).collect()}
    for k, (i, t) in enumerate(rows):
        q = len(t) // 4
        assert got[i] == hashlib.sha256((t[: len(t) - q] + rows[(k + 1) % len(rows)][1][:q]).encode()).hexdigest()
