import duckdb
import pytest

import corpus_pipeline
from vigil.llm import registry


def test_stages(spark, docs):
    columns = docs.columns
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, "")
        assert out.columns == columns, name
        now = spark.createDataFrame(out.collect(), docs.schema)
        if name == "language_id":
            assert {4, 5, 6}.isdisjoint({r.doc_id for r in now.collect()})
        if name == "near_dedup":
            ids = [r.doc_id for r in now.collect()]
            assert 1 in ids and 2 not in ids and 3 not in ids and len(ids) == len(set(ids))
    assert corpus_pipeline.STAGES[-1][1](spark, now, "").count() > 0


def test_dedup_judges_rows_with_one_id_apart(spark, docs):
    text = lambda a: " ".join(f"{a}{i}" for i in range(60))
    rows = [(1, text("a")), (2, text("a")), (2, text("b")), (3, text("c")), (3, text("d")), (3, text("d")), (None, text("c")), (None, text("e")), (None, text("e"))]
    df = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], docs.schema)
    got = [(r.doc_id, r.text[0]) for r in corpus_pipeline.deduplicated(spark, df, "").collect()]
    assert sorted(got, key=str) == sorted([(1, "a"), (2, "b"), (3, "c"), (3, "d"), (None, "e")], key=str)


def test_empty(spark, none):
    now = none
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, "")
        assert now.count() == 0


@pytest.mark.parametrize("name", registry.ORACLES)
def test_sql(spark, name):
    d = "/root/testdata/sf0.001"
    c = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        c.execute(f"create view {t} as select * from '{d}/{t}.parquet'")
    df = registry.QUERIES[name](spark, d)
    got = c.execute(registry.ORACLES[name])
    names = [x[0] for x in got.description]
    want = [dict(zip(names, r, strict=True)) for r in got.fetchall()]
    assert sorted(names) == sorted(df.columns)
    assert sorted(str([r[x] for x in sorted(names)]) for r in df.collect()) == sorted(str([r[x] for x in sorted(names)]) for r in want)


def test_clashing_columns_repeated_and_empty_rows(spark, docs):
    from pyspark.sql import functions as F

    names = ("shard", "size", "score", "lang_pred", "kept", "copies", "taken", "length", "__copy", "node", "n")
    now = docs.withColumns({n: F.lit("x") for n in names})
    columns = now.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, "")
        assert now.columns == columns, name
        now = spark.createDataFrame(now.collect(), now.schema)
        assert now.where(" OR ".join(f"`{n}` <> 'x'" for n in names)).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, now, "").count() > 0


def test_run_equals_its_stages_by_brute_force(spark, docs, tmp_path):
    """The rows that a plain implementation of the stages leaves, for the model that the corpus gives."""
    from collections import Counter

    import public_tokenizers
    from tokenizers import Tokenizer

    from vigil.llm import langid, mixing
    from vigil.llm.common import fold

    docs.write.parquet(f"{tmp_path}/documents.parquet")
    model = langid.Scores(langid.fit(docs.where(~langid.held_out())))
    rows = docs.collect()
    languages, scores = model.predict([r.text for r in rows])
    kept = [r for r, lang, score in zip(rows, languages, scores, strict=True) if lang != "und" and score >= corpus_pipeline.LEAST_SCORE]
    order = sorted({(r.doc_id is None, r.doc_id or 0, r.text): r for r in kept}.values(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.text))
    sets = []
    for r in order:
        w = fold(r.text)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)})
    group = list(range(len(order)))
    for i in range(len(order)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group] if group[j] < group[i] else [group[i] if g == group[j] else g for g in group]
    unique = [r for i, r in enumerate(order) if group[i] == i]
    mixed = Counter({r.doc_id: r.copies for r in mixing.copies(spark.createDataFrame(unique, docs.schema)).collect()})
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {r.doc_id: mixed[r.doc_id] * (len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in unique if mixed[r.doc_id]}
    got = Counter()
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r.doc_id] += r.length
    assert got == want
