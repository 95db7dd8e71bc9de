"""Each reference query against its SQL on the smallest tables."""

import duckdb
import pytest

from vigil.plans.oracles import ORACLES
from vigil.plans.queries import QUERIES

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


def shown(v):
    return None if v is None or v != v else round(float(v), 5) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    rows = [tuple(shown(r[c]) for c in sorted(df.columns)) for r in df.collect()]
    assert rows
    if name in ORACLES:
        got = duck.execute(ORACLES[name])
        names = [x[0] for x in got.description]
        assert sorted(names) == sorted(df.columns)
        want = [tuple(shown(dict(zip(names, r, strict=True))[c]) for c in sorted(names)) for r in got.fetchall()]
        assert sorted(rows, key=str) == sorted(want, key=str)


def test_stage0_rows_of_repeated_urls(spark, tmp_path):
    """Pages that share a url, also with blanks around it or null, are judged apart, as the SQL does."""
    rows = [(i, [" a.org/x ", "https://b.org/", None, "https://c.org/?q"][i % 4 if i < 40 else 1], "") for i in range(60)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    df = QUERIES["q_stage0_rows"](spark, str(tmp_path))
    c = duckdb.connect()
    c.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    want = c.execute(f"select {', '.join(df.columns)} from ({ORACLES['q_stage0_rows']})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want) and len(want) == 60


def test_stage0_rows_keep_inputs_single(spark):
    """By url: each input has one row, whatever is repeated or padded on the other sides."""
    from vigil.operators import outcomes

    of = spark.createDataFrame
    inputs = of([(1, "a"), (2, " a "), (3, "b"), (4, "c")], "pos int, url string")
    decisions = of([("a", "p", "w", True, False, "fetched"), ("a", "p", "w", False, False, "fetched")], "url string, admission_path string, review_only_reason string, admitted boolean, review_only boolean, fetch_status string")
    got = outcomes.stage0_rows(inputs, of([("a", 1), ("a ", 2)], "url string, score int"), decisions, of([("b",), ("b",)], "url string"), of([("c",)], "url string")).collect()
    assert sorted((r.input_position, r.score, r.final_status) for r in got) == [(1, 2, "shortlisted"), (2, 2, "shortlisted"), (3, None, "filtered_lexical_miss"), (4, None, "dns_not_mapped_lexical_passthrough")]
