import math
from collections import Counter

import pytest

from vigil.llm import lm
from vigil.llm.common import fold


def brute(texts, order=3, least=2):
    words, counts = [fold(t) for t in texts], Counter()
    for w in words:
        for k in range(1, order + 1):
            counts.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    total = sum(map(len, words))

    def s(w, i, k):
        if k == 0:
            return counts[(w[i],)] / total
        gram = tuple(w[i - k : i + 1])
        return counts[gram] / counts[gram[:-1]] if counts[gram] >= least else 0.4 * s(w, i, k - 1)

    return [sum(math.log(s(w, i, min(i, order - 1))) for i in range(len(w))) for w in words]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_equals_brute_force(docs, order):
    rows = docs.collect()
    want = Counter()
    for r, x in zip(rows, brute([r.text for r in rows], order), strict=True):
        want[r.doc_id, round(x, 6)] += 1
    got = Counter((r.doc_id, round(r.log_score, 6)) for r in lm.score(docs, order=order, chunk_bytes=20_000).collect())
    assert got == want


def test_blank_and_no_rows(docs, none):
    got = {r.doc_id: r for r in lm.score(docs).collect()}
    assert all((got[d].n_words, got[d].log_score, got[d].mean_log_score) == (0, 0.0, None) for d in (4, 5, 6))
    assert lm.score(none).count() == 0
    assert lm.score(docs.where("doc_id in (4, 5)")).count() == 2


def test_clashing_names_and_one_id(spark):
    rows = [(1, f"a b c d {i % 3}", i, "x") for i in range(12)]
    got = lm.score(spark.createDataFrame(rows, "doc_id long, text string, chunk int, p string"), chunk_bytes=30).collect()
    assert sorted(round(r.log_score, 6) for r in got) == sorted(round(x, 6) for x in brute([r[1] for r in rows]))
