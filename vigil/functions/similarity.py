"""String similarities that Spark lacks, as Arrow-batched functions; equal pairs of a batch are computed once."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def jaro_winkler(a: str, b: str) -> float:
    """Jaro-Winkler similarity; the prefix counts 0.1 a character, four at most, and only above 0.7."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    free, left = [True] * len(b), []
    for i, c in enumerate(a):
        j = next((j for j in range(max(0, i - reach), min(len(b), i + reach + 1)) if free[j] and b[j] == c), None)
        if j is not None:
            free[j] = False
            left.append(c)
    if not left:
        return 0.0
    right = [c for c, f in zip(b, free, strict=True) if not f]
    m = len(left)
    jaro = (m / len(a) + m / len(b) + (m - sum(x != y for x, y in zip(left, right, strict=True)) // 2) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(4, len(a), len(b)))
    return jaro + prefix * 0.1 * (1 - jaro)


def most_similar(a: str, b: int) -> float:
    """The greatest Jaro-Winkler similarity that a text can have to one of b characters: all of the shorter one's match, in order."""
    if not a or not b:
        return 0.0
    m = min(len(a), b)
    jaro = (m / len(a) + m / b + 1) / 3
    return jaro + 0.4 * (1 - jaro)


def best_jaro_winkler(a: str, others: list[str], apart: int | None = None) -> tuple[float, int]:
    """(similarity, place) of the first of others that is most similar to a; (0, -1) without any. Only lengths up to `apart` away count;
    those that can't exceed the best so far by their lengths alone aren't compared."""
    best, at = 0.0, -1
    for i, b in enumerate(others):
        if (apart is None or abs(len(a) - len(b)) <= apart) and most_similar(a, len(b)) > best and (x := jaro_winkler(a, b)) > best:
            best, at = x, i
    return best, at


def indel_ratio(a: str, b: str) -> float:
    """100 * 2 * longest common subsequence / both lengths."""
    if not a and not b:
        return 100.0
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return 200.0 * row[-1] / (len(a) + len(b))


def token_set_ratio(a: str, b: str) -> float:
    """The best Indel ratio among the common words and these with each side's other words."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    left, right = (" ".join(filter(None, [both, *[" ".join(sorted(s))]])) for s in (x - y, y - x))
    if both and (x <= y or y <= x):
        return 100.0
    return max(indel_ratio(left, right), *((indel_ratio(both, left), indel_ratio(both, right)) if both else (0.0,)))


def _pairwise(f: Callable[[str, str], float]):
    @F.pandas_udf(T.DoubleType())
    def udf(a: pd.Series, b: pd.Series) -> pd.Series:
        known: dict[tuple, float | None] = {}
        return pd.Series([known[p] if p in known else known.setdefault(p, None if p[0] is None or p[1] is None else f(*p)) for p in zip(a, b, strict=True)], dtype="float64")

    return udf


jaro_winkler_udf, indel_ratio_udf, token_set_ratio_udf = _pairwise(jaro_winkler), _pairwise(indel_ratio), _pairwise(token_set_ratio)


def best_of_list(apart: int | None = None):
    """A function of a text and an array of texts: struct(similarity, place) by best_jaro_winkler(); place from 0. Equal pairs of a batch
    are computed once."""

    @F.pandas_udf("similarity double, place int")
    def udf(a: pd.Series, others: pd.Series) -> pd.DataFrame:
        known: dict[tuple, tuple] = {}
        pairs = [(x, tuple(y) if y is not None else ()) for x, y in zip(a, others, strict=True)]
        found = [known[p] if p in known else known.setdefault(p, best_jaro_winkler(p[0] or "", p[1], apart)) for p in pairs]
        return pd.DataFrame(found, columns=["similarity", "place"])

    return udf


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")
