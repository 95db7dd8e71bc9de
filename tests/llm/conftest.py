import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and to in thren ertion ouble anly thish wherd ondle reath stier".split()


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls in every column, empty and blank texts, one very long text, copies, near copies, and a repeated row."""
    import random

    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "."]) for _ in range(n))
    base = text(120)
    near = base.split()
    near[60] = "changed"
    rows = [(i, text(rng.randrange(5, 90)), "en", f"s{i % 3}", None) for i in range(10, 40)]
    rows += [(1, base, "en", "s0", 1), (2, base, "en", "s1", 1), (3, " ".join(near), "en", None, 1), (4, None, None, "s1", None), (5, "", "en", "s2", 0), (6, " \n\t ", "en", "s2", 4)]
    rows += [(7, text(20_000), "en", "s0", None), (8, "Einzeln", "de", "s2", 7), (9, "été œuvre — naïve 東京", "fr", "s2", 1), (None, "no number here at all", "en", "s2", 1), (10, rows[0][1], "en", "s1", None)]
    return spark.createDataFrame(rows, DOC).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOC)
