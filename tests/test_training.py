import random

from vigil.operators import training


def test_tuned_and_stacked(spark):
    rng = random.Random(1)
    rows = []
    for i in range(120):
        y = i % 2
        rows.append((float(y), None if i % 17 == 0 else y + rng.random(), "ab"[rng.random() < 0.5], f"{'login secure' if y else 'news sport'} {i % 5}", rng.random()))
    df = spark.createDataFrame(rows, "label double, x double, kind string, body string, extra double")
    model = training.tuned(df, training.preparation(["x"], ["kind"], "body", terms=20), folds=2)
    scored = training.with_probability(df, model)
    assert scored.where("prediction = label").count() > 110
    assert scored.where("top__p < 0.5").count() == 0
    both = training.stacked(df, model, ["extra"]).transform(scored)
    assert both.where("stack__y = label").count() > 110
