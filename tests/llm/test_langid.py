from vigil.llm import langid


def corpus(spark):
    kinds = {"en": "the and of house water through", "de": "und der nicht schön durch wasser", "fr": "le les été où forêt eau"}
    rows = [(i, " ".join(w for j, w in enumerate(kinds[lang].split() * 4) if (i + j) % 3), lang, "s") for i, lang in enumerate(list(kinds) * 60)]
    return spark.createDataFrame([*rows, (900, None, "en", "s"), (901, "12 — 34", "en", "s"), (902, "", None, "s"), (903, "Schönheit", None, "s"), (None, "the house", None, "s"), (904, "the " * 60_000, None, "s")], "doc_id long, text string, lang string, score string")


def test_held_out_accuracy_and_edges(spark):
    df = corpus(spark)
    got = {r.doc_id: r for r in langid.identify(df).collect()}
    assert len(got) == df.count()
    assert all(got[r.doc_id].lang_pred == r.lang for r in df.where(langid.held_out()).collect() if r.lang and r.doc_id < 900)
    assert all((got[d].lang_pred, got[d].score) == ("und", 0.0) for d in (900, 901, 902))
    assert got[903].lang_pred == "de" and got[None].lang_pred == "en" and got[904].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got.values())


def test_lang_source_and_id_are_no_inputs(spark):
    from pyspark.sql import functions as F

    df = corpus(spark)
    model = langid.fit(df)
    a = {(r.text, r.lang_pred, r.score) for r in langid.predict(df, model).collect()}
    b = {(r.text, r.lang_pred, r.score) for r in langid.predict(df.withColumn("lang", F.lit("xx")).withColumn("doc_id", F.lit(0)), model).collect()}
    assert a == b


def test_nothing_learned_and_no_rows(spark, none):
    df = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert langid.identify(df).first().lang_pred == "und"
    assert langid.identify(none).count() == 0


def test_word_first_then_longest_grams():
    import numpy as np

    v = lambda *x: np.array(x, float)
    m = langid.Model(["a", "b"], {"xy": v(0, -5)}, {"<z": v(-9, 0), "z": v(-1, -1), ">": v(-1, -1)}, 2, v(-20, -20))
    languages, scores = langid.Scores(m).predict(["xy", None, "z", "...", "xy z", "xy"])
    assert languages == ["a", "und", "b", "und", "a", "a"] and scores[1] == scores[3] == 0.0 and scores[0] == scores[5]
    assert langid.Scores(m).predict(["xy " * 300_000, "z"])[0] == ["a", "b"]
    # unseen words are dropped once they are many, and found again
    scores = langid.Scores(m)
    scores.MOST = 3
    words = [f"z{chr(97 + i)}" for i in range(20)]
    first = [scores.predict([w, "xy"]) for w in words]
    assert first == [langid.Scores(m).predict([w, "xy"]) for w in words] == [scores.predict([w, "xy"]) for w in words]


def plain(rows, n_max=4):
    """The same model by dictionaries: (text) -> (language, score)."""
    import math
    import re
    from collections import Counter

    words, grams = {}, {}
    for text, lang in rows:
        if lang and text:
            for w in re.findall(r"[^\W\d_]+", text.lower()):
                words.setdefault(lang, Counter())[w] += 1
                for k in range(1, n_max + 1):
                    grams.setdefault((lang, k), Counter()).update(f"<{w}>"[i : i + k] for i in range(len(w) + 3 - k))
    languages = sorted(words)
    known, pieces = set().union(*words.values()), {k: set().union(*(c for (_, o), c in grams.items() if o == k)) for k in range(1, n_max + 1)}
    log = lambda c, w: math.log((c[w] + 0.5) / (sum(c.values()) + 1))

    def word(w, lang):
        if w in known:
            return log(words[lang], w)
        t, total = f"<{w}>", 0.0
        for i in range(len(t)):
            k = next((k for k in range(min(n_max, len(t) - i), 0, -1) if t[i : i + k] in pieces[k]), 0)
            total += log(grams.get((lang, k), Counter()), t[i : i + k]) if k and (lang, k) in grams else math.log(0.5 / 2) if k else -math.log(1e6)
        return total / len(t)

    def predict(text):
        tokens = re.findall(r"[^\W\d_]+", (text or "").lower())
        if not tokens:
            return "und", 0.0
        sharp = [sum(word(w, x) for w in tokens) / len(tokens) * min(len(tokens), 12) for x in languages]
        p = [math.exp(x - max(sharp)) for x in sharp]
        best = max(range(len(p)), key=p.__getitem__)
        return languages[best], p[best] / sum(p)

    return predict


def test_equals_a_plain_model(spark):
    long = "abcdefghij" * 30
    rows = [(1, "the house the water", "en"), (2, "das haus das wasser", "de"), (3, f"le {long} eau", "fr"), (4, f"unseen words {long[5:]} houses wassern", None), (5, "zzz", None), (6, "eaux a", None), (7, long + "x", None), (8, "aqua", "la")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = plain([r[1:] for r in rows])
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(df, langid.fit(df)).collect()}
    for i, text, _ in rows:
        language, score = want(text)
        assert got[i][0] == language and abs(got[i][1] - score) < 1e-9, i


def test_letters_behind_the_64th_count_and_any_number_of_languages(spark):
    same = "q" * 100
    rows = [(1, same + "uvw" * 20, "aa"), (2, same + "xyz" * 20, "bb"), (3, same + "xyz" * 21, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id: r.lang_pred for r in langid.predict(df, langid.fit(df)).collect()}[3] == "bb"
    many = spark.createDataFrame([(i, f"wort{chr(97 + i // 26)}{chr(97 + i % 26)}", f"l{i:03d}") for i in range(230)], "doc_id long, text string, lang string")
    assert all(r.lang_pred == r.lang for r in langid.predict(many, langid.fit(many)).collect())
