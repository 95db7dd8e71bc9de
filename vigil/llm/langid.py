"""Language identification by word-first backoff."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm.common import small_batches, tables

#: A token for this purpose: letters only.
_LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
#: Slices of a language's words and n-grams that are ranked apart.
SLICES = 16
#: Words from which a text is summed by itself.
LONG = 1 << 18


def held_out(id_col="doc_id"):
    """Documents whose crc32(doc_id as text) mod 5 is 0 aren't learned from. A null id counts as empty text, whose remainder is 0."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


class Model:
    """Log frequencies of words and character n-grams by language.

    languages: sorted. words: word to a vector over the languages. grams: the same for n-grams of order 1 to n_max of '<word>'.
    """

    def __init__(self, languages: list[str], words: dict[str, np.ndarray], grams: dict[str, np.ndarray], n_max: int, floor: np.ndarray):
        self.languages, self.words, self.grams, self.n_max, self.floor = languages, words, grams, n_max, floor


class Scores:
    """Rows of a table for words: known words first, then unseen ones as they come, by their n-grams."""

    MOST = 200_000  # unseen words that are kept for further batches

    def __init__(self, model: Model):
        self.model = model
        self.grams = {g: i for i, g in enumerate(model.grams, 1)}
        self.gram_table = np.array([model.floor, *model.grams.values()], float)
        self.known = np.array(list(model.words.values()), float).reshape(len(model.words), len(model.languages))
        self.forget()

    def forget(self) -> None:
        """Keep the known words only."""
        self.rows = {w: i for i, w in enumerate(self.model.words)}
        self.table, self.size = self.known, len(self.known)

    def learn(self, words: list[str]) -> None:
        """Rows for unseen words: the mean, over a word's positions, of the longest known n-gram that starts there."""
        find, n_max, ids, sizes = self.grams.get, self.model.n_max, [], []
        for word in words:
            text = f"<{word}>"
            for i in range(len(text)):
                for j in range(min(i + n_max, len(text)), i, -1):
                    if at := find(text[i:j]):
                        ids.append(at)
                        break
                else:
                    ids.append(0)
            sizes.append(len(text))
        means = np.add.reduceat(self.gram_table[ids], np.cumsum([0, *sizes[:-1]])) / np.array(sizes)[:, None]
        if self.size + len(words) > len(self.table):
            self.table = np.concatenate([self.table[: self.size], np.zeros((max(len(words), self.size), self.table.shape[1]))])
        self.table[self.size : self.size + len(words)] = means
        self.rows.update(zip(words, range(self.size, self.size + len(words)), strict=True))
        self.size += len(words)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of whole texts."""
        languages, scores, held, sizes, at, chars = [UNKNOWN] * len(texts), [0.0] * len(texts), [], [], [], 0

        def close() -> None:
            if unseen := [w for w in dict.fromkeys(held) if w not in self.rows]:
                self.learn(unseen)
            rows = np.fromiter(map(self.rows.__getitem__, held), np.int64, len(held))
            if len(sizes) == 1 and len(rows) > LONG:
                sums = (np.bincount(rows, minlength=self.size) @ self.table[: self.size])[None]
            else:
                sums = np.add.reduceat(self.table[rows], np.cumsum([0, *sizes[:-1]]))
            mean = sums / np.array(sizes)[:, None]
            sharp = mean * np.minimum(sizes, 12)[:, None]
            p = np.exp(sharp - sharp.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            best = p.argmax(1)
            for i, b, x in zip(at, best.tolist(), p[np.arange(len(at)), best].tolist(), strict=True):
                languages[i], scores[i] = self.model.languages[b], x
            if self.size - len(self.known) > self.MOST:
                self.forget()
            held.clear()
            sizes.clear()
            at.clear()

        for i, text in enumerate(texts):
            tokens = _LETTERS.findall(text.lower()) if text and self.model.languages else []
            if tokens and any(c.isalpha() for c in text):  # superscripts and the like are no letters
                if len(tokens) > LONG and at:
                    close()
                held += tokens
                sizes.append(len(tokens))
                at.append(i)
                chars += len(text)
                if chars > 1 << 20:
                    close()
                    chars = 0
        if at:
            close()
        return languages, scores


def fit(labelled: DataFrame, *, sample_docs: int = 20_000, top_words: int = 5_000, top_grams: int = 4_000, n_max: int = 4) -> Model:
    """A model from labelled(doc_id, text, lang).

    It is fitted on a sample of about sample_docs labelled documents, taken by a hash of doc_id whatever the table's order and
    size. Counts are made in DataFrame operations with partial sums; the driver gets, for each language, the top_words
    commonest words and for each order 1 to n_max the top_grams commonest character n-grams: the model's size is fixed by
    the sample and by what there are of languages in it. Ranks are taken in slices of each language first, so that no
    task gets all words of one. Words of any length are counted whole. Rows without text or lang teach nothing; without
    any other, the model has no languages. Null ids count as one.
    """
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    n = known.count()
    share = min(1.0, sample_docs / max(1, n))
    sample = known.where(F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("langid")), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))) if share < 1 else known
    tokens = sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}]+)"), F.lit(1))).alias("word"))
    counts = tokens.groupBy("lang", "word").agg(F.count("*").alias("n"))
    shared = counts.persist()
    try:
        sizes = {r["lang"]: r.n for r in shared.groupBy("lang").agg(F.sum("n").alias("n")).collect()}

        def top(counted: DataFrame, most: int, *part: str) -> list:
            order = (F.desc("n"), F.col("item"))
            sliced = counted.withColumn("slice", F.pmod(F.xxhash64("item"), F.lit(SLICES))).withColumn("r", F.row_number().over(Window.partitionBy(*part, "slice").orderBy(*order))).where(F.col("r") <= most)
            return sliced.withColumn("r", F.row_number().over(Window.partitionBy(*part).orderBy(*order))).where(F.col("r") <= most).collect()

        words = top(shared.withColumnRenamed("word", "item"), top_words, "lang")
        # a long word goes in pieces, of which each gives the n-grams that start in its first letters
        padded, step = F.concat(F.lit("<"), F.col("word"), F.lit(">")), 64
        pieces = shared.withColumn("at", F.explode(F.sequence(F.lit(1), F.length(padded), F.lit(step)))).select("lang", "n", F.expr(f"substring(concat('<', word, '>'), at, {step + n_max - 1})").alias("piece"))

        def of_order(k: int) -> Column:
            last = F.least(F.lit(step), F.length("piece") - k + 1)
            return F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring("piece", i, F.lit(k)))).otherwise(F.array().cast("array<string>"))

        grams = F.flatten(F.array(*[of_order(k) for k in range(1, n_max + 1)]))
        gram_counts = pieces.select("lang", "n", F.explode(grams).alias("item")).groupBy("lang", "item").agg(F.sum("n").alias("n")).withColumn("order", F.length("item"))
        totals = {(r["lang"], r["order"]): r.n for r in gram_counts.groupBy("lang", "order").agg(F.sum("n").alias("n")).collect()}
        parts = top(gram_counts, top_grams, "lang", "order")
    finally:
        shared.unpersist()
    return assemble(sizes, [(r["lang"], r["item"], r["n"]) for r in words], [(r["lang"], r["item"], r["n"], totals[r["lang"], r["order"]]) for r in parts], n_max)


def assemble(sizes: dict[str, int], words: list[tuple], grams: list[tuple], n_max: int) -> Model:
    """The model of counts: add-one half smoothing, so that what a language lacks costs it a finite amount."""
    languages = sorted(sizes)
    at = {x: i for i, x in enumerate(languages)}

    def table(counts: dict[str, np.ndarray], totals: np.ndarray) -> dict[str, np.ndarray]:
        return {k: np.log((v + 0.5) / (totals + 1.0)) for k, v in counts.items()}

    word_counts: dict[str, np.ndarray] = {}
    for lang, item, n in words:
        if lang in at:
            word_counts.setdefault(item, np.zeros(len(at)))[at[lang]] += n
    by_order: list[dict[str, np.ndarray]] = [{} for _ in range(n_max + 1)]
    totals = np.ones((n_max + 1, len(at)))
    for lang, item, n, total in grams:
        if lang in at:
            by_order[len(item)].setdefault(item, np.zeros(len(at)))[at[lang]] += n
            totals[len(item), at[lang]] = total
    merged: dict[str, np.ndarray] = {}
    for order in range(1, n_max + 1):
        merged |= table(by_order[order], totals[order])
    size = np.array([float(sizes[x]) for x in languages])
    return Model(languages, table(word_counts, size), merged, n_max, np.full(len(languages), -math.log(1e6)))


def predict(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score (0 to 1, how far the best language is ahead of the others over a dozen words).

    Known words are scored by their log frequency in each language, unseen ones by the longest known character n-grams
    at each of its positions. Every word of a text counts, whole; ties go to the first language by code point. Null texts and
    those without letters, and all texts where nothing was learned, get 'und' and score 0. Repeated rows are predicted alike;
    no rows give no rows; columns named lang_pred or score are replaced.
    The model, of a fixed size, goes to the workers with the function; there is no shuffle.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.drop("lang_pred", "score")
    shipped = spark.sparkContext.broadcast(model)  # of a fixed size, see fit()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scores(shipped.value)
        for batch in batches:
            found, scores = own.predict(batch.column(batch.schema.get_field_index(text_col)).to_pylist())
            cols = [pa.array(found, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols], names=[*batch.schema.names, "lang_pred", "score"])

    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(work, schema)


def identify(docs: DataFrame, **options) -> DataFrame:
    """Fit on the labelled documents that aren't held out, and predict every row; see fit() and predict()."""
    return predict(docs, fit(docs.where(~held_out()), **options))


def op6(spark, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out()))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
