"""Exact BM25 top-k search over an inverted index, with block-max pruning in each shard."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import U64, fold, hashes, small_batches, stash, tables
from vigil.llm.lm import squeeze, stretch

#: Documents of a block, and of a shard at most; terms and queries that are broadcast together at most (24 and 16 bytes each).
BLOCK, MOST_DOCS, TERMS, QUERIES = 64, 16_384, 1_000_000, 50_000
#: Numbers in a shard's matrix, scores held together, and pairs scored exactly together, at most.
MATRIX, HELD, PAIRS = 1 << 23, 1 << 19, 4_000
#: One in so many shards is searched first, for floors. A term is dense if it occurs in so large a share of queries times documents.
FIRST, DENSE = 16, 0.0007
#: Clusters of a shard's documents, and the terms that tell them apart.
CLUSTERS, TELLING = 16, 256
SEGMENT = "shard long, n_docs long, n_words long, ids binary, lengths binary, terms binary, starts binary, docs binary, tfs binary"
_SEGMENT = pa.schema([("shard", pa.int64()), ("n_docs", pa.int64()), ("n_words", pa.int64()), *((c, pa.binary()) for c in ("ids", "lengths", "terms", "starts", "docs", "tfs"))])


def clustered(terms: np.ndarray, docs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """An order of documents in which neighbours share frequent terms, so that the maxima of a block are near what its documents have.

    terms, docs: the postings, terms numbered. Two rounds of spherical k-means on the most frequent terms, then by length.
    """
    n = len(lengths)
    counts = np.bincount(terms)
    telling = np.argsort(-counts, kind="stable")[:TELLING]
    column = np.full(len(counts), -1)
    column[telling] = np.arange(len(telling))
    there = column[terms] >= 0
    x = np.zeros((n, len(telling)), np.float32)
    x[docs[there], column[terms[there]]] = np.log1p(n / counts[telling]).astype(np.float32)[column[terms[there]]]
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-6)
    centres = x[np.linspace(0, n - 1, min(CLUSTERS, n)).astype(int)]
    for _ in range(2):
        own = (x @ centres.T).argmax(1)
        centres = np.stack([x[own == c].sum(0) if (own == c).any() else centres[c] for c in range(len(centres))])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-6)
    return np.lexsort((lengths, own))


def build_index(docs: DataFrame, *, shard_bytes: int = 8 << 20) -> DataFrame:
    """The inverted index of docs(doc_id, text): a row for each shard of about shard_bytes of text (16,384 documents at most), without a shuffle.

    ids, lengths: the documents, in the order of clustered(); terms: sorted hashes; starts: where each term's postings begin;
    docs, tfs: the postings, by document within a term.
    """

    def segment(shard: int, ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        lengths = np.array([len(x) for x in texts], np.int64)
        words = hashes([w for x in texts for w in x])
        owner = np.repeat(np.arange(len(texts)), lengths)
        order = np.lexsort((owner, words))
        words, owner = words[order], owner[order]
        new = np.ones(len(words), bool)
        new[1:] = (words[1:] != words[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        tfs, term_of, doc_of = np.diff(np.append(at, len(words))), words[at], owner[at]
        terms, starts, numbers = np.unique(term_of, return_index=True, return_inverse=True)
        if len(terms):
            by = clustered(numbers, doc_of, lengths)
            place = np.empty(len(by), np.int64)
            place[by] = np.arange(len(by))
            order = np.lexsort((place[doc_of], numbers))
            doc_of, tfs, ids, lengths = place[doc_of][order], tfs[order], np.array(ids, np.int64)[by], lengths[by]
        row = [shard, len(ids), int(lengths.sum()), np.array(ids, np.int64).tobytes(), squeeze(lengths.astype(np.uint32), False), squeeze(terms, True), squeeze(starts.astype(np.uint32), True), squeeze(doc_of.astype(np.uint32), False), squeeze(tfs.astype(np.uint32), False)]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _SEGMENT.types, strict=True)], schema=_SEGMENT)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size, shard = [], [], 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(doc)
                texts.append(fold(text))
                size += len(text or "")
                if size >= shard_bytes or len(ids) == MOST_DOCS:
                    yield segment(shard, ids, texts)
                    ids, texts, size, shard = [], [], 0, shard + 1
        if ids:
            yield segment(shard, ids, texts)

    return docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, SEGMENT)


def frequencies(index: DataFrame) -> DataFrame:
    """(term, df) over all shards."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, starts, docs in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                t, s = stretch(terms, U64, True), stretch(starts, np.uint32, True)
                n = np.diff(np.append(s, int.from_bytes(docs[:8], "little")))
                yield pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.array(n.astype(np.int64))], names=["term", "df"])

    return index.select("terms", "starts", "docs").mapInArrow(work, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def query_terms(queries: DataFrame, stats: DataFrame, n_docs: int) -> DataFrame:
    """(query_id, term, weight): the distinct terms of each query (query_id, text) over its whole text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for query, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                terms = np.unique(hashes(fold(text)))
                yield pa.RecordBatch.from_arrays([pa.array([query] * len(terms), pa.int64()), pa.array(terms.view(np.int64))], names=["query_id", "term"])

    found = queries.mapInArrow(work, "query_id long, term long").distinct()
    idf = F.log(1 + (F.lit(float(n_docs)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return found.join(stats, "term").select("query_id", "term", idf.alias("weight"))


class Asked:
    """Queries of a block: entries (query, term, weight) by query and then term, and for each query a floor that its k best reach."""

    def __init__(self, query: np.ndarray, term: np.ndarray, weight: np.ndarray, floors: dict[int, float]):
        order = np.lexsort((term, query))
        self.weight = weight[order]
        self.queries, self.row = np.unique(query[order], return_inverse=True)
        self.terms, self.which = np.unique(term[order], return_inverse=True)
        self.ends = np.append(np.flatnonzero(np.diff(self.row, prepend=-1)), len(self.row))
        self.key = self.row * len(self.terms) + self.which  # ascending
        self.floors = np.array([floors.get(q, 0.0) for q in self.queries.tolist()])


class Best:
    """The k best (score, document) of each query so far; of equal scores the least documents."""

    def __init__(self, floors: np.ndarray, k: int):
        self.k, self.floors = k, floors.copy()
        self.scores, self.ids = np.zeros((len(floors), k)), np.zeros((len(floors), k), np.int64)

    def add(self, row: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        touched = np.unique(row)
        old = self.scores[touched] > 0
        rows = np.concatenate([row, np.repeat(touched, old.sum(1))])
        all_ids, all_scores = np.concatenate([ids, self.ids[touched][old]]), np.concatenate([scores, self.scores[touched][old]])
        order = np.lexsort((all_ids, -all_scores, rows))
        rows, all_ids, all_scores = rows[order], all_ids[order], all_scores[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = rank < self.k
        self.scores[touched] = 0
        self.scores[rows[keep], rank[keep]], self.ids[rows[keep], rank[keep]] = all_scores[keep], all_ids[keep]
        self.floors[touched] = np.maximum(self.floors[touched], self.scores[touched, -1])


def spread(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after another."""
    sizes = ends - starts
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


class Shard:
    """A shard's postings, prepared for a block of queries.

    Terms that many of these queries ask for and many of these documents have are columns of a matrix, with their maxima for
    each block of documents; the others stay lists.
    """

    def __init__(self, row: dict, asked: Asked, k1: float, b: float, mean: float):
        self.asked = asked
        terms, starts = stretch(row["terms"], U64, True), stretch(row["starts"], np.uint32, True).astype(np.int64)
        self.ids, lengths = np.frombuffer(row["ids"], np.int64), stretch(row["lengths"], np.uint32, False)
        docs, tfs = stretch(row["docs"], np.uint32, False).astype(np.int64), stretch(row["tfs"], np.uint32, False)
        self.n = len(self.ids)
        self.blocks = -(-self.n // BLOCK)
        ends = np.append(starts[1:], len(docs))
        at = np.minimum(np.searchsorted(terms, asked.terms), max(0, len(terms) - 1))
        here = terms[at] == asked.terms if len(terms) else np.zeros(len(asked.terms), bool)
        # of each term of the block: its postings in this shard
        self.low, self.high = np.where(here, starts[at] if len(terms) else 0, 0), np.where(here, ends[at] if len(terms) else 0, 0)
        factors = tfs * (k1 + 1) / (tfs + k1 * (1 - b + b * lengths / mean)[docs])
        self.docs, self.factors = docs, factors
        share = np.bincount(asked.which, minlength=len(asked.terms)) / len(asked.queries) * (self.high - self.low) / max(1, self.n)
        dense = np.flatnonzero(share >= DENSE)
        dense = np.sort(dense[np.argsort(-share[dense], kind="stable")[: MATRIX // max(1, self.blocks * BLOCK)]])
        self.column = np.full(len(asked.terms), -1)
        self.column[dense] = np.arange(len(dense))
        self.matrix = np.zeros((self.blocks * BLOCK, len(dense)), np.float32)
        where = spread(self.low[dense], self.high[dense])
        self.matrix[docs[where], np.repeat(np.arange(len(dense)), (self.high - self.low)[dense])] = factors[where]
        self.peaks = self.matrix.reshape(self.blocks, BLOCK, len(dense)).max(1) if len(dense) else np.zeros((self.blocks, 0), np.float32)
        self.by_doc: tuple | None = None
        self.numbers = np.full(len(terms), -1)  # of the shard's terms, those of the block
        self.numbers[at[here]] = np.flatnonzero(here)
        self.sizes = ends - starts

    def exact(self, row: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The scores of (query, document) pairs: a document's terms in the order of their hashes, so that copies have equal scores."""
        if self.by_doc is None:
            number = np.repeat(self.numbers, self.sizes)
            known = np.flatnonzero(number >= 0)
            order = known[np.argsort(self.docs[known], kind="stable")]
            heads = np.searchsorted(self.docs[order], np.arange(self.n + 1))
            self.by_doc = number[order], self.factors[order], heads
        number, factors, heads = self.by_doc
        where, sizes = spread(heads[doc], heads[doc + 1]), heads[doc + 1] - heads[doc]
        key = np.repeat(row, sizes) * len(self.asked.terms) + number[where]
        at = np.minimum(np.searchsorted(self.asked.key, key), len(self.asked.key) - 1)
        weight = np.where(self.asked.key[at] == key, self.asked.weight[at], 0.0)
        return np.bincount(np.repeat(np.arange(len(row)), sizes), weight * factors[where], len(row))

    def search(self, low: int, high: int, best: Best) -> None:
        """Add what this shard has for queries low to high: blocks whose bound reaches a query's floor are scored, and documents
        that reach it are scored exactly."""
        asked, m = self.asked, high - low
        entries = slice(asked.ends[low], asked.ends[high])
        row, which, weight = asked.row[entries] - low, asked.which[entries], asked.weight[entries]
        column = self.column[which]
        dense = column >= 0
        wanted = np.zeros((m, self.matrix.shape[1]), np.float32)
        wanted[row[dense], column[dense]] = weight[dense]
        row, which, weight = row[~dense], which[~dense], weight[~dense]
        sizes, where = self.high[which] - self.low[which], spread(self.low[which], self.high[which])
        width = self.blocks * BLOCK
        scores = np.bincount(np.repeat(row * width, sizes) + self.docs[where], np.repeat(weight, sizes) * self.factors[where], m * width).reshape(m, self.blocks, BLOCK).astype(np.float32)
        bounds = (wanted @ self.peaks.T + scores.max(2)) * np.float32(1.0001)
        floors = best.floors[low:high].astype(np.float32) * np.float32(0.9999)
        alive = (bounds >= floors[:, None]) & (bounds > 0)
        for block in np.flatnonzero(alive.any(0)):
            rows = np.flatnonzero(alive[:, block])
            scores[rows, block] += wanted[rows] @ self.matrix[block * BLOCK : (block + 1) * BLOCK].T
        scores[~alive] = 0
        flat = scores.reshape(m, width)
        if width > best.k:  # what this shard alone has as its k-th best is a floor, too
            floors = np.maximum(floors, np.partition(flat, width - best.k, 1)[:, width - best.k] * np.float32(0.9999))
        rows, docs = np.nonzero((flat >= floors[:, None]) & (flat > 0))
        for part in range(0, len(rows), PAIRS):
            r, d = rows[part : part + PAIRS], docs[part : part + PAIRS]
            exact = self.exact(r + low, d)
            good = (exact > 0) & (exact >= best.floors[r + low])
            if good.any():
                best.add(r[good] + low, self.ids[d[good]], exact[good])


def blocks_of(terms: DataFrame, most: int, most_queries: int = QUERIES) -> list[DataFrame]:
    """terms(query_id, term, weight) in blocks of whole queries: of at most `most` rows and `most_queries` queries, but for hash
    buckets of queries that alone have more."""
    rows, queries = terms.agg(F.count("*"), F.count_distinct("query_id")).first()
    n = max(1, -(-8 * rows // most), -(-8 * queries // most_queries))
    bucket = F.pmod(F.xxhash64("query_id"), F.lit(n))
    blocks, size, asked = [[0]], 0, 0
    for at, r, q in sorted(terms.groupBy(bucket.alias("b")).agg(F.count("*"), F.count_distinct("query_id")).collect()):
        if size and (size + r > most or asked + q > most_queries):
            blocks.append([at])
            size = asked = 0
        blocks[-1][1:] = [at]
        size, asked = size + r, asked + q
    return [terms.where(bucket.between(b[0], b[-1])) for b in blocks]


def search(docs: DataFrame, queries: DataFrame, *, k: int = 10, k1: float = 1.2, b: float = 0.75, index: DataFrame | None = None) -> DataFrame:
    """(query_id, rank, doc_id, score): for each of queries(query_id, text) the k best of docs(doc_id, text) by BM25, exactly.

    A query is searched by all distinct terms of its whole text, each weighted by its idf. Every document is in the index; shards are
    searched with the statistics of all documents, and what each task has as its k best is merged.

    A shard's documents lie in blocks of like ones. For each query, the maxima of a block's terms, times the query's
    weights, bound what any of its documents can score, and only blocks whose bound reaches the floor, the k-th best score
    so far, are scored; documents that reach it are scored exactly. A part of the shards, one in 16 by a hash, is searched
    first, and the k-th best of all of these is the floor that the other shards begin with: so what leaves the shards is in
    proportion to the queries, however many shards there are. Shards are of bounded size. Queries go to the shards
    in blocks of a bounded number of terms, which are broadcast one after another (40 MB at most) and each read the index.

    Terms are words as of common.fold(). Scores of equal size go by doc_id. Documents and queries without words match nothing;
    null ids are left out; repeated rows are documents of their own, repeated queries add up; no rows give no rows; other
    columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shards = index if index is not None else stash(build_index(docs))
    n_docs, n_words = shards.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    mean = max(1, n_words) / max(1, n_docs)
    asked = queries.where("query_id IS NOT NULL").select(F.col("query_id").cast("long").alias("query_id"), "text")
    terms = stash(query_terms(asked, frequencies(shards), n_docs))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    first = F.pmod(F.xxhash64("shard"), F.lit(FIRST)) == 0
    found = None
    for block in blocks_of(terms, TERMS):
        mine = block.toArrow()
        columns = [mine[c].to_numpy() for c in ("query_id", "term", "weight")]

        def searched(some: DataFrame, floors: dict[int, float], columns: list = columns) -> DataFrame:
            shipped = spark.sparkContext.broadcast((columns[0], columns[1].view(U64), columns[2], floors))
            return stash(some.mapInArrow(_searcher(shipped, k, k1, b, mean), "query_id long, doc_id long, score double").withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k))

        ahead = searched(shards.where(first), {})
        floors = {r.query_id: r.score for r in ahead.where(F.col("rank") == k).select("query_id", "score").toLocalIterator()}  # a number for each query of the block
        part = ahead.union(searched(shards.where(~first), floors)).select("query_id", "doc_id", "score")
        found = part if found is None else found.union(part)
    return found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _searcher(shipped, k: int, k1: float, b: float, mean: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, term, weight, floors = shipped.value
        if not len(query):
            return
        asked = Asked(query, term, weight, floors)
        best = Best(asked.floors, k)
        for batch in batches:
            for i in range(len(batch)):
                (row,) = batch.slice(i, 1).to_pylist()
                shard = Shard(row, asked, k1, b, mean)
                together = max(1, HELD // (max(1, shard.blocks) * BLOCK))
                for low in range(0, len(asked.queries) if shard.n else 0, together):
                    shard.search(low, min(low + together, len(asked.queries)), best)
        rows, at = np.nonzero(best.scores > 0)
        for low in range(0, len(rows), 100_000):
            r, a = rows[low : low + 100_000], at[low : low + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(asked.queries[r]), pa.array(best.ids[r, a]), pa.array(best.scores[r, a])], names=["query_id", "doc_id", "score"])

    return work


def op9(spark, sf_dir: str) -> DataFrame:
    docs = tables(spark, sf_dir, "documents").select("doc_id", "text")
    return search(docs, docs.where("doc_id % 100 = 0").withColumnRenamed("doc_id", "query_id")).withColumn("score", F.round("score", 6))


SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL),
corpus AS (SELECT count(*) AS n, sum(len(w)) / count(*) AS mean FROM docs),
counts AS (SELECT doc_id, x, any_value(size) AS size, count(*) AS tf FROM (SELECT doc_id, len(w) AS size, unnest(w) AS x FROM docs) GROUP BY doc_id, x),
idfs AS (SELECT x, ln(1 + (any_value(n) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM counts, corpus GROUP BY x),
scored AS (
  SELECT q.doc_id AS query_id, d.doc_id, sum(idf * d.tf * 2.2 / (d.tf + 1.2 * (0.25 + 0.75 * d.size / mean))) AS score
  FROM counts q JOIN counts d ON q.x = d.x JOIN idfs ON idfs.x = q.x, corpus
  WHERE q.doc_id % 100 = 0 GROUP BY q.doc_id, d.doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS k FROM scored)
SELECT query_id, CAST(k AS INTEGER) AS rank, doc_id, round(score, 6) AS score FROM ranked WHERE k <= 10
"""
