"""Stupid-backoff scores of documents, computed relationally from hash-partitioned n-gram counts."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import U64, fold, hashes, pair_hash, stash, tables

#: data: of each order of a round, the hashes and counts that a chunk has in partition p; or, in the same order, their sums.
ASKED, ANSWERED = "p int, chunk int, data array<binary>", "chunk int, p int, round int, data array<binary>"
_ASKED = pa.schema([("p", pa.int32()), ("chunk", pa.int32()), ("data", pa.list_(pa.binary()))])
_ANSWERED = pa.schema([("chunk", pa.int32()), ("p", pa.int32()), ("round", pa.int32()), ("data", pa.list_(pa.binary()))])
_SCORED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("partial", pa.float64()), ("unigrams", pa.int64())])


def squeeze(values: np.ndarray, deltas: bool) -> bytes:
    """Unsigned numbers, as differences or as they are, by byte planes and compressed."""
    if deltas and len(values):
        values = np.concatenate([values[:1], np.diff(values)])
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return len(values).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(planes).tobytes(), "zstd", asbytes=True)


def stretch(data: bytes, dtype: type, deltas: bool) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(data[8:], n * size, "zstd", asbytes=True), np.uint8).reshape(size, n)
    values = np.ascontiguousarray(planes.T).view(dtype).ravel()
    return np.cumsum(values, dtype=dtype) if deltas else values


def grams(texts: list[str | None], order: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For k = 1 to order the hash of the k-gram that ends at each word of the texts; each word's place in its text, and its text."""
    each = [fold(t) for t in texts]
    sizes = np.array([len(x) for x in each], np.int64)
    words = hashes([w for x in each for w in x])
    place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = [words]
    for k in range(2, order + 1):
        longer = np.zeros(len(words), U64)
        longer[1:] = pair_hash(out[-1][:-1] ^ U64(k), words[1:])  # hash of (the k-1 words before, this word)
        out.append(longer)
    return out, place, np.repeat(np.arange(len(texts)), sizes)


def rounds(order: int) -> list[tuple[int, ...]]:
    """Which k-grams are counted together (k from 0): words and pairs first, then one order after the other."""
    return [tuple(range(min(2, order))), *[(k,) for k in range(2, order)]]


class Chunk:
    """The texts of a chunk, their n-grams, and the sums over all documents as far as they are known."""

    def __init__(self, texts: list[str | None], order: int, least: int):
        self.found, self.place, self.text = grams(texts, order)
        self.order, self.least, self.texts, self.sums = order, least, len(texts), []

    def asked(self, k: int) -> np.ndarray:
        """The words whose k-gram is counted: it can't occur `least` times unless both of the shorter ones in it do."""
        there = self.place >= k
        if k > 1:
            enough = self.sums[k - 1] >= self.least
            there = there & enough
            there[1:] &= enough[:-1]
        return there

    def ask(self, turn: int, chunk: int, partitions: int) -> pa.Table:
        parts: dict[int, list[bytes]] = {}
        orders = rounds(self.order)[turn]
        for i, k in enumerate(orders):
            values, counts = np.unique(self.found[k][self.asked(k)], return_counts=True)
            edges = np.searchsorted(values, _edges(partitions))
            for p in np.flatnonzero(np.diff(edges)).tolist():
                a, b = edges[p], edges[p + 1]
                parts.setdefault(p, [squeeze(values[:0], True), squeeze(counts[:0].astype(np.uint32), False)] * len(orders))[2 * i : 2 * i + 2] = squeeze(values[a:b], True), squeeze(counts[a:b].astype(np.uint32), False)
        return pa.Table.from_arrays([pa.array(list(parts), pa.int32()), pa.array([chunk] * len(parts), pa.int32()), pa.array(list(parts.values()), pa.list_(pa.binary()))], schema=_ASKED)

    def learn(self, answers: pa.Table, turns: int) -> None:
        """Take the sums of the first rounds."""
        rows = sorted(zip(*(answers.column(c).to_pylist() for c in ("round", "p", "data")), strict=True), key=lambda x: x[:2])
        for turn, orders in enumerate(rounds(self.order)[:turns]):
            for i, k in enumerate(orders):
                there, sums = self.asked(k), np.zeros(len(self.place))
                where = np.unique(self.found[k][there], return_inverse=True)[1]
                sums[there] = np.concatenate([np.empty(0, U64), *(stretch(data[i], U64, False) for r, _, data in rows if r == turn)]).astype(np.float64)[where]
                self.sums.append(sums)

    def score(self, backoff: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: its words, its sum of logarithms without those of 1 / N, and the number of the latter."""
        # from the longest history down: log S, and which words haven't found theirs yet
        logs, lost, sums = np.zeros(len(self.place)), np.ones(len(self.place), bool), self.sums
        for k in range(self.order - 1, 0, -1):
            here = lost & (self.place >= k)
            kept = here & (sums[k] >= self.least)
            at = np.flatnonzero(kept)
            logs[at] += np.log(sums[k][at]) - np.log(sums[k - 1][at - 1])
            logs[here & ~kept] += math.log(backoff)
            lost &= ~kept
        logs[lost] += np.log(sums[0][lost])
        return np.bincount(self.text, minlength=self.texts), np.bincount(self.text, logs, self.texts), np.bincount(self.text, lost, self.texts)


def score(docs: DataFrame, *, order: int = 3, least: int = 2, backoff: float = 0.4, chunk_bytes: int = 8 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score) of each row of docs, by stupid backoff over the corpus's own counts.

    S(w | h) = c(h w) / c(h) if the n-gram (h w) occurs at least `least` times in all documents, else backoff * S(w | h without its
    first word); S(w) = c(w) / N. A document's score is the sum of log S over its words; the first words have shorter histories.
    Words are folded as in common.fold().

    Documents are dealt into chunks of about chunk_bytes by a hash, once. A chunk sums its n-grams and asks, for each of the
    hash partitions of the count tables, for the totals of those that lie there; the partition adds up what all chunks
    have (the count table), joins it to each chunk's n-grams and answers; the chunk, whose text is read from the same
    shuffle, adds the logarithms over its documents. Words and pairs are counted first. An n-gram of three words or more
    is sent only if both of the shorter ones in it occur `least` times, as it can't otherwise. A frequent n-gram is one entry a
    chunk; chunks and partitions have bounded sizes, and their number grows with the corpus. What is moved are the texts,
    once, and the chunks' distinct n-grams, as differences of sorted hashes: a row for each chunk and partition.

    A task holds one chunk; a very long text is one by itself. Null and blank texts have no words, log_score 0 and a null mean.
    Repeated rows count each time; null ids are kept; no rows give no rows; other columns are ignored.
    """
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    total = base.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, math.ceil(total / chunk_bytes))
    tables_ = max(1, n // 2)
    # the same again if a task is run again; rows without id may be copies of one text, so their place counts, too
    place = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    chunks = base.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text", place), F.lit(n)).cast("int"))

    def of(table: pa.Table) -> Chunk:
        return Chunk(table.column("text").to_pylist(), order, least)

    def ask(table: pa.Table) -> pa.Table:
        return of(table).ask(0, table.column("chunk")[0].as_py(), tables_)

    def ask_more(turn: int):
        def work(table: pa.Table, answers: pa.Table) -> pa.Table:
            own = of(table)
            own.learn(answers, turn)
            return own.ask(turn, table.column("chunk")[0].as_py(), tables_)

        return work

    def answer(turn: int):
        def work(table: pa.Table) -> pa.Table:
            chunk, data = table.column("chunk").to_pylist(), table.column("data").to_pylist()
            sums: list[list[bytes]] = [[] for _ in chunk]
            for i in range(len(data[0]) // 2):
                values = [stretch(x[2 * i], U64, True) for x in data]
                counts = np.concatenate([stretch(x[2 * i + 1], np.uint32, False) for x in data]).astype(np.int64)
                known, where = np.unique(np.concatenate(values), return_inverse=True)
                # the count table, joined back
                found, at = np.bincount(where, counts, len(known)).astype(np.int64).astype(U64)[where], 0
                for out, v in zip(sums, values, strict=True):
                    out.append(squeeze(found[at : at + len(v)], False))
                    at += len(v)
            return pa.Table.from_arrays([pa.array(chunk, pa.int32()), table.column("p"), pa.array([turn] * len(chunk), pa.int32()), pa.array(sums, pa.list_(pa.binary()))], schema=_ANSWERED)

        return work

    def add_up(table: pa.Table, answers: pa.Table) -> pa.Table:
        own = of(table)
        own.learn(answers, len(rounds(order)))
        words, logs, unigrams = own.score(backoff)
        return pa.Table.from_arrays([table.column("doc_id"), pa.array(words, pa.int64()), pa.array(logs), pa.array(unigrams.astype(np.int64))], schema=_SCORED)

    by_chunk = chunks.groupBy("chunk")
    answers = by_chunk.applyInArrow(ask, ASKED).groupBy("p").applyInArrow(answer(0), ANSWERED)
    for turn in range(1, len(rounds(order))):
        asked = by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(ask_more(turn), ASKED)
        answers = answers.union(asked.groupBy("p").applyInArrow(answer(turn), ANSWERED))
    parts = stash(by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(add_up, "doc_id long, n_words long, partial double, unigrams long"))
    words = parts.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    log_score = F.col("partial") - F.col("unigrams") * F.lit(math.log(max(1, words)))
    return parts.select("doc_id", "n_words", log_score.alias("log_score"), F.when(F.col("n_words") > 0, log_score / F.col("n_words")).alias("mean_log_score"))


def _edges(n: int) -> np.ndarray:
    """Bounds of n equal ranges of 64-bit hashes; the last is the greatest hash itself, which stays in the last range."""
    return np.array([(i << 64) // n for i in range(n)] + [(1 << 64) - 1], U64)


def op5(spark, sf_dir: str) -> DataFrame:
    return score(tables(spark, sf_dir, "documents")).withColumns({c: F.round(c, 6) for c in ("log_score", "mean_log_score")})


SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs),
grams AS (SELECT doc_id, i, w[i] AS a, CASE WHEN i > 1 THEN w[i - 1] || ' ' || w[i] END AS b, CASE WHEN i > 2 THEN w[i - 2] || ' ' || w[i - 1] || ' ' || w[i] END AS c, CASE WHEN i > 1 THEN w[i - 1] END AS before FROM words),
counts AS (
  SELECT a AS g, count(*) AS n FROM grams GROUP BY a
  UNION ALL SELECT b, count(*) FROM grams WHERE b IS NOT NULL GROUP BY b
  UNION ALL SELECT c, count(*) FROM grams WHERE c IS NOT NULL GROUP BY c),
total AS (SELECT count(*) AS n FROM words),
scored AS (
  SELECT doc_id, CASE
      WHEN z.n >= 2 THEN ln(z.n) - ln(yb.n)
      WHEN y.n >= 2 THEN CASE WHEN c IS NOT NULL THEN ln(0.4) ELSE 0 END + ln(y.n) - ln(xb.n)
      ELSE CASE WHEN c IS NOT NULL THEN 2 * ln(0.4) WHEN b IS NOT NULL THEN ln(0.4) ELSE 0 END + ln(x.n) - ln(total.n) END AS s
  FROM grams CROSS JOIN total JOIN counts x ON x.g = a LEFT JOIN counts y ON y.g = b LEFT JOIN counts z ON z.g = c LEFT JOIN counts xb ON xb.g = before
  LEFT JOIN counts yb ON yb.g = CASE WHEN c IS NOT NULL THEN substr(c, 1, length(c) - length(a) - 1) END),
sums AS (SELECT doc_id, sum(s) AS s FROM scored GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, round(coalesce(s, 0), 6) AS log_score, round(CASE WHEN len(w) > 0 THEN s / len(w) END, 6) AS mean_log_score
FROM docs LEFT JOIN sums USING (doc_id)
"""
