"""Harmonic packing of tokenised documents into sequences of a fixed capacity."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from vigil.llm.common import small_batches

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])
#: Printable stand-ins for bytes in byte-level vocabularies: printable bytes stand for themselves, the others follow from U+0100.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTES = {chr(b): b for b in _PRINTABLE} | {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in set(_PRINTABLE))}
_END = b"\x01"


class Words:
    """Ids of many plain words at once: the tokenizer's own vocabulary and merges, run by tiktoken's merge loop.

    A word is followed by an end byte; the pairs of a byte and the end byte merge before all others, which gives the
    symbols with the word-end suffix; then the merges follow in their order. None of this trains anything.
    """

    def __init__(self, model: dict):
        import tiktoken

        suffix = model["end_of_word_suffix"]

        def raw(token: str) -> bytes:
            end = token.endswith(suffix) and token != suffix
            return bytes(_BYTES[c] for c in (token[: -len(suffix)] if end else token)) + (_END if end else b"")

        base = [bytes([b]) for b in range(256)]
        merged = [raw(a) + raw(b) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        order = [*base, *(b + _END for b in base), *merged]
        if len(set(order)) != len(order):
            raise ValueError("two merges make the same token")
        ids = {raw(t): i for t, i in model["vocab"].items() if all(c in _BYTES for c in t.removesuffix(suffix))}
        self.ids = np.array([ids.get(t, 0) for t in order], "<u4")
        self.ends = np.array([t.endswith(_END) and len(t) > 1 for t in order])
        self.encoding = tiktoken.Encoding("words", pat_str=r"[^\x01 ]+\x01", mergeable_ranks={t: i for i, t in enumerate(order)}, special_tokens={})

    def __call__(self, words: list[str], counts: list[int]) -> list[bytes]:
        """words: each piece ended by the end byte; counts: pieces of each word."""
        found = np.array(self.encoding.encode_ordinary(" ".join(words)), np.int64)
        stops = (np.flatnonzero(self.ends[found]) + 1)[np.cumsum(counts) - 1] * 4
        data, at, out = self.ids[found].tobytes(), 0, []
        for stop in stops.tolist():
            out.append(data[at:stop])
            at = stop
        return out


class Encoder:
    """Ids of texts as little-endian 32-bit bytes, equal to tokenizers' encode(text, add_special_tokens=False).

    Blanks and line ends are never part of a token and always end one, so a text's ids are those of its
    blank-separated chunks one after another. Chunks seen before come from a cache of bounded size; new ones of Latin
    letters, with '.' or ',' after them or not, are encoded together; all others by the tokenizer itself.
    """

    def __init__(self, path: str, entries: int = 300_000, longest: int = 48):
        from tokenizers import Tokenizer

        self.tokenizer, self.entries, self.longest, self.cache = Tokenizer.from_file(path), entries, longest, {}
        config = json.loads(Path(path).read_text())
        known = [x["type"] for x in config["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"] and r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+" in json.dumps(config["pre_tokenizer"]).replace("\\\\", "\\")
        #: Only for the normaliser and splitter that this class knows.
        self.words = Words(config["model"]) if known and config["model"]["end_of_word_suffix"] else None

    def learn(self, chunks: list[str]) -> None:
        known, plain, words, counts = self.cache, [], [], []
        for x in chunks:
            core = x[:-1] if x[-1:] in (".", ",") else x
            if self.words and core.isalpha() and max(core) <= "\xff":
                plain.append(x)
                words.append(f"{core.lower()}\x01" if core is x else f"{core.lower()}\x01{x[-1]}\x01")
                counts.append(1 if core is x else 2)
            else:
                known[x] = np.array(self.tokenizer.encode(x, add_special_tokens=False).ids, "<u4").tobytes()
        if plain:
            known.update(zip(plain, self.words(words, counts), strict=True))

    def __call__(self, text: str) -> bytes:
        chunks, known = text.replace("\n", " ").split(" "), self.cache
        out = []
        for i in range(0, len(chunks), 100_000):
            part = chunks[i : i + 100_000]
            new = [x for x in set(part) if x not in known]
            if new:
                self.learn(new)
            out.append(b"".join([known[x] for x in part]))
            if len(known) > self.entries:
                known.clear()
            else:
                for x in new:
                    if len(x) > self.longest:
                        del known[x]
        return b"".join(out)


def cuts(tokens: int, capacity: int, finest: int) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a document. A piece of class k takes a slot of capacity // k, so k of them fill a bin.

    Whole capacities come first. What remains goes into the class whose slot just holds it if its bins would lose at
    most capacity // 64, or if it is at most capacity // finest; else the largest capacity // k that fits is cut off.
    """
    out = [(capacity, 1)] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        k = capacity // rest
        if rest * finest <= capacity or capacity - k * rest <= capacity // 64:
            return [*out, (rest, k)]
        k = -(-capacity // rest)
        out.append((capacity // k, k))
        rest -= capacity // k
    return out


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end: int = 1, finest: int = 32, id_col: str = "doc_id", text_col: str = "text", encoder: Callable = Encoder) -> DataFrame:
    """Pieces of documents with their places in sequences of at most capacity tokens.

    Harmonic packing: the pieces' lengths fall into classes of reciprocal capacity; each worker (input partition) fills
    bins of class k with exactly k pieces, by itself and in one streaming pass without a shuffle, holding only the
    open bins, fewer than one per class. What remains open at the end of a partition is laid end to end and cut at the
    capacity, so that a worker leaves one sequence that isn't full. Documents are cut freely: see cuts().

    Rows: one per piece; sequence_id is unique over all workers, offset is gapless from 0 within a sequence.
    Null text counts as empty: its ids are just the end id. Repeated rows are packed once each; a null id stays null; no
    rows give no rows; other columns are ignored.
    """
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        base, made, open_bins, out = TaskContext.get().partitionId() << 33, 0, {}, []
        stop = np.array([end], "<u4").tobytes()

        def close(pieces: list[tuple]) -> None:
            nonlocal made
            at = 0
            for piece in pieces:
                out.append((*piece[:5], base + made, at))
                at += piece[2]
            made += 1

        def batch() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) if out else [[]] * 7
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=_ARROW)

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = memoryview(encode(text) + stop if text else stop)
                total, at = len(ids) // 4, 0
                for length, k in cuts(total, capacity, finest):
                    part = ids[4 * at : 4 * (at + length)]
                    piece = (doc, at, length, zlib.crc32(part), total, bytes(part) if k > 1 else b"")  # the ids are for the last step, which may cut again
                    at += length
                    if k == 1:
                        close([piece])
                        continue
                    bin_ = open_bins.setdefault(k, [])
                    bin_.append(piece)
                    if len(bin_) == k:
                        close(open_bins.pop(k))
            if out:
                yield batch()
        line, room = [], capacity
        for k in sorted(open_bins):
            for doc, start, _, _, total, ids in open_bins[k]:
                while ids:
                    part, ids = ids[: 4 * room], ids[4 * room :]
                    length = len(part) // 4
                    line.append((doc, start, length, zlib.crc32(part), total))
                    start, room = start + length, room - length
                    if not room:
                        close(line)
                        line, room = [], capacity
        if line:
            close(line)
        if out:
            yield batch()

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(work, PIECES)


def op3(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
