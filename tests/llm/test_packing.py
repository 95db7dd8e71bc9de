import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from vigil.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, docs, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    want = defaultdict(list)
    for r in docs:
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id].append(np.array([*ids, 1], "<u4").tobytes())
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(want)
    for doc, data in want.items():
        for copy in data:
            for p in (p for p in pieces[doc] if p.doc_tokens == len(copy) // 4):
                assert any(zlib.crc32(x[4 * p.start : 4 * (p.start + p.length)]) == p.ids_crc32 for x in data)
        assert sum(p.length for p in pieces[doc]) == sum(len(x) // 4 for x in data)
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return [sum(x[1] for x in parts) for parts in bins.values()]


def test_every_id_once(docs):
    rows = packing.pack(docs, PATH).collect()
    check(rows, docs.collect(), 2048)


def test_small_capacity_fills_bins(docs):
    used = check(packing.pack(docs.coalesce(1), PATH, capacity=64, finest=8).collect(), docs.collect(), 64)
    assert sum(64 - u for u in used) < 0.05 * sum(used)


def test_cuts_are_whole():
    for n in range(1, 5000):
        parts = packing.cuts(n, 2048, 32)
        assert sum(p for p, _ in parts) == n and all(p * k <= 2048 for p, k in parts)


def test_encoder_equals_tokenizer():
    encode, tokenizer = packing.Encoder(PATH, entries=50), Tokenizer.from_file(PATH)
    texts = ["", " ", "Hello, World. it's 12,5 don't", "naïve Ünder straße, ÿ ß. 東京 é", "a\n\nb\tc", "<|endoftext|> x", "K\u0301 H\u0331 Kelvin \u212a", "x" * 300, "., ,. ... !?", "Σίσυφος. İstanbul"]
    for t in [*texts, " ".join(texts)]:
        assert encode(t) == np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t
    assert encode.words is not None


def test_no_rows(none):
    assert packing.pack(none, PATH).count() == 0


def test_other_columns_with_clashing_names(docs):
    from pyspark.sql import functions as F

    named = ("start", "length", "offset", "sequence_id", "doc_tokens", "ids_crc32")
    more = docs.select("text", "doc_id", *[F.lit("x").alias(c) for c in named])
    assert sorted(map(tuple, packing.pack(more, PATH).drop("sequence_id", "offset").collect()), key=str) == sorted(map(tuple, packing.pack(docs, PATH).drop("sequence_id", "offset").collect()), key=str)
