"""Token counts, token-id shards and the wavelet matrix."""

import random
import sys
import os
import zlib

import numpy as np
import public_tokenizers
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import plain  # noqa: E402
from tidewater.llm import token_counts, token_ids  # noqa: E402
from tidewater.llm.wavelet import WaveletMatrix  # noqa: E402

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def library(path):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def noise(n):
    rng = random.Random(3)
    alphabet = "abcAB'sS tT\n\t  \x0b\x0c\x1c\x85\xa0é ÉßÄ°İΣς0123²½!?.,<|>-_́　漢字😀ａ‍﻿'ll"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(n)] + [
        "a<|endoftext|>b", "<|startoftext|> x <|ENDOFTEXT|>", "", " ", "\n", "can't don'T IT'S 'S we'LL", "İSTANBUL ΣΑΣ"]


def test_lengths_and_ids_of_odd_texts_are_the_library_s():
    texts = noise(3000)
    assert token_counts.PieceLengths(BYTE).counts(texts) == [len(x) for x in library(BYTE)(texts)]
    got = token_ids.WordIds(WORD).encode(texts)
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == library(WORD)(texts)


@pytest.mark.parametrize("table", [0, 50])
def test_token_counts(odd, sample, table):
    for docs in (odd, sample):
        rows = [(r.doc_id, r.text or "") for r in docs.collect()]
        want = sorted(((i is None, i or 0), len(t.encode()), len(x), len(x) > 1024)
                      for (i, t), x in zip(rows, library(BYTE)([t for _, t in rows])))
        got = token_counts.token_counts(docs, BYTE, table=max(table, 1), sample_docs=20).collect()
        assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_wavelet_matrix():
    rng = np.random.default_rng(0)
    for n, bits in ((0, 3), (1, 1), (511, 4), (512, 5), (1500, 16), (700, 17)):
        ids = rng.integers(0, min(2 ** bits, 40) if n > 600 else 2 ** bits, n)
        m = WaveletMatrix.from_bytes(WaveletMatrix.build(ids, bits).to_bytes())
        assert m.decode().tolist() == ids.tolist()
        for i in range(0, n, 37):
            assert m.access(i) == ids[i]
            assert m.rank(int(ids[i]), i) == int((ids[:i] == ids[i]).sum())
        for t in {int(x) for x in ids[:5]} | {0, 2 ** bits + 1}:
            assert m.count(t) == int((ids == t).sum())
            assert m.occurrences(t) == np.flatnonzero(ids == t).tolist()


def test_token_shards_round_trip(odd, sample, monkeypatch):
    monkeypatch.setattr(token_ids, "SHARD_TOKENS", 5000)  # several shards a part
    for docs in (odd, sample):
        files = token_ids.token_shards(docs, WORD)
        rows = [(r.doc_id, r.text or "") for r in docs.collect()]
        ids = [x + [2] for x in library(WORD)([t for _, t in rows])]
        want, at = [], 0
        for (i, _), x in sorted(zip(rows, ids), key=lambda y: (plain.id_key(y[0][0]), np.asarray(y[1], "<u2").tobytes())):
            want.append((i, at, len(x), zlib.crc32(np.asarray(x, "<u4").tobytes())))
            at += len(x)
        got = token_ids.read_shards(files).orderBy("start").collect()
        assert [tuple(r) for r in got] == want
    # lookup in one shard file
    shard = files.orderBy("part", "seq").first()
    m = WaveletMatrix.from_bytes(shard.matrix)
    assert m.count(2) >= shard.n_docs and m.occurrences(2)[0] >= 0


def test_no_rows(none):
    assert token_counts.token_counts(none, BYTE).count() == 0
    assert token_ids.read_shards(token_ids.token_shards(none, WORD)).count() == 0
