"""Backtracking BPE against plain merging and against the library."""

import hashlib
import json
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerline.llm import bpe_codec
from ledgerline.llm.bpe_codec import Decoder, Merges, TextEncoder, WordEncoder

VOCABULARY = bpe_codec.read_vocabulary()
LIBRARY = Tokenizer.from_str(VOCABULARY.decode())
ENCODER = TextEncoder(VOCABULARY)


def _plain(word, merged):
    """Merge the pair of lowest rank, the leftmost first, until there is none."""
    tokens = list(word)
    while True:
        ranked = [(merged[p], i) for i, p in enumerate(zip(tokens, tokens[1:])) if p in merged]
        if not ranked:
            return tokens
        number, i = min(ranked)
        tokens[i : i + 2] = [number]


def _random_model(r, symbols, merges):
    vocab = {s: i for i, s in enumerate(symbols)}
    rules = []
    for _ in range(merges):
        a, b = r.choice(list(vocab)), r.choice(list(vocab))
        if len(a + b) < 9 and a + b not in vocab:
            vocab[a + b] = len(vocab)
            rules.append([a, b])
    return {"vocab": vocab, "merges": rules}


@pytest.mark.parametrize("seed", range(12))
def test_random_merges_equal_plain_merging(seed):
    r = random.Random(seed)
    merges = Merges(_random_model(r, "ab" if seed % 2 else "abc", 4 + 6 * seed))
    words = WordEncoder(merges)
    symbols = {t: i for i, t in enumerate(merges.texts[: merges.base])}
    for _ in range(300):
        text = "".join(r.choice(list(symbols)) for _ in range(r.randrange(1, 40)))
        assert words.tokens(text) == _plain([symbols[c] for c in text], merges.merged)


def _odd_texts():
    r = random.Random(3)
    out = ["", "a", "<|endoftext|>x<|startoftext|≯>", "ΑΣΣ ÎİŠ x\x1cy\x85z", "é é `  q", "日本🙂👩‍👩", "'s't're'LL"]
    out += ["<|endoftext", "½ ² ⅷ   　", "a" * 5000, "ing" * 3000, "the" * 1000 + "!" * 1000]
    out += ["".join(r.choice("aabbeinrst'<|>.é0 ") for _ in range(300)) for _ in range(40)]
    any_char = lambda: r.choice([r.randrange(32, 0x250), r.randrange(0x300, 0x3000), r.randrange(0x10000, 0x1FFFF)])
    return out + ["".join(chr(any_char()) for _ in range(200)) for _ in range(40)]


def test_ids_equal_the_library():
    for text in _odd_texts():
        assert ENCODER.ids(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_small_tables_give_the_same(monkeypatch):
    monkeypatch.setattr(bpe_codec, "KEPT_CHUNKS", 3)
    monkeypatch.setattr(bpe_codec, "KEPT_WORDS", 2)
    small = TextEncoder(VOCABULARY)
    for text in _odd_texts():
        assert small.ids(text) == ENCODER.ids(text)


def test_plain_path_equals_the_library():
    r = random.Random(9)
    for limit in (128, 0x180):
        for _ in range(300):
            text = "".join(chr(r.randrange(limit)) for _ in range(80))
            assert ENCODER.ids(text) == LIBRARY.encode(text, add_special_tokens=False).ids
    for c in range(0x21, 0x180):
        for text in (chr(c), f"a{chr(c)}b", f"'{chr(c)}s1{chr(c)}"):
            assert ENCODER.ids(text) == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text_equals_the_library(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert ENCODER.ids(text) == ids
    out, ends = Decoder(VOCABULARY).texts(np.array(ids, np.int32), np.array([len(ids)]))
    assert out.tobytes().decode() == LIBRARY.decode(ids, skip_special_tokens=False)


def test_decoding_of_odd_ids():
    lists = [[], [320, 10**6, -1], [10**6], [49407, 320], [320], []]
    flat = np.array([i for x in lists for i in x], np.int32)
    out, ends = Decoder(VOCABULARY).texts(flat, np.cumsum([len(x) for x in lists]))
    data, begin = out.tobytes(), 0
    for ids, end in zip(lists, ends):
        known = [i for i in ids if 0 <= i < 49408]
        assert data[begin:end].decode() == LIBRARY.decode(known, skip_special_tokens=False)
        begin = end


def test_a_token_with_two_merges_is_refused():
    model = {"vocab": {"a": 0, "aa": 1, "aaa": 2}, "merges": [["a", "a"], ["a", "aa"], ["aa", "a"]]}
    with pytest.raises(ValueError):
        Merges(model)
    assert json.loads(VOCABULARY)["model"]["type"] == "BPE"


def test_query_digests(spark, tmp_path):
    from ledgerline.llm.catalog import op12_bpe_codec

    texts = [None, *_odd_texts(), "same", "same"]
    ids = [None, *range(len(texts) - 1)]
    rows = {"doc_id": pa.array(ids, pa.int64()), "text": texts, "ids": ["x"] * len(texts), "decoded": ["y"] * len(texts)}
    pq.write_table(pa.table(rows), f"{tmp_path}/documents.parquet")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in zip(ids, texts):
        e = LIBRARY.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(e), sha(" ".join(map(str, e))), sha(LIBRARY.decode(e, skip_special_tokens=False))))
    got = [tuple(r) for r in op12_bpe_codec(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    pq.write_table(pa.table(rows).slice(0, 0), f"{tmp_path}/documents.parquet")
    assert op12_bpe_codec(spark, str(tmp_path)).count() == 0
