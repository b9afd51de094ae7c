"""Token counts against the library, and the rounds of merges against one merge after the other."""

import functools
import random

import numpy as np
import pytest

from opinions.llm import tokens
from opinions.llm.queries import byte_tokenizer


@functools.cache
def whole():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_tokenizer())


def want(text):
    return len(whole().encode(text or "", add_special_tokens=False).ids)


ODD = [
    "", " ", "\n\n  x", "it's we'LL o'clock 'tis 'S", "a<|endoftext|>b<|endoftext|>", "<|endoftext|><|endoftex|>", "aaaaaaaaaaaaaaa",
    "x\x1c\x1d y\x85 z  w v　u", "été ́ İı ſﬁ 日本語 한국어 \U0001f600\U0001f468‍\U0001f469", "1234567890 ½ ² Ⅷ ٣",
    "a_b-c/d\\e  \t  f", "\u0000\u0001", "ꟸꟊ ౝ \U0001e030 Ᲊ", "========----", "ab " * 5000, "  ﻿",
]


def test_odd_texts():
    assert tokens.Counter(byte_tokenizer()).counts(ODD) == [want(t) for t in ODD]


def test_random_texts():
    rng = random.Random(5)
    letters = "abcdeABtheing '’.,;!?0129\n\t éßñ日本́\U0001f600_<|>endoftx"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    assert tokens.Counter(byte_tokenizer()).counts(texts) == [want(t) for t in texts]


def test_forgetful_workers_and_long_texts_count_the_same(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    monkeypatch.setattr(tokens, "HELD", 4)
    texts = ["the cat sat on the mat " * n for n in range(1, 9)] + ODD
    counter = tokens.Counter(byte_tokenizer())
    assert [counter.counts([t])[0] for t in texts] == [want(t) for t in texts]


def test_very_long_pre_tokens():
    rng = random.Random(2)
    texts = ["".join(rng.choice("acgt") for _ in range(200_000)), "z" * 100_001, "".join(rng.choice("etaoinshr") for _ in range(20_000))]
    assert tokens.Counter(byte_tokenizer()).counts(texts) == [want(t) for t in texts]


def one_by_one(symbols, merges):
    """Always the leftmost of the pairs with the lowest rank."""
    rank = {(a, b): (r, c) for r, (a, b, c) in enumerate(merges)}
    symbols = list(symbols)
    while True:
        found = [(rank[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in rank]
        if not found:
            return len(symbols)
        r, i = min(found)
        symbols[i : i + 2] = [merges[r][2]]


@pytest.mark.parametrize("seed", range(30))
def test_rounds_equal_single_merges(seed):
    """Merges in any order, so that a result may merge again at a lower rank, or come from two merges."""
    rng = random.Random(seed)
    size = rng.choice([6, 12])
    pairs = list({(rng.randrange(size), rng.randrange(size)) for _ in range(rng.choice([4, 15, 40]))})
    rng.shuffle(pairs)
    merges = [(a, b, rng.randrange(size)) for a, b in pairs]
    table = tokens.arranged(merges, size)
    m = tokens.Merges(size, None, None, *table, None, None)
    rows = [[rng.randrange(size) for _ in range(rng.randint(1, 25))] for _ in range(60)]
    flat, lens = np.array(sum(rows, []), np.int32), np.array([len(r) for r in rows])
    rank = np.append(tokens.ranked(flat[:-1], flat[1:], size, *table[:2]), tokens.END).astype(np.int32)
    rank[np.cumsum(lens) - 1] = tokens.END
    assert tokens.survivors(flat, lens, rank, m).tolist() == [one_by_one(r, merges) for r in rows]


def test_other_vocabularies_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        tokens.loaded(public_tokenizers.path("word_bpe_49k.json"))


def test_rows(spark, texts):
    rows = [(1, None), (2, ""), (3, "same"), (3, "same"), (None, "été"), (4, "ab " * 400_000)]
    got = tokens.counted(texts(rows), byte_tokenizer()).collect()
    plain = [(i, len((t or "").encode()), want(t), want(t) > 512) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(plain, key=repr)
    assert tokens.counted(texts([]), byte_tokenizer()).count() == 0


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in tokens.counted(docs, byte_tokenizer()).collect()}
    assert got == {r["doc_id"]: (len((r["text"] or "").encode()), want(r["text"]), want(r["text"]) > 512) for r in docs.collect()}
