"""Ids against the plain tokenizer, places against the rules of packing."""

import functools
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from opinions.llm import packing
from opinions.llm.queries import tokenizer


@functools.cache
def whole():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer())


def plain_ids(text):
    return whole().encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, got, capacity=packing.CAPACITY):
    want = []
    for i, text in rows:
        ids = np.array(plain_ids(text), "<u4")
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want.append((i, n, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    held = defaultdict(list)
    for r in got:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held), sum(w[3] for w in want)


def test_odd_rows(spark, texts):
    rows = [(1, None), (2, ""), (3, "Don't STOP, it's 12 o'clock"), (3, "Don't STOP, it's 12 o'clock"), (None, "été"),
            (4, "<|endoftext|> a b c\x1cd é İI ﬁ 日本語 \x85x"), (5, "ab " * 30_000), (6, " \n\t ")]
    got = packing.best_fit(texts(rows), tokenizer()).collect()
    check(rows, got)


def test_empty(spark, texts):
    assert packing.best_fit(texts([]), tokenizer()).count() == 0


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    used, total = check(rows, packing.best_fit(docs, tokenizer()).collect())
    assert used <= 1.05 * total / packing.CAPACITY + 1


def one_by_one(lengths, capacity):
    """Best fit decreasing over single pieces: the rooms that are left."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(8))
def test_plan_equals_best_fit_of_single_pieces(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 37, 100])
    lengths = [rng.randint(1, capacity) for _ in range(rng.choice([1, 30, 400]))]
    counts = {n: lengths.count(n) for n in lengths}
    filled, ranks = defaultdict(int), defaultdict(list)
    for p in packing.plan(counts, capacity):
        for k in range(p.n):
            filled[p.sequence + k // p.per] += p.length
        ranks[p.length] += range(p.first, p.first + p.n)
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
    assert sorted(capacity - f for f in filled.values()) == one_by_one(lengths, capacity)


def test_sequences_hold_the_ids(spark, texts):
    rows = [(i, f"text number {i} " * (i + 1)) for i in range(30)]
    placed = packing.best_fit(texts(rows), tokenizer(), capacity=64, keep_ids=True)
    ids = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4") for r in packing.sequences(placed).collect()}
    for r in placed.collect():
        want = plain_ids(dict(rows)[r["doc_id"]])[r["start"] : r["start"] + r["length"]]
        assert ids[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]].tolist() == want


def test_words_equal_the_tokenizer():
    rng = random.Random(3)
    letters = "abcxyzABZéÉßÿ÷×ñÑüœŒ0194.,;'’!?-_|<>/\u0301İıſﬁ日\u00a0\u0085\x1c"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    words += ["it's.", "'s", "<|endoftext|>", "<|ENDOFTEXT|>", "<|endoftext|>.", "x<|startoftext|>,", "3.", "a.b.,", ".,", "é."]
    texts = [" ".join(words[i : i + 7]) for i in range(0, len(words), 7)]
    got = packing.encoded([t.encode() for t in texts], tokenizer())
    for t, x in zip(texts, got, strict=True):
        assert np.frombuffer(x, "<u4").tolist() == plain_ids(t)[:-1], t


def test_other_tokenizers_get_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["A text, with  spaces.\n", "", "é 日本"]
    want = [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in packing.encoded([t.encode() for t in texts], path)] == want


def test_forgetful_workers_encode_the_same(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    texts = ["a b c d e", "f g a", "b b b"]
    got = [np.frombuffer(x, "<u4").tolist() for t in texts for x in packing.encoded([t.encode()], tokenizer())]
    assert got == [plain_ids(t)[:-1] for t in texts]


def test_a_full_cache_keeps_frequent_words(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    known = packing._known(tokenizer())
    known.clear()
    merged = []
    batch = packing._batch_ids
    monkeypatch.setattr(packing, "_batch_ids", lambda low, starts, lens, m: merged.append(len(lens)) or batch(low, starts, lens, m))
    for n in range(30):
        text = " ".join(["often", *("rare" + "".join("abcdefghij"[int(c)] for c in f"{n}{i:02d}") for i in range(20))])
        assert np.frombuffer(next(packing.encoded([text.encode()], tokenizer())), "<u4").tolist() == plain_ids(text)[:-1]
        assert len(known.slots) <= 71 and len(known.old[0]) <= 71
    assert sum(merged) == 601


def test_merged_words_equal_the_model():
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("etaoinshrdlucmzBÉéßñÀ.,!÷") for _ in range(rng.randint(1, 14))).encode() for _ in range(3000)})
    low, sizes, letters = packing._stems(words)
    starts = np.cumsum(sizes) - sizes
    plain = np.flatnonzero(letters)
    assert len(plain) > 500
    for i, word in enumerate(words):
        stem = word.rstrip(packing.MARKS)
        assert letters[i] == (len(stem) if packing.LETTERS.fullmatch(stem) else 0)
    left, ids = packing._batch_ids(low, starts[plain], letters[plain], packing._word_merges(tokenizer()))
    want = [packing._model_ids(whole(), words[i][: letters[i]]) for i in plain]
    assert ids.astype("<u4").tobytes() == b"".join(want) and left.tolist() == [len(w) // 4 for w in want]


def test_long_texts_are_split_at_blanks(monkeypatch):
    monkeypatch.setattr(packing, "PART", 20)
    text = "one two, three\nfour  five.six it's " * 9 + "x" * 90
    assert np.frombuffer(next(packing.encoded([text.encode()], tokenizer())), "<u4").tolist() == plain_ids(text)[:-1]
