"""Collocations against plain counting of all phrases."""

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from opinions.llm import phrases


def plain(rows, top, least):
    """The result's rows from (lang, text) pairs."""
    count, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = tuple(w for w in re.split("[ \t]+", piece) if w)
            total[lang] += len(words)
            for m in range(1, 6):
                count[lang].update(words[i : i + m] for i in range(len(words) - m + 1))
    out = []
    for lang, f in count.items():
        n, found = total[lang], []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        held = set()
        for q, b in candidates.items():
            for m in range(2, len(q)):
                held |= {(q[i : i + m], b) for i in range(len(q) - m + 1)}
        for p, a in candidates.items():
            if (p, a) in held:
                continue
            cuts = [(1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def corpus(seed, docs=60, length=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "A.B", "x y", "\x00", "日本"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    passages = [" ".join(rng.choices(vocabulary, k=7)) for _ in range(6)]
    rows = []
    for _ in range(docs):
        words = rng.choices(vocabulary, weights, k=rng.randint(0, length))
        for _ in range(rng.choice([0, 1, 2])):
            words.insert(rng.randint(0, len(words)), rng.choice(passages))
        seps = rng.choices([" ", "  ", "\t", ". ", ",", "\n", "! ", " ? "], [20, 1, 1, 1, 1, 1, 1, 1], k=len(words))
        text = "".join(w.upper() if rng.random() < 0.1 else w for pair in zip(words, seps) for w in pair)
        rows.append((rng.choice(["en", "en", "fr", None]), text))
    return rows + [(None, None), ("en", ""), ("xx", "a a a a a a a a"), ("xx", "..."), ("en", rows[0][1]), ("en", rows[0][1])]


def read(spark, rows, top, least):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "lang string, text string, word string, h1 long")
    return sorted(map(tuple, phrases.collocations(df, top, least).collect()))


def test_equals_plain_counting(spark):
    for seed, top, least in ((1, 2000, 3), (2, 5, 2)):
        rows = corpus(seed)
        assert read(spark, rows, top, least) == plain(rows, top, least)


def test_settled_frontier_is_not_expanded(spark, monkeypatch):
    """Rare words in fixed phrases fill the ranks; frequent words cannot reach them and are left out of the second block."""
    rng = random.Random(3)
    pairs = [f"r{i}a r{i}b" for i in range(30)]
    rows = [("en", ". ".join([*rng.sample(pairs, 6), " ".join(rng.choices("abcdefgh", k=80))])) for _ in range(100)]
    seen = []
    grown = phrases.grown
    monkeypatch.setattr(phrases, "grown", lambda read, level, *args: seen.append(level.count()) or grown(read, level, *args))
    assert read(spark, rows, 10, 3) == plain(rows, 10, 3)
    assert seen[0] >= 30 and seen[-1] == 0


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK", 9)
    monkeypatch.setattr(phrases, "BITS", 4)
    rows = corpus(4, 25, 25)
    assert read(spark, rows, 7, 4) == plain(rows, 7, 4)


def test_runs_and_parts_do_not_matter(monkeypatch):
    """Tasks that split long texts and take a few words at a time see the same words and pieces."""
    batch = pa.RecordBatch.from_pydict({"lang": [a or "und" for a, _ in corpus(5)], "text": [t or "" for _, t in corpus(5)]})

    def pieces():
        out = Counter()
        for lang, raw in phrases._runs(batch):
            words = phrases.Words(lang, 0)
            here = phrases.slots(raw, words)
            found = np.array(words.hashes, np.uint64)[here]
            for row in (found, *(np.array(r, np.int64).view(np.uint64) for r in phrases._rows(phrases._pieces(found)).to_pylist())):
                kept = row is found
                assert kept or row[-1] == 0
                flat = [tuple(p) for zero, p in itertools.groupby(row.tolist(), lambda h: h != 0) if zero]
                out.update((kept, p) for p in flat if len(p) > 1)
                out["words"] += kept * sum(map(len, flat))
        return out

    want = pieces()
    for name, value in (("RUN", 50), ("ROW", 7), ("PART", 20)):
        monkeypatch.setattr(phrases, name, value)
    assert pieces() == want and want["words"] == sum(len(re.findall(r"[^ \t.,;:!?\n-\r]+", t or "")) for _, t in corpus(5))
    assert {k: n for (kept, k), n in ((k, n) for k, n in want.items() if k != "words") if kept} == {
        k: n for (kept, k), n in ((k, n) for k, n in want.items() if k != "words") if not kept
    }
    long = "a bb ccc, " * 30
    assert len(phrases.slots(long.encode(), phrases.Words("x", 0))) == 120


def test_phrases_that_share_a_number(monkeypatch):
    monkeypatch.setattr(phrases, "_mixed", lambda parts: parts[0] * np.uint64(0) + np.uint64(1))
    words = np.array([0, 1, 2, 3, 1, 2, 0, 2, 1, 2, 3, 0], np.uint64)
    sought = phrases.Sought.of(np.array([[1, 2, 9], [2, 3, 9]], np.uint64))
    places, which = sought.find(words, phrases._windows(words, 2))
    got = sorted((int(p), tuple(int(x[w]) for x in sought.parts)) for p, w in zip(places, which))
    assert got == [(1, (1, 2)), (2, (2, 3)), (4, (1, 2)), (8, (1, 2)), (9, (2, 3))]


def test_exact_beyond_64_bits(spark):
    """Counts whose products need more than 64 bits."""
    h = "h1 long, h2 long, h3 long, h4 long, h5 long"
    big = 3_000_000_000_000
    words = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 2, big + 7)], "lang string, word string, h long, n long")
    candidates = spark.createDataFrame([(1, 2, 0, 0, 0, big - 1)], h + ", n long")
    around = spark.createDataFrame([(1, 2, 0, 0, 0, big - 1, 0, 5, 0, 5)], h + ", n long, left_least long, left_most long, right_least long, right_most long")
    totals = spark.createDataFrame([("en", 9 * big)], "lang string, total long")
    r = phrases.scored(candidates, around, words, candidates, totals).first()
    assert r["score"] == 1000 * (big - 1) * 9 * big // (big * (big + 7))


@pytest.mark.parametrize("text", ["", "...", "one", "one two"])
def test_few_words(spark, text):
    assert read(spark, [("en", text)], 10, 1) == plain([("en", text)], 10, 1)


def test_empty(spark):
    assert read(spark, [], 10, 1) == []
