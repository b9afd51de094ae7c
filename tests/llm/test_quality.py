"""Marginals against all labelings, features against plain Python, and accuracy on held-out labels."""

import itertools
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinions.llm import quality


def test_marginals_equal_the_sum_over_all_labelings():
    rng = np.random.default_rng(0)
    lines = np.array([3, 1, 5, 2])
    x = rng.normal(size=(lines.sum(), quality.FEATURES))
    chain = quality.Chain(rng.normal(size=quality.FEATURES) * 0.2, rng.normal(size=2), rng.normal(size=(2, 2)))
    got, pairs, first = quality.marginals(chain, x, lines)
    want, want_pairs, want_first = np.zeros(len(x)), np.zeros((2, 2)), np.zeros(2)
    for a, n in zip(np.cumsum(lines) - lines, lines):
        odds = x[a : a + n] @ chain.weights
        weighted = []
        for y in itertools.product((0, 1), repeat=int(n)):
            s = chain.start[y[0]] + sum(o for o, k in zip(odds, y) if k) + sum(chain.pairs[p] for p in zip(y, y[1:]))
            weighted.append((np.exp(s), y))
        total = sum(w for w, _ in weighted)
        for w, y in weighted:
            want[a : a + n] += np.array(y) * w / total
            want_first[y[0]] += w / total
            for p in zip(y, y[1:]):
                want_pairs[p] += w / total
    assert np.allclose(got, want, atol=1e-6)
    assert np.allclose(pairs, want_pairs, atol=1e-6) and np.allclose(first, want_first, atol=1e-6)


def test_features_of_lines():
    own, size, lines = quality.measured([b"", "Ab cd.\n\nxx xx xx!! 12".encode(), "é\né".encode()])
    assert lines.tolist() == [1, 3, 2] and size.tolist() == [0, 6, 0, 13, 2, 2]
    name = lambda row, n: own[row, quality.SPACE + 1 + quality.NAMED.index(n)]
    assert own[1, quality.UPPER] == pytest.approx(1 / 6) and own[3, quality.DIGIT] == pytest.approx(2 / 13)
    assert own[4, quality.OTHER] == 1
    assert name(3, "repeated_words") == pytest.approx(1 / 4) and name(3, "odd_word_ends") == pytest.approx(1 / 4)
    assert name(1, "closed") == 1 and name(3, "closed") == 0
    assert name(5, "seen_before") == 1 and name(4, "seen_before") == 0
    assert name(0, "empty") == 1 and name(2, "empty") == 1 and name(1, "word_length") == pytest.approx(0.25)


def test_neighbours_stay_inside_a_document():
    own = np.arange(1.0, 6)[:, None] * np.ones((1, quality.OWN))
    x = quality.with_neighbours(own, np.array([2, 3]))
    assert x[:, 1].tolist() == [1, 2, 3, 4, 5]
    assert x[:, 1 + quality.OWN].tolist() == [0, 1, 0, 3, 4]
    assert x[:, 1 + 2 * quality.OWN].tolist() == [2, 0, 4, 5, 0]


def test_score_does_not_depend_on_the_batch(monkeypatch):
    rng = np.random.default_rng(1)
    chain = quality.Chain(rng.normal(size=quality.FEATURES), rng.normal(size=2), rng.normal(size=(2, 2)))
    texts = [b"", b"One line.", b"a!! b!!\nc | d\nWell formed text.", b"x " * 50_000, b"\n" * 2000]
    together = quality.scores(chain, texts)
    monkeypatch.setattr(quality, "GROUP", 1)
    assert np.allclose(together, quality.scores(chain, texts))
    assert ((together >= 0) & (together <= 1)).all()


def test_odd_rows(spark, texts):
    docs = texts([(1, None), (1, ""), (None, "Text."), (2, "A!! B!!")])
    labels = spark.createDataFrame([(1, 1, "x"), (2, 0, "x"), (3, None, "x"), (None, 1, "x")], "doc_id long, quality int, text string")
    got = quality.classified(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == 4 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] == 1}) == 1
    blank = quality.classified(docs, labels.limit(0)).collect()
    assert {r["score"] for r in blank} == {0.5}
    assert quality.classified(texts([]), labels).count() == 0


def test_held_out_labels_are_never_learned(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    lies = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fitted(docs, labels), quality.fitted(docs, lies)
    assert np.array_equal(a.weights, b.weights)
    seen = quality.classified(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert (seen.predicted == seen.quality).mean() > 0.95
    assert seen[seen.quality == 1].predicted.mean() > 0.97


def test_lines_are_taken_from_all_over_a_document():
    assert quality.places(64, 64, 5).tolist() == list(range(64))
    for lines, most in ((65, 64), (406, 64), (100_000, 64), (30, 7), (20, 1)):
        at = quality.places(lines, most, -5)
        assert at.tolist() == quality.places(lines, most, -5).tolist()
        assert 0 <= at.min() and at.max() < lines and (np.diff(at) > 0).all() and most // 2 < len(at) <= most
    assert len({int(quality.places(1000, 64, k)[-1]) for k in range(50)}) > 10
    assert all(quality.places(1000, 64, k)[-1] >= 750 for k in range(50))


def test_junk_behind_clean_lines_is_learned(spark, texts):
    clean, junk = "The house by the river was quiet.", "$$## BUY!! %%%% @@@ WIN WIN WIN !!!! ####"
    rows = [(i, "\n".join([clean] * 64 + [clean if i % 2 else junk] * 300)) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    chain = quality.fitted(texts(rows), labels)
    bad, good = quality.scores(chain, ["\n".join([junk] * 50).encode(), "\n".join([clean] * 50).encode()])
    assert bad < 0.1 and good > 0.6


def random_chain(seed):
    rng = np.random.default_rng(seed)
    return quality.Chain(rng.normal(size=quality.FEATURES), rng.normal(size=2), rng.normal(size=(2, 2)))


@pytest.mark.parametrize("lines", [1, 2, 3, 4, 5, 6, 7, 50])
def test_runs_of_lines_score_like_the_whole_text(monkeypatch, lines):
    """Three lines at a time, with lines that repeat across runs, empty ones, and an end of line at the end."""
    rng = np.random.default_rng(lines)
    words = ["", "A good line.", "x!! x!! x!!", "12 34", "\u00e9t\u00e9 ##", "a" * 200]
    texts = ["\n".join(rng.choice(words, lines)).encode() for _ in range(20)]
    chain = random_chain(lines)
    want = quality.scores(chain, texts)
    own = [quality.lines_to_learn(t, 4, 9) for t in texts]
    monkeypatch.setattr(quality, "LONG", 3)
    assert np.allclose([quality.long_score(chain, t) for t in texts], want, atol=1e-9)
    assert np.allclose(quality.mixed_scores(chain, iter([b"", *texts, b"one"])), [*quality.scores(chain, [b""]), *want, *quality.scores(chain, [b"one"])], atol=1e-9)
    for t, x in zip(texts, own):
        some = np.delete(quality.lines_to_learn(t, 4, 9), quality.SEEN, 1)
        assert np.array_equal(some, np.delete(x, quality.SEEN, 1))


def test_a_million_lines_take_little_memory():
    code = """
import resource, sys
import numpy as np
from opinions.llm import quality
rng = np.random.default_rng(0)
chain = quality.Chain(rng.normal(size=quality.FEATURES), rng.normal(size=2), rng.normal(size=(2, 2)))
text = b"\\n".join(b"line %d" % (i % 700_000) for i in range(1_000_000))
quality.mixed_scores(chain, iter([b"a text\\n" * 25_000]))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
score = quality.mixed_scores(chain, iter([text]))[0]
print(score, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    score, grown = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    assert 0 <= float(score) <= 1 and int(grown) < 300
