"""Groups of equal texts against plain Python, also where identifiers collide."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from opinions.llm import exact


def plain(rows):
    key = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    groups = {}
    for (i, t), k in zip(rows, key):
        groups.setdefault(k, []).append((-len(t or ""), i is not None, i))
    out = []
    for (i, _), k in zip(rows, key):
        keep = min(groups[k], key=lambda g: (g[0], g[1], g[2] or 0))[2]
        out.append((i, keep, len(groups[k]), i == keep, hashlib.sha256(k.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(docs, rows, **options):
    got = exact.deduplicated(docs, **options)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(rows)


def corpus(seed=0):
    rng = random.Random(seed)
    sentences = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(1, 90))) + rng.choice(".!?,") for _ in range(30)]
    rows = []
    for i in range(80):
        rows.append((i, " ".join(rng.choice(sentences) for _ in range(rng.randint(0, 60)))))
    for i in range(80, 140):
        text = rng.choice(rows)[1]
        rows.append((i, rng.choice([text, text.replace(" ", "\n \t"), text.replace(" ", ""), text + "x", text + " "])))
    return rows


def test_random_texts(spark, texts):
    rows = corpus()
    check(texts(rows), rows)


def test_colliding_identifiers(spark, texts):
    rows = corpus(1)
    check(texts(rows), rows, identify=lambda c: F.struct(F.length(c).alias("a"), F.lit(0).alias("b")))


def test_odd_rows(spark, texts):
    rows = [(1, None), (2, ""), (3, " \t\r\n\x0b\x0c"), (None, "a b"), (4, "ab"), (4, "ab"), (5, "x" * 200_000), (6, "x" * 200_000 + " ")]
    check(texts(rows), rows)


def test_empty(spark, texts):
    assert exact.deduplicated(texts([])).count() == 0


@pytest.mark.parametrize("length", [0, 1, 511, 512, 513, 8191, 8192, 8193, 30_000])
def test_chunks_make_up_the_text(spark, length):
    text = "".join("abcdefg."[i % 8] if i % 3000 < 1500 else "x" for i in range(length))
    parts = cut(spark, text)[0]
    assert "".join(parts) == text and all(0 < len(p) <= exact.MOST for p in parts)
    assert all(len(p) >= exact.LEAST for p in parts[:-1])


def cut(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["c"] for r in df.select("i", exact.chunks(F.col("t")).alias("c")).orderBy("i").collect()]


def test_chunks_depend_on_content(spark):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh. ") for _ in range(60_000)).replace(" ", "")
    first, second = map(set, cut(spark, text, "changed start." + text))
    assert len(first & second) > 0.5 * len(first)


@pytest.mark.parametrize("letters", ["abcdefghij,;(){}", "0123456789abcdef", "\u4e00\u4e8c\u4e09\u56db\u4e94\U0001f600\U0001f601"])
def test_chunks_without_sentences_depend_on_content(spark, letters):
    rng = random.Random(3)
    text = "".join(rng.choice(letters) for _ in range(100_000))
    parts, moved, inner = cut(spark, text, "new" + text, text[:50_000] + "z" + text[50_000:])
    assert "".join(parts) == text and "".join(moved) == "new" + text
    assert 20 < len(parts) < 200 and all(len(p) <= exact.MOST for p in parts)
    assert len(set(parts) & set(moved)) > 0.8 * len(parts) and len(set(parts) & set(inner)) > 0.8 * len(parts)


def test_chunks_of_repeated_characters(spark):
    texts = ["x" * 100_000, "xy" * 50_000, "a." + "\U0001f600" * 20_000]
    for text, parts in zip(texts, cut(spark, *texts)):
        assert "".join(parts) == text and all(0 < len(p) <= exact.MOST for p in parts)
