"""Hits against a plain search for every window, with a benchmark of any item length."""

import random
import re

import pytest

from opinions.llm import decontaminate


def plain_words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def plain(docs, items, window=13):
    wins = {}
    for item, text in items:
        w = plain_words(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            wins.setdefault(tuple(w[i : i + window]), set()).add(str(item))
    out = {}
    for key, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for n in {len(x) for x in wins}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in wins:
                    hit |= set(range(i, i + n))
                    found |= wins[tuple(w[i : i + n])]
        out[key] = (len(w), len(hit), sorted(found), 0 < len(hit) and 20 * len(hit) >= len(w))
    return out


def check(spark, texts, docs, items, **options):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(texts(docs), bench, **options)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items", "contaminated", "spans"]
    rows = got.collect()
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in rows} == plain(docs, items)
    assert all(r["n_items"] == len(r["items"]) for r in rows) and len(rows) == len(docs)
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, texts, seed):
    rng = random.Random(seed)
    words = ["a", "B", "çé", "D1", "e", "f", "É"] + [f"w{i}" for i in range(12)]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", ", ", "--", "\n", " . "]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 2, 6, 7, 8, 12, 13, 14, 30]))) for i in range(12)]
    items.append((90, items[3][1]))
    docs = []
    for i in range(60):
        body = [text(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            body += [rng.choice(items)[1].swapcase() if rng.random() < 0.3 else rng.choice(items)[1], text(rng.randint(0, 20))]
        docs.append((i, rng.choice(["", " ", "."]).join(body)))
    assert any(r["contaminated"] for r in check(spark, texts, docs, items))


def test_only_ascii_letters_are_lowered(spark, texts):
    long = " ".join(f"word{i}" for i in range(12))
    check(spark, texts, [(1, f"{long} ÉCOLE"), (2, f"{long.upper()} école"), (3, f"{long} K")], [(1, f"{long} école"), (2, f"{long} k")])


def test_odd_rows(spark, texts):
    passage = " ".join(f"p{i}" for i in range(20))
    docs = [(1, None), (2, ""), (3, "..."), (None, passage), (4, "x " * 30_000 + passage), (5, f"{passage} {passage}")]
    rows = check(spark, texts, docs, [(1, passage), (2, None), (3, "!!"), (4, passage)])
    assert {r["doc_id"]: r["contaminated"] for r in rows}[4] is False
    check(spark, texts, docs, [])
    check(spark, texts, docs, [(1, ""), (2, None)])
    assert decontaminate.contamination(texts([]), spark.createDataFrame([(1, passage)], "item_id long, text string")).count() == 0


def test_large_benchmark_is_joined_by_shuffle(spark, texts, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    passage = " ".join(f"p{i}" for i in range(20))
    check(spark, texts, [(1, f"a b {passage} c"), (2, "nothing here")], [(7, passage)])


def test_edge_of_the_share(spark, texts):
    passage = " ".join(f"p{i}" for i in range(13))
    docs = [(n, passage + " z" * n) for n in (13 * 19 - 1, 13 * 19, 13 * 19 + 1)]
    rows = check(spark, texts, docs, [(1, passage)])
    assert {r["doc_id"]: r["contaminated"] for r in rows} == {246: True, 247: True, 248: False}


def test_repeated_keys_are_taken_together(spark, texts):
    passage = " ".join(f"p{i}" for i in range(13))
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    (row,) = decontaminate.contamination(texts([(1, passage), (1, "one two")]), bench).collect()
    assert (row["n_words"], row["n_hit"], row["contaminated"]) == (13, 13, True)
