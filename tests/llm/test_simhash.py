"""Fingerprints and classes against plain Python over all pairs."""

import re

import numpy as np
import pytest
import xxhash

from opinions.llm import simhash
from opinions.llm.components import components


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(rows, prints):
    """Smallest id that links reach, by flooding over all pairs of different fingerprints."""
    by = {}
    for (i, _), f in zip(rows, prints):
        by.setdefault(f, []).append(-1 if i is None else i)
    left, out = set(by), {}
    while left:
        todo, group = [left.pop()], set()
        while todo:
            x = todo.pop()
            group.add(x)
            near = {y for y in left if (x ^ y).bit_count() <= 3}
            left -= near
            todo.extend(near)
        least = min(min(by[x]) for x in group)
        out |= {x: None if least == -1 else least for x in group}
    return out


def check(spark, docs, rows, **options):
    prints = [plain_fingerprint(t) for _, t in rows]
    classes = plain_classes(rows, prints)
    want = sorted(((i, f"{f:016x}", classes[f]) for (i, _), f in zip(rows, prints)), key=repr)
    got = simhash.near_duplicates(docs, **options)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_odd_rows(spark, texts):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (4, "one"), (5, "one two"), (6, "ÉCOLE Été x y z"),
            (None, "one"), (7, "a b c d"), (8, "a b c d"), (9, "word " * 70_000)]
    check(spark, texts(rows), rows)


def test_empty(spark, texts):
    assert simhash.near_duplicates(texts([])).count() == 0


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check(spark, docs, rows)


def test_crowded_blocks_connect_the_same(spark):
    rng = np.random.default_rng(3)
    centre = int(rng.integers(1 << 62))
    near = {centre}
    for _ in range(300):
        x = centre
        for b in rng.integers(0, 64, int(rng.integers(1, 9))):
            x ^= 1 << int(b)
        near.add(x)
    values = sorted(x - (1 << 64) if x >> 63 else x for x in near)
    distinct = spark.createDataFrame([(v,) for v in values], "fp long")
    results = []
    for small in (1024, 8):
        root = {r["a"]: r["root"] for r in components(simhash.links(distinct, len(values), small)).collect()}
        results.append({v: root.get(v, v) for v in values})
    assert results[0] == results[1]
    groups = plain_classes([(i, None) for i in range(len(values))], [v % (1 << 64) for v in values])
    for v in values:
        for w in values:
            assert (results[0][v] == results[0][w]) == (groups[v % (1 << 64)] == groups[w % (1 << 64)])


@pytest.mark.parametrize("blocks", [4, 5, 6, 7])
def test_close_pairs_share_a_mask(blocks):
    rng = np.random.default_rng(blocks)
    for _ in range(200):
        flips = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        assert any(flips & m == 0 for m in simhash.masks(blocks))


def test_long_chain_is_one_component(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500), (600, 601)], "a long, b long")
    got = {r["a"]: r["root"] for r in components(chain).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 601: 600}
