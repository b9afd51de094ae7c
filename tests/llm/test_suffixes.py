"""Removed bytes against a dictionary of all passages."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from opinions.llm import suffixes


def plain(rows):
    """(key, n_bytes, n_removed, n_spans, sha256) with every passage looked up; rows in their order."""
    seen, out = set(), []
    for key, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 99):
            p = b[i : i + 100]
            if p in seen:
                gone[i : i + 100] = True
            seen.add(p)
        spans = int(np.diff(np.concatenate(([0], gone.astype(int)))).clip(0).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((key, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def result(df):
    assert df.columns == ["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256", "kept"]
    out = []
    for r in df.collect():
        assert sum(s["stop"] - s["start"] for s in r["spans"]) == r["n_removed"]
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]
        out.append((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]))
    return sorted(out, key=repr)


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    text = lambda k: " ".join(word() for _ in range(k))
    passages = [text(rng.randint(15, 60)) for _ in range(5)]
    line = text(12)
    rows = []
    for i in range(n):
        parts = [text(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 3)
            parts += [p[a : len(p) - rng.randint(0, len(p) // 3)], text(rng.randint(0, 10)), line]
        rows.append((i, rng.choice(["", " "]).join(parts)))
    rows.append((n, rows[3][1]))
    rows.append((n + 1, "x" * 700 + rows[5][1]))
    rows.append((n + 2, "ab" * 300))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_repeated_passages(spark, texts, seed):
    rows = corpus(seed)
    docs = texts(rows).repartition(5)
    assert result(suffixes.without_repeats(docs)) == sorted(plain(rows), key=repr)


@pytest.mark.parametrize("bucket, run", [(4, 30_000), (1_000_000, 3), (50, 7), (1_000_000, 1)])
def test_tiny_buckets_and_runs_compare_across_their_ends(spark, texts, bucket, run):
    rows = corpus(9)
    docs = texts(rows).repartition(7)
    assert result(suffixes.without_repeats(docs, bucket=bucket, run=run)) == sorted(plain(rows), key=repr)


def test_runs_cut_batches_anywhere():
    batches = [pa.RecordBatch.from_pydict({"a": list(range(i, i + n))}) for i, n in ((0, 5), (5, 0), (5, 7), (12, 1))]
    assert [t.column("a").to_pylist() for t in suffixes._runs(iter(batches), 3)] == [[0, 1, 2], [3, 4, 5], [6, 7, 8], [9, 10, 11], [12]]
    assert [t.num_rows for t in suffixes._runs(iter(batches), 100)] == [13] and list(suffixes._runs(iter(()), 3)) == []


def test_equal_hashes_of_other_bytes_are_no_repeat(spark, texts, monkeypatch):
    rows = corpus(6)
    monkeypatch.setattr(suffixes.xxhash, "xxh3_64_intdigest", lambda b: 0)
    docs = texts(rows).coalesce(1)
    got = [r for b in map_strands(docs) for r in b.to_pylist()]
    text = {i: t.encode() for i, t in rows}
    held = {}
    for r in got:
        start, n = r["at"] >> 16, r["at"] >> 8 & 255
        held.setdefault(r["kind"], []).append(text[r["id"]][start : start + n + 99])
    assert held[suffixes.REPEAT] and set(held[suffixes.REPEAT]) <= set(held[suffixes.LOOKUP]) | set(held[suffixes.SORT])


def map_strands(docs):
    """The strands of one batch, cut in this process so that a patched hash counts."""
    caught = []

    class Rows:
        schema = docs.selectExpr("doc_id AS id", "text").schema

        def select(self, *names):
            return self

        def mapInArrow(self, run, schema):
            caught.extend(run(iter(docs.selectExpr("doc_id AS id", "text").toArrow().combine_chunks().to_batches())))

    suffixes._strand_rows(Rows())
    return caught


def test_batches_that_differ_from_scan_to_scan(spark, texts):
    rows = corpus(5)

    def dealt(batches):
        batch = pa.Table.from_batches(list(batches)).combine_chunks()
        order = random.SystemRandom().sample(range(len(batch)), len(batch))
        yield from batch.take(pa.array(order)).to_batches()

    docs = texts(rows).coalesce(1)
    docs = docs.mapInArrow(dealt, docs.schema)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 8)
    try:
        assert result(suffixes.without_repeats(docs)) == sorted(plain(rows), key=repr)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_odd_rows(spark, texts):
    a, b = "the same passage " * 10, "".join(chr(ord("a") + i * 7 % 26) for i in range(150))
    rows = [(1, None), (2, ""), (3, "short"), (4, a), (5, b), (6, "x" + b), (7, b[:99]), (8, b[:100]), (9, "long " * 50_000)]
    assert result(suffixes.without_repeats(texts(rows))) == sorted(plain(rows), key=repr)


def test_null_and_repeated_keys(spark, texts):
    b = "".join(chr(ord("a") + i * 7 % 26) for i in range(150))
    docs = texts([(None, b), (1, b), (2, "other"), (2, "other"), (3, b + "!"), (3, "more")])
    got = result(suffixes.without_repeats(docs))
    same = plain([(None, b), (1, b), (2, "other"), (3, b + "!"), (3, "more")])
    assert got == sorted(same + [same[2]], key=repr)


def test_empty(spark, texts):
    assert suffixes.without_repeats(texts([])).count() == 0


def test_long_documents_are_hashed_in_pieces(monkeypatch):
    data = np.frombuffer(random.Random(1).randbytes(5000), np.uint8)
    whole = suffixes.strands(data)
    monkeypatch.setattr(suffixes, "PIECE", 512)
    start, n, anchor, h = suffixes.strands(data)
    assert int(n.sum()) == len(data) - 99 and (np.repeat(anchor, n) == np.repeat(whole[2], whole[1])).all()
    assert dict(zip(anchor.tolist(), h.tolist())) == dict(zip(whole[2].tolist(), whole[3].tolist()))


def test_multikey_sort_finds_equal_passages():
    rng = random.Random(4)
    pool = [rng.randbytes(100) for _ in range(20)]
    pool += [p[:99] + b"?" for p in pool[:5]]
    held = [rng.choice(pool) for _ in range(200)]
    data = np.frombuffer(b"".join(held) + bytes(8), np.uint8)
    left, group = suffixes.multikey_sorted(data, np.arange(200) * 100)
    got = {}
    for i, g in zip(left.tolist(), group.tolist()):
        got.setdefault(g, []).append(i)
    want = {}
    for i, p in enumerate(held):
        want.setdefault(p, []).append(i)
    assert sorted(got.values()) == sorted(v for v in want.values() if len(v) > 1)
    assert suffixes.multikey_sorted(data, np.zeros(0, np.int64))[0].size == 0


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    assert result(suffixes.without_repeats(docs)) == sorted(plain(rows), key=repr)
