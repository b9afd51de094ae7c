"""Shards against the published loop, slots against their rules."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from opinions.llm import common, shards


def plain_jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("n", [1, 2, 40, 41, 1000])
def test_jump_equals_the_plain_loop(n):
    rng = random.Random(n)
    keys = [0, 1, (1 << 64) - 1, *(rng.getrandbits(64) for _ in range(500))]
    assert shards.jump(np.array(keys, np.uint64), n).tolist() == [plain_jump(k, n) for k in keys]


def test_growing_moves_rows_only_into_the_new_shard():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64)
    before, after = shards.jump(keys, 40), shards.jump(keys, 41)
    assert set(after[before != after].tolist()) == {40}
    assert abs((before != after).mean() - 1 / 41) < 0.006
    assert max(Counter(before.tolist()).values()) < 1.25 * len(keys) / 40


def test_table(spark, texts):
    rows = [(i, "é" * (i % 7)) for i in range(3000)] + [(None, "x"), (5, None), (5, ""), (6, "y" * 300_000)]
    got = shards.sharded(texts(rows).repartition(5), 40).collect()
    assert list(got[0].asDict()) == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots, place = defaultdict(list), {}
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 40)
        assert place.setdefault(r["doc_id"], (r["shard"], r["grown_shard"])) == (r["shard"], r["grown_shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(40))
    assert shards.sharded(texts([]), 40).count() == 0
    with pytest.raises(ValueError):
        shards.sharded(texts(rows), 0)


def test_ranks_have_no_gaps_whatever_the_parts(spark):
    df = spark.range(500).selectExpr("id", "if(id % 3 = 0, 0, id % 5) AS g")
    for parts in (1, 7, 1024):
        held = defaultdict(list)
        for r in common.with_rank(df, ["g"], ["id"], "rank", parts).collect():
            held[r["g"]].append(r["rank"])
        assert all(sorted(x) == list(range(len(x))) for x in held.values())


def test_samples_are_the_least_by_hash(spark):
    from pyspark.sql import functions as F

    df = spark.range(5000).select(F.col("id").alias("k"))
    hashed = df.withColumn("h", F.pmod(F.xxhash64("k"), F.lit(1 << 24)))
    want = [r["k"] for r in hashed.orderBy("h", "k").limit(50).collect()]
    assert [r["k"] for r in common.sampled(df, "k", 50).collect()] == want
    assert common.about(df, "k", 10_000).count() == 5000 and 200 < common.about(df, "k", 400).count() < 700


def test_written_tables_can_be_forgotten(spark):
    kept = common.written(spark.range(10).toDF("k"))
    assert kept.count() == 10 and "opinions-llm" in kept.inputFiles()[0]
    common.forget(spark)
    with pytest.raises(Exception, match="(?i)not exist|not found"):
        spark.catalog.clearCache()
        common.written(kept).count()
