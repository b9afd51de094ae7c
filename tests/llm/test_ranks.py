"""Ranks without hot parts."""

from pyspark.sql import functions as F

from opinions.llm import common
from opinions.llm.common import with_rank


def rows(spark, n=3000):
    """A key on a third of the rows, and another third that is alike in every column."""
    i = F.col("id")
    third = F.pmod(i, F.lit(3))
    return spark.range(0, n, 1, 16).select(
        (i % 2).alias("shard"),
        F.when(third == 0, -1).when(third == 1, -2).otherwise(i).alias("key"),
        F.when(third != 1, F.crc32(i.cast("string"))).alias("crc"),
    )


def test_gapless_and_each_row_once(spark):
    df = rows(spark)
    ranked = with_rank(df, ["shard"], ["key"], "slot").collect()
    for shard in (0, 1):
        assert sorted(r["slot"] for r in ranked if r["shard"] == shard) == list(range(1500))
    assert sorted(tuple(r)[:3] for r in ranked if r["crc"] is not None) == sorted(map(tuple, df.filter("crc IS NOT NULL").collect()))
    assert sum(r["crc"] is None for r in ranked) == 1000


def test_no_part_holds_a_hot_key(spark):
    parts = common._parted(rows(spark, 90_000), common.RANK_PARTS).groupBy("_part").agg(F.count(F.lit(1)).alias("k"), F.sum("_n").alias("n"))
    most = parts.agg(F.max("k"), F.max("n")).first()
    assert most[0] <= 150  # some 60 on average
    assert most[1] <= 90_000 / 3 / 8 + 150  # the rows that are alike come from 16 tasks


def test_empty(spark):
    assert with_rank(rows(spark).limit(0), ["shard"], ["key"], "slot").count() == 0
