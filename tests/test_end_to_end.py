"""From a CSV export to the leader per region, by hand-made rows."""

import statistics

import pytest
from helpers import values
from pyspark.sql import functions as F

from catalog import tables as t

from opinions import schema
from opinions.operators.durable import durable
from opinions.operators.langid import word_counts
from opinions.operators.scope import population, region_scope
from opinions.plans import regional
from opinions.plans.texts import cleaned_mentions, scored_mentions
from opinions.sources import io

CSV = '''user_id,text,user_join_date,city,country,region,region_code
1,"the house is
good @you",01/02/2019,,X,R1,
2,the house is bad,01/02/2019,,X,R1,
3,the dog and the cat are good,01/02/2021,,X,R2,
4,das haus ist good,01/02/2019,,X,R1,
,the house is good,01/02/2019,,X,R1,
5,the bee and the house are good,01/02/2019,,X,R1,
6,@only,01/02/2019,,X,R1,
'''


def test_csv_to_regions(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(CSV, encoding="utf-8")
    raw = io.read_csv(spark, str(path), schema.RAW_MENTION).drop("_corrupt")
    one = raw.withColumns({"subject": F.lit("a"), "mention_id": F.coalesce(F.col("user_id").cast("long"), F.lit(99))})
    two = one.withColumns({"subject": F.lit("b"), "mention_id": F.col("mention_id") + 100})
    both = one.unionByName(two).withColumn("ts", F.lit("2020-10-01").cast("timestamp"))
    known = word_counts(
        spark.createDataFrame(
            [("en", "the house is the dog and the cat are"), ("de", "das haus ist der hund und die katze")],
            "lang string, text string",
        )
    )
    lexicon = spark.createDataFrame([("good", 2.0), ("bad", -2.0)], "token string, valence double")
    rivals = {"a": "bee", "b": "dog"}
    assert values(cleaned_mentions(both, rivals).filter("mention_id = 1"), "text") == [("the house isgood ",)]

    scored = scored_mentions(both, lexicon, known, ["en", "de"], rivals)
    io.write_scored(scored, str(tmp_path / "scored"))
    back = io.read_parquet(spark, str(tmp_path / "scored"))
    # Line breaks vanish, as in the cleaning rules, so "isgood" is not a scored word.
    assert sorted(values(back, "mention_id", "subject", "polarity")) == [
        (1, "a", 0), (2, "a", -1), (3, "a", 1), (101, "b", 0), (102, "b", -1), (105, "b", 1),
    ]

    scoped = region_scope(back, ["X"], excluded=["OUT"])
    assert population(scoped, "established", cutoff="2020-09-01").count() == 5
    spine = spark.createDataFrame([("R1",), ("R2",)], "region string")
    board = regional.scoreboard(population(scoped, "mentions", order="positive_first"), spine, ("a", "b"))
    assert values(board, "region", "n_a", "n_b", "leader") == [("R1", 0, 1, "b"), ("R2", 1, 0, "a")]


def test_one_pass_equals_two_joined_passes(spark, sf, monkeypatch):
    """One scan and one cleaning of the texts; lexicon and profiles too large to broadcast take two passes to the same rows."""
    raw = t.text_mentions(spark, sf)
    known = durable(word_counts(t.texts(spark, sf)))

    def scored():
        return scored_mentions(raw, t.lexicon(spark, sf), known, t.LANGS, t.RIVALS, rules=t.RULES, carry=["mention_id", "subject", "user_id"])

    one = scored()
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("doc_id") and plan.count("https?://[A-Za-z0-9./]*") == 1
    rows = values(one)
    assert len(rows) > 20
    monkeypatch.setattr("opinions.plans.texts.fits_broadcast", lambda dim: False)
    assert values(scored(), *one.columns) == rows


def test_correlations_of_pairs_with_nulls(spark):
    rows = [(1.0, 2.0, 5, None), (2.0, 1.0, 5, 3.0), (None, 7.0, 5, 1.0), (4.0, 9.0, 5, None), (5.0, None, 5, 8.0)]
    got = {(r["x"], r["y"]): (r["r"], r["n"]) for r in regional.correlation_matrix(spark.createDataFrame(rows, "a double, b double, c int, d double"), "abcd").collect()}
    assert len(got) == 16
    for i, x in enumerate("abcd"):
        for j, y in enumerate("abcd"):
            both = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]
            a, b = zip(*both)
            flat = len(set(a)) == 1 or len(set(b)) == 1
            want = None if flat else statistics.correlation(a, b)
            assert got[x, y][1] == len(both) and got[x, y][0] == (want if flat else pytest.approx(want))
    empty = regional.correlation_matrix(spark.createDataFrame([], "a double, b double"), "ab").collect()
    assert len(empty) == 4 and all(r["r"] is None and r["n"] == 0 for r in empty)
