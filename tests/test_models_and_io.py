import math
import random
import statistics
from collections import Counter

import pytest
from helpers import values
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinions import rules, schema
from opinions.functions.values import date_notations, parse_dates
from opinions.operators import bow, langid
from opinions.operators import models as m
from opinions.operators.durable import durable
from opinions.operators.sentiment import sentiment_scores
from opinions.sources import io, profiles

DOCS = [
    (1, "good good film", 0), (2, "bad film", 1), (3, "good play", 0), (4, "bad bad play", 1), (5, "good film", 0),
    (6, "nice film", 0), (7, "awful play", 1), (8, "bad film film", 1), (10, "good bad", 0),
]


@pytest.fixture(scope="module")
def featured(spark):
    df = spark.createDataFrame(DOCS, "mention_id long, text string, label int")
    return durable(m.vectorized(bow.with_terms(df)).select("mention_id", "label", "words", "features"))


def test_split_depends_on_the_key(featured):
    train, test = m.key_split(featured, "mention_id")
    assert values(test, "mention_id") == [(10,), (5,)]
    assert train.count() + test.count() == featured.count()
    left, right = m.random_split(featured, 0.8, 42)
    assert left.count() + right.count() == featured.count()


def plain_bayes(docs, kind):
    """Predictions from dense vectors, class by class."""
    terms = sorted({t for _, words, _ in docs for t in words})
    train = [d for d in docs if d[0] % 5]
    classes = sorted({d[2] for d in train})
    counts = {d[0]: [d[1].count(t) for t in terms] for d in docs}
    columns = list(zip(*(counts[d[0]] for d in train)))
    largest = max(statistics.pvariance(c) for c in columns)
    out = []
    for key, _, label in docs:
        if key % 5:
            continue
        score = {}
        for c in classes:
            own = [counts[d[0]] for d in train if d[2] == c]
            if kind == "multinomial":
                total = sum(map(sum, own)) + len(terms)
                s = math.log((len(own) + 1) / (len(train) + len(classes)))
                s += sum(n * math.log((sum(col) + 1) / total) for n, col in zip(counts[key], zip(*own)))
            else:
                s = math.log(len(own) / len(train))
                for n, col in zip(counts[key], zip(*own)):
                    var = statistics.pvariance(col) + 1e-9 * largest
                    s -= 0.5 * math.log(2 * math.pi * var) + (n - statistics.fmean(col)) ** 2 / (2 * var)
            score[c] = s
        out.append((key, label, max(classes, key=lambda c: (score[c], -c))))
    return sorted(out)


@pytest.mark.parametrize("kind", ["multinomial", "gaussian"])
def test_bayes_equals_dense_bayes(spark, kind):
    rng = random.Random(kind)
    words = [f"w{i}" for i in range(40)]
    docs = []
    for i in range(1, 121):
        label = rng.choice([0, 1, 3])
        docs.append((i, [rng.choice(words[label * 8 : label * 8 + 16]) for _ in range(rng.randint(0, 12))], label))
    docs.append((125, ["never", "seen"], 1))
    df = spark.createDataFrame([(i, label) for i, _, label in docs], "mention_id long, label int")
    rows = [(i, t, n) for i, words_, _ in docs for t, n in Counter(words_).items()]
    terms = spark.createDataFrame(rows, "mention_id long, term string, n long")
    fit = m.multinomial_bayes if kind == "multinomial" else m.gaussian_bayes
    assert sorted(values(fit(df, terms), "mention_id", "label", "prediction")) == plain_bayes(docs, kind)
    # Terms far beyond any vocabulary bound change nothing where no held-out text has them.
    rare = spark.range(2**18 + 10).selectExpr("1L AS mention_id", "concat('rare', id) AS term", "0L AS n")
    if kind == "gaussian":
        more = terms.unionByName(rare.limit(2000))
        assert sorted(values(fit(df, more), "mention_id", "label", "prediction")) == plain_bayes(docs, kind)


def test_bayes_without_training_texts(spark):
    docs = spark.createDataFrame([(5, 1)], "mention_id long, label int")
    terms = spark.createDataFrame([(5, "a", 1)], "mention_id long, term string, n long")
    for fit in (m.multinomial_bayes, m.gaussian_bayes):
        assert values(fit(docs, terms), "mention_id", "prediction") == [(5, None)]


def test_forest_and_accuracy(spark):
    rows = [(i, ["good", "film"] if i % 2 else ["bad", "play"], i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "mention_id long, words array<string>, label int")
    train, test = m.key_split(m.vectorized(df), "mention_id")
    forest = m.predictions(m.random_forest(train, trees=5), test, ["mention_id"])
    again = m.predictions(m.random_forest(train, trees=5), test, ["mention_id"])
    assert values(forest) == values(again)
    assert all(r["label"] == r["prediction"] for r in forest.collect())
    assert values(m.accuracy_table({"rf": forest}), "model", "accuracy", "n") == [("rf", 1.0, 12)]


def test_durable_uses_the_shared_folder(spark, featured):
    assert spark.sparkContext.getCheckpointDir() is not None
    assert "Scan ExistingRDD" in featured._jdf.queryExecution().executedPlan().toString()


def test_csv_with_line_breaks(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        'user_id,text,user_join_date,city,country,region,region_code\n'
        '1,"two\nlines, ""quoted""",01/02/2020,,X,R1,R\n'
        ',plain,,,X,,\n',
        encoding="utf-8",
    )
    df = io.read_csv(spark, str(path), schema.RAW_MENTION)
    rows = df.collect()
    assert len(rows) == 2 and rows[0]["text"] == 'two\nlines, "quoted"'
    assert rows[1]["user_id"] is None and rows[1]["region"] is None and rows[0]["_corrupt"] is None
    assert io.spread(df, 3, "user_id").rdd.getNumPartitions() == 3


def test_csv_is_read_by_name(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('when,text,extra,uid,n\n2020-10-01,"hi, there",x,7,3\nlater,"two\nlines",y,8,many\n', encoding="utf-8")
    wanted = T.StructType(
        [T.StructField("user_id", T.StringType()), T.StructField("text", T.StringType()),
         T.StructField("n", T.IntegerType()), T.StructField("country", T.StringType())]
    )
    df = io.read_csv(spark, str(path), wanted, columns={"user_id": "uid"})
    assert df.columns == ["user_id", "text", "n", "country", "_corrupt"]
    assert values(df) == [("7", "hi, there", 3, None, None), ("8", "two\nlines", None, None, None)]
    path.write_text("text,uid\na,1\nb,2,3\n", encoding="utf-8")
    rows = io.read_csv(spark, str(path), wanted, columns={"user_id": "uid"}).collect()
    assert [(r["user_id"], r["_corrupt"] is not None) for r in rows] == [("1", False), ("2", True)]


def test_only_small_inputs_are_spread(spark, tmp_path):
    spark.range(100).repartition(2).write.parquet(str(tmp_path / "small"))
    small = spark.read.parquet(str(tmp_path / "small"))
    cores = spark.sparkContext.defaultParallelism
    assert io.fill_cluster(small, "id").rdd.getNumPartitions() == cores
    many = spark.range(100).repartition(io.SMALL_PIECES + 1)
    assert io.fill_cluster(many, "id").rdd.getNumPartitions() == io.SMALL_PIECES + 1


def test_lexicon_file(spark, tmp_path):
    path = tmp_path / "lexicon.txt"
    path.write_text("good\t1.9\t0.9\t[2, 1]\nbad\t-2.5\t0.6\t[]\ngood\t2.1\t0\t[]\n\nbroken line\n:)\t2.0\t1\t[]\n")
    got = values(io.read_lexicon(spark, str(path)), "token", "valence")
    assert got == [(":)", 2.0), ("bad", -2.5), ("good", 2.1)]


def test_scored_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a", "good day"), (2, "b", "bad day")], "mention_id long, subject string, text string")
    lexicon = spark.createDataFrame([("good", 2.0), ("bad", -2.0)], "token string, valence double")
    scored = sentiment_scores(docs, lexicon, keys=["mention_id", "subject"])
    io.write_scored(scored, str(tmp_path / "out"))
    back = io.read_parquet(spark, str(tmp_path / "out"))
    assert values(back, *scored.columns) == values(scored)
    only = back.filter(F.col("subject") == "a")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(subject" in only


def test_bucketed_texts_are_scored_without_a_shuffle(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"good day {i}") for i in range(50)], "mention_id long, text string")
    io.write_bucketed(docs, "bucketed_texts", "mention_id", 4, str(tmp_path / "bucketed"))
    lexicon = spark.createDataFrame([("good", 2.0)], "token string, valence double")
    scored = sentiment_scores(spark.table("bucketed_texts"), lexicon)
    assert "Exchange hashpartitioning" not in scored._jdf.queryExecution().executedPlan().toString()
    assert scored.filter("polarity = 1").count() == 50
    spark.sql("DROP TABLE bucketed_texts")


def test_region_tables(spark):
    table = io.region_table(spark)
    assert table.count() == 51 and table.select("region_code").distinct().count() == 51
    spine = {r["region"] for r in io.region_spine(spark).collect()}
    assert len(spine) == 50 and "District of Columbia" not in spine
    assert values(io.first_rows(table, 2, "region"), "region_code") == [("AK",), ("AL",)]


def test_fixed_lists():
    assert len(set(rules.NEGATORS)) == 59
    assert len(rules.RuleSet().boosters) == 66
    assert len(rules.IDIOMS) == 7 and len(set(rules.EDGE_RUNS)) == 17


def test_writing_one_subject_again_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "scored")
    rows = spark.range(1000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN 'b' WHEN id % 10 = 1 THEN NULL ELSE 'a' END AS subject")
    io.write_scored(rows.repartition(16), path, rows_per_file=300)
    files = {d.name.split("=")[1]: len(list(d.glob("*.parquet"))) for d in (tmp_path / "scored").iterdir() if d.is_dir()}
    assert files["a"] <= 3 and files["b"] == 1 and files["__HIVE_DEFAULT_PARTITION__"] == 1
    io.write_scored(spark.createDataFrame([(-1, "a")], "id long, subject string"), path)
    io.write_scored(spark.createDataFrame([(-1, "a")], "id long, subject string"), path)
    back = io.read_parquet(spark, path)
    assert values(back.filter("subject = 'a'"), "id") == [(-1,)]
    assert back.filter("subject = 'b'").count() == 100 and back.filter("subject IS NULL").count() == 100


def test_stored_profiles(spark, tmp_path):
    texts = spark.createDataFrame([("en", "the house is here"), ("de", "das haus ist hier")], "lang string, text string")
    words = langid.word_counts(texts)
    learned = langid.langid_profiles(words)
    profiles.write_profiles(words, learned, str(tmp_path / "one"))
    stored = profiles.read_profiles(spark, str(tmp_path / "one"))
    assert values(stored.words) == values(words, *stored.words.columns) and values(stored.profiles) == values(learned, *stored.profiles.columns)
    others = spark.createDataFrame([(1, "is the house"), (2, "ist das haus"), (3, "12 ?")], "mention_id long, text string")
    found = langid.langid_predict(others, stored.profiles, ["de", "en"], words=stored.words)
    assert values(found, "mention_id", "pred") == [(1, "en"), (2, "de"), (3, None)]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        profiles.write_profiles(words, learned, str(tmp_path / "one"))
    profiles.write_profiles(words, learned, str(tmp_path / "old"), format=profiles.FORMAT + 1)
    with pytest.raises(ValueError, match="format"):
        profiles.read_profiles(spark, str(tmp_path / "old"))
    learned.limit(3).write.mode("overwrite").parquet(str(tmp_path / "one" / "profiles"))
    with pytest.raises(ValueError, match="whole"):
        profiles.read_profiles(spark, str(tmp_path / "one"))


def test_date_notation_comes_from_the_data(spark):
    def table(rows):
        return spark.createDataFrame([(x,) for x in rows], "d string")

    days = ["13/02/2020", "01.02.2020", " 2-3-2020 ", "x", None, "2020-05-06 01:02:03", "5 Jun 2021"]
    counts = {r["notation"]: (r["fits"], r["alone"], r["place"]) for r in date_notations(table(days), "d").collect()}
    assert counts["d-M-yyyy"] == (3, 1, 1) and counts["M-d-yyyy"] == (2, 0, 2) and counts["yyyy-M-d H:m:s"][:2] == (1, 1)
    got = [(r["d"], str(r["day"]), r["day_unsure"]) for r in parse_dates(table(days), "d", "day").collect()]
    assert got == [
        ("13/02/2020", "2020-02-13", False), ("01.02.2020", "2020-02-01", False), (" 2-3-2020 ", "2020-03-02", False),
        ("x", "None", False), (None, "None", False), ("2020-05-06 01:02:03", "2020-05-06", False), ("5 Jun 2021", "2021-06-05", False),
    ]
    # Both orders are in use: the one with more dates goes first, and dates that the other reads otherwise are told.
    mixed = ["13/02/2020", "14/02/2020", "02/15/2020", "3/4/2020", "5/5/2020"]
    got = [(str(r["day"]), r["day_unsure"]) for r in parse_dates(table(mixed), "d", "day").collect()]
    assert got == [("2020-02-13", False), ("2020-02-14", False), ("2020-02-15", False), ("2020-04-03", True), ("2020-05-05", False)]
    assert parse_dates(table(["x", None]), "d", "day").filter("day IS NULL").count() == 2
    assert parse_dates(table([]), "d", "day").count() == 0


def test_csv_in_pieces(spark, tmp_path):
    """Records with line breaks across pieces of a few hundred bytes, in several files, against Spark's own reader."""
    rng = random.Random(12)
    parts = ["plain", 'say "hi"', "two\nlines", "a,b", "", "x\r\ny", "é😀", "\n\n", "word " * 20, '"']
    schema_ = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("more", T.StringType())])
    (tmp_path / "in").mkdir()
    for f in range(3):
        rows = [["id", "text", "more"]]
        rows += [[str(i), "".join(rng.choice(parts) for _ in range(rng.randint(0, 5))), rng.choice(parts)] for i in range(150)]
        rows[20][1] = "long\n" * 400  # lies across several pieces
        lines = [",".join('"' + x.replace('"', '""') + '"' if set(x) & set('",\n\r') else x for x in r) for r in rows]
        (tmp_path / "in" / f"{f}.csv").write_text("\n".join(lines) + ("\n" if f else ""), encoding="utf-8", newline="")
    path = str(tmp_path / "in")
    want = values(io.read_csv(spark, path, schema_))
    assert len(want) == 450
    assert values(io.read_csv(spark, path, schema_, split=True)) == want
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        pieces = spark.read.text(path).rdd.getNumPartitions()
        got = values(io.read_csv(spark, path, schema_, split=True))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert pieces > 50 and got == want
    (tmp_path / "in" / "9.csv").write_text("id,other,more\n1,2,3\n")
    with pytest.raises(Exception, match="header"):
        io.read_csv(spark, path, schema_, split=True).collect()


def test_tasks_of_little_text(spark):
    rows = [(i % 3 or None, "x" * 50) for i in range(400)] + [(7, None)]
    df = spark.createDataFrame(rows, "k long, text string").coalesce(1)
    assert io.in_small_tasks(df, "text", "k", chars=10_000).rdd.getNumPartitions() == 1
    some = io.in_small_tasks(df.withColumn("text", F.concat("text", F.monotonically_increasing_id())), "text", "k", chars=2_000)
    held = [r["count"] for r in some.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == 401 and len(held) >= 10 and max(held) < 100
    assert io.in_small_tasks(df.limit(0), "text", "k").count() == 0


def test_gathered_keeps_a_key_together_in_bounded_tasks(spark):
    df = spark.range(200).select((F.col("id") % 50).alias("k"), F.repeat(F.lit("x"), 100).alias("text"))
    some = io.gathered(df, "text", "k", chars=2_000)
    assert some.rdd.getNumPartitions() == 10
    tasks = some.withColumn("p", F.spark_partition_id()).groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("p").alias("p"))
    assert values(tasks, "n", "p") == [(4, 1)] * 50
    assert io.gathered(df.limit(0), "text", "k").count() == 0
    assert io.gathered(df, "text", "k").rdd.getNumPartitions() == 1
