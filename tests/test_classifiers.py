"""Queries of classifiers without an SQL twin."""

import hashlib
import random
from collections import Counter

import duckdb
import pytest
from helpers import values
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors

import __spark_entry__ as entry
from catalog import models
from catalog import tables as t
from check import TABLES
from opinions.operators import bow, forest
from opinions.operators import models as m
from opinions.operators.durable import durable
from oracle import sql


def test_comparison_has_the_accuracy_of_both_models(spark, sf):
    assert not set(models.NO_TWIN) & set(sql.queries())
    got = entry.queries()["classifier_comparison"](spark, sf)
    assert got.columns == ["model", "accuracy", "n"]
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    bayes = [(a, n) for model, a, n in db.execute(sql.queries()["nb_accuracy"]).fetchall() if model == "multinomial"]
    rows = values(models.forest_predicted(spark, sf), "label", "prediction")
    forest = (round(sum(label == guess for label, guess in rows) / len(rows), 6), len(rows))
    assert values(got) == [("naive_bayes", *bayes[0]), ("random_forest", *forest)]


def test_features_hold_every_term(spark):
    n = 2**18 + 10
    docs = spark.range(1).selectExpr(f"concat(transform(sequence(1, {n}), i -> concat('t', i)), array('b', 'b', 'a', 'a')) AS words")
    features = m.vectorized(docs, size=n + 2).first()["features"]
    assert features.size == n + 2 and features.numNonzeros() == n + 2
    assert features[0] == features[1] == 2
    assert m.hash_width(docs) == m.WIDEST and m.hash_width(docs, widest=2**30) in (2**18, 2**19)  # 2 % off
    shared = m.hashed(docs, 1024).first()["features"]
    assert shared.size == 1024 and shared.toArray().sum() == n + 4
    # Equally frequent terms go by the term.
    few = spark.createDataFrame([(["c", "b", "a"],), (["d", "d"],), (["a"],)], ["words"])
    assert [r["features"].toArray().tolist() for r in m.vectorized(few, size=3).collect()] == [[1, 0, 1], [0, 2, 0], [1, 0, 0]]


def bucket_of(term, width):
    return int(hashlib.md5(term.encode()).hexdigest()[:8], 16) % width


def test_buckets_and_collisions(spark):
    terms = [f"t{i}" for i in range(300)] + ["é", "日本"]
    held = Counter(Counter(bucket_of(t, 64) for t in terms).values())
    got = m.collisions(spark.createDataFrame([(t,) for t in terms + terms[:9]], "term string"), 64)
    assert values(got, "terms_in_bucket", "buckets", "terms") == sorted(((k, n, k * n) for k, n in held.items()), key=repr)
    docs = spark.createDataFrame([(terms[:40] + terms[:5],), ([],)], "words array<string>")
    first, none = (r["features"].toArray().tolist() for r in m.hashed(docs, 64).collect())
    counts = Counter(bucket_of(t, 64) for t in terms[:40] + terms[:5])
    assert first == [counts[i] for i in range(64)] and not any(none)
    assert m.hash_width(docs.limit(0)) == 16


def test_forest_rows_give_the_predictions(spark, sf):
    """The trees as rows, walked in plain Python over plain counts, against Spark's own predictions of all held-out texts."""
    docs = durable(bow.with_terms(t.labelled(spark, sf)).select("mention_id", "label", "words"))
    width = m.hash_width(docs)
    train, test = m.key_split(m.hashed(docs, width), "mention_id")
    model = m.random_forest(train)
    nodes = {(r["tree"], r["node"]): r for r in m.forest_rows(model, spark).collect()}
    trees = {k[0] for k in nodes}
    assert len(trees) == 200 and all(len(r["votes"]) == len(nodes[0, 0]["votes"]) for r in nodes.values())

    def walked(words):
        counts = Counter(bucket_of(w, width) for w in words)
        sums = [0.0] * len(nodes[0, 0]["votes"])
        for tree in trees:
            r = nodes[tree, 0]
            while r["feature"] is not None:
                r = nodes[tree, r["left"] if counts[r["feature"]] <= r["threshold"] else r["right"]]
            sums = [s + v for s, v in zip(sums, r["votes"])]
        best = max(sums)
        return next(c for c, s in enumerate(sums) if s > best - 1e-9)

    want = sorted((r["mention_id"], walked(r["words"])) for r in test.collect())
    assert len(want) > 10 and values(m.predictions(model, test, ["mention_id"]), "mention_id", "prediction") == sorted(want, key=repr)


def test_forest_of_joint_classes(spark, sf):
    got = entry.queries()["rf_joint_class"](spark, sf)
    marks = models.QUERIES["nb_joint_class"](spark, sf)
    assert values(got, "mention_id", "label") == values(marks, "mention_id", "label")
    assert {r["prediction"] for r in got.collect()} <= {0, 1, 2, 3, 4}


def test_forest_input_is_hashed_once(spark, sf):
    """What the forest reads, three times before it keeps it, is stored; no reading hashes the words again."""
    model, test = models.forest(bow.with_terms(t.labelled(spark, sf)))
    plan = test._jdf.queryExecution().optimizedPlan().toString()
    assert model.getNumTrees == 200 and "md5" not in plan and "words" not in test.columns


def counted(spark, rows, width, terms, most):
    """Texts of up to ``terms`` of ``width`` features, the first of them in up to ``most`` copies; class 2 of 0 to 3 has none."""
    rng = random.Random(rows)
    out = []
    for i in range(rows):
        label = rng.choice([0, 1, 1, 3])
        held = {(rng.randrange(width) + label * 5) % width: float(rng.randint(1, 3)) for _ in range(rng.randrange(terms))}
        held |= {j: float(rng.randint(1, most)) for j in range(3) if rng.random() < 0.7 - 0.1 * label}
        out.append((label, Vectors.sparse(width, held)))
    return durable(spark.createDataFrame(out, ["label", "features"]).repartition(3))


def stored(spark, model, path):
    model.write().save(path)
    return sorted(map(str, spark.read.parquet(f"{path}/data").collect()))


@pytest.mark.parametrize(
    ("rows", "width", "terms", "most", "trees", "depth", "mb"),
    [
        (300, 1 << 16, 30, 2, 6, 5, 256),  # several tables of bins a batch
        (12_000, 40, 20, 80, 12, 5, 256),  # thresholds from a sample, more values than bins
        (500, 3_000, 20, 60, 4, 3, 0),  # a group a node
        (400, 200, 10, 9, 3, 7, 1),
    ],
)
def test_forest_is_the_one_that_spark_grows(spark, tmp_path, rows, width, terms, most, trees, depth, mb):
    train = counted(spark, rows, width, terms, most)
    estimator = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=11, maxMemoryInMB=mb)
    own, theirs = forest.fit(train, estimator), estimator.fit(train)
    assert stored(spark, own, str(tmp_path / "own")) == stored(spark, theirs, str(tmp_path / "theirs"))
    assert (own.numFeatures, own.numClasses, own.getNumTrees, own.getMaxDepth()) == (width, 4, trees, depth)
    assert values(own.transform(train), "label", "prediction") == values(theirs.transform(train), "label", "prediction")


def test_forest_holds_terms_and_not_features(spark, monkeypatch):
    """A training text takes bytes for its terms, whatever the number of features; Spark's own trainer, which holds all of
    them for each text, gets none of the texts."""
    train = counted(spark, 60, 1 << 15, 12, 2)
    fitted = []
    plain = RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df, *a: (fitted.append(df.first()["features"].size), plain(self, df, *a))[1])
    model = m.random_forest(train, trees=7)
    assert fitted == [1] and model.numFeatures == 1 << 15
    cuts = forest.thresholds(train, 1 << 15, 60, 32, 42)
    texts = forest.bagged_texts(train, "label", cuts, 7, 42).collect()
    assert sum(len(r["idx"]) + len(r["bins"]) for r in texts) <= 5 * sum(r["features"].numNonzeros() for r in train.collect())
    assert len(texts) == 60 and {len(r["bag"]) for r in texts} == {7}


def test_forest_of_dense_features_and_refusals(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i % 3, Vectors.dense([float(rng.randrange(4) + (i % 3) * (j == 2)) for j in range(9)])) for i in range(200)]
    train = durable(spark.createDataFrame(rows, ["label", "features"]))
    estimator = RandomForestClassifier(numTrees=5, seed=2)
    both = [stored(spark, f, str(tmp_path / str(i))) for i, f in enumerate((forest.fit(train, estimator), estimator.fit(train)))]
    assert both[0] == both[1]
    with pytest.raises(ValueError, match="below zero"):
        forest.fit(spark.createDataFrame([(0, Vectors.dense([-2.0])), (1, Vectors.dense([1.0]))], ["label", "features"]), estimator)
    with pytest.raises(Exception, match="empty"):
        forest.fit(train.limit(0), estimator)


def test_hashed_arrays_with_gaps(spark):
    docs = spark.createDataFrame([(["a", None, "é", "a"],), ([None],), ([],), (["b"],)], "words array<string>").coalesce(1)
    got = [r["features"] for r in m.hashed(docs, 32).collect()]
    want = [Counter(bucket_of(t, 32) for t in terms) for terms in (["a", "é", "a"], [], [], ["b"])]
    assert [dict(zip(v.indices.tolist(), v.values.tolist())) for v in got] == want and {v.size for v in got} == {32}
    plan = m.hashed(docs, 32)._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan and "ArrowEvalPython" in plan
