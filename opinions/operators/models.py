"""Classifiers on bags of words.

Naive Bayes works on one long table (text, label, fold, term, count), which is joined and written once: statistics are sums per
class and term, a prediction is a sum per text and class. The random forest is that of Spark ML's estimator, grown on sparse counts
(``operators.forest``) of hashed features, whose number is measured and bounded. No vocabulary or matrix comes to the driver, and no term is left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinions.functions.buckets import bucket_vectors
from opinions.functions.values import in_test_split
from opinions.operators import forest
from opinions.operators.bow import array_frequency
from opinions.operators.durable import durable, shared_folder
from opinions.operators.joins import fits_broadcast
from opinions.operators.shipping import shipped

FEATURES = "features"
#: Share of the largest variance of a term that is added to all variances.
SMOOTHING = 1e-9
#: Features of the forest at most.
WIDEST = 1 << 15


def vectorized(docs: DataFrame, words: str = "words", size: int = 1 << 18, vocab: Sequence[str] | None = None) -> DataFrame:
    """Add ``features``: term counts over the ``size`` most frequent terms, or over ``vocab``, whose names are on the driver.

    Terms stand in order of their frequency, equally frequent ones by the term, so every run has the same features. Where
    there are more terms, ``hashed`` leaves none out.
    """
    if vocab is not None:
        return CountVectorizerModel.from_vocabulary(list(vocab), words, FEATURES).transform(docs)
    terms = array_frequency(docs, words).orderBy(F.desc("freq"), "term").select("term").limit(size)
    # The names go from Spark to the model as they are; through Python each would be a call of its own.
    names = getattr(terms._jdf, "as")(docs.sparkSession._jvm.org.apache.spark.sql.Encoders.STRING()).collect()
    model = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", names)
    return model.setInputCol(words).setOutputCol(FEATURES).transform(docs)


def bucket(term: Column, width: int) -> Column:
    """The feature that a term counts for."""
    return F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("long") % width


def hash_width(docs: DataFrame, words: str = "words", widest: int = WIDEST) -> int:
    """The power of two that is not below the measured number of different terms, ``widest`` at most.

    The number comes from a sketch of a fixed size (2 % off), so nothing here grows with the terms.
    """
    # Exploding an expression, not a bare column: Spark would else make the array twice.
    terms = docs.select(F.explode(F.concat(F.col(words), F.array().cast("array<string>"))).alias("term"))
    n = terms.agg(F.approx_count_distinct("term", 0.02)).first()[0]
    return min(widest, 1 << max(4, (n - 1).bit_length() if n else 0))


def hashed(docs: DataFrame, width: int, words: str = "words") -> DataFrame:
    """Add ``features``: how often a text has terms of each bucket. Every term counts; several may share a bucket."""
    shipped(docs.sparkSession)
    vectors = F.arrow_udf(lambda terms: bucket_vectors(terms, width), returnType=VectorUDT())
    return docs.withColumn(FEATURES, vectors(F.col(words)))


def collisions(terms: DataFrame, width: int) -> DataFrame:
    """terms_in_bucket, buckets, terms: how many buckets hold one, two, ... different terms of ``terms``."""
    held = terms.select("term").distinct().groupBy(bucket(F.col("term"), width).alias("bucket")).agg(F.count(F.lit(1)).alias("terms_in_bucket"))
    sums = held.groupBy("terms_in_bucket").agg(F.count(F.lit(1)).alias("buckets"))
    return sums.withColumn("terms", F.col("terms_in_bucket") * F.col("buckets"))


def key_split(df: DataFrame, key: str, folds: int = 5) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, four to one; a row's side depends on its key only."""
    test = in_test_split(F.col(key), folds)
    return df.filter(~test), df.filter(test)


def random_split(df: DataFrame, train: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    left, right = df.randomSplit([train, 1 - train], seed)
    return left, right


def class_counts(train: DataFrame, label: str = "label") -> dict[int, int]:
    """Texts per class; a row per class."""
    rows = train.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r[label]: r["n"] for r in sorted(rows, key=lambda r: r[label])}


def labelled_terms(docs: DataFrame, terms: DataFrame, key: str = "mention_id", label: str = "label", folds: int = 5) -> DataFrame:
    """key, label, test, term, n: the term counts of ``docs`` with label and side, written once for all sums and predictions."""
    side = docs.select(key, F.col(label).alias("label"), in_test_split(F.col(key), folds).alias("test"))
    side = F.broadcast(side) if fits_broadcast(side) else side
    return durable(terms.join(side, key).select(key, "label", "test", "term", "n"))


def _statistics(tagged: DataFrame, classes: Sequence[int], squares: bool) -> DataFrame:
    """term, s_<class>, q_<class>: sums of counts and of their squares over the training texts of each class.

    Terms of held-out texts alone have zeros, so the number of rows is the number of terms of both sides.
    """
    n = F.col("n").cast("double") if squares else F.col("n")
    zero = F.lit(0).cast("double" if squares else "long")
    seen = {c: ~F.col("test") & (F.col("label") == c) for c in classes}
    sums = [F.coalesce(F.sum(F.when(seen[c], n)), zero).alias(f"s_{c}") for c in classes]
    if squares:
        sums += [F.coalesce(F.sum(F.when(seen[c], n * n)), zero).alias(f"q_{c}") for c in classes]
    return durable(tagged.groupBy("term").agg(*sums))


def _summed(tagged: DataFrame, stats: DataFrame, gains: dict[int, Column], key: str) -> DataFrame:
    """key, d_<class>: for each held-out text the sum of its terms' gains."""
    stats = stats.withColumnRenamed("term", "_term")
    stats = F.broadcast(stats) if fits_broadcast(stats) else stats
    joined = tagged.filter("test").join(stats, F.col("term") == F.col("_term"))
    return joined.groupBy(key).agg(*[F.sum(g).alias(f"d_{c}") for c, g in gains.items()])


def _decided(test: DataFrame, sums: DataFrame, base: dict[int, Column], key: str, label: str) -> DataFrame:
    """The class with the greatest score; ties go to the smaller class."""
    scored = test.select(key, label).join(sums, key, "left")
    scores = [F.struct((base[c] + F.coalesce(F.col(f"d_{c}"), F.lit(0.0))).alias("s"), F.lit(-c).alias("c")) for c in base]
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return scored.select(key, label, (-best["c"]).cast("int").alias("prediction"))


def multinomial_bayes(
    docs: DataFrame,
    terms: DataFrame,
    key: str = "mention_id",
    label: str = "label",
    folds: int = 5,
    tagged: DataFrame | None = None,
) -> DataFrame:
    """key, label, prediction for the held-out texts, by multinomial naive Bayes with add-one smoothing.

    ``docs`` has key and label, ``terms`` has key, term and n; ``tagged`` is their ``labelled_terms``, if it exists
    already. Every term of either side counts.
    """
    train, test = key_split(docs, key, folds)
    classes = class_counts(train, label)
    if not classes:
        return test.select(key, label, F.lit(None).cast("int").alias("prediction"))
    tagged = labelled_terms(docs, terms, key, label, folds) if tagged is None else tagged
    stats = _statistics(tagged, list(classes), squares=False)
    whole = stats.agg(F.count(F.lit(1)).alias("v"), *[F.coalesce(F.sum(f"s_{c}"), F.lit(0)).alias(f"s_{c}") for c in classes]).first()
    texts = sum(classes.values())
    floor = {c: F.log(F.lit(1.0 / max(whole[f"s_{c}"] + whole["v"], 1))) for c in classes}
    gains = {c: F.col("n") * (F.log(F.col(f"s_{c}") + F.lit(1.0)) + floor[c]) for c in classes}
    prior = {c: F.log(F.lit((n + 1.0) / (texts + len(classes)))) for c, n in classes.items()}
    return _decided(test, _summed(tagged, stats, gains, key), prior, key, label)


def gaussian_bayes(
    docs: DataFrame,
    terms: DataFrame,
    key: str = "mention_id",
    label: str = "label",
    folds: int = 5,
    tagged: DataFrame | None = None,
) -> DataFrame:
    """key, label, prediction for the held-out texts, by Gaussian naive Bayes over the counts of all terms.

    A text has few of the terms. Its score is that of a text without any, a constant of the class, plus a
    correction for each term it has; absent terms are never written out. Parameters as in ``multinomial_bayes``.
    """
    train, test = key_split(docs, key, folds)
    classes = class_counts(train, label)
    if not classes:
        return test.select(key, label, F.lit(None).cast("int").alias("prediction"))
    texts = sum(classes.values())
    tagged = labelled_terms(docs, terms, key, label, folds) if tagged is None else tagged
    stats = _statistics(tagged, list(classes), squares=True)

    def total(letter: str) -> Column:
        return sum((F.col(f"{letter}_{c}") for c in classes), F.lit(0.0))

    spread = F.max(F.when(total("s") > 0, total("q") / texts - F.pow(total("s") / texts, 2)))
    whole = stats.agg(F.count(F.lit(1)).alias("v"), spread.alias("most")).first()
    least = SMOOTHING * (whole["most"] or 0.0)
    if least == 0:  # no term varies, so none tells classes apart
        least = SMOOTHING
    mu = {c: F.col(f"s_{c}") / size for c, size in classes.items()}
    var = {c: F.col(f"q_{c}") / size - mu[c] * mu[c] + least for c, size in classes.items()}
    seen = {c: F.col(f"s_{c}") > 0 for c in classes}
    silent = stats.agg(
        *[F.coalesce(F.sum(F.when(seen[c], F.log(2 * F.pi() * var[c]) + mu[c] * mu[c] / var[c])), F.lit(0.0)).alias(f"x_{c}") for c in classes],
        *[F.count_if(seen[c]).alias(f"k_{c}") for c in classes],
    ).first()
    never = F.log(2 * F.pi() * F.lit(least))
    base = {
        c: F.log(F.lit(size / texts)) - 0.5 * (F.lit(silent[f"x_{c}"]) + (whole["v"] - silent[f"k_{c}"]) * never)
        for c, size in classes.items()
    }
    n = F.col("n").cast("double")
    gains = {c: (2 * n * mu[c] - n * n) / (2 * var[c]) for c in classes}
    # A term that no class has seen costs every class the same.
    return _decided(test, _summed(tagged, stats.filter(total("s") > 0), gains, key), base, key, label)


def random_forest(train: DataFrame, trees: int = 200, seed: int = 42, depth: int = 5, label: str = "label"):
    """The model that Spark's estimator fits, grown on sparse counts; ``train`` should be ``durable``, as it is read four times."""
    return forest.fit(
        train, RandomForestClassifier(featuresCol=FEATURES, labelCol=label, numTrees=trees, seed=seed, maxDepth=depth)
    )


def forest_rows(model: RandomForestClassificationModel, spark) -> DataFrame:
    """tree, node, feature, threshold, left, right, votes: every node of a fitted forest.

    A text goes to ``left`` where its count of ``feature`` is at most ``threshold``; a leaf has no feature. ``votes`` holds a
    node's share of each class; a text's class has the greatest sum over the leaves it comes to, the smaller one in a draw.
    """
    path = f"{shared_folder(spark)}/forest-{uuid.uuid4().hex}"
    model.write().save(path)
    node = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    inner = F.col("leftChild") >= 0
    whole = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
    return node.select(
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"),
        F.transform("impurityStats", lambda x: x / whole).alias("votes"),
    )


def predictions(model, test: DataFrame, keys: Sequence[str], label: str = "label") -> DataFrame:
    out = model.transform(test)
    return out.select(*keys, label, F.col("prediction").cast("int").alias("prediction"))


def accuracy(pred: DataFrame, label: str = "label") -> DataFrame:
    hit = (F.col("prediction") == F.col(label)).cast("double")
    return pred.agg(F.round(F.avg(hit), 6).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def accuracy_table(named: dict[str, DataFrame], label: str = "label") -> DataFrame:
    """One row per model: its accuracy on the held-out rows."""
    tables = [accuracy(p, label).select(F.lit(m).alias("model"), "accuracy", "n") for m, p in named.items()]
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out
