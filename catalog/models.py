"""Classifier queries over the labelled texts and over the scored corpora."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import tables as t
from opinions.functions.values import joint_class
from opinions.operators import bow
from opinions.operators import models as m
from opinions.operators import sentiment as sen
from opinions.operators.durable import durable

QUERIES = {}
#: Queries that show what the forest predicts, which SQL cannot; they have no twin.
NO_TWIN = {}
KEY = ["mention_id"]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def no_twin(fn):
    NO_TWIN[fn.__name__] = fn
    return fn


def bag(docs):
    return bow.bag_of_words(docs, stems=bow.frequent_stems(docs))


def bags(spark, d):
    """Labels, term counts of the labelled texts, and both in the one table that fitting and predicting read."""
    marks, terms = t.marks(spark, d), bag(t.labelled(spark, d))
    return marks, terms, m.labelled_terms(marks, terms)


def scored_classes(spark, d):
    """mention_id, label: the joint class of subject and scored polarity, over both corpora."""
    docs = t.texts(spark, d).select("mention_id", "subject", "text")
    scores = sen.sentiment_scores(docs, t.lexicon(spark, d), t.RULES, keys=["mention_id", "subject"])
    return scores.select("mention_id", joint_class(F.col("subject"), F.col("polarity"), t.SUBJECTS).alias("label"))


def forest(docs):
    """Held-out features and the fitted forest, from mention_id, label and words."""
    docs = durable(docs.select("mention_id", "label", "words"))
    # Hashed once: the forest reads its input four times before it keeps it.
    train, test = m.key_split(durable(m.hashed(docs, m.hash_width(docs)).drop("words")), "mention_id")
    return m.random_forest(train.filter("label IS NOT NULL")), test


def forest_predicted(spark, d):
    model, test = forest(bow.with_terms(t.labelled(spark, d)))
    return m.predictions(model, test, KEY)


@no_twin
def rf_joint_class(spark, d):
    """The classes that scoring gives the mentions of both subjects, predicted from their words by the forest."""
    words = bow.with_terms(t.texts(spark, d)).select("mention_id", "words")
    model, test = forest(words.join(scored_classes(spark, d), "mention_id"))
    return m.predictions(model, test, KEY)


@no_twin
def rf_predictions(spark, d):
    """What the forest predicts for the held-out texts; a test reads the trees and comes to the same classes."""
    return forest_predicted(spark, d)


@no_twin
def rf_trees(spark, d):
    """The fitted forest, a row a node."""
    model, _ = forest(bow.with_terms(t.labelled(spark, d)))
    return m.forest_rows(model, spark)


@query
def feature_collisions(spark, d):
    """How many of the forest's features stand for one, two, ... different terms."""
    docs = durable(bow.with_terms(t.labelled(spark, d)).select("words"))
    terms = docs.select(F.explode(F.concat("words", F.array().cast("array<string>"))).alias("term"))
    return m.collisions(terms, m.hash_width(docs))


@query
def nb_multinomial(spark, d):
    docs, terms, tagged = bags(spark, d)
    return m.multinomial_bayes(docs, terms, tagged=tagged)


@query
def nb_gaussian(spark, d):
    docs, terms, tagged = bags(spark, d)
    return m.gaussian_bayes(docs, terms, tagged=tagged)


@query
def nb_accuracy(spark, d):
    docs, terms, tagged = bags(spark, d)
    return m.accuracy_table(
        {
            "multinomial": m.multinomial_bayes(docs, terms, tagged=tagged),
            "gaussian": m.gaussian_bayes(docs, terms, tagged=tagged),
        }
    )


@query
def nb_joint_class(spark, d):
    """The classes that scoring gives the mentions of both subjects, predicted from their words."""
    return m.multinomial_bayes(durable(scored_classes(spark, d)), bag(t.texts(spark, d)))


@no_twin
def classifier_comparison(spark, d):
    """model, accuracy, n: both models on the same held-out texts."""
    docs, terms, tagged = bags(spark, d)
    return m.accuracy_table(
        {"naive_bayes": m.multinomial_bayes(docs, terms, tagged=tagged), "random_forest": forest_predicted(spark, d)}
    )
