"""Queries over texts: cleaning, tokens, language, words."""

from __future__ import annotations

import uuid

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from catalog import tables as t
from opinions.functions import text as x
from opinions.functions.porter import step_1a
from opinions.functions.values import in_test_split, polarity_of
from opinions.operators import bow, langid, scope
from opinions.operators import sentiment as sen
from opinions.operators.durable import durable, shared_folder
from opinions.plans import texts as plan
from opinions.sources import profiles
from opinions.sources.io import gathered, in_small_tasks

QUERIES = {}
KEY = ["mention_id"]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def docs(spark, d):
    return t.texts(spark, d).select("mention_id", "text", "lang")


def cleaned(spark, d):
    return docs(spark, d).select("mention_id", x.clean_social(F.col("text")).alias("text"))


def hits(spark, d):
    return sen.scored_tokens(docs(spark, d), t.lexicon(spark, d), t.RULES, KEY)


def exact(name):
    """All digits of a product of the rule constants (at most 11), without a negative zero."""
    return (F.round(name, 12) + 0.0).alias(name)


@query
def lexicon_dim(spark, d):
    return t.lexicon(spark, d)


@query
def exclude_cross_mention(spark, d):
    kept = scope.exclude_cross_mention(t.texts(spark, d), t.RIVALS)
    return kept.select("mention_id", "subject")


@query
def clean_social(spark, d):
    return cleaned(spark, d).filter("text <> ''")


@query
def clean_bow(spark, d):
    return docs(spark, d).select("mention_id", x.clean_bow(F.col("text")).alias("text"))


@query
def remove_punct(spark, d):
    return docs(spark, d).select("mention_id", x.remove_punct(F.col("text")).alias("text"))


@query
def tokens_min2(spark, d):
    return cleaned(spark, d).select("mention_id", F.posexplode(x.tokens_min2(F.col("text"))).alias("pos", "tok"))


@query
def strip_edge_punct(spark, d):
    toks = F.explode(x.tokens_min2(F.col("text"))).alias("tok")
    pairs = cleaned(spark, d).select(toks).groupBy("tok").agg(F.count(F.lit(1)).alias("n"))
    return pairs.select("tok", "n", x.strip_edge(F.col("tok")).alias("bare"))


@query
def bare_token_set(spark, d):
    return cleaned(spark, d).select("mention_id", F.explode(x.bare_token_set(F.col("text"))).alias("tok"))


@query
def allcaps_differential(spark, d):
    return sen.tokenized(docs(spark, d), t.RULES, KEY, "text").select(
        "mention_id", "n", F.coalesce(F.col("mixed"), F.lit(False)).cast("int").alias("mixed")
    )


@query
def punctuation_emphasis(spark, d):
    text = F.col("text")
    return cleaned(spark, d).select(
        "mention_id",
        F.regexp_count(text, F.lit("!")).alias("exclaims"),
        F.regexp_count(text, F.lit(r"\?")).alias("asks"),
        F.round(sen.emphasis(text, t.RULES), 6).alias("emph"),
    )


@query
def token_context(spark, d):
    return sen.token_context(docs(spark, d), t.RULES, KEY)


@query
def least_bigram(spark, d):
    context = sen.token_context(docs(spark, d), t.RULES, KEY)
    return sen.least_bigrams(context, t.RULES).select("mention_id", "pos", "b1", "tok")


@query
def token_ngrams(spark, d):
    """Two- and three-word phrases that end at a token, with their counts."""
    return sen.phrase_counts(in_small_tasks(docs(spark, d), "text", "mention_id"))


@query
def lexicon_hits(spark, d):
    return hits(spark, d).select("mention_id", "pos", "tok", "valence")


@query
def first_context_score(spark, d):
    return hits(spark, d).select("mention_id", "pos", "first", "tok", exact("score"))


@query
def caps_effect(spark, d):
    return hits(spark, d).select("mention_id", "pos", F.col("shout").cast("int").alias("shout"), exact("v_caps"))


@query
def booster_effect(spark, d):
    return hits(spark, d).select("mention_id", "pos", exact("boost1"), exact("boost2"), exact("boost3"))


@query
def negation_effect(spark, d):
    return hits(spark, d).select("mention_id", "pos", exact("v1"), exact("v2"), exact("v3"))


@query
def idiom_override(spark, d):
    return hits(spark, d).select("mention_id", "pos", exact("idiom"), exact("damp"), exact("v_idiom"))


@query
def least_rule(spark, d):
    return hits(spark, d).select("mention_id", "pos", exact("v_idiom"), exact("v_least"))


@query
def contrast_reweight(spark, d):
    return hits(spark, d).select("mention_id", "pos", "turn", exact("score"), exact("weighted"))


@query
def phrase_table(spark, d):
    """Idioms and dampeners from a table of phrases instead of a list."""
    tables = sen.rule_tables(spark, t.RULES)._replace(phrases=durable(t.phrase_table(spark, d)))
    found = sen.scored_tokens(docs(spark, d), t.lexicon(spark, d), t.RULES, KEY, tables=tables)
    return found.select("mention_id", "pos", exact("idiom"), exact("damp"), exact("v_idiom"))


@query
def sentiment_scores(spark, d):
    return sen.sentiment_scores(docs(spark, d), t.lexicon(spark, d), t.RULES)


@query
def sentiment_label(spark, d):
    scores = sen.sentiment_scores(docs(spark, d), t.lexicon(spark, d), t.RULES)
    return scores.select("mention_id", polarity_of(F.col("compound")).alias("polarity"))


def language_words(spark, d):
    """Word counts per language, read by the profiles and by the table of frequent words."""
    return durable(langid.word_counts(docs(spark, d)))


@query
def langid_profiles(spark, d):
    out = langid.langid_profiles(langid.word_counts(docs(spark, d)))
    return out.select("lang", "gram", "n", F.round("logp", 6).alias("logp"))


def predicted(spark, d):
    words = language_words(spark, d)
    return langid.langid_predict(docs(spark, d), langid.langid_profiles(words), t.LANGS, words=words)


@query
def langid_predict(spark, d):
    return predicted(spark, d).withColumn("best", F.round("best", 3))


@query
def langid_filter(spark, d):
    return langid.keep_language(predicted(spark, d)).select("mention_id", "pred")


@query
def langid_held_out(spark, d):
    """Held-out texts by profiles of the others, which are stored and read back."""
    texts = docs(spark, d)
    test = in_test_split(F.col("mention_id"))
    words = durable(langid.word_counts(texts.filter(~test)))
    path = f"{shared_folder(spark)}/langid-{uuid.uuid4().hex}"
    profiles.write_profiles(words, langid.langid_profiles(words), path)
    stored = profiles.read_profiles(spark, path)
    found = langid.langid_predict(texts.filter(test), stored.profiles, t.LANGS, words=stored.words)
    return found.withColumn("best", F.round("best", 3))


@query
def scored_mentions(spark, d):
    raw, words = t.text_mentions(spark, d), language_words(spark, d)
    carry = ["mention_id", "subject", "user_id"]
    scored = plan.scored_mentions(
        raw, t.lexicon(spark, d), words, t.LANGS, t.RIVALS, rules=t.RULES, carry=carry
    )
    return t.with_authors(spark, d, scored)


@query
def stopword_table(spark, d):
    """Stop words that the texts use, with their counts."""
    banned = spark.createDataFrame([(w,) for w in StopWordsRemover.loadDefaultStopWords("english")], "word string")
    words = docs(spark, d).select(F.explode(x.bow_words(F.col("text"))).alias("word"))
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(F.broadcast(banned), "word", "left_semi")


@query
def stopword_filter(spark, d):
    alone, others = bow.by_sharing(docs(spark, d), KEY)
    counts = bow.words_of(alone, KEY, counted=True)
    if others is None:
        return counts
    shared = bow.words_of(in_small_tasks(others, "text", *KEY), KEY, counted=True)
    return counts.unionByName(shared.groupBy(*KEY, "word").agg(F.sum("n").alias("n")))


@query
def stem_step1a(spark, d):
    words = bow.words_of(docs(spark, d), KEY).select("word").distinct()
    return words.select("word", step_1a(F.col("word")).alias("stem"))


@query
def stem_vocab(spark, d):
    return bow.stem_vocabulary(bow.words_of(docs(spark, d), KEY))


@query
def bag_of_words(spark, d):
    texts = docs(spark, d)
    stems = bow.frequent_stems(texts)
    alone, others = bow.by_sharing(texts, KEY)
    bag = bow.bag_of_words(gathered(alone, "text", *KEY), stems=stems)
    if others is None:
        return bag
    return bag.unionByName(bow.bag_of_words(in_small_tasks(others, "text", *KEY), stems=stems))


@query
def term_topk(spark, d):
    return bow.term_topk(bow.term_frequency(bow.words_of(docs(spark, d), KEY)))
