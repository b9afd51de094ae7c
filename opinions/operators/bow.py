"""Bag of words: cleaned, stop-word-free, stemmed terms per text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinions.functions.porter import stem
from opinions.functions.text import bow_pieces, drop_stopwords, exploded, telling
from opinions.operators.durable import durable
from opinions.operators.joins import fits_broadcast


def english_stopwords() -> list[str]:
    """Spark's own English list; needs a running session."""
    return StopWordsRemover.loadDefaultStopWords("english")


def terms_column(text: Column, stopwords: Sequence[str] | None = None, stems: bool = True) -> Column:
    """The terms of a text as an array, in order: cleaned, without stop words, stemmed."""
    stopwords = english_stopwords() if stopwords is None else stopwords
    # Stop words have two letters or more, so an empty piece goes with the short words.
    kept = drop_stopwords(bow_pieces(F.coalesce(text, F.lit(""))), stopwords)
    return F.transform(kept, stem) if stems else kept


def words_of(
    docs: DataFrame, keys: Sequence[str], text: str = "text", stopwords: Sequence[str] | None = None, counted: bool = False
) -> DataFrame:
    """One row per remaining word of a text, not stemmed. If ``counted``, one row per different word, with its count ``n``: a text's
    words are sorted in its row, and what lies between the ends of two runs of equal words is counted."""
    stopwords = english_stopwords() if stopwords is None else stopwords
    pieces = bow_pieces(F.coalesce(text, F.lit("")))
    if not counted:
        return docs.select(*keys, exploded(pieces).alias("word")).filter(telling(F.col("word"), stopwords))
    texts = docs.select(*keys, F.sort_array(pieces).alias("_words"))
    # The places after the last word of each run; after the text's last word there is none, so null.
    ends = F.filter(F.sequence(F.lit(1), F.size("_words")), lambda i: ~F.get("_words", i).eqNullSafe(F.get("_words", i - 1)))
    runs = texts.select(*keys, "_words", ends.alias("_ends"))
    places = runs.select(*keys, "_words", "_ends", exploded(F.sequence(F.lit(0), F.size("_ends") - 1), "int").alias("_run"))
    end, start = F.get("_ends", F.col("_run")), F.coalesce(F.get("_ends", F.col("_run") - 1), F.lit(0))
    rows = places.select(*keys, F.get("_words", end - 1).alias("word"), (end - start).cast("long").alias("n"))
    return rows.filter(telling(F.col("word"), stopwords))


def by_sharing(docs: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """The texts that have their key to themselves, and those whose key several rows have (null is a key), if there are any.

    What is counted for a text of the first kind is whole. Only keys are shuffled to tell, unless the shared ones are too many
    to broadcast: then a text moves once, by its key.
    """
    names = [f"_key{i}" for i in range(len(keys))]
    rows = docs.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.count(F.lit(1)).alias("_rows"))
    shared = durable(rows.filter("_rows > 1").drop("_rows"))
    if shared.isEmpty():
        return docs, None
    side = F.broadcast(shared) if fits_broadcast(shared) else shared
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    return docs.join(side, same, "left_anti"), docs.join(side, same, "left_semi")


def stem_vocabulary(words: DataFrame) -> DataFrame:
    """word, stem for each distinct word."""
    return words.select("word").distinct().withColumn("stem", stem(F.col("word")))


def with_terms(docs: DataFrame, text: str = "text", stopwords: Sequence[str] | None = None) -> DataFrame:
    """Add ``words``, the term array that vocabulary and classifiers read. No shuffle."""
    return docs.withColumn("words", terms_column(F.col(text), stopwords))


def frequent_stems(docs: DataFrame, key: str = "mention_id", text: str = "text", most: int = 200_000, texts: int = 4_000) -> DataFrame:
    """word, stem of the words that make up one in ``most`` or more of some ``texts`` texts, chosen by the hash of their key.

    At most ``most`` rows, whatever the texts hold. The table only saves work: a word that it lacks is stemmed where it stands.
    """
    rows, steps = docs.count(), 1 << 24
    some = docs if rows <= texts else docs.filter(F.pmod(F.xxhash64(key), F.lit(steps)) < texts * steps // rows)
    counts = durable(words_of(some, [], text).groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.filter(F.col("n") * most >= total).select("word", stem(F.col("word")).alias("stem"))


def bag_of_words(
    docs: DataFrame,
    keys: Sequence[str] = ("mention_id",),
    text: str = "text",
    stopwords: Sequence[str] | None = None,
    stems: DataFrame | None = None,
) -> DataFrame:
    """keys, term, n. Counts are combined in the task that reads the text.

    ``stems`` (from ``frequent_stems``, at most 200,000 rows) gives the stems of frequent words, others are stemmed in the row;
    the result is the same without it.
    """
    words = words_of(docs, keys, text, stopwords)
    term = stem(F.col("word"))
    if stems is not None:
        words = words.join(F.broadcast(stems.toDF("_word", "_stem")), F.col("word") == F.col("_word"), "left")
        term = F.when(F.col("_stem").isNull(), term).otherwise(F.col("_stem"))
    return words.select(*keys, term.alias("term")).groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("n"))


def term_frequency(words: DataFrame) -> DataFrame:
    """term, freq over all texts, from unstemmed words: counted first, so each distinct word is
    stemmed once."""
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(stem(F.col("word")).alias("term")).agg(F.sum("n").alias("freq"))


def array_frequency(docs: DataFrame, words: str = "words") -> DataFrame:
    """term, freq over all texts, from their term arrays."""
    # Exploding an expression, not a bare column: Spark would else test the array for emptiness
    # below the projection that makes it, and so clean and stem every text again.
    terms = docs.select(F.explode(F.concat(F.col(words), F.array().cast("array<string>"))).alias("term"))
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("freq"))


def term_topk(frequencies: DataFrame, k: int = 20) -> DataFrame:
    return frequencies.orderBy(F.desc("freq"), "term").limit(k)
