"""Language identification from character n-grams.

Profiles are learned from labelled texts and hold every gram; prediction adds up log-probabilities of
the grams that any profile holds. The score of a word depends on the word alone, so frequent words are
scored once, in a table bounded by construction, and only other words are cut into grams. Profiles are
broadcast if they are measured to be small, else joined by shuffle; sums are made per text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinions.functions.text import clean_social, exploded
from opinions.operators.durable import durable
from opinions.operators.joins import BROADCAST_ROWS, fits_broadcast, lookup_join

DIGITS = 6


def letter_pieces(cleaned: Column) -> Column:
    """The words of ``letter_runs`` and perhaps empty strings; never an empty array of a text that is not null."""
    return F.split(F.lower(cleaned), r"[^\p{L}]+")


def letter_runs(cleaned: Column) -> Column:
    return F.filter(letter_pieces(cleaned), lambda w: w != "")


def words_for_grams(text: Column) -> Column:
    """Lower-case letter runs of the cleaned text."""
    return letter_runs(clean_social(F.coalesce(text, F.lit(""))))


def word_rows(docs: DataFrame, keys: Sequence[Column | str], text: Column) -> DataFrame:
    """keys, word: a row for each letter run of the cleaned text, and perhaps rows without a word; one at least a text."""
    pieces = letter_pieces(clean_social(F.coalesce(text, F.lit(""))))
    rows = docs.select(*keys, exploded(pieces).alias("word"))
    return rows.withColumn("word", F.when(F.col("word") != "", F.col("word")))


def word_grams(word: Column, sizes: Sequence[int] = (1, 2, 3)) -> Column:
    def grams(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(word) - (size - 1))
        some = F.transform(starts, lambda i: F.substring(word, i, F.lit(size)))
        return F.when(F.length(word) >= size, some).otherwise(F.array().cast("array<string>"))

    return F.concat(*[grams(s) for s in sizes])


def gram_rows(rows: DataFrame, kept: Sequence[str], word: Column, sizes: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """kept, gram: a row for each gram of ``word_grams``, and one with a null gram where there is none.

    Grams are cut at the places where they start, in two explosions: functions without a lambda are generated code, so that
    a row is not copied on its way from the explosion of texts to the sums.
    """
    at, word_at = F.col("_at"), F.col("_cut")
    places = F.when(F.length(word_at) >= min(sizes), F.sequence(F.lit(1), F.length(word_at)))
    rows = rows.select(*kept, word.alias("_cut")).select(*kept, "_cut", F.explode_outer(places).alias("_at"))
    here = [F.when(at + (k - 1) <= F.length(word_at), F.substring(word_at, at, F.lit(k))) for k in sizes]
    none = F.array(F.lit(None).cast("string"))
    grams = rows.select(*kept, "_at", F.explode_outer(F.when(at.isNull(), none).otherwise(F.array(*here))).alias("gram"))
    return grams.filter(at.isNull() | F.col("gram").isNotNull()).drop("_at")


def word_counts(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, word, c: how often each word occurs; counted next to the scan, then combined."""
    return (
        word_rows(labelled, [F.col(lang).alias("lang")], F.col(text))
        .filter("word IS NOT NULL")
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("c"))
    )


def langid_profiles(words: DataFrame) -> DataFrame:
    """lang, gram, n, total, v, logp from ``word_counts``: every gram of a language with its add-one
    log-probability. ``total`` counts the language's grams, ``v`` the different grams of all languages."""
    counts = durable(
        gram_rows(words, ["lang", "c"], F.col("word"))
        .filter("gram IS NOT NULL")
        .groupBy("lang", "gram")
        .agg(F.sum("c").alias("n"))
    )
    v = counts.select("gram").distinct().count()
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))  # a row per language
    logp = F.log((F.col("n") + 1) / (F.col("total") + v))
    return counts.join(F.broadcast(total), "lang").select(
        "lang", "gram", "n", "total", F.lit(v).cast("long").alias("v"), logp.alias("logp")
    )


def wide_profiles(profiles: DataFrame, langs: Sequence[str]) -> DataFrame:
    """One row per gram with a log-probability per language; unseen grams get the add-one floor."""
    floor = F.max(F.log(1 / (F.col("total") + F.col("v"))))
    floors = {r["lang"]: r["floor"] for r in profiles.groupBy("lang").agg(floor.alias("floor")).collect()}
    return profiles.groupBy("gram").agg(
        *[
            F.coalesce(F.max(F.when(F.col("lang") == g, F.col("logp"))), F.lit(floors.get(g)).cast("double")).alias(f"lp_{g}")
            for g in langs
        ]
    )


def word_scores(words: DataFrame, wide: DataFrame, langs: Sequence[str], most: int = BROADCAST_ROWS) -> DataFrame:
    """word, w_<lang>: summed log-probabilities of the most frequent words, at most ``most`` of them.

    Words stand in classes by the logarithm of their counts, and the table has the highest classes that fit, each whole; so
    nothing is sorted, and of the words only a row a class comes to the driver.
    """
    counts = words.groupBy("word").agg(F.sum("c").alias("c")).withColumn("class", F.floor(F.log2("c") * 16))
    least, held = None, 0
    for r in sorted(counts.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r["class"]):
        held += r["n"]
        if held > most:
            break
        least = r["class"]
    kept = counts.filter(F.lit(False) if least is None else F.col("class") >= least)
    grams = gram_rows(kept, ["word"], F.col("word")).filter("gram IS NOT NULL")
    return (
        lookup_join(grams, wide, {"gram": "gram"}, small=fits_broadcast(wide))
        .groupBy("word")
        .agg(*[F.sum(f"lp_{g}").alias(f"w_{g}") for g in langs])
    )


def langid_predict(
    docs: DataFrame,
    profiles: DataFrame,
    langs: Sequence[str],
    keys: Sequence[str] = ("mention_id",),
    text: str = "text",
    words: DataFrame | None = None,
) -> DataFrame:
    """keys, pred, best: the likeliest language; no known gram gives null. Ties go by language code.

    ``words`` (``word_counts`` of any corpus like this one) only makes it faster.
    """
    langs = sorted(langs)
    wide = durable(wide_profiles(profiles, langs))
    rows = word_rows(docs, keys, F.col(text))
    grams, score = with_scores(rows, wide, None if words is None else word_scores(words, wide, langs), langs)
    sums = grams.groupBy(*keys).agg(*[F.sum(score[g]).alias(f"s_{g}") for g in langs])
    pred, best = likeliest(langs)
    return sums.select(*keys, pred.alias("pred"), best.alias("best"))


def with_scores(rows: DataFrame, wide: DataFrame, table: DataFrame | None, langs: Sequence[str]) -> tuple[DataFrame, dict[str, Column]]:
    """Rows with a column ``word``, one for each gram of words that ``table`` lacks, and the score of a row per language.

    ``table`` (from ``word_scores``, 200,000 rows at most) is broadcast, ``wide`` if it is measured to be small.
    """
    others = rows.columns
    small = fits_broadcast(wide)
    if table is None:
        grams = gram_rows(rows, others, F.col("word"))
        return lookup_join(grams, wide, {"gram": "gram"}, small=small), {g: F.col(f"lp_{g}") for g in langs}
    rows = rows.join(F.broadcast(table.withColumnRenamed("word", "_word")), F.col("word") == F.col("_word"), "left")
    grams = gram_rows(rows, [*others, *[f"w_{g}" for g in langs]], F.when(F.col("_word").isNull(), F.col("word")))
    joined = lookup_join(grams, wide, {"gram": "gram"}, small=small)
    return joined, {g: F.coalesce(f"w_{g}", f"lp_{g}") for g in langs}


def likeliest(langs: Sequence[str]) -> tuple[Column, Column]:
    """The language with the greatest of the sums s_<lang>, and that sum; ties go by language code."""
    sums = {g: F.round(F.col(f"s_{g}"), DIGITS) for g in sorted(langs)}
    best = F.greatest(*sums.values()) if len(sums) > 1 else next(iter(sums.values()))
    return F.coalesce(*[F.when(s == best, g) for g, s in sums.items()]), best


def keep_language(predicted: DataFrame, lang: str = "en") -> DataFrame:
    """Texts predicted as ``lang``; a text without a prediction is rejected."""
    return predicted.filter(F.col("pred") == lang)
