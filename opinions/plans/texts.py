"""From raw mentions to scored mentions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinions.functions.text import clean_social
from opinions.operators.durable import durable
from opinions.operators.joins import fits_broadcast, lookup_join
from opinions.operators.langid import langid_profiles, letter_pieces, likeliest, wide_profiles, with_scores, word_rows, word_scores
from opinions.operators.scope import drop_missing_user, exclude_cross_mention
from opinions.operators.sentiment import NEIGHBOURS, finish_scores, neighbours, ruled, sentiment_scores, tokenized
from opinions.rules import RuleSet

CARRIED = ("mention_id", "subject", "user_id", "user_join_date", "country", "region", "ts")


def cleaned_mentions(raw: DataFrame, rivals: dict[str, str], text: str = "text") -> DataFrame:
    """Mentions with a user and without the rival, their text cleaned and not empty."""
    return usable_mentions(raw, rivals, text).withColumn(text, clean_social(F.col(text)))


def usable_mentions(raw: DataFrame, rivals: dict[str, str], text: str = "text") -> DataFrame:
    """The same rows with their raw text; scorer and language identification clean it themselves."""
    kept = exclude_cross_mention(drop_missing_user(raw), rivals, text)
    return kept.filter(clean_social(F.col(text)) != "")


def scored_mentions(
    raw: DataFrame,
    lexicon: DataFrame,
    words: DataFrame,
    langs: Sequence[str],
    rivals: dict[str, str],
    lang: str = "en",
    rules: RuleSet | None = None,
    carry: Sequence[str] = CARRIED,
    profiles: DataFrame | None = None,
) -> DataFrame:
    """Filter, clean, identify the language, score and label.

    ``words`` are the ``word_counts`` of texts with known languages, ``profiles`` what was learned of them, if it is stored.
    A text is read and cleaned once: its scorer tokens and its language words are one array, whose elements meet lexicon and
    profiles as broadcast tables and are summed per text next to the scan. Texts are never shuffled; join back on
    ``mention_id`` where the text is wanted. A text that cleaning leaves empty has no language and goes.
    """
    rules, langs = rules or RuleSet(), sorted(langs)
    kept = exclude_cross_mention(drop_missing_user(raw), rivals)
    wide = durable(wide_profiles(langid_profiles(words) if profiles is None else profiles, langs))
    table = word_scores(words, wide, langs)
    lex = lexicon.select("token", "valence")
    if not (fits_broadcast(lex) and fits_broadcast(wide)):
        return _scored_apart(kept, lexicon, wide, table, langs, lang, rules, carry)
    of_text = [*carry, "n", "mixed", "turn", "emph"]
    cells = tokenized(kept, rules, carry, "text", {"words": letter_pieces}).select(*of_text, "toks", "lows", "words")
    # The arrays are made before they are exploded, so that the explosion is generated code, which hands the token array on
    # instead of copying it for every element; concat keeps Spark from testing them for emptiness, and so making them twice.
    # The first n cells are tokens in lower case, the others words; an empty piece is no word.
    rows = cells.select(*of_text, "toks", F.posexplode(F.concat("lows", "words")).alias("at", "cell"))
    said, heard = F.col("at") < F.col("n"), (F.col("at") >= F.col("n")) & (F.col("cell") != "")
    rows = rows.select(
        *of_text,
        "toks",
        F.when(said, F.col("at") + 1).otherwise(0).alias("pos"),
        F.when(said, F.col("cell")).alias("low"),
        F.when(heard, F.col("cell")).alias("word"),
    )
    rows = lookup_join(rows, lex, {"low": "token"}, small=True).filter((F.col("pos") == 0) | F.col("valence").isNotNull())
    # A row for each hit, and one for all language words of a text: what only hits have is one column, null for a word.
    near = neighbours(rows.withColumn("tok", F.get("toks", F.col("pos") - 1)))
    own = ["pos", "tok", *NEIGHBOURS]
    near = near.select(*of_text, "word", "valence", F.when(F.col("pos") > 0, F.struct(*own)).alias("hit"))
    scores, score = with_scores(near, wide, table, langs)
    hits = scores.groupBy(*of_text, "valence", "hit").agg(*[F.sum(score[g]).alias(f"s_{g}") for g in langs])
    hits = hits.select("*", "hit.*").drop("hit").withColumn("pos", F.coalesce("pos", F.lit(0)))
    sums = [F.max(f"s_{g}").alias(f"s_{g}") for g in langs]
    found = finish_scores(ruled(hits, lex, rules, carry, True), rules, carry, sums)
    return found.filter(likeliest(langs)[0] == lang).drop(*[f"s_{g}" for g in langs])


def _scored_apart(
    kept: DataFrame, lexicon: DataFrame, wide: DataFrame, table: DataFrame, langs: Sequence[str], lang: str, rules: RuleSet, carry: Sequence[str]
) -> DataFrame:
    """The same where lexicon or profiles are too large to broadcast: two passes whose narrow results are joined."""
    scored = sentiment_scores(kept, lexicon, rules, keys=carry)
    rows = word_rows(kept, ["mention_id"], F.col("text"))
    grams, score = with_scores(rows, wide, table, langs)
    sums = grams.groupBy("mention_id").agg(*[F.sum(score[g]).alias(f"s_{g}") for g in langs])
    return scored.join(sums.filter(likeliest(langs)[0] == lang).select("mention_id"), "mention_id", "left_semi")
