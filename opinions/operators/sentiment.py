"""Lexicon sentiment as one DataFrame plan.

A text is one row, and so is its token array. The array is exploded, tokens that the lexicon does
not know are dropped by a broadcast join in the same stage, and the few scored tokens read their
neighbours from the array by position. These hits, with five neighbours each, make the only shuffle: by
text, where repeated tokens take the neighbours of their first place and scores are summed. No text
crosses the network, and the cost of a text is linear in its length but for sorting its hits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinions.functions.text import clean_social, is_upper, lower_tokens, mixed_case, scorer_tokens
from opinions.functions.values import polarity_of
from opinions.operators.joins import fits_broadcast, lookup_join
from opinions.rules import RuleSet

NEIGHBOURS = ("b1", "b2", "b3", "a1", "a2")
SCORES = ("neg", "neu", "pos", "compound")
# Sums closer to zero than this many digits are zero: their sign would depend on summation order.
SUM_DIGITS = 9


class RuleTables(NamedTuple):
    """The scorer's word lists as tables of any size, in place of the lists of a ``RuleSet``.

    ``words`` is unique on token: token, delta (of a booster, else null), negates. ``phrases`` is unique on phrase: phrase,
    valence (of an idiom, else null), damps (a booster of two words). A table is broadcast if it is measured to be small.
    """

    words: DataFrame
    phrases: DataFrame


def rule_tables(spark: SparkSession, rules: RuleSet) -> RuleTables:
    """The lists of ``rules`` as tables."""
    single = {w for w in rules.boosters if " " not in w} | set(rules.negators)
    words = [(w, rules.boosters.get(w), w in rules.negators) for w in sorted(single)]
    pairs = [w for w in rules.boosters if " " in w]
    phrases = [(p, rules.idioms.get(p), p in pairs) for p in sorted({*rules.idioms, *pairs})]
    return RuleTables(
        spark.createDataFrame(words, "token string, delta double, negates boolean"),
        spark.createDataFrame(phrases, "phrase string, valence double, damps boolean"),
    )


def _quoted(word: str) -> str:
    return "'" + word.replace("\\", "\\\\").replace("'", "\\'") + "'"


def word_list(words: Iterable[str]) -> Column:
    return F.expr(f"cast(array({', '.join(_quoted(w) for w in words)}) AS array<string>)")


def word_table(table: dict[str, float]) -> Column:
    pairs = ", ".join(f"{_quoted(w)}, {float(v)!r}D" for w, v in table.items())
    return F.expr(f"cast(map({pairs}) AS map<string, double>)")


def emphasis(cleaned: Column, rules: RuleSet) -> Column:
    # Pieces are counted, as Spark cuts at a single character without a regex.
    exclaims = F.least(F.size(F.split(cleaned, "!")) - 1, F.lit(rules.exclaim_cap))
    asks = F.size(F.split(cleaned, r"\?")) - 1
    return exclaims * rules.exclaim_step + (
        F.when(asks <= 1, 0.0).when(asks <= 3, asks * rules.question_step).otherwise(rules.question_cap)
    )


def tokenized(
    docs: DataFrame, rules: RuleSet, keys: Sequence[str], text: str, more: Mapping[str, Callable[[Column], Column]] | None = None
) -> DataFrame:
    """keys, toks, lows (toks in lower case; [""] for none), n, mixed (some but not all tokens in capitals), turn (contrast
    word), emph; ``more`` columns are made of the same cleaned text."""
    toks = F.col("toks")
    return (
        docs.select(*keys, clean_social(F.coalesce(F.col(text), F.lit(""))).alias("cleaned"))
        .withColumn("toks", scorer_tokens(F.col("cleaned")))
        .withColumn("lows", lower_tokens(toks))
        .select(
            *keys,
            *[f(F.col("cleaned")).alias(name) for name, f in (more or {}).items()],
            "toks",
            "lows",
            F.size(toks).alias("n"),
            mixed_case(F.col("cleaned")).alias("mixed"),
            F.array_position("lows", rules.contrast_word).cast("int").alias("turn"),
            emphasis(F.col("cleaned"), rules).alias("emph"),
        )
    )


def neighbours(rows: DataFrame) -> DataFrame:
    """Neighbours of each token's own place; positions start at 1."""
    shift = {"b1": -2, "b2": -3, "b3": -4, "a1": 0, "a2": 1}
    near = [F.get("toks", F.col("pos") + by).alias(name) for name, by in shift.items()]
    return rows.select("*", *near).drop("toks")


def _of_first_place(hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Give every hit the neighbours of the first place where the same token occurs in its text.

    One pass over a text's hits in the order of token and place; the sums per text that follow need no
    further shuffle.
    """
    order = Window.partitionBy(*keys).orderBy("tok", "pos")
    here = F.struct(F.col("pos").cast("int").alias("first"), *NEIGHBOURS)
    head = F.when(~F.col("tok").eqNullSafe(F.lag("tok").over(order)) | F.lag("pos").over(order).isNull(), here)
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = hits.withColumn("_head", head).withColumn("_head", F.last("_head", ignorenulls=True).over(running))
    return placed.drop(*NEIGHBOURS).select("*", "_head.*").drop("_head")


def token_context(
    docs: DataFrame, rules: RuleSet, keys: Sequence[str] = ("mention_id",), text: str = "text"
) -> DataFrame:
    """Every token with up to three tokens before and two after it."""
    rows = tokenized(docs, rules, keys, text).select(
        *keys, "toks", F.posexplode(F.concat(F.array().cast("array<string>"), "toks")).alias("at", "tok")
    )
    shift = {"b1": -1, "b2": -2, "b3": -3, "a1": 1, "a2": 2}
    near = [F.get("toks", F.col("at") + by).alias(name) for name, by in shift.items()]
    return rows.select(*keys, (F.col("at") + 1).alias("pos"), "tok", *near)


def phrase_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """two, three, n: the phrases of two and of three tokens (null at a text's second token) that end at a token.

    Counted by one string, the longest of the two: tokens hold no blanks, so the other is its end. Only tokens are made, not
    the columns of a text, and counts are combined in the task that reads the text.
    """
    cleaned = clean_social(F.coalesce(F.col(text), F.lit("")))
    toks = docs.select(scorer_tokens(cleaned).alias("toks"))
    # As in scored_mentions: the array is made first, and the explosion is generated code.
    rows = toks.select("toks", F.posexplode(F.concat("toks", F.array().cast("array<string>"))).alias("at", "tok")).filter("at > 0")
    two = F.concat(F.get("toks", F.col("at") - 1), F.lit(" "), F.col("tok"))
    said = F.when(F.col("at") > 1, F.concat(F.get("toks", F.col("at") - 2), F.lit(" "), two)).otherwise(two)
    counts = rows.select(said.alias("said"), (F.col("at") > 1).alias("long")).groupBy("said", "long").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        F.substring_index("said", " ", -2).alias("two"), F.when(F.col("long"), F.col("said")).alias("three"), "n"
    )


def least_bigrams(context: DataFrame, rules: RuleSet) -> DataFrame:
    """Places where "least" follows another word than "at": the pair form of the negation test, which
    the scorer itself never meets, as it tests one word at a time."""
    pair = (F.lower("tok") == rules.least_word) & (F.lower("b1") != rules.least_exempt[0])
    return context.filter(pair)


def scored_tokens(
    docs: DataFrame,
    lexicon: DataFrame,
    rules: RuleSet,
    keys: Sequence[str],
    text: str = "text",
    keep_texts: bool = False,
    tables: RuleTables | None = None,
) -> DataFrame:
    """One row per token that the lexicon knows, with every intermediate value of its score.

    ``lexicon`` must be unique on ``token``. Positions start at 1. With ``keep_texts`` each text adds
    a row with ``pos`` 0 and no token, so that texts without any scored token stay present.
    """
    doc_cols = [*keys, "n", "mixed", "turn", "emph"]
    lex = lexicon.select("token", "valence")
    small = fits_broadcast(lex)

    cells = F.concat(F.array(F.lit(None).cast("string")), F.col("toks"))
    rows = tokenized(docs, rules, keys, text).select(
        *doc_cols, "toks", F.posexplode(cells).alias("pos", "tok")
    )
    if not keep_texts:
        rows = rows.filter("pos > 0")
    rows = rows.select("*", F.lower("tok").alias("low"))

    def known(df: DataFrame) -> DataFrame:
        out = lookup_join(df, lex, {"low": "token"}, small=small)
        return out.filter(F.col("valence").isNotNull() | (F.col("pos") == 0))

    # A lexicon too large to broadcast shuffles the tokens, so the array must be gone before.
    return ruled(neighbours(known(rows)) if small else known(neighbours(rows)), lex, rules, keys, small, tables)


def ruled(
    hits: DataFrame, lex: DataFrame, rules: RuleSet, keys: Sequence[str], small: bool, tables: RuleTables | None = None
) -> DataFrame:
    """Every intermediate score of hits, which have tok, pos, valence, the neighbours and columns of their text."""
    hits = _of_first_place(hits, keys)
    hits = hits.select("*", *[F.lower(b).alias(f"low_{b}") for b in ("b1", "b2", "b3")])
    for b in ("b1", "b2", "b3"):
        # The same table under the same names each time: one broadcast serves all joins.
        hits = hits.withColumnRenamed("valence", "_kept")
        hits = lookup_join(hits, lex, {f"low_{b}": "token"}, small=small)
        hits = hits.withColumnsRenamed({"valence": f"val_{b}", "_kept": "valence"})
    return _apply_rules(hits, rules, tables)


#: The words around a hit that may be a phrase; the first phrase that the table holds counts.
PHRASES = (("tok", "a1", "a2"), ("tok", "a1"), ("b1", "tok"), ("b2", "b1", "tok"), ("b2", "b1"), ("b3", "b2", "b1"), ("b3", "b2"))


def _phrase(*names: str) -> Column:
    return F.concat(*[c for n in names for c in (F.lit(" "), F.col(n))][1:])


class _Lists(NamedTuple):
    """What the word lists say about a hit: per neighbour the delta of a booster (else null) and whether it negates,
    whether the hit is a booster itself, and of the phrases around it the idiom's valence and whether one damps."""

    delta: dict[str, Column]
    negates: dict[str, Column]
    booster: Column
    idiom: Column
    damps: Column


def _literal_lists(rules: RuleSet) -> _Lists:
    boosters, booster_words = word_table(rules.boosters), word_list(rules.boosters)
    idioms, idiom_phrases = word_table(rules.idioms), word_list(rules.idioms)
    negators, pairs = word_list(rules.negators), word_list(k for k in rules.boosters if " " in k)
    # The filter also ends the generated method here: the stages around it stay short enough to be compiled.
    matching = F.filter(F.array(*[_phrase(*p) for p in PHRASES]), lambda p: F.array_contains(idiom_phrases, p))
    near = ("b1", "b2", "b3")
    return _Lists(
        {b: F.try_element_at(boosters, F.col(f"low_{b}")) for b in near},
        {b: F.array_contains(negators, F.col(f"low_{b}")) for b in near},
        F.array_contains(booster_words, F.lower("tok")),
        F.try_element_at(idioms, F.get(matching, F.lit(0))),
        F.array_contains(pairs, _phrase("b3", "b2")) | F.array_contains(pairs, _phrase("b2", "b1")),
    )


def _joined_lists(hits: DataFrame, tables: RuleTables) -> tuple[DataFrame, _Lists]:
    """Hits with what the tables say: words are looked up by themselves, phrases by the words around the hit."""
    words = tables.words.select("token", "delta", "negates")
    phrases = tables.phrases.select("phrase", F.col("valence").alias("worth"), "damps")
    few_words, few_phrases = fits_broadcast(words), fits_broadcast(phrases)
    hits = hits.withColumn("low_tok", F.lower("tok"))
    near = ("b1", "b2", "b3")
    for b in (*near, "tok"):
        # The same table under the same names each time: one broadcast serves all joins.
        hits = lookup_join(hits, words, {f"low_{b}": "token"}, small=few_words)
        hits = hits.withColumnsRenamed({"delta": f"delta_{b}", "negates": f"negates_{b}"})
    for i, names in enumerate(PHRASES):
        hits = lookup_join(hits.withColumn("_phrase", _phrase(*names)), phrases, {"_phrase": "phrase"}, small=few_phrases)
        hits = hits.drop("_phrase").withColumnsRenamed({"worth": f"worth_{i}", "damps": f"damps_{i}"})
    two = [F.coalesce(f"damps_{PHRASES.index(p)}", F.lit(False)) for p in (("b3", "b2"), ("b2", "b1"))]
    return hits, _Lists(
        {b: F.col(f"delta_{b}") for b in near},
        {b: F.coalesce(f"negates_{b}", F.lit(False)) for b in near},
        F.col("delta_tok").isNotNull(),
        F.coalesce(*[F.col(f"worth_{i}") for i in range(len(PHRASES))]),
        two[0] | two[1],
    )


def _apply_rules(hits: DataFrame, rules: RuleSet, tables: RuleTables | None = None) -> DataFrame:
    """Scores of the hits. Everything that depends on words is settled first, as flags and factors
    per neighbour; the running value then passes through arithmetic only, which keeps the generated
    code small enough for the JVM to compile."""
    col = F.col
    never_2, never_3 = rules.never_factors
    hits, lists = (hits, _literal_lists(rules)) if tables is None else _joined_lists(hits, tables)
    never_links = word_list(rules.never_links)
    links = {b: F.coalesce(F.array_contains(never_links, col(b)), F.lit(False)) for b in ("b1", "b2")}

    def negated(b: str) -> Column:
        return F.when(
            lists.negates[b] | col(f"low_{b}").contains(rules.contraction), rules.negation_factor
        ).otherwise(1.0)

    flips = {
        "b1": negated("b1"),
        "b2": F.when((col("b2") == rules.never_word) & links["b1"], never_2).otherwise(negated("b2")),
        "b3": F.when(
            links["b1"] | ((col("b3") == rules.never_word) & links["b2"]), never_3
        ).otherwise(negated("b3")),
    }
    words: dict[str, Column] = {"shout": col("mixed") & is_upper(col("tok"))}
    for factor, b in zip(rules.distance_factors, ("b1", "b2", "b3")):
        free = col(b).isNotNull() & col(f"val_{b}").isNull()
        words[f"lift_{b}"] = F.coalesce(F.when(free, lists.delta[b] * factor), F.lit(0.0))
        loud = free & col("mixed") & lists.delta[b].isNotNull() & is_upper(col(b))
        words[f"loud_{b}"] = F.when(loud, rules.caps_step * factor).otherwise(0.0)
        words[f"flip_{b}"] = F.when(free, flips[b]).otherwise(1.0)

    far = col("b3").isNotNull() & col("val_b3").isNull()
    words["idiom"] = F.when(far, lists.idiom)
    words["damp"] = F.when(far & lists.damps, rules.bigram_step).otherwise(0.0)

    exempt = F.coalesce(
        F.array_contains(word_list(rules.least_exempt), col("low_b2")), F.lit(False)
    )
    least = (col("low_b1") == rules.least_word) & col("val_b1").isNull() & ~exempt
    words["flip_least"] = F.when(least, rules.negation_factor).otherwise(1.0)

    low = F.lower("tok")
    softened = (low == rules.softener[0]) & (F.lower("a1") == rules.softener[1])
    silent = lists.booster | F.coalesce(softened, F.lit(False))
    turn, pos = col("turn"), col("pos")
    before, after = rules.contrast_factors
    words["flip_turn"] = (
        F.when((turn > 0) & (pos < turn), before).when((turn > 0) & (pos > turn), after).otherwise(1.0)
    )
    words["silent"] = silent
    def side(run: Column) -> Column:
        """1 above zero, else -1."""
        return F.when(run > 0, 1.0).otherwise(-1.0)

    def push(b: str, run: Column) -> Column:
        return col(f"lift_{b}") * F.when(run < 0, -1.0).otherwise(1.0) + col(f"loud_{b}") * side(run)

    # Each value may name the ones before it.
    value = col("valence")
    values = {
        "v_caps": value + F.when(col("shout"), rules.caps_step).otherwise(0.0) * side(value),
        "boost1": push("b1", col("v_caps")),
        "v1": (col("v_caps") + col("boost1")) * col("flip_b1"),
        "boost2": push("b2", col("v1")),
        "v2": (col("v1") + col("boost2")) * col("flip_b2"),
        "boost3": push("b3", col("v2")),
        "v3": (col("v2") + col("boost3")) * col("flip_b3"),
        "v_idiom": F.coalesce("idiom", "v3") + col("damp"),
        "v_least": col("v_idiom") * col("flip_least"),
        "score": F.when(col("silent"), 0.0).otherwise(col("v_least")),
        "weighted": col("score") * col("flip_turn"),
    }
    out = hits.select("*", *[c.alias(n) for n, c in words.items()])
    return out.select("*", *[c.alias(n) for n, c in values.items()])


def sentiment_scores(
    docs: DataFrame,
    lexicon: DataFrame,
    rules: RuleSet | None = None,
    keys: Sequence[str] = ("mention_id",),
    text: str = "text",
    tables: RuleTables | None = None,
) -> DataFrame:
    """keys, neg, neu, pos, compound, polarity.

    ``keys`` must identify a text; name further narrow columns to carry them along without a join. ``tables`` replace
    the word lists of ``rules``.
    """
    rules = rules or RuleSet()
    hits = scored_tokens(docs, lexicon, rules, keys, text, keep_texts=True, tables=tables)
    return finish_scores(hits, rules, keys)


def finish_scores(hits: DataFrame, rules: RuleSet, keys: Iterable[str], more: Sequence[Column] = ()) -> DataFrame:
    """keys, neg, neu, pos, compound, polarity from the hits of texts; ``more`` are further sums per text."""
    w = F.col("weighted")
    kept = sorted(set(hits.agg(*more).columns)) if more else []
    sums = hits.groupBy(*keys).agg(
        *more,
        F.max("n").alias("n"),
        F.max("emph").alias("emph"),
        F.coalesce(F.sum(w), F.lit(0.0)).alias("total"),
        F.coalesce(F.sum(F.when(w > 0, w + 1)), F.lit(0.0)).alias("up"),
        F.coalesce(F.sum(F.when(w < 0, 1 - w)), F.lit(0.0)).alias("down"),
        F.count_if(w != 0).alias("loud"),
    )
    total, up, down = (F.round(c, SUM_DIGITS) for c in ("total", "up", "down"))
    emph = F.col("emph")
    sums = sums.withColumns(
        {
            "total": F.when(total == 0, 0.0).otherwise(F.col("total") + F.signum(total) * emph),
            "up_all": F.col("up") + F.when(up > down, emph).otherwise(0.0),
            "down_all": F.col("down") + F.when(down > up, emph).otherwise(0.0),
            "flat": (F.col("n") - F.col("loud")).cast("double"),
        }
    ).withColumn("mass", F.col("up_all") + F.col("down_all") + F.col("flat"))

    def part(name: str) -> Column:
        return F.coalesce(F.round(F.try_divide(F.col(name), F.col("mass")), 3), F.lit(0.0))

    s = F.col("total")
    compound = F.round(s / F.sqrt(s * s + rules.squash), 4) + 0.0  # no negative zero
    return sums.select(
        *keys,
        F.when(F.col("n") > 0, part("down_all")).otherwise(0.0).alias("neg"),
        F.when(F.col("n") > 0, part("flat")).otherwise(0.0).alias("neu"),
        F.when(F.col("n") > 0, part("up_all")).otherwise(0.0).alias("pos"),
        F.when(F.col("n") > 0, compound).otherwise(0.0).alias("compound"),
        *kept,
    ).withColumn("polarity", polarity_of(F.col("compound")))
