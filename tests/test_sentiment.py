import time
import random
from collections import Counter

import pytest
from helpers import values
from plain_scorer import Plain, tokens
from pyspark.sql import functions as F

from opinions.functions.text import clean_social, scorer_tokens, strip_edge
from opinions.operators import sentiment as sen
from opinions.operators.durable import durable
from opinions.rules import RuleSet

LEXICON = {"good": 2.0, "bad": -2.0, "great": 3.0, "happy": 2.5}


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(list(LEXICON.items()), "token string, valence double")


def texts(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "mention_id long, text string")


def token_scores(spark, lexicon, text, column="weighted", rules=None):
    hits = sen.scored_tokens(texts(spark, [text]), lexicon, rules or RuleSet(), ["mention_id"])
    return [round(r[column], 6) for r in hits.orderBy("pos").collect()]


# Expected values by hand: valence, then boost, flip, idiom, least, contrast in that order.
CASES = [
    ("food was good", [2.0]),
    ("food was GOOD", [2.733]),  # 2 + 0.733
    ("FOOD WAS GOOD", [2.0]),  # all in capitals: no emphasis
    ("food very good", [2.293]),
    ("food very bad", [-2.293]),
    ("food VERY good", [3.026]),  # 2 + 0.293 + 0.733
    ("very nice good", [2.27835]),  # 0.293 * 0.95
    ("very nice red good", [2.2637]),  # 0.293 * 0.9
    ("food hardly good", [1.707]),
    ("food not good", [-1.48]),
    ("food don't good", [-1.48]),  # contraction
    ("not nice good", [-1.48]),
    ("not nice red good", [-1.48]),
    ("never so good", [3.4395]),  # (2 + 0.293) * 1.5
    ("food red so good", [2.86625]),  # third step: b1 'so' amplifies, (2 + 0.293) * 1.25
    ("bad good", [-2.0, 2.0]),  # neighbour in the lexicon: no effect
    ("at least good", [2.0]),
    ("the least good", [-1.48]),
    ("least good", [-1.48]),
    ("good but bad", [1.0, -3.0]),
    ("good food not good", [2.0, 2.0]),  # repeats take the first context
    ("this is kind of good", [1.707]),  # third step: 'kind of' damps, 2 - 0.293
    ("we all had bad ass day", [1.5]),  # idiom ahead of the word
    ("oh my yeah right good", [-2.0]),  # idiom behind the word
]


def test_rules(spark, lexicon):
    hits = sen.scored_tokens(texts(spark, [t for t, _ in CASES]), lexicon, RuleSet(), ["mention_id"])
    got = {i: [] for i in range(len(CASES))}
    for r in hits.orderBy("mention_id", "pos").collect():
        got[r["mention_id"]].append(round(r["weighted"], 6))
    assert [(t, got[i]) for i, (t, _) in enumerate(CASES)] == CASES


def test_scored_booster_counts_zero(spark):
    lex = spark.createDataFrame([("so", 2.0), ("kind", 2.4)], "token string, valence double")
    assert token_scores(spark, lex, "oh so kind of") == [0.0, 0.0]
    assert token_scores(spark, lex, "we are kind") == [2.4]


def test_emphasis(spark):
    rows = ["good!!!!!", "good?", "good??", "good???", "good????", "good!? yes?"]
    out = texts(spark, rows).select("mention_id", F.round(sen.emphasis(F.col("text"), RuleSet()), 6).alias("e"))
    got = [r["e"] for r in out.orderBy("mention_id").collect()]
    assert got == [1.168, 0.0, 0.36, 0.54, 0.96, 0.652]


def test_empty_and_unscored_texts(spark, lexicon):
    out = sen.sentiment_scores(texts(spark, ["a", "", None, "no match here"]), lexicon)
    rows = values(out, "mention_id", "neg", "neu", "pos", "compound", "polarity")
    assert rows == [
        (0, 0.0, 0.0, 0.0, 0.0, 0),
        (1, 0.0, 0.0, 0.0, 0.0, 0),
        (2, 0.0, 0.0, 0.0, 0.0, 0),
        (3, 0.0, 1.0, 0.0, 0.0, 0),
    ]


def test_edge_strip(spark):
    cases = {'"good': "good", "good!": "good", "good!!!!": "good!!!!", '"good"': '"good"', "?!?good": "good",
             "go-od.": "go-od.", "x!": "x!", "naïve,": "naïve", "...": "..."}
    df = spark.createDataFrame(list(cases.items()), "tok string, want string")
    assert [r["tok"] for r in df.filter(strip_edge(F.col("tok")) != F.col("want")).collect()] == []


ALPHABET = (
    "good bad great happy GOOD Bad very VERY hardly not never so this but BUT least at kind of sort "
    "just enough don't isn't bad ass yeah right the bomb hand to mouth cut mustard food Food day so, good! "
    '"great happy? !!bad good!!!! @you RT x'
).split()


def random_texts(n, seed):
    rng = random.Random(seed)
    return [" ".join(rng.choices(ALPHABET, k=rng.randint(0, 14))) + rng.choice(["", "!", "??", " ?!?"]) for _ in range(n)]


def test_against_plain_scorer(spark, lexicon):
    rows = random_texts(3000, 7)
    plain = Plain(LEXICON, RuleSet())
    got = {
        r["mention_id"]: (r["neg"], r["neu"], r["pos"], r["compound"])
        for r in sen.sentiment_scores(texts(spark, rows), lexicon).collect()
    }
    assert len(got) == len(rows)
    for i, text in enumerate(rows):
        want = plain.scores(text)
        assert all(abs(a - b) <= 0.0011 for a, b in zip(got[i][:3], want[:3])), text
        assert abs(got[i][3] - want[3]) <= 0.00011, text


def test_tokens_against_plain(spark):
    rows = random_texts(500, 3) + ["RT @né_1: hi there", "see http://a.b/c?d=e-f x1", "two\nlines", "lone @ sign"]
    df = texts(spark, rows).select("mention_id", scorer_tokens(clean_social(F.col("text"))).alias("toks"))
    got = {r["mention_id"]: r["toks"] for r in df.collect()}
    assert all(got[i] == tokens(t) for i, t in enumerate(rows))


def test_large_lexicon_path_gives_the_same(spark, lexicon, monkeypatch):
    docs = texts(spark, random_texts(400, 5))
    small = values(sen.sentiment_scores(docs, lexicon))
    monkeypatch.setattr(sen, "fits_broadcast", lambda dim: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert values(sen.sentiment_scores(docs, lexicon)) == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partitioning_does_not_matter(spark, lexicon):
    docs = texts(spark, random_texts(300, 11))
    assert values(sen.sentiment_scores(docs.repartition(7), lexicon)) == values(
        sen.sentiment_scores(docs.coalesce(1), lexicon)
    )


def test_score_properties(spark, lexicon):
    out = sen.sentiment_scores(texts(spark, random_texts(500, 13)), lexicon)
    parts = F.col("neg") + F.col("neu") + F.col("pos")
    assert out.filter((parts != 0) & (F.abs(parts - 1) > 0.002)).count() == 0
    assert out.filter(F.abs("compound") >= 1).count() == 0


def test_long_texts_cost_in_proportion(spark, lexicon, monkeypatch):
    """A late lexicon word that fills half of a text: twice the text, about twice the time at most."""

    def seconds(n):
        text = " ".join([f"w{i}" for i in range(n // 2)] + ["good"] * (n // 2))
        docs = texts(spark, [text])
        started = time.perf_counter()
        assert len(sen.sentiment_scores(docs, lexicon).collect()) == 1
        return time.perf_counter() - started

    for small in (True, False):
        monkeypatch.setattr(sen, "fits_broadcast", lambda dim, small=small: small)
        seconds(1000)
        shorter = min(seconds(20_000) for _ in range(2))
        assert min(seconds(40_000) for _ in range(2)) <= 2 * shorter + 0.5


def test_one_narrow_shuffle_and_no_python(spark, lexicon, sf):
    from catalog import tables as t

    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("doc_id", "mention_id")
    plan = sen.sentiment_scores(docs, t.lexicon(spark, sf), t.RULES)._jdf.queryExecution().executedPlan().toString()
    main = [line for line in plan.splitlines() if "Exchange hashpartitioning(mention_id" in line]
    assert len(main) == 1
    assert "toks" not in main[0] and "text" not in main[0]
    assert "Python" not in plan and "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") == 4


def test_rule_tables_equal_the_lists(spark, lexicon, monkeypatch):
    rules = RuleSet()
    docs = texts(spark, random_texts(300, 8))
    tables = sen.rule_tables(spark, rules)
    columns = ["mention_id", "pos", "lift_b1", "loud_b2", "flip_b3", "idiom", "damp", "silent", "weighted"]

    def scores(tables=None):
        return values(sen.scored_tokens(docs, lexicon, rules, ["mention_id"], tables=tables), *columns)

    want = scores()
    assert scores(tables) == want
    monkeypatch.setattr(sen, "fits_broadcast", lambda dim: False)
    assert scores(tables) == want


def test_first_of_several_phrases_counts(spark, lexicon):
    rules = RuleSet()
    tables = sen.rule_tables(spark, rules)
    phrases = [("good cheap food", 1.0, False), ("good cheap", 3.0, False), ("so very", None, True), ("big so", -2.0, False)]
    tables = tables._replace(phrases=spark.createDataFrame(phrases, "phrase string, valence double, damps boolean"))
    docs = texts(spark, ["one big so very good cheap food", "one big so red good cheap", "big so red good"])
    rows = sen.scored_tokens(docs, lexicon, rules, ["mention_id"], tables=tables).collect()
    assert sorted((r["mention_id"], r["idiom"], r["damp"]) for r in rows) == [(0, 1.0, -0.293), (1, 3.0, 0.0), (2, -2.0, 0.0)]


def test_many_phrases_score_like_few(spark, lexicon):
    """100,000 phrases are joined, not searched: about the time of ten."""
    docs = texts(spark, random_texts(4000, 5))
    rules = RuleSet()
    few = sen.rule_tables(spark, rules)
    more = spark.range(100_000).selectExpr("concat('word', id, ' other') AS phrase", "1.0D AS valence", "false AS damps")
    many = few._replace(phrases=durable(few.phrases.unionByName(more)))
    seconds, rows = {}, {}
    for name, tables in (("few", few), ("many", many), ("few", few), ("many", many)):  # the second round counts
        started = time.perf_counter()
        rows[name] = values(sen.sentiment_scores(docs, lexicon, rules, tables=tables))
        seconds[name] = time.perf_counter() - started
    assert rows["few"] == rows["many"]
    assert seconds["many"] < 2 * seconds["few"] + 2


def test_phrase_counts(spark):
    """One string a phrase is grouped, and the phrases are those of the tokens' neighbours."""
    docs = texts(spark, ["a", "aa bb", "aa bb cc aa bb", "", "éé, 日本 bb  aa bb cc", None, "aa bb cc"])
    got = sen.phrase_counts(docs)
    near = [(r["b2"], r["b1"], r["tok"]) for r in sen.token_context(docs, RuleSet()).collect() if r["b1"] is not None]
    want = Counter((f"{b} {c}", None if a is None else f"{a} {b} {c}") for a, b, c in near)
    assert values(got, "two", "three", "n") == sorted(((*k, n) for k, n in want.items()), key=repr) and max(want.values()) == 3
    moved = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hash" in line]
    assert len(moved) == 1 and "said" in moved[0] and "two" not in moved[0] and "three" not in moved[0]
