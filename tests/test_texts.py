import itertools
import random
import re
import string
import unittest.mock

import pytest
from helpers import values
from pyspark.sql import functions as F

from catalog import texts as catalog
from opinions.functions import porter
from opinions.functions import text as x
from opinions.functions.porter import stem
from opinions.operators import bow, langid
from opinions.sources import io

SAMPLES = [
    "RT @name: hi", "@é1 x", "http://a.b/c?d=e-f x", "two\nlines", "snake_case", "don't stop", "covid19 9lives",
    "Straße ß GROSS", "⠀ braille ⠀", "double  blanks", "lone @ sign", "httpX://odd y", "tab\there nbsp end",
    "no not the NOT n't a", "", "RT @a: RT @b: both", "email a@b.c", "https://x.y/z", "q: http://x.y", "٣ digits ٤",
]


def social(t):
    for pattern in (r"RT @\w*:", r"@\w*", r"https?://[A-Za-z0-9./]*", "\n"):
        t = re.sub(pattern, "", t)
    return t


def words(t):
    t = re.sub(r"http.?://[^\s]+[\s]?", "", re.sub(r"@\w+", "", t)).replace("_", "")
    t = "".join(" " if ch in string.punctuation else ch for ch in t)
    return re.sub(r"\d+", "", t).lower().split()


def test_cleaning_matches_python(spark):
    rng = random.Random(1)
    pieces = SAMPLES + ["@", "_", "http://", "9", "'", "RT @", ":", "\n", " "]
    rows = SAMPLES + ["".join(rng.choices(pieces, k=rng.randint(1, 5))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(rows)), "i long, t string").select(
        "i", x.clean_social(F.col("t")).alias("s"), x.clean_bow(F.col("t")).alias("b"),
        x.remove_punct(F.col("t")).alias("p"), x.bare_token_set(F.col("t")).alias("set"),
    )
    for r in df.collect():
        t = rows[r["i"]]
        assert r["s"] == social(t), t
        assert r["b"] == " ".join(words(t)), t
        bare = "".join(ch for ch in t if ch not in string.punctuation)
        assert r["p"] == bare
        assert sorted(r["set"]) == sorted({w for w in bare.replace("\n", " ").split(" ") if len(w) > 1})


def test_null_text(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(x.clean_social(F.col("t")), x.clean_bow(F.col("t"))).first() == (None, None)


def test_upper_matches_python(spark):
    cases = ["A", "AB1", "Ab", "ab", "1", "ß", "STRASSE", "É", "É.", "ǅ", "", "A'B"]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = [r[0] for r in df.select(x.is_upper(F.col("t"))).collect()]
    assert got == [c.isupper() for c in cases]


def test_stopwords(spark):
    df = spark.createDataFrame([("The cat is not on a mat no more, don't",)], "text string")
    got = df.select(x.drop_stopwords(x.bow_words(F.col("text")), bow.english_stopwords())).first()[0]
    assert got == ["cat", "not", "mat", "no"]


# Word pairs published with the algorithm.
PORTER = (
    "caresses caress ponies poni ties tie cats cat feed feed agreed agre plastered plaster bled bled motoring motor "
    "sing sing conflated conflat troubled troubl sized size hopping hop tanned tan falling fall hissing hiss fizzed "
    "fizz failing fail filing file happy happi sky sky relational relat conditional condit rational ration valenci "
    "valenc digitizer digit radicalli radic differentli differ vileli vile analogousli analog vietnamization vietnam "
    "operator oper feudalism feudal decisiveness decis hopefulness hope callousness callous formaliti formal "
    "sensitiviti sensit sensibiliti sensibl triplicate triplic formative form formalize formal electrical electr "
    "hopeful hope goodness good revival reviv allowance allow inference infer airliner airlin adjustable adjust "
    "defensible defens irritant irrit replacement replac adjustment adjust dependent depend adoption adopt communism "
    "commun activate activ homologous homolog effective effect probate probat rate rate cease ceas controll control "
    "roll roll dies die died die dying die enjoy enjoy say say geologi geolog by by yes ye"
).split()


def test_porter_examples(spark):
    pairs = list(zip(PORTER[::2], PORTER[1::2]))
    df = spark.createDataFrame(pairs, "word string, want string").select("word", "want", stem(F.col("word")).alias("got"))
    assert [tuple(r) for r in df.collect() if r["got"] != r["want"]] == []


def kinds(word):
    """c or v per letter, by the definition of the algorithm."""
    out = ""
    for i, ch in enumerate(word):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and out[-1] == "c")
        out += "v" if vowel else "c"
    return out


def test_measure_patterns_match_the_definition(spark):
    from opinions.functions import porter as p

    made = ["".join(w) for n in range(1, 6) for w in itertools.product("aybtw", repeat=n)]
    df = spark.createDataFrame([(w, "Y" + w[1:] if w[0] == "y" else w) for w in made], "w string, m string")
    m = F.col("m")
    rows = df.select(
        "w", *[m.rlike(getattr(p, n)).alias(n) for n in
               ("MEASURE_1", "MEASURE_2", "MEASURE_IS_1", "HAS_VOWEL", "ENDS_CONSONANT", "SHORT_END")]
    ).collect()
    for r in rows:
        w, k = r["w"], kinds(r["w"])
        measure = len(re.findall("v+c+", k))
        short = (k.endswith("cvc") and w[-1] not in "wxy") or k == "vc"
        want = (measure > 0, measure > 1, measure == 1, "v" in k, k[-1] == "c", short)
        assert tuple(r)[1:] == want, w


def test_bag_counts_and_topk(spark):
    rows = [(1, "Cats cat running, runs!"), (2, "cat the the"), (3, "a I"), (4, None)]
    df = spark.createDataFrame(rows, "mention_id long, text string")
    assert values(bow.bag_of_words(df), "mention_id", "term", "n") == [(1, "cat", 2), (1, "run", 2), (2, "cat", 1)]
    freq = bow.term_frequency(bow.words_of(df, ["mention_id"]))
    assert values(freq, "term", "freq") == [("cat", 3), ("run", 2)]
    assert values(bow.array_frequency(bow.with_terms(df)), "term", "freq") == [("cat", 3), ("run", 2)]
    assert values(bow.term_topk(freq, 1), "term") == [("cat",)]


def test_texts_are_cleaned_once(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = bow.array_frequency(bow.with_terms(docs))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("http[^") == 1


def test_language(spark):
    train = spark.createDataFrame(
        [("en", "the cat and the dog"), ("en", "this is the house"), ("de", "der hund und die katze"), ("de", "das ist das haus")],
        "lang string, text string",
    )
    words = langid.word_counts(train)
    profiles = langid.langid_profiles(words)
    docs = spark.createDataFrame([(1, "the mouse"), (2, "die maus und"), (3, "123 !!"), (4, None)], "mention_id long, text string")
    pred = langid.langid_predict(docs, profiles, ["en", "de"])
    assert values(pred, "mention_id", "pred") == [(1, "en"), (2, "de"), (3, None), (4, None)]
    assert values(langid.keep_language(pred, "en"), "mention_id") == [(1,)]
    # The table of frequent words changes nothing, whatever it holds.
    some = words.filter("word < 'h'")
    for known in (words, some):
        assert values(langid.langid_predict(docs, profiles, ["en", "de"], words=known)) == values(pred)


def test_language_brute_force(spark):
    import math
    from collections import Counter

    texts = [("x", "abab ba"), ("y", "bcbc cb a"), ("x", "aab")]
    counts = {"x": Counter(), "y": Counter()}
    for lang, t in texts:
        for w in t.split():
            counts[lang].update(w[i : i + n] for n in (1, 2, 3) for i in range(len(w) - n + 1))
    vocab = set().union(*counts.values())
    df = spark.createDataFrame(texts, "lang string, text string")
    got = {(r["lang"], r["gram"]): r["logp"] for r in langid.langid_profiles(langid.word_counts(df)).collect()}
    for lang, c in counts.items():
        for g, n in c.items():
            assert math.isclose(got[lang, g], math.log((n + 1) / (sum(c.values()) + len(vocab))))


def test_profiles_hold_every_gram(spark):
    word = "".join(chr(ord("a") + i % 26) + chr(0x3B1 + i // 26) for i in range(600))
    df = spark.createDataFrame([("x", word), ("y", "aaa")], "lang string, text string")
    words = langid.word_counts(df)
    profiles = langid.langid_profiles(words)
    kinds = {word[i : i + n] for n in (1, 2, 3) for i in range(len(word) - n + 1)}
    assert profiles.filter("lang = 'x'").count() == len(kinds) > 500
    frequent = langid.word_scores(words, langid.wide_profiles(profiles, ["x", "y"]), ["x", "y"], most=1)
    assert frequent.count() == 0  # no word makes up all of the text


def test_language_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("doc_id", "mention_id")
    train, test = docs.filter("mention_id % 5 <> 0"), docs.filter("mention_id % 5 = 0")
    pred = langid.langid_predict(test, langid.langid_profiles(langid.word_counts(train)), ["de", "en", "es", "fr"])
    joined = pred.join(test.select("mention_id", "lang"), "mention_id")
    assert joined.agg(F.avg((F.col("pred") == F.col("lang")).cast("double"))).first()[0] > 0.95


def test_words_without_a_suffix_are_their_stems(spark):
    """The short way of ``stem`` says nothing else than the whole algorithm, which a stem table of one row leaves to it."""
    ends = [*porter.ENDINGS, "ies", "ied", "eed", "sses", "ational", "x", "n", "l", "th", "é", "yy"]
    words = sorted({a + b for a in ("", "b", "ab", "cond", "hopp", "y", "tionou", "ß") for b in ends} | set(porter.IRREGULAR))
    df = spark.createDataFrame([(w,) for w in words] + [(None,)], "word string")
    short = values(df.select("word", stem(F.col("word")).alias("stem")))
    with unittest.mock.patch.object(porter, "ends_in_suffix", lambda w: F.lit(True)):
        assert values(df.select("word", stem(F.col("word")).alias("stem"))) == short
    skipped = df.filter(~porter.ends_in_suffix(F.col("word")))
    assert 20 < skipped.count() < len(words) and not set(values(skipped)) & {(w,) for w in porter.IRREGULAR}


def test_words_are_exploded_by_generated_code(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("doc_id", "mention_id")
    plans = (bow.bag_of_words(docs), langid.word_counts(docs))
    for plan in (p._jdf.queryExecution().executedPlan().toString() for p in plans):
        # A function of elements would make Spark evaluate the explosion, and all above it, without generated code.
        assert plan.count("Generate explode") == 1 and "lambda" not in plan.split("Generate explode")[1]


def test_word_scores_hold_the_most_frequent_words(spark):
    words = spark.createDataFrame([("x", f"w{i}" + "abcdefghij"[i % 10], 1 + (i % 4 == 0) * i) for i in range(400)], "lang string, word string, c long")
    wide = langid.wide_profiles(langid.langid_profiles(words), ["x"])
    for most, n in ((400, 400), (399, 99), (99, 99), (0, 0)):  # 99 words are frequent, the others alike
        assert langid.word_scores(words, wide, ["x"], most=most).count() == n
    some = [r["word"] for r in langid.word_scores(words, wide, ["x"], most=30).collect()]
    assert 20 < len(some) <= 30 and set(some) == {r["word"] for r in words.orderBy(F.desc("c")).limit(len(some)).collect()}


def test_bag_with_a_stem_table(spark):
    """The same bag whatever the table holds, and no text in an exchange."""
    rows = [(1, "Running runners ran; flies denied the caresses"), (2, "running running flies"), (3, None), (4, "the 12 @x")]
    docs = spark.createDataFrame(rows, "mention_id long, text string")
    plain = values(bow.bag_of_words(docs))
    stems = bow.frequent_stems(docs)
    assert values(stems) and all(values(bow.bag_of_words(docs, stems=s)) == plain for s in (stems, stems.limit(1), stems.limit(0)))
    assert values(bow.frequent_stems(docs, most=4)) == [("running", "run")]
    assert values(bow.frequent_stems(docs.limit(0))) == []
    plan = bow.bag_of_words(docs, stems=stems)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and "text" not in exchanges[0]


def test_grams_are_cut_by_generated_code(spark):
    """The rows of word_grams without functions of elements, which copied every row of a text's words."""
    words = spark.createDataFrame([("a",), ("ab",), ("çde",), ("𝒜bcd",), ("abab",), ("",), (None,)], "word string")
    cut = langid.gram_rows(words, ["word"], F.col("word"))
    want = words.select("word", F.explode_outer(langid.word_grams(F.col("word"))).alias("gram"))
    assert values(cut) == values(want)
    wide = spark.createDataFrame([("a", -1.0), ("ab", -2.0)], "gram string, lp_en double")
    table = spark.createDataFrame([("ab", -9.0)], "word string, w_en double")
    rows, score = langid.with_scores(words, wide, table, ["en"])
    assert "lambdafunction" not in rows._jdf.queryExecution().optimizedPlan().toString()
    sums = rows.groupBy("word").agg(F.sum(score["en"]).alias("s"))
    assert {r["word"]: r["s"] for r in sums.collect()} == {"a": -1.0, "ab": -9.0, "çde": None, "𝒜bcd": None, "abab": -6.0, "": None, None: None}


def test_tokens_of_odd_texts_as_by_their_patterns(spark):
    """Edges, capitals, lower case and marks are found without a regex a token, to the same results."""
    texts = ["", " ", "a", "AB", "AB cd", "A bc", "I AM", "İΣ ΑΣ ab", "x'' ab!! !!ab !!ab!! a!b! ..", "ab!\r ab.  .\rab \x85ab?",
             "?!?ab ab?!?! ab-. #ab 'ab", "12 ab", "1! ?? 𝒜𝒜, Ǆa ǅǅ", "wow!!!!! why? why?? ???"]
    rows = spark.createDataFrame([(t,) for t in texts], "c string")
    c = F.col("c")
    by_pattern = F.transform(x.tokens_min2(c), lambda w: F.when(w.rlike(x.PUNCT), F.regexp_replace(w, x.EDGE_PATTERN, "$1$2")).otherwise(w))
    got = rows.select("c", by_pattern.alias("old"), x.scorer_tokens(c).alias("new"), x.mixed_case(c).alias("mixed"))
    lows = got.select("*", F.transform("old", F.lower).alias("low"), x.lower_tokens(F.col("new")).alias("lows"))
    for r in lows.withColumn("upper", F.size(F.filter("old", x.is_upper))).collect():
        assert r["new"] == r["old"], r["c"]
        assert r["mixed"] == (1 <= r["upper"] < len(r["old"])), r["c"]
        assert r["lows"] == (r["low"] or [""]), r["c"]
    plan = rows.select(x.mixed_case(c), x.lower_tokens(F.split(c, " ")))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan


def documents(spark, folder, rows):
    """A folder with the documents that the queries read, from (doc_id, text), in several files."""
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit("s1"), "n_chars": F.length("text").cast("long")}
    )
    df.repartition(8).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


ODD_TEXTS = ["Cats cat running, runs runs!", "the cat cat the not", "", None, "a I 12", "don't _ x''", "zz " * 500 + "éé aa", "cats"]
#: Every text has a key of its own; some share one, or have none; all share one.
SHARING = [(1, 2, 3, 4, 6, 7, 8, 9), (None, 2, None, 4, 2, 6, 4, 8), (5,) * 8]


@pytest.mark.parametrize("keys", SHARING)
def test_bag_needs_no_shuffle_of_words(spark, tmp_path, keys):
    """Texts with a key of their own move by the key, and what is made of them does not; rows that share a key, or have none, are added."""
    d = documents(spark, tmp_path, list(zip(keys, ODD_TEXTS)))
    with unittest.mock.patch.object(io, "SMALL_PIECES", 0):  # as for a large input, which is not dealt out by id beforehand
        docs, got = catalog.docs(spark, d), catalog.QUERIES["bag_of_words"](spark, d)
    plan = got._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "term" in line]
    assert len(moved) == (len(set(keys)) < len(keys))
    assert values(got, "mention_id", "term", "n") == values(bow.bag_of_words(docs), "mention_id", "term", "n")


def test_words_are_counted_in_the_row(spark):
    """A text's word counts need no aggregation, whose table would hold the words of all texts of a task."""
    docs = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "mention_id long, text string")
    plain = bow.words_of(docs, ["mention_id"]).groupBy("mention_id", "word").agg(F.count(F.lit(1)).alias("n"))
    counted = bow.words_of(docs, ["mention_id"], counted=True)
    assert values(counted, "mention_id", "word", "n") == values(plain, "mention_id", "word", "n")
    assert "Aggregate" not in counted._jdf.queryExecution().executedPlan().toString()
    assert (6, "zz", 500) in values(counted, "mention_id", "word", "n")


@pytest.mark.parametrize("keys", SHARING)
def test_stopword_filter_adds_up_shared_keys_only(spark, tmp_path, keys):
    d = documents(spark, tmp_path, list(zip(keys, ODD_TEXTS)))
    got = catalog.QUERIES["stopword_filter"](spark, d)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("Aggregate" in plan) == (len(set(keys)) < len(keys))
    want = bow.words_of(catalog.docs(spark, d), ["mention_id"]).groupBy("mention_id", "word").agg(F.count(F.lit(1)).alias("n"))
    assert values(got, "mention_id", "word", "n") == values(want, "mention_id", "word", "n")
