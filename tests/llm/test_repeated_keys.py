"""Rows that share a key, or have none, are documents of their own."""

import corpus_pipeline
from opinions.llm import decontaminate

SF = "/root/testdata/sf0.001"


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_contamination_of_rows(spark, texts):
    passage = " ".join(f"p{i}" for i in range(13))
    clean = "word " * 1000
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    rows = [(1, passage), (1, clean), (None, passage), (None, clean), (None, clean), (2, passage), (2, passage), (3, None), (3, "")]
    got = decontaminate.contamination_of_rows(texts(rows), bench)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items", "contaminated", "spans"]
    want = [(k, len((t or "").split()), 13 if t == passage else 0, t == passage) for k, t in rows]
    assert values(got, "doc_id", "n_words", "n_hit", "contaminated") == sorted(want, key=repr)


def pairs(df):
    return values(df, "doc_id", "text")


def test_stages_judge_rows(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").filter("length(text) > 200").first()["text"]
    words = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    one, other, third = " ".join(words), " ".join(words[::-1]) + " end", "So it goes on, by and by, 12 34 56 78."
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    table = lambda rows: spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], schema)
    twice = [(1, one), (1, one), (1, one + " "), (None, other), (None, other), (2, one), (None, third), (1, third)]
    exact = corpus_pipeline.exact_dedup(spark, table(twice), SF)
    assert pairs(exact) == sorted([(1, one + " "), (None, other), (None, third)], key=repr)
    near = corpus_pipeline.near_dedup(spark, table([(None, None), (None, ""), (3, ""), (3, third)]), SF)
    got = pairs(near)
    assert len(got) == 2 and (3, third) in got and sum(k is None for k, _ in got) == 1
    rows = [(None, item), (None, other), (4, item), (4, "clean " * 10_000), (5, other)]
    kept = corpus_pipeline.decontamination(spark, table(rows), SF)
    assert pairs(kept) == sorted([rows[1], rows[3], rows[4]], key=repr)
