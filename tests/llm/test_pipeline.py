"""Each stage against a plain version on its own input, and the whole run."""

import pytest

import corpus_pipeline
from opinions.llm import quality
from test_decontaminate import plain as plain_hits
from test_exact import plain as plain_groups
from test_packing import check as check_packing
from test_simhash import plain_classes, plain_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF))
        out.append(docs)
    return out


def rows(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_stages_are_the_five(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "packing"]
    for s in steps[1:5]:
        assert s.schema == steps[0].schema
        # Rows pass as they are.
        assert s.exceptAll(steps[0]).isEmpty()


def test_quality(spark, steps):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    chain = quality.fitted(steps[0], labels)
    before = rows(steps[0])
    scores = quality.scores(chain, [(t or "").encode() for _, t in before])
    assert rows(steps[1]) == [r for r, s in zip(before, scores) if s >= 0.3]
    kept = {i for i, _ in rows(steps[1])}
    marks = {r["doc_id"]: r["quality"] for r in labels.collect()}
    good = [i for i, q in marks.items() if q]
    assert sum(i in kept for i in good) >= 0.97 * len(good)


def test_exact(steps):
    before = rows(steps[1])
    kept = {g[0] for g in plain_groups(before) if g[3]}
    assert rows(steps[2]) == [r for r in before if r[0] in kept]


def test_near(steps):
    before = rows(steps[2])
    prints = [plain_fingerprint(t) for _, t in before]
    classes = plain_classes(before, prints)
    assert rows(steps[3]) == [r for r, f in zip(before, prints) if classes[f] == r[0]]


def test_decontamination(spark, steps):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    before = rows(steps[3])
    found = plain_hits(before, items)
    assert rows(steps[4]) == [r for r in before if not found[r[0]][3]]


def test_packing(steps):
    check_packing(rows(steps[4]), steps[5].collect())


def test_run(spark, steps):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == steps[5].columns
    assert rows_of(got) == rows_of(steps[5])


def rows_of(df):
    return sorted(tuple(r)[:5] for r in df.collect())


def test_stages_take_odd_documents(spark):
    """Null and repeated rows, empty tables and further columns pass every stage."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, _gone string, kept string"
    odd = [(1, None, "en", "s", 0, "x", "y"), (1, None, "en", "s", 0, "x", "y"), (None, "a b c.", None, None, None, None, None),
           (2, "", "en", "s", 0, "x", "y"), (3, "word " * 20_000, "en", "s", 1, "x", "y")]
    for data in (odd, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            docs = corpus_pipeline.written(out)
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert last.count() >= docs.count()
    near = corpus_pipeline.near_dedup(spark, spark.createDataFrame(odd, schema), SF)
    assert {r["doc_id"] for r in near.collect()} >= {None, 3}
