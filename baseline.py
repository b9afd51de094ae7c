"""Scorer throughput next to the shape it replaces: a Python function called once per row.

The per-row shape is the sequential scorer of the tests inside a plain Python UDF; its word tables
are built once per worker, which is kinder than building them for every row.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "tests"))

import bench  # noqa: E402
from catalog import tables as t  # noqa: E402
from opinions.operators import sentiment as sen  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def timed(df) -> float:
    started = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = bench.session(cpus)
    spark.sparkContext.addPyFile(os.path.join(os.path.dirname(os.path.abspath(__file__)), "tests", "plain_scorer.py"))
    docs = t.texts(spark, sf_dir).select("mention_id", "text").persist()
    n = docs.count()
    tokens = sen.token_context(docs, t.RULES).count()
    words = {r["token"]: r["valence"] for r in t.lexicon(spark, sf_dir).collect()}
    rules = t.RULES

    def score(text):
        from plain_scorer import Plain

        return float(Plain(words, rules).scores(text)[3])

    per_row = F.udf(score, "double")
    out = {"texts": n, "tokens": tokens, "cpus": cpus}
    for name, frame in (
        ("plan", lambda: sen.sentiment_scores(docs, t.lexicon(spark, sf_dir), rules)),
        ("per_row_udf", lambda: docs.select("mention_id", per_row("text").alias("compound"))),
    ):
        runs = [timed(frame()) for _ in range(2)]
        out[name] = {"sec_cold": round(runs[0], 2), "sec": round(runs[1], 2), "tokens_per_sec": round(tokens / runs[1])}
    print(json.dumps(out))


if __name__ == "__main__":
    main()
