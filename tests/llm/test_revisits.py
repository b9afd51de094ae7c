"""Revisits against a plain walk over each URL's records."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from opinions.llm import revisits

SCHEMA = "id long, date timestamp, url string, kind string, status int, headers map<string,string>, source string, head string"


def plain(rows):
    out, last = [], {}
    least = dt.datetime.min
    for i, date, url, kind, status, headers, *_ in sorted(rows, key=lambda r: (r[1] or least, r[0] is not None, r[0] or 0)):
        own, source = headers or {}, last.get(url) if url is not None else None
        state = "full"
        if kind == "revisit":
            state = "orphan" if source is None else "unverified"
            if source:
                theirs = source[2]
                for name, clean in (("etag", lambda x: x.strip().removeprefix("W/")), ("last-modified", str.strip)):
                    if name in own and name in theirs:
                        state = "resolved" if clean(own[name]) == clean(theirs[name]) else "changed"
                        break
        taken = state in ("resolved", "unverified")
        if taken:
            allowed = {k: v for k, v in own.items() if k not in revisits.OWN_MESSAGE}
            own, status = {**source[2], **allowed}, source[1]
        out.append((i, date, url, kind, state, source[0] if taken else None, status, sorted(own.items())))
        if kind == "response" and url is not None:
            last[url] = (i, status, headers or {})
    return sorted(out, key=repr)


def rows_of(df):
    assert df.columns == ["id", "date", "url", "kind", "state", "source_id", "status", "headers"]
    return sorted(((*tuple(r)[:7], sorted(r["headers"].items())) for r in df.collect()), key=repr)


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_random_crawl(spark, parts):
    rng = random.Random(parts)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(400):
        url = rng.choice(["a.example/hot"] * 6 + [f"b.example/{k}" for k in range(8)] + [None])
        tag = rng.choice(['"1"', 'W/"1"', '"2"', None])
        headers = {"content-length": str(i), "x": str(i), **({"etag": tag} if tag else {})}
        if rng.random() < 0.3:
            headers["last-modified"] = rng.choice("pq")
        kind = rng.choice(["response", "revisit", "revisit", "revisit"])
        date = start + dt.timedelta(hours=rng.randint(0, 60))
        rows.append((i, date, url, kind, 200 if kind == "response" else 304, rng.choice([headers, None]), "s", "h"))
    captures = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(revisits.resolved(captures, parts=parts)) == plain(rows)


def test_no_response_and_empty(spark):
    rows = [(1, dt.datetime(2024, 1, 1), "u", "revisit", 304, None, None, None)]
    assert rows_of(revisits.resolved(spark.createDataFrame(rows, SCHEMA))) == plain(rows)
    assert revisits.resolved(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("parts", [1, 4])
def test_null_dates_and_ids_and_very_long_urls(spark, parts):
    day = dt.datetime(2024, 1, 1)
    long = "c.example/" + "x" * 100_000
    rows = []
    for url in ("a.example/p", long, "", None):
        for i, date in ((1, None), (None, day), (None, None), (2, day)):
            for kind, status, tag in (("response", 200, '"1"'), ("revisit", 304, 'W/"1"')):
                at = date if kind == "response" or date is None else date + dt.timedelta(days=1)
                rows.append((None if i is None else 10 * i + (kind == "revisit"), at, url, kind, status, {"etag": tag}, None, None))
    # responses of one URL carry the same validator, so that ties of null dates and null ids leave only their ids open
    got = rows_of(revisits.resolved(spark.createDataFrame(rows, SCHEMA), parts=parts))
    assert len(got) == len(rows)
    for i, date, url, kind, state, source, status, headers in got:
        late = date is not None and date > day
        assert state == "full" if kind == "response" else state in ("resolved", "orphan")
        assert state != "orphan" or url is None or not late
        if late and url is not None:
            assert (state, source, status) == ("resolved", 20, 200)
        if state == "orphan":
            assert source is None and status == 304


def test_repeated_rows_and_ids(spark):
    day = dt.datetime(2024, 1, 1)
    full = (7, day, "u", "response", 200, {"etag": "a", "x": "1"}, None, None)
    again = (7, day + dt.timedelta(days=1), "u", "revisit", 304, {"etag": "a", "x": "2"}, None, None)
    rows = [full, full, again, again, again]
    assert rows_of(revisits.resolved(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_canonical_urls(spark):
    same = ["http://www.Example.com:80/a/?b=2&a=1#x", "https://example.com/a?a=1&b=2&utm_source=z", "HTTP://example.com/a/?ref=q&b=2&a=1"]
    other = ["https://example.com/A?a=1&b=2", "not a url", "", None, "https://m.example.com/a"]
    df = spark.createDataFrame([(u,) for u in same + other], "u string").select(revisits.canonical(F.col("u")).alias("c"))
    got = [r["c"] for r in df.collect()]
    assert got == ["example.com/a?a=1&b=2"] * 3 + ["example.com/A?a=1&b=2", "not a url", "", None, "m.example.com/a"]
