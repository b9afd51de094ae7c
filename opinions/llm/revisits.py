"""WARC revisits: a not-modified record takes its content from the latest earlier full response of its URL."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinions.llm.common import written

#: Query parameters that tell nothing about the content; a name that ends in * stands for a prefix.
IGNORED = ("utm_*", "ref", "fbclid", "gclid", "sessionid")
#: Headers of a not-modified answer that describe its own message and must not replace stored ones.
OWN_MESSAGE = (
    "connection",
    "content-encoding",
    "content-length",
    "content-md5",
    "content-range",
    "content-type",
    "keep-alive",
    "proxy-authenticate",
    "proxy-connection",
    "te",
    "trailer",
    "transfer-encoding",
    "upgrade",
)


def canonical(url: Column, ignored: Sequence[str] = IGNORED) -> Column:
    """One spelling for the URLs of a page: no scheme, www, default port, fragment, closing slash or ignored
    parameters; host in lower case, parameters sorted. What is no URL stays as it is; null stays null."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www[0-9]*\.", "")
    path = F.regexp_replace(F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1), r"/+$", "")
    params = F.split(F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1), "&")

    def told(p):
        name = F.substring_index(p, "=", 1)
        keep = p != ""
        for i in ignored:
            keep = keep & ~(name.startswith(i[:-1]) if i.endswith("*") else name == i)
        return keep

    query = F.array_join(F.array_sort(F.filter(params, told)), "&")
    made = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    return F.when(host == "", url).otherwise(made)


def _filled(records: DataFrame, parts: int | None) -> DataFrame:
    """Each record with ``source``, the latest full response before it in its range partition.

    Records are range-partitioned and sorted by (url, date, id): a URL with a third of all records is spread
    over many tasks. ``head`` marks records of a partition's first URL that come before any full response
    there. Each partition adds one row with ``tail``, its last URL's last full response.
    """
    full = records.schema["full"].dataType
    schema = T.StructType(
        [
            *(T.StructField(f.name, f.dataType) for f in records.schema.fields),  # all may be null
            T.StructField("source", full),
            T.StructField("head", T.BooleanType()),
            T.StructField("tail", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last_url = last = None
        opened = False
        spare = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            urls, own = batch.column("url"), batch.column("full")
            names = np.array(urls.to_pylist(), object)
            new = np.concatenate(([not opened or names[0] != last_url], names[1:] != names[:-1]))
            if not opened:
                first, opened = names[0], True
            begin = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            has = np.array([x.is_valid for x in own])
            # Place of the latest full response strictly before each row; 0 is the one carried over.
            before = np.concatenate(([0], np.maximum.accumulate(np.where(has, np.arange(1, n + 1), 0))[:-1]))
            carried = pa.array([None if new[0] else last], own.type)
            pool = pa.concat_arrays([carried, own])
            usable = (before > begin) | ((before == 0) & (begin == 0) & (not new[0]))
            places = pa.array(np.where(usable, before, 0), mask=~usable)
            source = pool.take(places)
            nothing = np.array([not x.is_valid for x in source])
            head = nothing & (names == first) & np.array([x is not None for x in names])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, source, pa.array(head), pa.array(np.zeros(n, bool))], names=schema.names
            )
            at = np.flatnonzero(has & (np.arange(n) >= begin[-1]))
            last = own[int(at[-1])].as_py() if len(at) else (last if begin[-1] == 0 and not new[0] else None)
            last_url, spare = names[-1], batch
        if last is not None and last_url is not None:
            blank = [pa.nulls(1, c.type) for c in spare.columns]
            blank[schema.names.index("url")] = pa.array([last_url])
            yield pa.RecordBatch.from_arrays(
                [*blank, pa.array([last], spare.column("full").type), pa.array([False]), pa.array([True])],
                names=schema.names,
            )

    dealt = records.repartitionByRange("url", "date", "id") if parts is None else records.repartitionByRange(
        parts, "url", "date", "id"
    )
    return dealt.sortWithinPartitions("url", "date", "id").mapInArrow(run, schema)


def _opaque(tag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(F.trim(tag), "^W/", "")


def resolved(
    captures: DataFrame,
    ignored: Sequence[str] = IGNORED,
    not_permitted: Sequence[str] = OWN_MESSAGE,
    parts: int | None = None,
) -> DataFrame:
    """Resolve not-modified records: id, date, url, kind, state, source_id, status, headers.

    ``captures`` has id, date, url, kind ("response" or "revisit"), status and headers (a map with names in
    lower case). A revisit is joined to the latest response of its canonical URL that comes before it by
    (date, id). Validators decide: an ETag if both have one (weak comparison), else Last-Modified if both have
    one. ``state`` is "full" for a response, "resolved" where a validator agrees, "changed" where it differs,
    "unverified" where there is none to compare, and "orphan" without an earlier response. Resolved and unverified
    records get the response's id and status and its headers, updated with the revisit's permitted ones; other
    revisits keep their own.

    A null URL, date or id never gives or takes content, except that a null date or id sorts first. Null headers
    are no headers. Rows that repeat an id are records each; ties go by date, then id. Other columns are
    ignored; an empty table gives no rows.
    """
    none = F.create_map().cast("map<string,string>")
    is_full = (F.col("kind") == "response") & F.col("url").isNotNull()
    records = captures.select("id", "date", "url", "kind", "status", F.coalesce("headers", none).alias("headers")).select(
        "id", "date", canonical(F.col("url"), ignored).alias("url"), "kind", "status", "headers",
        F.when(is_full, F.struct("id", "date", "status", "headers")).alias("full"),
    )
    filled = written(_filled(records, parts))
    tail = filled.filter("tail").select(F.col("url").alias("_url"), F.col("source").alias("_source"))
    place = F.struct(F.col("_source.date").alias("date"), F.col("_source.id").alias("id"))
    # At most one row for each partition; each holds until the next one of its URL.
    held = tail.select("_url", "_source", place.alias("_from")).withColumn(
        "_to", F.lead("_from").over(Window.partitionBy("_url").orderBy("_from"))
    )
    rows = filled.filter("NOT tail").drop("tail")
    now = F.struct("date", "id")
    carried = rows.filter("head").join(
        F.broadcast(held),
        (F.col("url") == F.col("_url"))
        & (F.col("_from") < now)
        & (F.col("_to").isNull() | (now <= F.col("_to"))),
        "left",
    )
    carried = carried.withColumn("source", F.coalesce("source", "_source")).select(rows.columns)
    every = rows.filter("NOT head").unionByName(carried)
    theirs, own = F.col("source.headers"), F.col("headers")
    tags = _opaque(own["etag"]), _opaque(theirs["etag"])
    same = F.coalesce(tags[0] == tags[1], F.trim(own["last-modified"]) == F.trim(theirs["last-modified"]))
    state = (
        F.when(F.col("kind") == "response", "full")
        .when(F.col("source").isNull(), "orphan")
        .when(same, "resolved")
        .when(~same, "changed")
        .otherwise("unverified")
    )
    takes = F.col("state").isin("resolved", "unverified")
    allowed = F.map_filter(own, lambda k, _: ~k.isin(*not_permitted))
    kept = F.map_filter(theirs, lambda k, _: ~F.map_contains_key(allowed, k))
    return every.withColumn("state", state).select(
        "id",
        "date",
        "url",
        "kind",
        "state",
        F.when(takes, F.col("source.id")).alias("source_id"),
        F.when(takes, F.col("source.status")).otherwise(F.col("status")).alias("status"),
        F.when(takes, F.map_concat(kept, allowed)).otherwise(own).alias("headers"),
    )
