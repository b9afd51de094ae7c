"""The subpackage's queries over the driver's tables, and their SQL."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinions.llm import chat, decontaminate, exact, packing, phrases, pii, quality, repair, revisits, shards, simhash, suffixes, tokens
from opinions.llm.common import shipped

QUERIES = {}
SHARDS = 40


def query(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        shipped(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _listed(spans):
    """Spans as kind:start:end by start, then kind."""
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(pii.KINDS) for x in (k, i)])
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], rank[s["kind"]], s["stop"], s["kind"])))
    parts = F.transform(order, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")))
    return F.array_join(parts, ",")


def _number(spans, kind):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


@query
def op1_pii(spark, d):
    docs = table(spark, d, "documents")
    spans = pii.found(docs, pii.fitted(docs))
    return spans.select(
        "doc_id",
        *[_number("base", k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(_listed("base"), 256).alias("base_sha256"),
        _listed(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


@query
def op2_decontaminate(spark, d):
    found = decontaminate.contamination_of_rows(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op3_simhash(spark, d):
    return simhash.near_duplicates(table(spark, d, "documents"))


@query
def op4_chat(spark, d):
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, d, "conversations").select(extra.columns).unionByName(extra)
    made = chat.formatted(turns)
    read = made.select(
        "conv_id",
        "formatted",
        "valid",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.trained_text(F.col("segments")).alias("trained"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


@query
def op5_exact_dedup(spark, d):
    return exact.deduplicated(table(spark, d, "documents"))


def captures(pages: DataFrame) -> DataFrame:
    """A crawl of ``pages``: a response for most pages, and two not-modified answers for each, a day and two later."""
    n = F.col("page_id")
    seen = F.lit(1_600_000_000) + n * 60
    stamp = F.date_format(F.timestamp_seconds(seen), "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    size = F.octet_length(F.coalesce("html", F.lit(""))).cast("string")
    first = F.create_map(
        F.lit("content-type"), F.lit("text/html"), F.lit("content-length"), size,
        F.lit("etag"), tag, F.lit("last-modified"), stamp, F.lit("cache-control"), F.lit("max-age=60"),
    )
    second = F.create_map(
        F.lit("etag"), F.when(n % 5 == 0, F.lit('"changed"')).otherwise(F.concat(F.lit("W/"), tag)),
        F.lit("cache-control"), F.lit("max-age=3600"), F.lit("content-length"), F.lit("0"),
    )
    third = F.create_map(
        F.when(n % 3 == 2, F.lit("expires")).otherwise(F.lit("last-modified")), F.when(n % 3 == 1, F.lit("other")).otherwise(stamp)
    )

    def record(k, kind, status, headers):
        return F.struct(
            (3 * n + k).alias("id"),
            (seen + 86_400 * k).alias("date"),
            "url",
            F.lit(kind).alias("kind"),
            F.lit(status).alias("status"),
            headers.alias("headers"),
        )

    made = F.array(record(0, "response", 200, first), record(1, "revisit", 304, second), record(2, "revisit", 304, third))
    return pages.select("page_id", F.explode(made).alias("r")).filter("r.kind = 'revisit' OR page_id % 7 <> 0").select("r.*")


@query
def op6_revisits(spark, d):
    found = revisits.resolved(captures(table(spark, d, "pages").select("page_id", "url", "html")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.withColumn("headers", F.array_join(lines, "\n"))


@query
def op7_quality(spark, d):
    return quality.classified(table(spark, d, "documents"), table(spark, d, "labels"))


@query
def op8_shards(spark, d):
    return shards.sharded(table(spark, d, "documents"), SHARDS)


@query
def op9_best_fit(spark, d):
    return packing.best_fit(table(spark, d, "documents"), tokenizer())


@query
def op10_suffix_dedup(spark, d):
    found = suffixes.without_repeats(table(spark, d, "documents"))
    n_spans = F.size("spans").cast("long").alias("n_spans")
    return found.select("doc_id", "n_bytes", "n_removed", n_spans, "kept_sha256")


@query
def op11_token_counts(spark, d):
    return tokens.counted(table(spark, d, "documents"), byte_tokenizer())


@query
def op12_collocations(spark, d):
    return phrases.collocations(table(spark, d, "documents"))


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults that the key and turn of a row decide; a dropped row has ``there`` false."""
    filled = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(filled["conv_id"], F.lit(":"), filled["turn"])) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(filled["text"], ".!?", "")).otherwise(filled["text"])
    row = F.struct(
        F.when(kind == 4, "user").otherwise(filled["role"]).alias("role"), text.alias("text"), (kind != 0).alias("there")
    )
    rows = turns.select("conv_id", "turn", F.explode(F.when(kind == 3, F.array(row, row)).otherwise(F.array(row))).alias("r"))
    return rows.select("conv_id", "turn", "r.*")


@query
def op13_repair(spark, d):
    found = repair.repaired(damaged(table(spark, d, "conversations")), present="there")
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    digest = F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256")
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", digest)


SQL = {
    "op2_decontaminate": r"""
        WITH cut AS (
            SELECT doc_id, list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
        tests AS (
            SELECT item_id, list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
        wins AS (
            SELECT DISTINCT item_id, least(len(w), 13) AS n,
                   array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS gram
            FROM (SELECT *, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM tests WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM wins),
        grams AS (
            SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS gram
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM cut, sizes WHERE len(w) >= n)),
        hit AS (SELECT doc_id, i, grams.n, item_id FROM grams JOIN wins ON grams.gram = wins.gram AND grams.n = wins.n),
        places AS (SELECT doc_id, count(DISTINCT p) AS n_hit
                   FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit))
                   GROUP BY doc_id),
        named AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
                  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
        SELECT c.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM cut c LEFT JOIN places p ON c.doc_id = p.doc_id LEFT JOIN named m ON c.doc_id = m.doc_id""",
    "op4_chat": r"""
        WITH rows AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        per AS (
            SELECT conv_id, count(*) AS n_turns,
                   string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS said,
                   coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS trained,
                   sum(length('<|im_start|>') + length(role) + 1 + length('<|im_end|>') + 1 + length(replace(replace(
                       replace(text, '\', '\e'), '<|im_start|>', '\a'), '<|im_end|>', '\b'))) AS formatted_chars,
                   string_agg(role, ',' ORDER BY turn) AS roles
            FROM rows GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(trained) AS loss_chars,
               sha256(trained) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars,
               regexp_full_match(roles, '(system,)?user,assistant(,user,assistant)*') AS valid
        FROM per""",
    "op6_revisits": r"""
        WITH u AS (
            SELECT page_id, url, 1600000000 + page_id * 60 AS seen, '"' || md5(coalesce(html, '')) || '"' AS tag,
                   strftime(make_timestamp((1600000000 + page_id * 60) * 1000000), '%a, %d %b %Y %H:%M:%S GMT') AS stamp,
                   octet_length(encode(coalesce(html, ''))) AS size,
                   regexp_replace(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)),
                       ':(80|443)$', ''), '^www[0-9]*\.', '') AS host,
                   regexp_replace(regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
                   array_to_string(list_sort(list_filter(
                       string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'),
                       lambda p: p <> '' AND NOT starts_with(p, 'utm_')
                           AND NOT string_split(p, '=')[1] IN ('ref', 'fbclid', 'gclid', 'sessionid'))), '&') AS q
            FROM pages),
        r AS (
            SELECT 3 * page_id + k AS id, seen + 86400 * k AS date, k, page_id, tag, stamp, size,
                   CASE WHEN host = '' THEN url ELSE host || path || CASE WHEN q <> '' THEN '?' || q ELSE '' END END AS url
            FROM u, (SELECT unnest([0, 1, 2]) AS k) WHERE k > 0 OR page_id % 7 <> 0),
        s AS (
            SELECT *, last_value(CASE WHEN k = 0 THEN {'id': id, 'tag': tag, 'stamp': stamp, 'size': size} END IGNORE NULLS)
                OVER (PARTITION BY url ORDER BY date, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS src
            FROM r),
        t AS (
            SELECT *, CASE
                WHEN k = 0 THEN 'full'
                WHEN src IS NULL THEN 'orphan'
                WHEN k = 1 THEN CASE WHEN page_id % 5 <> 0 AND tag = src.tag THEN 'resolved' ELSE 'changed' END
                WHEN page_id % 3 = 2 THEN 'unverified'
                WHEN page_id % 3 = 0 AND stamp = src.stamp THEN 'resolved' ELSE 'changed' END AS state
            FROM s)
        SELECT id, date, url, CASE WHEN k = 0 THEN 'response' ELSE 'revisit' END AS kind, state,
               CASE WHEN state IN ('resolved', 'unverified') THEN src.id END AS source_id,
               CASE WHEN k = 0 OR state IN ('resolved', 'unverified') THEN 200 ELSE 304 END AS status,
               CASE WHEN k = 0 THEN concat_ws(chr(10), 'cache-control: max-age=60', 'content-length: ' || size,
                        'content-type: text/html', 'etag: ' || tag, 'last-modified: ' || stamp)
                    WHEN state IN ('resolved', 'unverified') THEN concat_ws(chr(10),
                        'cache-control: ' || CASE WHEN k = 1 THEN 'max-age=3600' ELSE 'max-age=60' END,
                        'content-length: ' || src.size, 'content-type: text/html',
                        'etag: ' || CASE WHEN k = 1 THEN 'W/' || tag ELSE src.tag END,
                        CASE WHEN k = 2 AND page_id % 3 = 2 THEN 'expires: ' || stamp END,
                        'last-modified: ' || src.stamp)
                    WHEN k = 1 THEN concat_ws(chr(10), 'cache-control: max-age=3600', 'content-length: 0',
                        'etag: ' || CASE WHEN page_id % 5 = 0 THEN '"changed"' ELSE 'W/' || tag END)
                    ELSE CASE WHEN page_id % 3 = 2 THEN 'expires: ' ELSE 'last-modified: ' END
                        || CASE WHEN page_id % 3 = 1 THEN 'other' ELSE stamp END END AS headers
        FROM t""",
    "op12_collocations": r"""
        WITH pieces AS (
            SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w
            FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
        totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
        f AS (
            SELECT lang, m, phrase, count(*) AS f FROM (
                SELECT lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS phrase
                FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
                      FROM pieces, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE len(w) >= m))
            GROUP BY lang, m, phrase),
        candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND f >= 100),
        cuts AS (
            SELECT c.lang, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, n,
                   (CAST(1000 AS HUGEINT) * c.f * n) // (CAST(x.f AS HUGEINT) * y.f) AS score
            FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c JOIN totals t ON t.lang = c.lang
            JOIN f x ON x.lang = c.lang AND x.m = k AND x.phrase = array_to_string(list_slice(c.w, 1, k), ' ')
            JOIN f y ON y.lang = c.lang AND y.m = c.m - k AND y.phrase = array_to_string(list_slice(c.w, k + 1, c.m), ' ')
            WHERE NOT EXISTS (
                SELECT 1 FROM candidates q WHERE q.lang = c.lang AND q.m > c.m AND 100 * q.f >= 100 * c.f
                AND contains(' ' || q.phrase || ' ', ' ' || c.phrase || ' '))
            QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1)
        SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
        FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM cuts)
        WHERE rank <= 2000""",
    "op5_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, length(coalesce(text, '')) AS size,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER same AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = first_value(doc_id) OVER same AS kept, text_sha256
        FROM n WINDOW same AS (PARTITION BY text_sha256 ORDER BY size DESC, doc_id)""",
}


def sql() -> dict[str, str]:
    return dict(SQL)
