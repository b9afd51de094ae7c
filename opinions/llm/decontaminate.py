"""Benchmark decontamination: windows of test words, found in every document and verified as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinions.llm.common import ascii_lower, written

#: Words in a window.
WINDOW = 13
#: A document is contaminated if at least one word in SHARE is hit.
SHARE = 20
#: Largest set of windows that is broadcast; a larger one is joined by shuffle.
BROADCAST_BYTES = 32 * 1024 * 1024
#: What separates words: all of ASCII but digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A document is read in blocks that start at every STEP-th word.
STEP = 7


def words(text: Column) -> Column:
    """Words in order, in the case of the text; null has none."""
    return F.split(F.coalesce(text, F.lit("")), SEPARATORS)


def trimmed(tokens: Column) -> Column:
    """Without the empty strings that separators at either end leave."""
    ahead = (F.get(tokens, F.lit(0)) == "").cast("int")
    behind = ((F.size(tokens) > 1) & (F.get(tokens, F.size(tokens) - 1) == "")).cast("int")
    return F.slice(tokens, ahead + 1, F.size(tokens) - ahead - behind)


def item_windows(items: DataFrame, item: str, text: str, window: int = WINDOW) -> DataFrame:
    """Distinct (gram, size, item) of a benchmark. An item of fewer words, but not none, is one window."""
    split = items.select(F.col(item).alias("item"), words(ascii_lower(F.col(text))).alias("w"))
    split = split.select("item", trimmed(F.col("w")).alias("w")).filter(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(window))
    start = F.explode(F.sequence(F.lit(1), F.size("w") - size + 1))
    cut = split.select("item", "w", size.alias("size"), start.alias("at"))
    return cut.select(F.concat_ws(" ", F.slice("w", F.col("at"), F.col("size"))).alias("gram"), "size", "item").distinct()


def shared_words(size: int) -> tuple[int, int]:
    """First position and number of the words that every window of ``size`` words starting in a block has.

    Windows that start at words 0 to STEP - 1 of a block all hold its words STEP - 1 to size - 1. Short
    windows have no such words; 0 stands for that.
    """
    return STEP - 1, max(0, size - STEP + 1)


def screen(windows: DataFrame) -> DataFrame:
    """Distinct (size, key): what a block has in common with a window that starts in it."""
    common = F.when(F.col("size") >= STEP, F.col("size") - STEP + 1).otherwise(F.col("size"))
    offset = F.explode(F.sequence(F.lit(1), F.col("size") - common + 1))
    cut = windows.select("size", F.split("gram", " ").alias("w"), common.alias("n"), offset.alias("o"))
    return cut.select("size", F.lower(F.concat_ws(" ", F.slice("w", F.col("o"), F.col("n")))).alias("key")).distinct()


def _lane(tokens: Column, k: int) -> Column:
    return F.filter(tokens, lambda _, i: i % STEP == k)


def blocks(docs: DataFrame, key: str, text: str, reach: int) -> DataFrame:
    """Rows (id, n_words, block, c): words ``c`` from every STEP-th word on, ``reach`` of them, null beyond the end.

    A document without words has one row, with no block.
    """
    split = docs.select(F.col(key).alias("id"), words(F.col(text)).alias("w"))
    split = split.select("id", trimmed(F.col("w")).alias("w"))
    lanes = [_lane(F.col("w"), k).alias(f"l{k}") for k in range(STEP)]
    laned = split.select("id", F.size("w").alias("n_words"), *lanes)
    most = F.size("l0")

    def shifted(i):
        lane, by = f"l{i % STEP}", i // STEP
        return F.slice(lane, by + 1, F.greatest(most - by, F.lit(0))) if by else F.col(lane)

    zipped = F.arrays_zip(*[shifted(i).alias(f"c{i}") for i in range(reach)])
    rows = laned.select("id", "n_words", F.posexplode_outer(zipped).alias("block", "g"))
    return rows.select("id", "n_words", "block", *[F.col(f"g.c{i}").alias(f"c{i}") for i in range(reach)])


def hits(docs: DataFrame, windows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document key: id, n_rows, n_words, spans (sorted (at, to) of every hit window), grams (distinct).

    ``windows`` has ``gram`` and ``size``. Any window starts in one block of STEP words, and all windows
    of a block share the words after it; these are looked up, and only blocks that a test window shares
    spell out their windows. Those are compared as text, so a hash that happens to agree is no hit. Sets of
    at most BROADCAST_BYTES are broadcast: then only hits and a row per document are shuffled. A larger
    benchmark is joined by shuffle.
    """
    known = written(windows.select("gram", "size").distinct())
    keys = written(screen(known))
    sizes = sorted(r["size"] for r in known.select("size").distinct().collect())  # at most WINDOW numbers
    exact = known.select(F.col("gram").alias("_gram"), F.col("size").alias("_size"))
    keys = keys.select(F.col("key").alias("_key"), F.col("size").alias("_of"))
    weight = keys.agg(F.sum(F.octet_length("_key") + 64)).first()[0] or 0
    if weight + (known.agg(F.sum(F.octet_length("gram") + 64)).first()[0] or 0) <= BROADCAST_BYTES:
        exact, keys = F.broadcast(exact), F.broadcast(keys)
    reach = STEP - 1 + max(sizes, default=1)
    rows = blocks(docs, key, text, reach)
    cells = [F.col(f"c{i}") for i in range(reach)]

    def probe(size, first, n):
        # The last word of the part is there, or else no window of this size starts early enough.
        joined = F.when(cells[first + n - 1].isNotNull(), F.lower(F.concat_ws(" ", *cells[first : first + n])))
        return F.struct(F.lit(size).alias("of"), joined.alias("key"))

    probes = [probe(n, *shared_words(n)) for n in sizes if n >= STEP]
    probes += [probe(n, o, n) for n in sizes if n < STEP for o in range(STEP)]
    if len(probes) == 1:
        probed = rows.select("*", probes[0].alias("probe"), F.lit(True).alias("lead"))
    else:
        none = F.struct(F.lit(0).alias("of"), F.lit(None).cast("string").alias("key"))
        each = F.posexplode(F.array(*(probes or [none]))).alias("nth", "probe")
        probed = rows.select("*", each).withColumn("lead", F.col("nth") == 0).drop("nth")
    found = probed.join(
        keys, (F.col("probe.key") == F.col("_key")) & (F.col("probe.of") == F.col("_of")), "left"
    ).filter("_key IS NOT NULL OR (lead AND coalesce(block, 0) = 0)")
    row = F.array(*cells)
    starts = F.transform(
        F.array(*[F.lit(o) for o in range(STEP)]),
        lambda o: F.struct(
            (F.col("block") * STEP + o).alias("at"),
            F.col("_of").alias("size"),
            ascii_lower(F.concat_ws(" ", F.slice(row, o + 1, F.col("_of")))).alias("gram"),
        ),
    )
    head = F.col("lead") & (F.coalesce("block", F.lit(0)) == 0)  # once for each row of docs
    spelled = found.select("id", "n_words", head.alias("head"), F.explode_outer(F.when(F.col("_key").isNotNull(), starts)).alias("g"))
    one = F.when(F.col("head") & (F.coalesce("g.at", F.lit(0)) == 0), 1).otherwise(0).alias("one")
    spelled = spelled.select("id", "n_words", one, "g.*")
    same = (F.col("gram") == F.col("_gram")) & (F.col("size") == F.col("_size"))
    same = same & (F.col("at") + F.col("size") <= F.col("n_words"))
    span = F.when(F.col("_gram").isNotNull(), F.struct("at", (F.col("at") + F.col("size")).alias("to")))
    return (
        spelled.join(exact, same, "left")
        .groupBy("id")
        .agg(
            F.sum("one").alias("n_rows"),
            F.max("n_words").alias("n_words"),
            F.sort_array(F.collect_set(span)).alias("spans"),
            F.collect_set("_gram").alias("grams"),
        )
    )


def covered(spans: Column) -> Column:
    """Number of words in the union of sorted spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))

    def add(seen, s):
        fresh = s["to"] - F.greatest(seen["end"], s["at"])
        return F.struct(
            (seen["n"] + F.greatest(fresh, F.lit(0))).alias("n"), F.greatest(seen["end"], s["to"]).alias("end")
        )

    return F.aggregate(spans, start, add, lambda seen: seen["n"])


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    share: int = SHARE,
) -> DataFrame:
    """Where documents repeat benchmark items: key, n_words, n_hit, n_items, items, contaminated, spans.

    A word is hit if it lies in any occurrence of an item's window; ``spans`` are those occurrences as
    word positions, so a caller may cut them out or drop the document. A document is contaminated if
    words are hit and make up one in ``share`` or more. Null and empty texts have no words and are
    clean; an empty benchmark hits nothing; items with equal texts all count; rows that repeat a document
    key are taken together, with the largest number of words; other columns are ignored.
    """
    return _judged(docs, benchmark, key, text, item, item_text, window, share).drop("n_rows")


def row_identity(key: str = "doc_id", text: str = "text") -> Column:
    """What tells a document from others that have its key: the key, null or not, and a hash of the text."""
    return F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("text"))


def contamination_of_rows(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``contamination``, but each row is a document of its own, also where rows repeat a key: one row for each."""
    rows = docs.select(row_identity(key, text).alias("id"), F.col(text).alias("text"))
    found = _judged(rows, benchmark, "id", "text", "item_id", "text", WINDOW, SHARE)
    each = found.withColumn("n_rows", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows")))).drop("n_rows")
    return each.withColumn("id", F.col("id.key")).withColumnRenamed("id", key)


def _judged(docs, benchmark, key, text, item, item_text, window, share) -> DataFrame:
    windows = written(item_windows(benchmark, item, item_text, window))
    per_doc = written(hits(docs, windows, key, text))
    marked = per_doc.filter(F.size("grams") > 0).select("id", F.explode("grams").alias("gram"))
    # A document has an item once, however many of its windows occur.
    named = marked.join(windows.select("gram", "item"), "gram").groupBy("id").agg(
        F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items")
    )
    named = named.withColumnRenamed("id", "_id")
    none = F.array().cast("array<string>")
    n_hit = covered(F.col("spans"))
    return (
        per_doc.join(named, F.col("id").eqNullSafe(F.col("_id")), "left")
        .select(
            F.col("id").alias(key),
            "n_rows",
            F.col("n_words").cast("long").alias("n_words"),
            n_hit.alias("n_hit"),
            F.coalesce("items", none).alias("items"),
            "spans",
        )
        .select(
            key,
            "n_rows",
            "n_words",
            "n_hit",
            F.size("items").cast("long").alias("n_items"),
            "items",
            ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
            "spans",
        )
    )
