"""Readers and writers."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinions.operators.durable import durable
from opinions.operators.joins import fits_broadcast
from opinions.rules import REGION_CODES, REGION_WITHOUT_ROW

#: Pieces of an input that counts as small.
SMALL_PIECES = 4
#: Characters of text in a task of ``in_small_tasks``.
TASK_CHARS = 1 << 24
#: Characters of text in a task of ``gathered``.
GROUP_CHARS = 1 << 22


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    columns: Mapping[str, str] | None = None,
    corrupt: str = "_corrupt",
    split: bool = False,
) -> DataFrame:
    """CSV with a header and line breaks inside quoted fields, read by the names in the header.

    ``columns`` maps columns of ``schema`` to names in the file; others have their own name. Order does not
    matter, further columns are ignored, absent ones are null, and values that don't fit their type
    are null. Lines that do not fit the header keep their text in ``corrupt``. Files of one path whose headers
    differ raise an error. Spark reads a file with multi-line fields in one task; with ``split`` many tasks read it
    (``csv_records``), to the same rows.
    """
    reader = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt)
        .option("enforceSchema", False)  # compare each file's header with the names
    )
    names = reader.csv(path).columns
    strings = T.StructType([T.StructField(n, T.StringType()) for n in (*names, corrupt)])
    if split:
        ddl = ", ".join(f"`{n}` string" for n in strings.fieldNames())
        parsed = F.from_csv("record", ddl, _CSV | {"columnNameOfCorruptRecord": corrupt})
        rows = csv_records(spark, path, names).select(parsed.alias("r")).select("r.*")
    else:
        rows = reader.schema(strings).csv(path)
    source = dict(columns or {})

    def column(field: T.StructField) -> Column:
        name = source.get(field.name, field.name)
        found = rows[f"`{name}`"] if name in names else F.lit(None).cast("string")
        return found.try_cast(field.dataType).alias(field.name)

    return rows.select(*[column(f) for f in schema.fields], corrupt)


_CSV = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}


def csv_records(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """record: the CSV records of the files at ``path`` without their headers, read in pieces of files.

    A line break is inside a field if the quotes before it are odd in number. A first scan counts each piece's quotes, which
    tells whether a piece begins inside a field: a row a piece comes to the driver. The second cuts each piece into
    records; only records that lie across pieces are put together by a shuffle.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("piece"), "value"
    )
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    inside: set[tuple[str, int]] = set()
    last, state = None, 0
    for r in lines.groupBy("file", "piece").agg((F.sum(odd) % 2).alias("odd")).orderBy("file", "piece").collect():
        state = state if r["file"] == last else 0
        if state:
            inside.add((r["file"], r["piece"]))
        last, state = r["file"], (state + r["odd"]) % 2

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, held, begun = None, [], 0  # the piece, lines of the record at hand, and whether it began in this piece
        names = ["file", "piece", "kind", "record"]

        def batch_of(rows):
            return pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=_CUT)

        for batch in batches:
            rows = []
            for file, piece, value in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, piece) != here:
                    if held:
                        rows.append((*here, 2 if begun else 1, "\n".join(held)))
                    here, held, begun = (file, piece), [], (file, piece) not in inside
                    open_quote, top = not begun, piece == 0
                held.append(value)
                open_quote ^= value.count('"') % 2
                if not open_quote:
                    rows.append((file, piece, 4 if top else 3 if begun else 0, "\n".join(held)))
                    held, begun, top = [], True, False
            yield batch_of(rows)
        if held:
            yield batch_of([(*here, 2 if begun else 1, "\n".join(held))])

    # Kinds: 0 ends a record of earlier pieces, 1 goes on with it, 2 begins one, 3 is a whole one, 4 a file's header.
    found = lines.mapInArrow(cut, "file string, piece long, kind int, record string")
    order = Window.partitionBy("file").orderBy("piece", "kind")
    parts = found.filter("kind < 3").withColumn("_n", F.count_if(F.col("kind") == 2).over(order))
    held = parts.groupBy("file", "_n").agg(F.sort_array(F.collect_list(F.struct("piece", "kind", "record"))).alias("p"))
    across = held.select(F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"))
    line = F.regexp_replace("record", "\r$", "")
    cells = F.from_csv(line, ", ".join(f"c{i} string" for i in range(len(names))), _CSV)
    same = F.array(*[cells[f"c{i}"] for i in range(len(names))]) == F.array(*[F.lit(n) for n in names])
    wrong = F.raise_error(F.concat(F.lit("the header is not that of the other files: "), F.col("file"))).cast("boolean")
    data = F.when(F.col("kind") < 4, True).when(same, False).otherwise(wrong)
    whole = found.filter("kind > 2").filter(data).select("record")
    return whole.unionByName(across).select(line.alias("record")).filter("record <> ''")


_CUT = pa.schema([("file", pa.string()), ("piece", pa.int64()), ("kind", pa.int32()), ("record", pa.string())])


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def spread(df: DataFrame, parts: int, *keys: str) -> DataFrame:
    """Redistribute rows over ``parts`` tasks; by a row key, so that a rerun places them alike."""
    return df.repartition(parts, *keys)


def fill_cluster(df: DataFrame, *keys: str) -> DataFrame:
    """Spread an input that is too small to be scanned by many tasks; any other is left alone.

    A scan piece holds ``spark.sql.files.maxPartitionBytes`` at most, or one row group, so what is moved is bounded
    by SMALL_PIECES of them, however many cores there are. A larger input is never shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    pieces = df.rdd.getNumPartitions()
    return spread(df, cores, *keys) if pieces < min(cores, SMALL_PIECES + 1) else df


def in_small_tasks(df: DataFrame, text: str, *keys: str, chars: int = TASK_CHARS) -> DataFrame:
    """``df`` in tasks of about ``chars`` characters of text, for steps whose memory grows with the texts of a task.

    The number is measured. Where the scan's pieces are no larger, nothing moves; else each row moves once, by its keys and
    text, so that a key many rows share fills no task.
    """
    sizes = df.groupBy(F.spark_partition_id().alias("_p")).agg(F.sum(F.length(text)).alias("_n"))
    whole, most = sizes.agg(F.sum("_n"), F.max("_n")).first()
    if (most or 0) <= 2 * chars:
        return df
    return spread(df, -(-whole // chars), *keys, text)


def gathered(df: DataFrame, text: str, *keys: str, chars: int = GROUP_CHARS) -> DataFrame:
    """``df`` in tasks of about ``chars`` characters of text, with the rows of a key in one task.

    Groups of these keys and further columns are then made without another shuffle, so a text moves instead of all that is made
    of it. The number of tasks is measured; the keys should be of few rows each.
    """
    whole = df.agg(F.sum(F.length(text))).first()[0] or 0
    return spread(df, max(1, -(-whole // chars)), *keys)


def write_scored(df: DataFrame, path: str, by: str = "subject", mode: str = "overwrite", rows_per_file: int = 2_000_000) -> None:
    """Write rows in a folder for each value of ``by``, in files of about ``rows_per_file`` rows.

    Only folders of values that ``df`` holds are replaced, so writing one subject again leaves the others. A value's rows are dealt
    to as many tasks as it fills files, by a hash of the row, so a hot value is no task's alone and no value leaves a
    file per task.
    """
    rows = durable(df)
    counts = rows.groupBy(by).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("_files"))
    files = counts.agg(F.sum("_files")).first()[0] or 1
    counts = counts.withColumnRenamed(by, "_by")
    dealt = rows.join(F.broadcast(counts) if fits_broadcast(counts) else counts, F.col(by).eqNullSafe(F.col("_by")))
    dealt = dealt.withColumn("_file", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), "_files"))
    dealt = dealt.repartition(int(files), by, "_file").drop("_by", "_files", "_file")
    dealt.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> None:
    """Table clustered by a text key: later per-text sums and joins on it need no shuffle."""
    out = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (out.option("path", path) if path else out).saveAsTable(table)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """token, valence from lines ``token TAB valence TAB ...``; the last line of a token counts."""
    lines = spark.read.text(path, wholetext=False).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        # Pieces of a file in its order, then lines in the order of their piece.
        F.col("_metadata.file_block_start").alias("piece"),
        F.monotonically_increasing_id().alias("line"),
    )
    cells = F.split(F.trim("value"), "\t")
    parsed = lines.select(
        F.get(cells, F.lit(0)).alias("token"),
        F.get(cells, F.lit(1)).try_cast("double").alias("valence"),
        "file",
        "piece",
        "line",
    ).filter("token <> '' AND valence IS NOT NULL")
    last = Window.partitionBy("token").orderBy(F.desc("file"), F.desc("piece"), F.desc("line"))
    return parsed.withColumn("_rn", F.row_number().over(last)).filter("_rn = 1").select("token", "valence")


def stopword_table(spark: SparkSession, words: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(w,) for w in words], "token string")


def region_table(spark: SparkSession) -> DataFrame:
    """region, region_code of the 51 coded regions."""
    return spark.createDataFrame(list(REGION_CODES.items()), "region string, region_code string")


def region_spine(spark: SparkSession) -> DataFrame:
    """The 50 regions of the dense scoreboard."""
    return region_table(spark).filter(F.col("region") != REGION_WITHOUT_ROW)


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """A fixed number of rows in key order."""
    return df.orderBy(*order).limit(n)
