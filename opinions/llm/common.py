"""What several operators share: the shared folder, hidden column names and ranks without a task per group."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinions.operators.shipping import shipped  # noqa: F401

#: Parts that a group's rows are ranked in; a group of n rows costs its largest task about n / RANK_PARTS rows.
RANK_PARTS = 1024
#: Parts that rows which are alike in every column may spread over.
ALIKE_PARTS = 64
#: Bytes of text that are worked on together.
GROUP = 1_000_000


@functools.cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="opinions-llm-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return "file://" + folder


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``. A local session that names none
    (tests, a laptop) gets a folder of its own; on a cluster a missing setting is an error, because a
    machine's own folder is lost with the machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _own_folder()


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result no longer depends on any executor, and the planner knows its true size, so a join with
    it is broadcast only below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = f"{_application_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/opinions-llm/{spark.sparkContext.applicationId}"


def forget(spark: SparkSession) -> None:
    """Delete all that this application has written with ``written``, once its results are stored elsewhere."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: What a Python worker remembers between tasks.
REMEMBERED: list = []


def tidy() -> None:
    """Free what other operators' tasks have left in this Python worker, which Spark uses again and again."""
    for table in REMEMBERED:
        table.clear()
    pa.default_memory_pool().release_unused()


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _parted(df: DataFrame, parts: int) -> DataFrame:
    """Different rows with their number ``_n`` and part ``_part``; rows that are alike stand in ALIKE_PARTS parts at most."""
    columns = df.columns
    alike = df.withColumn("_alike", F.spark_partition_id() % ALIKE_PARTS)
    counted = alike.groupBy(*columns, "_alike").agg(F.count(F.lit(1)).alias("_n"))
    return counted.withColumn("_part", F.pmod(F.xxhash64(*columns, "_alike"), F.lit(parts)).cast("int"))


def with_rank(
    df: DataFrame, group: Sequence[str], key: Sequence[str], name: str, parts: int = RANK_PARTS
) -> DataFrame:
    """Add a gapless rank from 0 within each group, as ``name``.

    A window over whole groups would put a hot group in one task. Here every group is cut into parts by a
    hash of all columns; rows are ranked within their part by ``key``, then by all other columns, and each part starts where
    the counts of the earlier parts end. Only the counts (at most ``parts`` rows a group) are ordered group by group.
    Rows that are alike in every column are counted where they are read and get a run of ranks, so a key that many rows
    share fills no part, and a task that runs again deals the same ranks.
    """
    columns = df.columns
    part = _parted(df, parts)
    counts = part.groupBy(*group, "_part").agg(F.sum("_n").alias("_count"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*group, "_part", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_start"))
    order = [*key, *[c for c in columns if c not in key], "_alike"]
    local = Window.partitionBy(*group, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = part.withColumn("_local", F.coalesce(F.sum("_n").over(local), F.lit(0)))
    placed = ranked.join(starts, [*group, "_part"]).withColumn("_first", F.col("_start") + F.col("_local"))
    return placed.select(*columns, F.explode(F.sequence("_first", F.col("_first") + F.col("_n") - 1)).alias(name))


def grouped(texts: Iterable, weight: int = GROUP) -> Iterator[list]:
    """Runs of texts of about ``weight`` bytes; a longer text is a run of its own."""
    run, size = [], 0
    for t in texts:
        run.append(t or b"")
        size += len(run[-1])
        if size >= weight:
            yield run
            run, size = [], 0
    if run:
        yield run


def _byte_letters() -> dict[int, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in own]
    return {b: 256 + i for i, b in enumerate(others)}


BYTES = _byte_letters()


def about(df: DataFrame, key: str, n: int) -> DataFrame:
    """Some ``n`` rows of ``df``, all if it has no more: those whose key's hash is below a bound; the same in every run."""
    rows, steps = df.count(), 1 << 24
    return df if rows <= n else df.filter(F.pmod(F.xxhash64(key), F.lit(steps)) < n * steps // rows)


def sampled(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows that are least by a hash of their key, or fewer; of a large table only some 8 n are ordered."""
    return about(df, key, 8 * n).orderBy(F.pmod(F.xxhash64(key), F.lit(1 << 24)), key).limit(n)
