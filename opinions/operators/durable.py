"""Results that several later jobs read."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="opinions-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return "file://" + folder


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. A local session without that setting uses a folder of its own, which goes
    when the process ends; a cluster needs the setting, as its executors share no local folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return (folder or _own_folder()).rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """Compute ``df`` once for many readers.

    The result is written to the shared folder and survives lost executors. Nothing stays in executors' memory.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
