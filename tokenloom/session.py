"""Session helpers."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Bytes of an Arrow batch on its way to Python.
BATCH_BYTES = 4 << 20


def local_session(cores: int | str = 8, **settings: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tokenloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TOKENLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def runs_in_one_process(spark: SparkSession) -> bool:
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def names_shared_folder(spark: SparkSession) -> bool:
    """Whether a checkpoint folder is set, or may be made because all tasks run in this process."""
    context = spark.sparkContext
    named = context._jsc.sc().getCheckpointDir().nonEmpty() or context.getConf().get("spark.checkpoint.dir") is not None
    return named or runs_in_one_process(spark)


def shared_folder(spark: SparkSession) -> str:
    """URI of this session's checkpoint folder, which all executors share.

    It lies in the folder ``spark.checkpoint.dir`` names.  Only a session that
    runs in one process and names none gets a temporary one, removed at exit.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not runs_in_one_process(spark):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="tokenloom-checkpoint-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return re.sub("^file:/(?!/)", "file:///", context._jsc.sc().getCheckpointDir().get())


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def settled_if_possible(df: DataFrame) -> DataFrame:
    """:func:`settled`; on a cluster that names no folder ``df`` as it is, computed by each use."""
    return settled(df) if names_shared_folder(df.sparkSession) else df


def in_small_batches(spark: SparkSession) -> None:
    """From now on this session sends rows to Python in batches of ``BATCH_BYTES`` or one row; a smaller bound stays.

    Spark's own bound is 64 MB.  Vectors grow to it by doubling, in every task at
    once, and an executor keeps much of what they leave outside its heap.  The
    bound changes no result.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if not 0 < in_bytes(spark.conf.get(name)) <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))
