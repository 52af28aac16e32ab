"""Parquet tables written once and read many times."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager, nullcontext

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.session import shared_dir


_CURRENT = "_CURRENT"

#: Folders that one task of a partitioned write fills side by side; rows of any more are sorted by folder.
_OPEN_FOLDERS = 32
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_writing = threading.Lock()


def _hadoop(spark: SparkSession, path: str):
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(conf), conf


def current_version(spark: SparkSession, path: str) -> str | None:
    """Name of the folder that holds a table's rows now; None if it was never written."""
    place, files, _ = _hadoop(spark, f"{path}/{_CURRENT}")
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()


def _point_to(spark: SparkSession, path: str, version: str) -> None:
    """Make a version the current one: a file of one line is written aside and moved over the old one."""
    aside, files, conf = _hadoop(spark, f"{path}/{_CURRENT}-{uuid.uuid4().hex}")
    stream = files.create(aside)
    try:
        stream.write(bytearray(version.encode()))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    replace = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    replace[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(aside.toUri(), conf).rename(aside, hadoop.Path(f"{path}/{_CURRENT}"), replace)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the table's current version."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no table was written to {path}")
    return spark.read.parquet(f"{path}/{version}")


@contextmanager
def _open_folders(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes within it keep a file open per folder.

    By default a task sorts all its rows by folder to have one file open at a time, which spills once
    they outgrow its memory. A number set on the session is left alone.
    """
    with _writing:
        if int(spark.conf.get(_WRITERS)) > 0:
            yield
            return
        spark.conf.set(_WRITERS, str(_OPEN_FOLDERS))
        try:
            yield
        finally:
            spark.conf.unset(_WRITERS)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace the table at ``path`` and return it read back; ``partition_by`` are its last columns.

    The rows are written to a folder of their own, and a small pointer is moved to it last: until
    then, and after a failed write, readers get the old rows. The version before stays for readers
    that have begun; older ones are deleted. What is read back has real file sizes, so later joins are
    planned on those.
    """
    spark = df.sparkSession
    before = current_version(spark, path)
    version = f"v-{uuid.uuid4().hex}"
    with _open_folders(spark) if partition_by else nullcontext():
        df.write.partitionBy(*partition_by).parquet(f"{path}/{version}")
    _point_to(spark, path, version)
    folder, files, _ = _hadoop(spark, path)
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("v-") and name not in (version, before):
            files.delete(status.getPath(), True)
    return spark.read.schema(df.schema).parquet(f"{path}/{version}")


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> DataFrame:
    """Put rows into the current version of a partitioned table and return the whole table.

    Only the partitions that ``df`` has rows for are written, in place of what they held before, so a
    repeated run changes nothing. They are moved into place when all have been written.
    """
    spark = df.sparkSession
    place = f"{path}/{current_version(spark, path)}"
    if place.endswith("/None"):
        raise FileNotFoundError(f"no table was written to {path}")
    with _open_folders(spark):
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(place)
    return spark.read.schema(df.schema).parquet(place)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the shared folder and continue from the files.

    Cuts the lineage and freezes the rows, so a lost executor cannot change row placement. The
    application's folder can be deleted when it has ended.
    """
    spark = df.sparkSession
    path = f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def run_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"


def in_parallel(actions: list[Callable[[], object]], at_once: int = 8) -> None:
    """Run independent Spark actions side by side, so that small ones do not queue behind large ones.

    They keep the caller's local properties, such as its job group. The first error is raised once all
    have ended.
    """
    spark = SparkSession.active()
    with ThreadPoolExecutor(at_once) as pool:
        # One wrapper for each action: it holds the copy of the properties that the action changes.
        for done in [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]:
            done.result()
