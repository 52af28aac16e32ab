"""Reading and writing delimited text."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerloom.sources.schemas import RAW_SCHEMAS

_FILES_A_TASK = 100
#: Packings whose streams Hadoop alone is sure to read.
_OTHER_CODECS = (".deflate", ".snappy", ".lz4", ".lzo", ".zst")


def _first_line(spark: SparkSession, path) -> str:
    """First line of a file, unpacked if its name says how; nothing else is read."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        plain = codec.createInputStream(stream) if codec is not None else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def _opened(name: str) -> pa.NativeFile | None:
    """A file as a task can open it; None if its file system or packing is left to the driver."""
    if name.rsplit("/", 1)[-1].lower().endswith(_OTHER_CODECS):
        return None
    try:
        files, path = pa.fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", name))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, ImportError):
        return None
    return files.open_input_stream(path, compression="gzip" if path.endswith(".gz") else "bz2" if path.endswith(".bz2") else None)


def _line_of(stream: pa.NativeFile) -> str:
    read = []
    while data := stream.read(1 << 16):
        read.append(data)
        if b"\n" in data or b"\r" in data:
            break
    return re.split(rb"[\r\n]", b"".join(read), maxsplit=1)[0].decode("utf-8", "replace")


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines: list[str | None] = []
        for name in batch.column("file").to_pylist():
            stream = _opened(name)
            if stream is None:
                lines.append(None)
                continue
            with stream:
                lines.append(_line_of(stream))
        yield pa.RecordBatch.from_pydict({"file": batch.column("file"), "line": pa.array(lines, pa.string())})


def _files_by_first_line(spark: SparkSession, names: list[str]) -> list[tuple[str, list[str]]]:
    """First lines and the files that begin with each; of many files they are read in tasks.

    A line comes back once, whatever the number of its files. What tasks can't open (a file system that
    pyarrow does not know, a codec of Hadoop alone) is opened by the driver, file by file.
    """
    by_line: dict[str, list[str]] = {}
    left = names
    if len(names) > 1:
        tasks = min(len(names), max(spark.sparkContext.defaultParallelism, len(names) // _FILES_A_TASK))
        files = spark.createDataFrame([(name,) for name in names], "file string").repartition(tasks)
        lines = files.mapInArrow(_first_lines, "file string, line string").groupBy("line").agg(F.collect_list("file").alias("files"))
        read = {row.line: row.files for row in lines.collect()}
        left = read.pop(None, [])
        by_line.update(read)
    for name in left:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        by_line.setdefault(_first_line(spark, path), []).append(name)
    return sorted(((line, sorted(files)) for line, files in by_line.items()), key=lambda entry: entry[1])


def _files_by_header(spark: SparkSession, path: str, sep: str) -> dict[tuple[str, ...], list[str]]:
    """The files of a table by their header line; empty files have none and are left out."""
    found: dict[tuple[str, ...], list[str]] = {}
    for line, files in _files_by_first_line(spark, sorted(spark.read.text(path).inputFiles())):
        line = line.lstrip("\ufeff")
        if line:
            header = tuple(next(csv.reader([line], delimiter=sep)))
            found.setdefault(header, []).extend(_decoded(spark, name) for name in files)
    return found


def _decoded(spark: SparkSession, name: str) -> str:
    """The path that a file's address stands for; only an escaped one needs the JVM."""
    if "%" not in name:
        return name
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name)).toString()


def read_delimited(spark: SparkSession, path: str, schema: StructType, sep: str = ";") -> DataFrame:
    """Read a headed, optionally quoted text table, one file or a folder of parts, with declared types.

    Every file is bound by its own header, so parts may differ in the order of columns and in columns
    that are not declared; one that lacks a declared column is an error. An empty field is NULL, a
    field of blanks keeps its blanks, and a value that does not fit its type aborts the read. Only the
    header lines are looked at up front; nothing is inferred. A table without any header has no rows.
    """
    declared = {field.name.lower(): field for field in schema.fields}
    parts = []
    for header, files in _files_by_header(spark, path, sep).items():
        by_name = {name.strip().lower(): name for name in header}
        if missing := declared.keys() - by_name.keys():
            raise ValueError(f"{files[0]} lacks the columns {sorted(missing)}")
        in_file_order = StructType(
            [
                StructField(name, declared[name.strip().lower()].dataType if name.strip().lower() in declared else StringType(), True)
                for name in header
            ]
        )
        rows = spark.read.options(sep=sep, header=True, quote='"', mode="FAILFAST", nullValue="", enforceSchema=True)
        rows = rows.schema(in_file_order).csv(files)
        parts.append(rows.select(*[F.col(f"`{by_name[f.name.lower()]}`").alias(f.name) for f in schema.fields]))
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], schema)


def write_delimited(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """Write a headed text copy in parallel parts; blanks stay as they are, NULL becomes empty."""
    df.write.mode(mode).options(
        sep=sep,
        header=True,
        emptyValue="",
        nullValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)


def locate_input(spark: SparkSession, given: str | None, candidates: Iterable[str] = ()) -> str:
    """The folder with the raw files: the given one, else the first candidate holding the transactions."""
    if given:
        return given.rstrip("/")
    tried = []
    for folder in candidates:
        tried.append(folder)
        try:
            spark.read.schema(RAW_SCHEMAS["trans"]).csv(f"{folder.rstrip('/')}/trans.asc")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        return folder.rstrip("/")
    raise FileNotFoundError(f"no folder with trans.asc was given or found; looked in {tried}")


def read_raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All eight raw tables of the bank from ``<folder>/<table>.asc``."""
    return {name: read_delimited(spark, f"{folder}/{name}.asc", schema) for name, schema in RAW_SCHEMAS.items()}
