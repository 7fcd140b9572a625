"""Small write-once files that several writers may publish at once.

A published file is complete from the moment it can be seen, and no two
writers can publish one name: the bytes go to a hidden file of the writer's
own, which then takes the name in one step that fails where the name exists.
That step is a rename on HDFS-like file systems (which refuse an existing
target) and a hard link on local ones (whose rename would replace it).

Tables of records are folders of such files, one Parquet file a record, so
simultaneous writers share no commit folder and a reader sees whole records
only. Names that begin with a dot are skipped by every Spark reader.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def _located(spark: SparkSession, path: str):
    """The file system of ``path``, and the path with its scheme."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(hpath)


def publish(spark: SparkSession, path: str, data: bytes = b"") -> bool:
    """Make the file ``path`` with ``data``; False, and no change, if it exists already."""
    jvm = spark.sparkContext._jvm
    fs, final = _located(spark, path)
    own = jvm.org.apache.hadoop.fs.Path(final.getParent(), f".{uuid.uuid4()}")
    out = fs.create(own, False)            # makes the folder too
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    try:
        if final.toUri().getScheme() != "file":
            return not fs.exists(final) and bool(fs.rename(own, final))
        nio = jvm.java.nio.file
        nio.Files.createLink(nio.Paths.get(final.toUri()), nio.Paths.get(own.toUri()))
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(own, False)


def published(spark: SparkSession, folder: str) -> list[str]:
    """The names of the files published in ``folder``, in order; none if there is no folder."""
    fs, path = _located(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(path)) if n[0] not in "._")


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """The contents of one small file."""
    fs, found = _located(spark, path)
    stream = fs.open(found)
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()


def add_record(spark: SparkSession, folder: str, name: str, row: tuple, schema: T.StructType) -> bool:
    """Publish one row as the file ``name`` of a table of records; False if it is there already."""
    arrow = to_arrow_schema(schema)
    table = pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow, strict=True)], schema=arrow)
    sink = pa.BufferOutputStream()
    pq.write_table(table, sink)
    return publish(spark, f"{folder}/{name}.parquet", sink.getvalue().to_pybytes())


def records(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All records of a table; none if nothing was published."""
    if published(spark, folder):
        return spark.read.schema(schema).parquet(folder)
    return spark.createDataFrame([], schema)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in ``path``, in order; none if it does not exist."""
    fs, found = _located(spark, path)
    if not fs.exists(found):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(found) if s.isDirectory())


def folder_bytes(spark: SparkSession, path: str) -> int:
    """The size of all files under ``path``."""
    fs, found = _located(spark, path)
    return int(fs.getContentSummary(found).getLength())


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, found = _located(spark, path)
    fs.delete(found, True)
