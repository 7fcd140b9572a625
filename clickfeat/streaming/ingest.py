"""Incremental ingestion of raw CSV drops into the staging table.

A Structured Streaming file source tracks which files it has consumed in its
checkpoint, so each run picks up only new drops; ``availableNow`` drains the
backlog in bounded micro-batches and stops. Each row gets its source file
(``_metadata.file_path``) and the micro-batch's processing time.

Every file of the drop folder is read, whatever its ending (Spark skips names
that begin with . or _, and unpacks .gz and the like by their ending). The
stream itself only names new files; each micro-batch reads them as CSV by
their own headers, so drops may differ in the order and the set of their
columns. Headers are read by opening the files (a few KB of each), so the rows
themselves are scanned once.

The schema is stored beside the checkpoint, given explicitly or made of the
headers seen (all text): every widening publishes a further numbered file,
none is ever changed, and the one of the greatest number holds. A column that
a new drop brings is NULL for drops without it.

A micro-batch writes to a folder of its own number, so a batch that is run
again after a failure replaces its rows. ``compact`` swaps the folders of
committed batches for a few large files: a published manifest lists the
folders that hold, so that readers see every row once before, during and
after it.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clickfeat.sources.records import delete_folder, folder_bytes, folders, publish, published, read_bytes

SCHEMAS = "_stream_schema"
MANIFESTS = "_manifests"
BATCH = "ingest_batch"
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
MAX_FILES = 1000  # files of a micro-batch unless the caller says otherwise
OPENED = 16       # files opened at a time for their headers
HEADER_BYTES = 1 << 20
FILE_BYTES = 256 << 20  # of a compacted file, about
LINEAGE = (T.StructField("source_file", T.StringType()), T.StructField("processing_time", T.TimestampType()))


def _schemas(spark: SparkSession, checkpoint: str) -> list[str]:
    return [n for n in published(spark, f"{checkpoint}/{SCHEMAS}") if n.isdigit()]


def stored_schema(spark: SparkSession, checkpoint: str) -> T.StructType | None:
    """The schema of the greatest number; None before the first."""
    names = _schemas(spark, checkpoint)
    return T.StructType.fromJson(json.loads(read_bytes(spark, f"{checkpoint}/{SCHEMAS}/{names[-1]}"))) if names else None


def store_schema(spark: SparkSession, checkpoint: str, more: T.StructType) -> T.StructType:
    """Widen the stored schema by ``more``; the schema that holds then.

    Publishing fails if another writer took the number, whose schema is then widened instead.
    """
    while True:
        number = len(_schemas(spark, checkpoint)) + 1
        known = stored_schema(spark, checkpoint)
        wide = widened(known, more)
        if wide == known or publish(spark, f"{checkpoint}/{SCHEMAS}/{number:09d}", wide.json().encode()):
            return wide


def widened(schema: T.StructType | None, more: T.StructType) -> T.StructType:
    """``schema`` with the columns of ``more`` that it lacks."""
    have = list(schema.fields) if schema else []
    names = {f.name for f in have}
    return T.StructType([*have, *[f for f in more.fields if f.name not in names]])


def first_line(spark: SparkSession, file: str) -> str:
    """The first line of a file that is not blank ("" if none), read from its beginning only.

    The file is unpacked as its ending says. A line of over ``HEADER_BYTES``
    raises an error instead of being read on.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        reader = jvm.org.apache.hadoop.util.LineReader(codec.createInputStream(stream) if codec is not None else stream)
        line = jvm.org.apache.hadoop.io.Text()
        while True:
            got = reader.readLine(line, HEADER_BYTES, HEADER_BYTES)
            if got >= HEADER_BYTES:
                raise ValueError(f"no end of line in the first {HEADER_BYTES} bytes of {file}")
            text = line.toString().removeprefix("\ufeff")
            if got == 0 or text.strip():
                return text
    finally:
        stream.close()


def column_names(spark: SparkSession, line: str) -> tuple[str, ...]:
    """The columns that Spark's CSV reader makes of a header."""
    lines = getattr(spark.createDataFrame([(line,)], "value string")._jdf, "as")(
        spark.sparkContext._jvm.org.apache.spark.sql.Encoders.STRING())
    return tuple(spark._jsparkSession.read().option("header", True).csv(lines).columns())


def headers(spark: SparkSession, files: list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files by their header; files without a line are left out."""
    with ThreadPoolExecutor(OPENED) as pool:
        first = dict(zip(files, pool.map(lambda f: first_line(spark, f), files), strict=True))
    names = {line: column_names(spark, line) for line in set(first.values()) if line}
    out: dict[tuple[str, ...], list[str]] = {}
    for f in sorted(files):
        if first[f]:
            out.setdefault(names[first[f]], []).append(f)
    return out


def read_drops(spark: SparkSession, files: list[str], schema: T.StructType | None) -> tuple[DataFrame | None, T.StructType | None]:
    """The rows of CSV ``files`` with lineage, columns matched by header name; the widened schema.

    No rows (None) if no file holds a line.
    """
    groups = headers(spark, files)
    if not groups:
        return None, schema
    for names in groups:
        schema = widened(schema, T.StructType([T.StructField(n, T.StringType()) for n in names]))
    kinds = {f.name: f.dataType for f in schema.fields}
    out = None
    for names, own in groups.items():
        rows = spark.read.option("header", True) \
            .schema(T.StructType([T.StructField(n, kinds[n]) for n in names])).csv(own)
        rows = rows.select(
            *[F.col(f"`{f.name}`") if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields],
            F.col("_metadata.file_path").alias("source_file"))
        out = rows if out is None else out.union(rows)
    return out, schema


def ingest(spark: SparkSession, raw_path: str, staging_path: str, checkpoint: str,
           schema: T.StructType | None = None,
           max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Drain every new drop into ``staging_path`` and wait for the end.

    Exactly-once per file through the checkpoint; rerunning with no new
    files appends nothing. Waiting (Q10) means the next batch step never
    reads a half-written staging table. Columns of ``schema`` that are not
    stored yet are added with their types.
    """
    if schema is not None:
        store_schema(spark, checkpoint, schema)

    def write(batch: DataFrame, number: int) -> None:
        # At most the files of one micro-batch.
        files = [r["path"] for r in batch.select("path").collect()]
        rows, wide = read_drops(spark, files, stored_schema(spark, checkpoint))
        if rows is None:
            return
        store_schema(spark, checkpoint, wide)
        rows.withColumn("processing_time", F.current_timestamp()) \
            .write.mode("overwrite").parquet(f"{staging_path}/{BATCH}={number}")

    names = spark.readStream.format("binaryFile").schema(FILE_SCHEMA) \
        .option("maxFilesPerTrigger", max_files_per_trigger or MAX_FILES) \
        .load(raw_path).select("path")       # the contents are not read here
    query = (names.writeStream.foreachBatch(write)
             .option("checkpointLocation", f"{checkpoint}/stream")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def _batches(spark: SparkSession, staging_path: str) -> dict[int, str]:
    """The folders of micro-batches by number."""
    return {int(n.removeprefix(f"{BATCH}=")): n for n in folders(spark, staging_path) if n.startswith(f"{BATCH}=")}


def manifest(spark: SparkSession, staging_path: str) -> dict:
    """What the newest compaction says: ``folders`` of large files, which hold all batches up to ``upto``."""
    names = published(spark, f"{staging_path}/{MANIFESTS}")
    if not names:
        return {"folders": [], "upto": -1}
    return json.loads(read_bytes(spark, f"{staging_path}/{MANIFESTS}/{names[-1]}"))


def live_folders(spark: SparkSession, staging_path: str) -> list[str]:
    """The folders whose rows are the staging table: the compacted ones, then the batches after them."""
    held = manifest(spark, staging_path)
    later = sorted((k, n) for k, n in _batches(spark, staging_path).items() if k > held["upto"])
    return [*held["folders"], *(n for _, n in later)]


def _rows(spark: SparkSession, staging_path: str, checkpoint: str, names: list[str]) -> DataFrame:
    schema = T.StructType([*(stored_schema(spark, checkpoint) or T.StructType()).fields, *LINEAGE])
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{staging_path}/{n}" for n in names])


def read_staging(spark: SparkSession, staging_path: str, checkpoint: str) -> DataFrame:
    """All staged rows with the stored schema (no footers merged); absent columns are NULL."""
    return _rows(spark, staging_path, checkpoint, live_folders(spark, staging_path))


def compact(spark: SparkSession, staging_path: str, checkpoint: str, file_bytes: int = FILE_BYTES) -> int:
    """Swap the folders of committed micro-batches for files of about ``file_bytes``; the batches swapped.

    The rows are written to a new folder first; publishing the manifest that
    names it is the one step that swaps them, and it fails (without effect)
    if another compaction published first. Only batches that the stream has
    committed are taken, which it never runs again. The folders that a
    manifest replaces stay for readers that have begun; the next compaction
    deletes them.
    """
    names = published(spark, f"{staging_path}/{MANIFESTS}")
    held = manifest(spark, staging_path)
    for k, n in _batches(spark, staging_path).items():
        if k <= held["upto"]:
            delete_folder(spark, f"{staging_path}/{n}")
    committed = max((int(n) for n in published(spark, f"{checkpoint}/stream/commits") if n.isdigit()), default=-1)
    taken = sorted((k, n) for k, n in _batches(spark, staging_path).items() if held["upto"] < k <= committed)
    if not taken:
        return 0
    own = f"compacted-{len(names) + 1:09d}-{uuid.uuid4()}"
    files = -(-sum(folder_bytes(spark, f"{staging_path}/{n}") for _, n in taken) // file_bytes)
    _rows(spark, staging_path, checkpoint, [n for _, n in taken]).coalesce(max(1, files)) \
        .write.parquet(f"{staging_path}/{own}")
    now = {"folders": [*held["folders"], own], "upto": taken[-1][0]}
    if not publish(spark, f"{staging_path}/{MANIFESTS}/{len(names) + 1:09d}", json.dumps(now).encode()):
        delete_folder(spark, f"{staging_path}/{own}")
        return 0
    return len(taken)
