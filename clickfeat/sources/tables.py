"""Catalog tables at explicit paths.

A refresh never touches the rows that readers see. It writes a numbered folder
under the table's path, publishes that number (sources/records.py), and then
points the catalog at the folder. A refresh that fails on the way leaves the
old rows readable, by name and by path, and no reader sees an empty or
half-written table. The folder before the present one stays for scans that
have begun; older ones are deleted.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from clickfeat.sources.records import delete_folder, folders, publish, published, read_bytes

REFRESHES = "_refreshes"   # published numbers, each with its folder's name
KEPT = 2                   # folders that stay after a refresh
FILE_FORMATS = ("parquet", "orc", "json", "csv")


def write_table(df: DataFrame, name: str, path: str, fmt: str = "parquet") -> str:
    """Full refresh of an external catalog table at ``path`` (schema may change); the folder that holds it.

    Each table is written from other tables only, never from itself (H9).
    Of two refreshes at once the later to publish holds. A format with its own
    transaction log is overwritten in place, which is atomic there.
    """
    if fmt not in FILE_FORMATS:
        df.write.mode("overwrite").format(fmt).option("overwriteSchema", "true").option("path", path).saveAsTable(name)
        return path
    spark = df.sparkSession
    own = f"rows-{uuid.uuid4()}"
    df.write.format(fmt).save(f"{path}/{own}")
    number = len(published(spark, f"{path}/{REFRESHES}")) + 1
    while not publish(spark, f"{path}/{REFRESHES}/{number:09d}", own.encode()):
        number += 1
    _point(spark, name, f"{path}/{own}", fmt)
    _tidy(spark, path)
    return f"{path}/{own}"


def table_folder(spark: SparkSession, path: str) -> str:
    """The folder that holds the rows of the table written at ``path``."""
    numbers = published(spark, f"{path}/{REFRESHES}")
    if not numbers:
        raise FileNotFoundError(f"no table at {path}")
    return f"{path}/{read_bytes(spark, f'{path}/{REFRESHES}/{numbers[-1]}').decode()}"


def _point(spark: SparkSession, name: str, folder: str, fmt: str) -> None:
    """Make the catalog table ``name`` read ``folder``.

    Columns that were added come first, where the old rows are NULL, then
    the location moves in one step. Only a table whose columns were taken away or
    changed their type is made anew under another name that replaces it.
    """
    new = spark.read.format(fmt).load(folder).schema
    shape = lambda fields: [(f.name, f.dataType) for f in fields]
    if spark.catalog.tableExists(name):
        old = spark.table(name).schema
        if shape(new)[:len(old)] == shape(old):
            more = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new.fields[len(old):])
            if more:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({more})")
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(name)
            return
        fresh = f"{name}_{uuid.uuid4().hex}"
        spark.catalog.createTable(fresh, folder, fmt)
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
        return
    spark.catalog.createTable(name, folder, fmt)


def _tidy(spark: SparkSession, path: str) -> None:
    """Delete the folders of refreshes before the last ``KEPT``.

    A folder that no number names may be another refresh's that is being
    written, and stays.
    """
    numbers = published(spark, f"{path}/{REFRESHES}")
    there = set(folders(spark, path))
    for n in numbers[:-KEPT][-8 * KEPT:]:
        own = read_bytes(spark, f"{path}/{REFRESHES}/{n}").decode()
        if own in there:
            delete_folder(spark, f"{path}/{own}")


def materialize(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as parquet at ``path`` (a shared folder) and scan it back.

    Cuts the lineage: later plans read the files (column pruning, pushed
    filters, real statistics) instead of recomputing, and a lost executor
    costs a re-read, not a recomputation.
    """
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog scan by name."""
    return spark.table(name)
