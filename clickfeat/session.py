"""Session settings the library relies on, and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every entry point pins on the session it is given. They are
# runtime SQL confs, so they can be set on an existing session.
SQL_CONFS = {
    # Q5: day boundaries (date_add, date_trunc) are taken in UTC.
    "spark.sql.session.timeZone": "UTC",
    # AQE: runtime broadcast of small join sides (from measured shuffle
    # sizes), skew-join splitting of hot join keys, partition coalescing.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the SQL confs the library's semantics depend on."""
    for key, value in SQL_CONFS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "clickfeat") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CLICKFEAT_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Small local inputs: let AQE keep a few partitions per stage instead
        # of coalescing each to one task (cluster runs keep the 1 MB default).
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
    )
    for key, value in SQL_CONFS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def work_dir(spark: SparkSession) -> str:
    """The shared folder for tables, checkpoints and models.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (a
    shared file system every executor sees); without one this raises, since a
    machine-local folder would lose the tables. Only a local master, as in
    tests, gets a fresh folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[.*)?$", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="clickfeat-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused sub-folder of the work folder for one run."""
    return f"{work_dir(spark).rstrip('/')}/{name}-{uuid.uuid4()}"
