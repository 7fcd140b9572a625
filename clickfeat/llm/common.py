"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfeat.session import fresh_dir, prepare

# A word is a maximal run of anything but the six ASCII white-space characters.
# On bytes, lower() changes A-Z only and split() cuts at exactly those six.
WORDS_SQL = r"[^\x20\x09-\x0D]+"

# Rows an Arrow batch may hold: documents can be long, so batches stay short.
BATCH_ROWS = "1000"


def words(text: bytes | None) -> list[bytes]:
    """The lower-cased words of a UTF-8 text; none for NULL."""
    return text.lower().split() if text else []


def raw(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    return column.cast(pa.binary()).to_pylist()


def ready(spark: SparkSession) -> SparkSession:
    """The session with the library's settings and short Arrow batches."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared work folder and read back (lineage cut)."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.folder = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete ``stored`` tables; only once all that is made of them has been written itself."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df.folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, from batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = np.stack([b.column(k).to_numpy() for k in keys])
        cuts = [0, *(np.flatnonzero((np.diff(cols) != 0).any(0)) + 1).tolist(), b.num_rows]
        for lo, hi in pairwise(cuts):
            key = cols[:, lo].tobytes()
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(b.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def bounded_top(rows: DataFrame, count: str, most: int) -> DataFrame:
    """The rows of largest ``count``, at most ``most``: all above a value found by histogram.

    Only the histogram (64 powers of two, then 256 steps of one) reaches the
    driver, so no task sends its own ``most`` rows.
    """
    power = F.length(F.bin(F.col(count).cast("long"))) - 1
    powers = sorted(rows.filter(F.col(count) > 0).groupBy(power.alias("p")).count().collect(), reverse=True)
    total, above = 0, None
    for r in powers:
        if total + r["count"] > most:
            above = r["p"]
            break
        total += r["count"]
    if above is None:
        return rows.filter(F.col(count) > 0)
    low = 2 ** above
    step = F.floor((F.col(count) - low) * 256 / low)
    least = 2 * low
    for r in sorted(rows.filter(F.col(count).between(low, 2 * low - 1)).groupBy(step.alias("s")).count().collect(), reverse=True):
        if total + r["count"] > most:
            break
        total += r["count"]
        least = low + -(-r["s"] * low // 256)
    return rows.filter(F.col(count) >= least)


def bounded_sample(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, chosen by the hash of ``key`` (all, if fewer).

    Hashes above the wanted share are filtered out first, so that each task
    sends its share of the sample only.
    """
    share = min(1.0, 1.3 * most / max(1, rows.count()))
    h = F.pmod(F.xxhash64(key), F.lit(1 << 30))
    return rows.filter(h < share * (1 << 30)).orderBy(h, key).limit(most)


def crc_mod(column: str, mod: int):
    """crc32 of a column's text, modulo ``mod`` (NULL: of the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % mod


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """Connected components of undirected ``edges (a, b)``: rows ``(id, component)``.

    Alternating large-star and small-star steps (each one grouped minimum
    and one join); every round is written to the shared folder, so no state
    is ever gathered in one place. ``component`` is the smallest id of each
    component; ids without an edge to another id have no row. NULL ends are
    ignored. Raises if ``rounds`` steps do not converge (the bound on rounds
    is logarithmic, so 64 is never met in practice).
    """
    def star(e: DataFrame) -> DataFrame:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")) \
                  .select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a != b")         # at most a row for each edge; equal ones go below
        # Small star: edges point from the larger to the smaller end.
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low2, "a").select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                              F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e"))
        return small.select("e.*").filter("a != b").distinct()

    def mark(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    cur = stored(edges.filter("a IS NOT NULL AND b IS NOT NULL AND a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = mark(cur)
    for _ in range(rounds):
        if seen[0] == 0:
            break
        last, cur = cur, stored(star(cur), "edges")
        discard(last)
        now = mark(cur)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not converge")
    roots = cur.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return cur.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)
