"""Write-once files and what is built on them: registry, search journal, schemas, refreshes, compaction."""

import gzip
import json
import os
import subprocess
import sys
import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickfeat.plans import model as ML
from clickfeat.sources import records as R
from clickfeat.sources import tables as TB
from clickfeat.streaming import ingest as I

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
METRICS = {"average_precision": 0.5, "balanced_accuracy": 0.25, "mcc": 0.125}


@pytest.fixture()
def base():
    return tempfile.mkdtemp(prefix="clickfeat-records-")


class Broken(Exception):
    pass


def broken(*_, **__):
    raise Broken


# ---------------------------------------------------------------- publishing

def test_one_of_many_writers_publishes_a_name(spark, base):
    for k in range(10):
        data = [f"{k}-{w}".encode() * 1000 for w in range(8)]
        with ThreadPoolExecutor(8) as pool:
            won = list(pool.map(lambda d, k=k: R.publish(spark, f"{base}/a/{k}", d), data))
        assert won.count(True) == 1
        assert R.read_bytes(spark, f"{base}/a/{k}") == data[won.index(True)]
    assert R.published(spark, f"{base}/a") == sorted(str(k) for k in range(10))
    assert not [n for n in os.listdir(f"{base}/a") if n.startswith(".") and not n.endswith(".crc")]


def test_records_of_simultaneous_writers_are_all_there(spark, base):
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("x", T.DoubleType()), T.StructField("t", T.TimestampType())])
    assert R.records(spark, f"{base}/r", schema).count() == 0
    with ThreadPoolExecutor(8) as pool:
        done = list(pool.map(lambda n: R.add_record(spark, f"{base}/r", str(n), (n, None if n % 2 else n / 4, ML._now()), schema), range(40)))
    assert all(done)
    rows = R.records(spark, f"{base}/r", schema).orderBy("n").collect()
    assert [(r["n"], r["x"]) for r in rows] == [(n, None if n % 2 else n / 4) for n in range(40)]
    assert not R.add_record(spark, f"{base}/r", "7", (1, 1.0, None), schema)


# ---------------------------------------------------------------- registry

def test_simultaneous_registrations_get_a_number_each(spark, base):
    model = PipelineModel([SQLTransformer(statement="SELECT * FROM __THIS__")])
    for run in range(20):
        registry = f"{base}/{run}"
        with ThreadPoolExecutor(8) as pool:
            made = list(pool.map(lambda k, g=registry: ML.register(spark, model, g, "m", METRICS, run_id=str(k)), range(8)))
        assert sorted(made) == list(range(1, 9))
        rows = ML.versions(spark, registry).collect()
        assert sorted(r["version"] for r in rows) == list(range(1, 9))
        assert [r["version"] for r in rows if r["stage"] == "production"] == [8]
        assert {r["version"]: r["run_id"] for r in rows} == {v: str(k) for k, v in enumerate(made)}
        assert all(os.path.isdir(r["path"]) for r in rows)
    assert ML.latest_version(spark, registry, "m").first()["version"] == 8


def test_a_registration_that_breaks_off_is_not_seen(spark, base, monkeypatch):
    model = PipelineModel([SQLTransformer(statement="SELECT * FROM __THIS__")])
    assert ML.register(spark, model, base, "m", METRICS) == 1
    with monkeypatch.context() as m:
        m.setattr(ML, "add_record", broken)
        with pytest.raises(Broken):
            ML.register(spark, model, base, "m", METRICS)
    assert ML.latest_version(spark, base, "m").first()["version"] == 1
    assert ML.register(spark, model, base, "m", METRICS) == 3
    assert [(r["version"], r["stage"]) for r in ML.versions(spark, base).orderBy("version").collect()] == [(1, "archived"), (3, "production")]


# ---------------------------------------------------------------- search

def _measure(calls, stop_at=None):
    def objective(train, test, p):
        if len(calls) == stop_at:
            raise Broken
        calls.append(p)
        return {"average_precision": p.learning_rate, "balanced_accuracy": p.scale_pos_weight, "mcc": p.max_depth / 20}
    return objective


def test_a_broken_off_search_goes_on(spark, base):
    rows = spark.range(4)
    args = dict(max_evals=5, parallelism=1, seed=3, run_id="r", journal=f"{base}/trials")
    first, second, whole = [], [], []
    with pytest.raises(Broken):
        ML.tune(spark, rows, rows, objective=_measure(first, 2), **args)
    assert len(first) == 2 and ML.records(spark, f"{base}/trials", ML.TRIAL_SCHEMA).count() == 2
    got = ML.tune(spark, rows, rows, objective=_measure(second), **args)
    want = ML.tune(spark, rows, rows, objective=_measure(whole), **{**args, "journal": None})
    assert first + second == whole and len(second) == 3
    assert got.drop("logged_at").collect() == want.drop("logged_at").collect()
    again = []
    assert ML.tune(spark, rows, rows, objective=_measure(again), **args).count() == 5 and not again
    with pytest.raises(ValueError, match="other parameters"):
        ML.tune(spark, rows, rows, objective=_measure(again), **{**args, "seed": 4})
    assert ML.best_params(got) == max(whole, key=lambda p: p.learning_rate)


def test_a_failed_trial_ends_the_others_jobs(spark):
    import time

    slow = F.udf(lambda x: time.sleep(60) or x, "long")

    def objective(train, test, p):
        if p == first:
            time.sleep(3)
            raise Broken
        test.select(slow("id")).write.format("noop").mode("overwrite").save()

    first = ML.sample_params(__import__("random").Random(5))
    began = time.time()
    with pytest.raises(Broken):
        ML.tune(spark, spark.range(1), spark.range(1), max_evals=3, parallelism=3, seed=5, objective=objective)
    assert time.time() - began < 40


# ---------------------------------------------------------------- headers

def test_first_line_reads_the_beginning_only(spark, base):
    put = lambda name, data: open(f"{base}/{name}", "wb").write(data) and f"{base}/{name}"
    line = lambda name, data: I.first_line(spark, put(name, data))
    assert line("a", b"x,y\n1,2\n") == line("b", b"\n \r\nx,y\r\n1,2") == line("c", "﻿x,y".encode()) == "x,y"
    assert line("d.gz", gzip.compress(b"x,y\n" + b"1,2\n" * 1000)) == "x,y"
    assert line("f", b"\n\n") == ""
    with pytest.raises(ValueError, match="no end of line"):
        line("g", b"x" * (I.HEADER_BYTES + 10))


def test_columns_are_those_of_sparks_reader(spark, base):
    for k, text in enumerate(("a,b,c", '"a,1",b', "a,,a", "a", ' a ,"b ""q"""')):
        with open(f"{base}/{k}.csv", "w") as f:
            f.write(text + "\n1\n")
        assert I.column_names(spark, text) == tuple(spark.read.option("header", True).csv(f"{base}/{k}.csv").columns)


def test_files_without_a_line_are_no_error(spark, base):
    os.mkdir(f"{base}/raw")
    open(f"{base}/raw/empty", "w").close()
    I.ingest(spark, f"{base}/raw", f"{base}/staging", f"{base}/ckpt")
    assert I.read_staging(spark, f"{base}/staging", f"{base}/ckpt").count() == 0
    with open(f"{base}/raw/full", "w") as f:
        f.write("a,b\n1,2\n")
    I.ingest(spark, f"{base}/raw", f"{base}/staging", f"{base}/ckpt")
    assert [tuple(r)[:2] for r in I.read_staging(spark, f"{base}/staging", f"{base}/ckpt").collect()] == [("1", "2")]


READ_ONCE = """
import sys
from pyspark.sql import SparkSession
base = sys.argv[1]
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true")
         .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
         .config("spark.eventLog.dir", f"file://{base}/events").getOrCreate())
from clickfeat.streaming.ingest import ingest
ingest(spark, f"{base}/raw", f"{base}/staging", f"{base}/ckpt")
spark.stop()
"""


def test_ingest_reads_every_drop_once(base):
    """Input bytes of all tasks, from the event log, against the size of the drops."""
    os.makedirs(f"{base}/raw"), os.makedirs(f"{base}/events")
    size = 0
    for k in range(3):
        with open(f"{base}/raw/{k}.csv", "w") as f:
            f.write("user_id,price\n" if k else "price,user_id,extra\n")
            size += f.write(f"{k},1.5,x\n" * 400_000)
    subprocess.run([sys.executable, "-c", READ_ONCE, base], check=True, cwd=ROOT, timeout=300, capture_output=True)
    (log,) = os.listdir(f"{base}/events")
    read = 0
    with open(f"{base}/events/{log}") as f:
        for e in map(json.loads, f):
            if e["Event"] == "SparkListenerTaskEnd":
                read += e["Task Metrics"]["Input Metrics"]["Bytes Read"]
    assert 0.95 * size < read < 1.1 * size


# ---------------------------------------------------------------- schemas

def _fields(*names):
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def test_schemas_are_numbered_and_never_changed(spark, base, monkeypatch):
    assert I.stored_schema(spark, base) is None
    assert I.store_schema(spark, base, _fields("a")) == _fields("a")
    assert I.store_schema(spark, base, _fields("a")) == _fields("a")
    assert R.published(spark, f"{base}/_stream_schema") == ["000000001"]
    for step in ("createLink", "write"):            # a crash before the name exists
        with monkeypatch.context() as m:
            if step == "createLink":
                m.setattr(I, "publish", broken)
            else:
                m.setattr(I, "widened", broken)
            with pytest.raises(Broken):
                I.store_schema(spark, base, _fields("b"))
        assert I.stored_schema(spark, base) == _fields("a")
    assert I.store_schema(spark, base, _fields("b")) == _fields("a", "b") == I.stored_schema(spark, base)
    # A half-written file of another writer is no schema.
    with open(f"{base}/_stream_schema/.half", "w") as f:
        f.write('{"type"')
    assert I.stored_schema(spark, base) == _fields("a", "b")
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda n: I.store_schema(spark, base, _fields(n)), "cdefgh"))
    assert set(I.stored_schema(spark, base).names) == set("abcdefgh")


# ---------------------------------------------------------------- refreshes

def test_a_refresh_that_fails_leaves_the_old_rows(spark, base, monkeypatch):
    name, path = "t_" + os.path.basename(base).replace("-", "_"), f"{base}/t"
    first = TB.write_table(spark.range(5), name, path)
    bad = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("broken"))).alias("id"))
    with pytest.raises(Exception, match="broken"):
        TB.write_table(bad, name, path)
    assert spark.table(name).count() == 5 and TB.table_folder(spark, path) == first
    with monkeypatch.context() as m:                # after the write, before the number
        m.setattr(TB, "publish", broken)
        with pytest.raises(Broken):
            TB.write_table(spark.range(7), name, path)
    assert spark.table(name).count() == 5 and TB.table_folder(spark, path) == first
    begun = spark.table(name)
    second = TB.write_table(spark.range(7), name, path)
    assert spark.table(name).count() == 7 and spark.read.parquet(TB.table_folder(spark, path)).count() == 7
    assert begun.count() in (5, 7) and os.path.isdir(first)
    TB.write_table(spark.range(8), name, path)
    assert not os.path.isdir(first) and os.path.isdir(second)


def test_a_refresh_may_change_the_columns(spark, base):
    name, path = "c_" + os.path.basename(base).replace("-", "_"), f"{base}/t"
    TB.write_table(spark.range(3), name, path)
    TB.write_table(spark.range(4).withColumn("b", F.lit("x")), name, path)
    assert spark.table(name).columns == ["id", "b"] and spark.table(name).filter("b = 'x'").count() == 4
    TB.write_table(spark.range(2).selectExpr("cast(id AS string) AS b"), name, path)
    assert spark.table(name).dtypes == [("b", "string")] and spark.table(name).count() == 2


def test_readers_meet_whole_tables_only(spark, base):
    """While the table is refreshed, each read by name gives one refresh's rows."""
    name, path = "r_" + os.path.basename(base).replace("-", "_"), f"{base}/t"
    TB.write_table(spark.range(1000).withColumn("k", F.lit(0)), name, path)
    with ThreadPoolExecutor(1) as pool:
        writing = pool.submit(lambda: [TB.write_table(spark.range(1000 + k).withColumn("k", F.lit(k)), name, path) for k in range(1, 8)])
        seen = []
        while not writing.done():
            try:
                seen.append(tuple(spark.table(name).agg(F.count("*"), F.min("k"), F.max("k")).first()))
            except Exception as e:  # a scan slower than KEPT refreshes finds its folder gone; it never finds fewer rows
                assert "does not exist" in str(e) or "FILE_NOT_EXIST" in str(e) or "PATH_NOT_FOUND" in str(e)
        writing.result()
    assert seen and all(n == 1000 + lo and lo == hi for n, lo, hi in seen)


# ---------------------------------------------------------------- compaction

def _drop(base, k):
    os.makedirs(f"{base}/raw", exist_ok=True)
    with open(f"{base}/raw/{k:03d}.csv", "w") as f:
        f.write("a,b\n" if k < 30 else "b,a,c\n")
        f.writelines(f"{k},{r}\n" if k < 30 else f"{r},{k},z\n" for r in range(3))


def _staged(spark, base):
    return sorted(tuple(r)[:3] for r in I.read_staging(spark, f"{base}/staging", f"{base}/ckpt").collect())


def test_compaction_keeps_every_row_once(spark, base, monkeypatch):
    where = (spark, f"{base}/staging", f"{base}/ckpt")
    want = sorted((str(k), str(r), "z" if k >= 30 else None) for k in range(55) for r in range(3))
    for k in range(50):
        _drop(base, k)
    I.ingest(spark, f"{base}/raw", *where[1:], max_files_per_trigger=1)
    assert len(I.live_folders(*where[:2])) == 50
    with monkeypatch.context() as m:                 # a crash before the manifest is out
        m.setattr(I, "publish", broken)
        with pytest.raises(Broken):
            I.compact(*where)
    assert _staged(spark, base) == want[:0] + [w for w in want if int(w[0]) < 50]
    begun = I.read_staging(*where)
    assert I.compact(*where) == 50 and I.compact(*where) == 0
    (only,) = I.live_folders(*where[:2])
    assert len([n for n in os.listdir(f"{base}/staging/{only}") if n.endswith(".parquet")]) == 1
    for k in range(50, 55):
        _drop(base, k)
    I.ingest(spark, f"{base}/raw", *where[1:], max_files_per_trigger=1)
    assert _staged(spark, base) == want and len(I.live_folders(*where[:2])) == 6
    # A batch that is run again (its commit was lost) neither doubles nor loses rows.
    last = max(int(n) for n in os.listdir(f"{base}/ckpt/stream/commits") if n.isdigit())
    for n in (str(last), f".{last}.crc"):
        os.rename(f"{base}/ckpt/stream/commits/{n}", f"{base}/{n}.lost")
    assert I.compact(*where) == 4
    I.ingest(spark, f"{base}/raw", *where[1:], max_files_per_trigger=1)
    assert _staged(spark, base) == want
    assert I.compact(*where) == 1 and _staged(spark, base) == want
    del begun


def test_of_two_compactions_one_holds(spark, base):
    where = (spark, f"{base}/staging", f"{base}/ckpt")
    for k in range(6):
        _drop(base, k)
    I.ingest(spark, f"{base}/raw", *where[1:], max_files_per_trigger=1)
    with ThreadPoolExecutor(2) as pool:
        done = sorted(pool.map(lambda _: I.compact(*where), range(2)))
    assert done == [0, 6] and len(_staged(spark, base)) == 18
