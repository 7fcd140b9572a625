"""End-to-end: CSV drops -> stream -> every layer; rerun semantics; model registry."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from clickfeat.operators import layers as L
from clickfeat.plans import model as ML
from clickfeat.plans.pipeline import run_pipeline
from clickfeat.sources.events import NATIVE_COLUMNS, as_csv_strings, from_driver_events
from clickfeat.streaming.ingest import ingest, read_staging

SF = "/root/testdata/sf0.001"


def _write_drop(df, path):
    df.coalesce(1).write.option("header", True).csv(path)


@pytest.fixture(scope="module")
def lake(spark):
    base = tempfile.mkdtemp(prefix="clickfeat-test-")
    text = as_csv_strings(L.bronze(from_driver_events(spark, SF))).select(*NATIVE_COLUMNS)
    _write_drop(text, f"{base}/raw/all")
    written = run_pipeline(spark, f"{base}/lake", raw_path=f"{base}/raw/*",
                           checkpoint=f"{base}/ckpt", tiebreak=(), ties="multiply",
                           max_files_per_trigger=1)
    return base, written


def test_pipeline_counts(spark, lake):
    _, written = lake
    read = lambda t: spark.read.parquet(written[t])
    assert read("staging_events").count() == 1000
    assert read("silver_events").count() == 999
    assert read("raw_features").count() == 1115
    assert read("features_and_labels").count() == 896
    assert read("session_product_outcomes").count() == 535
    assert len(read("features_and_labels").columns) == 53
    assert len(read("raw_features").columns) == 56


def test_pipeline_tables_in_catalog(spark, lake):
    assert spark.table("features_and_labels").count() == 896
    assert "source_file" in spark.read.parquet(lake[1]["staging_events"]).columns


def test_stream_drains_incrementally(spark):
    base = tempfile.mkdtemp(prefix="clickfeat-stream-")
    text = as_csv_strings(L.bronze(from_driver_events(spark, SF))).select(*NATIVE_COLUMNS)
    a = text.filter(F.col("event_time") < "2024-01-15")
    b = text.filter(F.col("event_time") >= "2024-01-15")
    n_a, n_b = a.count(), b.count()
    staged, ckpt = f"{base}/staging", f"{base}/ckpt"
    _write_drop(a, f"{base}/raw/a")
    ingest(spark, f"{base}/raw/*", staged, ckpt)
    assert spark.read.parquet(staged).count() == n_a
    _write_drop(b, f"{base}/raw/b")
    ingest(spark, f"{base}/raw/*", staged, ckpt)
    assert spark.read.parquet(staged).count() == n_a + n_b
    ingest(spark, f"{base}/raw/*", staged, ckpt)
    out = spark.read.parquet(staged)
    assert out.count() == n_a + n_b
    assert out.select("source_file").distinct().count() == 2
    assert os.path.exists(f"{ckpt}/_stream_schema")


def test_model_train_register_score(spark, lake):
    registry = f"{lake[0]}/registry"
    features = spark.table("features_and_labels")
    summary = ML.train(spark, features, registry, "intent", max_evals=2, parallelism=2,
                       max_iter=3)
    assert summary["version"] == 1
    for split in ("train_test", "validate"):
        m = summary[split]
        assert 0.0 <= m["average_precision"] <= 1.0 and -1.0 <= m["mcc"] <= 1.0
    scored = ML.score(spark, features, registry, "intent")
    assert scored.count() == 896
    again = ML.score(spark, features, registry, "intent")
    a = sorted(r[0] for r in scored.select(ML.PROBABILITY).collect())
    b = sorted(r[0] for r in again.select(ML.PROBABILITY).collect())
    assert a == b
    ML.register(spark, ML.load_latest(spark, registry, "intent"), registry, "intent",
                summary["validate"])
    assert ML.latest_version(spark, registry, "intent").first().version == 2
    assert spark.read.parquet(f"{registry}/training_runs").count() == 2


def test_pipeline_tables_match_oracle(spark):
    """The written layers equal the oracle statements (driver data, event_id tiebreak)."""
    from clickfeat.oracle_sql import queries as oracle_queries
    from oracle import compare

    base = tempfile.mkdtemp(prefix="clickfeat-parity-")
    written = run_pipeline(spark, f"{base}/lake", staging=from_driver_events(spark, SF),
                           ties="multiply")
    sql = oracle_queries()
    for table in ("silver_events", "session_metrics", "user_metrics", "product_metrics",
                  "user_product_metrics", "raw_features", "session_product_outcomes",
                  "raw_features_and_labels", "features_and_labels"):
        r = compare(spark.read.parquet(written[table]), sql[table], SF)
        assert r["spark_cols"] == r["oracle_cols"], table
        assert r["hash_match"], table


def test_stream_rate_limited_drain(spark):
    """availableNow with maxFilesPerTrigger=1 drains several files in several batches."""
    base = tempfile.mkdtemp(prefix="clickfeat-rate-")
    text = as_csv_strings(L.bronze(from_driver_events(spark, SF))).select(*NATIVE_COLUMNS)
    text.repartition(3).write.option("header", True).csv(f"{base}/raw/d")
    q = ingest(spark, f"{base}/raw/*", f"{base}/staging", f"{base}/ckpt",
               max_files_per_trigger=1)
    assert spark.read.parquet(f"{base}/staging").count() == 1000
    batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 3


def test_stream_matches_columns_by_name_and_widens(spark):
    base = tempfile.mkdtemp(prefix="clickfeat-header-")
    raw, staged, ckpt = f"{base}/raw", f"{base}/staging", f"{base}/ckpt"
    text = as_csv_strings(L.bronze(from_driver_events(spark, SF))).select(*NATIVE_COLUMNS)
    _write_drop(text, f"{raw}/a")
    ingest(spark, f"{raw}/*", staged, ckpt)
    _write_drop(text.withColumn("campaign", F.lit("c")).select("campaign", *reversed(NATIVE_COLUMNS)), f"{raw}/b")
    ingest(spark, f"{raw}/*", staged, ckpt)
    out = read_staging(spark, staged, ckpt)
    assert out.columns == [*NATIVE_COLUMNS, "campaign", "source_file", "processing_time"]
    per_drop = out.groupBy("campaign").agg(F.sum(F.xxhash64(*NATIVE_COLUMNS).cast("decimal(38,0)")).alias("h"), F.count("*"))
    a, b = sorted(per_drop.collect(), key=str)
    assert a[1:] == b[1:] and {a[0], b[0]} == {None, "c"}


def test_stream_reads_every_file_name(spark):
    import gzip

    raw, root = tempfile.mkdtemp(), tempfile.mkdtemp()
    for k, name in enumerate(("a.csv", "b.csv.gz", "c.CSV", "d.txt", "e", "_skipped.csv")):
        put = gzip.open if name.endswith(".gz") else open
        with put(f"{raw}/{name}", "wt") as f:
            f.write(f"user_id,price\n{k},1.5\n")
    ingest(spark, raw, f"{root}/staging", f"{root}/check")
    rows = read_staging(spark, f"{root}/staging", f"{root}/check")
    assert sorted(r["user_id"] for r in rows.collect()) == ["0", "1", "2", "3", "4"]


def test_stream_honours_a_wider_schema(spark):
    from pyspark.sql import types as T

    base = tempfile.mkdtemp(prefix="clickfeat-wider-")
    spark.createDataFrame([("1", "x")], "a string, b string").coalesce(1).write.option("header", True).csv(f"{base}/raw/a")
    ingest(spark, f"{base}/raw/*", f"{base}/staging", f"{base}/ckpt")
    wider = T.StructType([T.StructField("a", T.StringType()), T.StructField("c", T.IntegerType())])
    spark.createDataFrame([("2", 7)], "a string, c int").coalesce(1).write.option("header", True).csv(f"{base}/raw/b")
    ingest(spark, f"{base}/raw/*", f"{base}/staging", f"{base}/ckpt", schema=wider)
    rows = read_staging(spark, f"{base}/staging", f"{base}/ckpt").select("a", "b", "c").collect()
    assert sorted(map(tuple, rows)) == [("1", "x", None), ("2", None, 7)]


def test_stream_keeps_rows_without_time(spark):
    from clickfeat.plans.queries import IN_DROP_A

    rows = spark.createDataFrame([(None,), ("2024-01-01 00:00:00",), ("2024-02-01 00:00:00",)], "event_time string")
    assert (rows.filter(IN_DROP_A).count(), rows.filter(f"NOT {IN_DROP_A}").count()) == (1, 2)


def test_default_pipeline_keeps_all_events_once(spark):
    """No cutoff (the driver's events are of 2024), one weighted feature row an event."""
    base = tempfile.mkdtemp(prefix="clickfeat-default-")
    written = run_pipeline(spark, f"{base}/lake", staging=from_driver_events(spark, SF))
    features = spark.read.parquet(written["raw_features"])
    assert features.count() == spark.read.parquet(written["silver_events"]).count() == 999
    assert features.agg(F.sum("_copies")).first()[0] == 1115


def test_two_registrations_at_once_make_two_versions(spark, lake):
    from concurrent.futures import ThreadPoolExecutor

    registry = f"{lake[0]}/registry-pair"
    train = spark.createDataFrame([(0, 1.0), (1, 2.0), (0, 1.5), (1, 2.5)], "purchased int, x double")
    model = ML.fit(train, ML.Params(1, 0.1, 1.0), max_iter=1)
    metrics = {"average_precision": 0.5, "balanced_accuracy": 0.5, "mcc": 0.0}
    with ThreadPoolExecutor(2) as pool:
        made = list(pool.map(lambda _: ML.register(spark, model, registry, "m", metrics), range(2)))
    assert sorted(made) == [1, 2]
    assert ML.versions(spark, registry).count() == 2


def test_absent_tiebreak_is_an_error(spark):
    with pytest.raises(ValueError, match="no such column"):
        L.bronze(from_driver_events(spark, SF), carry=["nothing"])


def test_session_without_user_is_in_no_split(spark):
    from clickfeat.operators import split as S

    df = spark.createDataFrame([(None, "s"), ("u", "s")], "user_id string, user_session string")
    assert [r["user_id"] for r in S.session_split(df).collect()] == ["u"]
    assert sum(S.split_rows(df, p).count() for p in ("train", "test", "validate")) == 1


def test_work_folder_needs_a_shared_one_on_a_cluster():
    from types import SimpleNamespace

    from clickfeat.session import work_dir

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077",
                              getConf=lambda: SimpleNamespace(get=lambda *_: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(SimpleNamespace(sparkContext=context))
