"""The command line wires the pipeline, training and scoring together."""

import json
import tempfile

from clickfeat.__main__ import main
from clickfeat.operators import layers as L
from clickfeat.sources.events import NATIVE_COLUMNS, as_csv_strings, from_driver_events


def test_cli_pipeline_train_score(spark, capsys):
    base = tempfile.mkdtemp(prefix="clickfeat-cli-")
    text = as_csv_strings(L.bronze(from_driver_events(spark, "/root/testdata/sf0.001")))
    text.select(*NATIVE_COLUMNS).coalesce(1).write.option("header", True).csv(f"{base}/raw/d1")
    main(["pipeline", "--raw", f"{base}/raw/*", "--lake", f"{base}/lake", "--ties", "multiply"])
    tables = json.loads(capsys.readouterr().out.strip().splitlines()[-1])["tables"]
    assert spark.read.parquet(tables["features_and_labels"]).count() == 896
    main(["train", "--lake", f"{base}/lake", "--registry", f"{base}/reg",
          "--max-evals", "1", "--parallelism", "1", "--max-iter", "2"])
    summary = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert summary["version"] == 1
    main(["score", "--lake", f"{base}/lake", "--registry", f"{base}/reg", "--out", f"{base}/s"])
    assert spark.read.parquet(f"{base}/s").count() == 896
