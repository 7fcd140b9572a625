"""Command line for the two daily tasks (and scoring).

    python -m clickfeat pipeline --raw <csv drops> --lake <root> [--before <time>]
    python -m clickfeat train --registry <root> [--name purchase_intent]
    python -m clickfeat score --registry <root> --out <path>
    python -m clickfeat daily --raw ... --lake ... --registry ...   # pipeline, then train

Run with ``spark-submit -m``-style launchers or plain ``python`` on a node
that can create a session; the session is taken as configured (master,
``spark.checkpoint.dir`` for shared work files).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from clickfeat.operators.running import Slicing
from clickfeat.plans import model as ML
from clickfeat.plans.pipeline import Lake, run_pipeline
from clickfeat.session import prepare
from clickfeat.sources.tables import table_folder

MODEL_NAME = "purchase_intent"


def _cutoff(text: str | None) -> dt.datetime | None:
    if text in (None, "", "none"):
        return None
    return dt.datetime.fromisoformat(text)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="clickfeat")
    sub = ap.add_subparsers(dest="cmd", required=True)
    for cmd in ("pipeline", "daily"):
        p = sub.add_parser(cmd)
        p.add_argument("--raw", required=True, help="folder (or glob) of headed CSV drops")
        p.add_argument("--lake", required=True, help="root folder of the layered tables")
        p.add_argument("--checkpoint", help="stream checkpoint (default <lake>/_checkpoint)")
        p.add_argument("--before", help="keep only events before this time")
        p.add_argument("--ties", default="weight", choices=["weight", "multiply", "collapse"])
        p.add_argument("--max-files-per-trigger", type=int)
        p.add_argument("--compact-after", type=int, default=100, help="staging folders that are swapped for large files beyond this")
        p.add_argument("--slice-unit", default="day")
        p.add_argument("--hot-rows", type=int, default=2_000_000)
    for cmd in ("train", "daily"):
        p = sub.choices.get(cmd) or sub.add_parser(cmd)
        if cmd == "train":
            p.add_argument("--lake", required=True, help="root folder of the layered tables")
        p.add_argument("--registry", required=True)
        p.add_argument("--name", default=MODEL_NAME)
        p.add_argument("--max-evals", type=int, default=ML.MAX_EVALS)
        p.add_argument("--parallelism", type=int, default=ML.PARALLELISM)
        p.add_argument("--max-iter", type=int, default=ML.MAX_ITER)
        p.add_argument("--seed", type=int, default=0)
        p.add_argument("--run-id", help="go on with the search of a training that was broken off")
    p = sub.add_parser("score")
    p.add_argument("--lake", required=True)
    p.add_argument("--registry", required=True)
    p.add_argument("--name", default=MODEL_NAME)
    p.add_argument("--out", required=True)
    args = ap.parse_args(argv)

    spark = prepare(SparkSession.builder.appName(f"clickfeat-{args.cmd}").getOrCreate())
    if args.cmd in ("pipeline", "daily"):
        written = run_pipeline(
            spark, args.lake, raw_path=args.raw, checkpoint=args.checkpoint,
            before=_cutoff(args.before), tiebreak=(), ties=args.ties,
            slicing=Slicing(unit=args.slice_unit, hot_rows=args.hot_rows),
            max_files_per_trigger=args.max_files_per_trigger, compact_after=args.compact_after)
        print(json.dumps({"tables": written}))
    features_path = table_folder(spark, Lake(args.lake.rstrip("/")).path("silver", "features_and_labels"))
    if args.cmd in ("train", "daily"):
        summary = ML.train(spark, spark.read.parquet(features_path), args.registry, args.name,
                           max_evals=args.max_evals, parallelism=args.parallelism,
                           seed=args.seed, max_iter=args.max_iter, run_id=args.run_id)
        print(json.dumps(summary))
    if args.cmd == "score":
        ML.score(spark, spark.read.parquet(features_path), args.registry, args.name) \
            .write.mode("overwrite").parquet(args.out)


if __name__ == "__main__":
    main()
