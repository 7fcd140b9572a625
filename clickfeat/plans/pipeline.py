"""The daily batch: raw drops -> staging -> bronze -> silver -> gold -> features.

Every layer is a full refresh of an external catalog table. Each step reads
its inputs back from the tables just written (not from a lazy frame), so the
layers agree with each other and every step's lineage starts at a table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from clickfeat.operators import features as FT
from clickfeat.operators import layers as L
from clickfeat.operators import metrics as M
from clickfeat.operators.running import SLICING, Slicing
from clickfeat.session import prepare
from clickfeat.sources.tables import read_table, write_table
from clickfeat.streaming.ingest import compact, ingest, live_folders, read_staging

RUNNING_EVENTS = "running_events"  # every event with both session levels' metrics (internal)
KEYED_FEATURES = "raw_features_keyed"  # one row per event + _copies (internal)


@dataclass(frozen=True)
class Lake:
    """Table paths under one root (a shared file system on a cluster); a table's
    rows are in a folder below its path (``sources.tables.table_folder``)."""

    root: str

    def staging(self) -> str:
        return f"{self.root}/staging/events"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"


def run_pipeline(spark: SparkSession, lake_root: str, *,
                 raw_path: str | None = None, checkpoint: str | None = None,
                 staging: DataFrame | None = None,
                 before: dt.datetime | None = None,
                 tiebreak: Sequence[str] = ("event_id",),
                 ties: str = "weight", slicing: Slicing = SLICING,
                 max_files_per_trigger: int | None = None,
                 compact_after: int = 100) -> dict[str, str]:
    """Run every layer; returns ``{table name: folder of its rows}``.

    Staging is compacted when it has more than ``compact_after`` folders.

    Input is either CSV drops at ``raw_path`` (ingested incrementally into
    staging with ``checkpoint``, ``max_files_per_trigger`` files a micro-batch)
    or an already-staged DataFrame ``staging``. All events are kept unless the
    caller gives a cutoff ``before``. ``ties="weight"`` writes one feature row
    an event with its copies as ``_copies``; "multiply" writes the copies.
    """
    prepare(spark)
    lake = Lake(lake_root.rstrip("/"))
    written: dict[str, str] = {}

    def write(df: DataFrame, name: str, layer: str) -> DataFrame:
        written[name] = write_table(df, name, lake.path(layer, name))
        return read_table(spark, name)

    if raw_path is not None:
        checkpoint = checkpoint or f"{lake.root}/_checkpoint"
        ingest(spark, raw_path, lake.staging(), checkpoint, max_files_per_trigger=max_files_per_trigger)
        if len(live_folders(spark, lake.staging())) > compact_after:
            compact(spark, lake.staging(), checkpoint)
        staging = read_staging(spark, lake.staging(), checkpoint)
        written["staging_events"] = lake.staging()
    if staging is None:
        raise ValueError("give raw_path or staging")

    bronze = write(L.bronze(staging, before, carry=tiebreak), "bronze_events", "bronze")
    silver = write(L.silver(bronze, tiebreak), "silver_events", "silver")

    # The running metrics of both session levels, with label and tie counts:
    # one event exchange for the two metric tables and all feature tables.
    running = write(FT.running_events(silver, slicing), RUNNING_EVENTS, "silver")
    for name, keys in FT.SESSION_LEVELS.items():
        write(M.level_table(running, name, keys), name, "gold")
    # Day counts per (user, product, day), written once; the three day-level
    # gold tables are cumulative windows over it and its roll-ups.
    up_counts = write(M.daily_counts(silver, ["user_id", "product_id"]),
                      "user_product_daily_counts", "gold")
    daily = {name: write(df, name, "gold") for name, df in FT.daily_frames(silver, up_counts).items()}
    # One row per event with its label and tie count; every feature table
    # below is a row-wise expansion or filter of it (no further shuffles).
    keyed = write(FT.raw_features_unexpanded(silver, daily, slicing, label=True, running=running),
                  KEYED_FEATURES, "silver")
    write(FT.expand(keyed.drop(FT.LABEL), ties), "raw_features", "silver")
    write(FT.session_product_outcomes(silver), "session_product_outcomes", "gold")
    labelled = write(FT.expand(FT.labelled(keyed), ties), "raw_features_and_labels", "silver")
    write(FT.training_rows(labelled), "features_and_labels", "silver")
    return written
