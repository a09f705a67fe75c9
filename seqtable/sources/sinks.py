"""Writing datasets: main file, sample, metadata, statistics, manifest."""

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtable import constants as K
from seqtable.operators import shape
from seqtable.operators.statistics import (
    PROFILE_COLUMNS,
    action_distributions,
    dataset_statistics,
    trajectory_distributions,
)
from seqtable.schema import TRAJECTORY_TYPES_BY_COLUMN
from seqtable.session import new_folder
from seqtable.sources.jsonl import read_trajectories


def new_run_id() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")


def write_jsonl(records: DataFrame, path: str) -> None:
    """One trajectory per line, nulls written out."""
    (
        records.select(*TRAJECTORY_TYPES_BY_COLUMN)
        .write.mode("errorifexists")
        .option("ignoreNullFields", "false")
        .json(path)
    )


def write_flat(actions: DataFrame, path: str) -> None:
    """One action per row, as snappy Parquet."""
    shape.flat_table(actions).write.mode("errorifexists").option("compression", "snappy").parquet(path)


def head(actions: DataFrame, n: int = K.SAMPLE_SIZE) -> DataFrame:
    """Action rows of the first n trajectories by start time, then id.

    Spark picks the join for the n ids.
    """
    first = shape.measure(actions).orderBy("start_us", "trajectory_id").limit(n)
    return actions.join(first.select("trajectory_id"), "trajectory_id", "left_semi")


def metadata(measures: DataFrame, config: dict) -> DataFrame:
    return measures.agg(
        F.lit(K.DATASET_VERSION).alias("dataset_version"),
        F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generation_date"),
        F.lit(json.dumps(config, sort_keys=True)).alias("generator_config"),
        F.count("*").alias("total_trajectories"),
        F.coalesce(F.sum("action_count"), F.lit(0)).alias("total_actions"),
        F.lit(K.SCHEMA_VERSION).alias("schema_version"),
    )


def save_dataset(
    valid_actions: DataFrame,
    root: str,
    run_id: str | None = None,
    file_format: str = "jsonl",
    sample_size: int = K.SAMPLE_SIZE,
    config: dict | None = None,
) -> DataFrame:
    """Write validated trajectories and everything that goes with them.

    The main file is written first. Sample, metadata and statistics are then
    computed from it, so the input is evaluated once and a lost executor costs
    no more than the step at hand. Returns the manifest (kind, path).
    """
    spark: SparkSession = valid_actions.sparkSession
    base = f"{root}/run_id={run_id or new_run_id()}"
    paths = {"main": f"{base}/main"}
    if file_format == "parquet":
        # The flat layout has no device and browser; keep them beside it for the statistics.
        stored_columns = ["trajectory_id", "pos", *shape.ACTION_COLUMNS, *PROFILE_COLUMNS, "domain", "goal", "goal_achieved"]
        staged = new_folder(spark, "staged")
        valid_actions.select(*stored_columns).write.mode("errorifexists").parquet(staged)
        rows = spark.read.parquet(staged)
        write_flat(rows, paths["main"])
        paths["sample"] = f"{base}/sample"
        write_jsonl(shape.to_records(head(rows, sample_size)).coalesce(1), paths["sample"])
    elif file_format == "jsonl":
        write_jsonl(shape.to_records(valid_actions), paths["main"])
        rows = shape.flatten(read_trajectories(spark, paths["main"], fail_fast=True))
    else:
        raise ValueError(f"unknown output format {file_format!r}")
    measured = new_folder(spark, "measures")
    shape.measure(rows, [*PROFILE_COLUMNS, "goal_achieved"]).write.parquet(measured)
    measures = spark.read.parquet(measured)
    paths["metadata"] = f"{base}/metadata"
    metadata(measures, config or {}).coalesce(1).write.json(paths["metadata"])
    paths["statistics"] = f"{base}/statistics"
    dataset_statistics(measures).coalesce(1).write.json(paths["statistics"] + "/totals")
    counts = trajectory_distributions(measures).unionByName(action_distributions(rows))
    counts.write.json(paths["statistics"] + "/distributions")
    return spark.createDataFrame(list(paths.items()), "kind string, path string")
