"""Reading stored trajectory files."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seqtable.functions import fields as fl
from seqtable.functions import text
from seqtable.functions.staging import computed_once
from seqtable.schema import TRAJECTORY


def read_trajectories(spark: SparkSession, path: str, fail_fast: bool = False) -> DataFrame:
    """JSON Lines trajectories with the explicit schema; blank lines are skipped.

    Lines that are not JSON end the job with ``fail_fast``. Otherwise they come
    back in ``broken_line`` (null for good rows).
    """
    if fail_fast:
        return spark.read.schema(TRAJECTORY).option("mode", "FAILFAST").json(path)
    return (
        spark.read.schema(TRAJECTORY + ", broken_line STRING")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "broken_line")
        .json(path)
    )


#: Blocks of files whose first line numbers are sent to all tasks at most (24 bytes each); more are joined by shuffle.
SENT_BLOCKS = 1 << 20


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value): every line of text files with its place, ``line`` counting from 0 in each file.

    The place doesn't depend on how Spark cuts the files: each task numbers the lines
    of its blocks, and the lines in a file's earlier blocks are counted first.
    """
    file, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    # Ids ascend by one within a task, and so within a block, in the order of the lines.
    lines = spark.read.text(path).select("value", file.alias("file"), start.alias("_start"), F.monotonically_increasing_id().alias("_id"))
    blocks = lines.groupBy("file", "_start").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    earlier = Window.partitionBy("file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0))
    blocks = blocks.select(F.xxhash64("file", "_start").alias("_block"), (before - F.col("_first")).alias("_shift"))
    n = blocks.limit(SENT_BLOCKS + 1).count()
    lines = lines.withColumn("_block", F.xxhash64("file", "_start"))
    lines = lines.join(F.broadcast(blocks) if n <= SENT_BLOCKS else blocks, "_block")
    return lines.select("file", (F.col("_id") + F.col("_shift")).alias("line"), "value")


def read_placed(spark: SparkSession, path: str) -> DataFrame:
    """JSON Lines trajectories with ``file`` and ``line``; blank lines are skipped.

    ``broken_line`` has the text of a line that is not a JSON object, and is null for good rows.
    """
    lines = read_lines(spark, path).where(text.strip(F.col("value")) != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken_line"}
    record = F.from_json("value", TRAJECTORY + ", broken_line STRING", options)
    return computed_once(lines.select("file", "line", record.alias("_r")), "_r").select("file", "line", "_r.*")


def quarantine(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and (file, line, broken_line) of the lines that can't be read."""
    broken = F.col("broken_line").isNotNull()
    return placed.where(~broken).drop("broken_line"), placed.where(broken).select("file", "line", "broken_line")


def unique_ids(trajectories: DataFrame) -> DataFrame:
    """Every stored line as a trajectory of its own, though ids collide.

    ``trajectory_id`` gets the line's place behind it (see `read_placed`; of rows read
    otherwise a number, in no particular order), so that all later steps tell lines
    apart; ``stored_id`` keeps what was read.
    """
    place = F.concat_ws(":", "file", "line") if {"file", "line"} <= set(trajectories.columns) else F.monotonically_increasing_id()
    numbered = F.concat_ws("~", "trajectory_id", place)
    return trajectories.withColumn("stored_id", F.col("trajectory_id")).withColumn("trajectory_id", numbered)


def _flag(f: Column) -> Column:
    """Missing counts as true, an explicit null as false."""
    return fl.is_missing(f) | fl.truthy(f)


def read_for_analysis(spark: SparkSession, path: str) -> DataFrame:
    """Flat rows for the analysis, with missing and null flags told apart.

    A typed reader turns both into null, so lines are read as VARIANT here. Stored
    ids can collide; ``record_key`` is the line's file and number, the same in every read.
    Trajectories without actions keep one row with null ``pos``.
    """
    line = read_lines(spark, path).where(text.strip(F.col("value")) != "")
    record = F.parse_json("value")  # a line that is not JSON ends the job
    head = line.select(record.alias("r"), F.concat_ws(":", "file", "line").alias("record_key")).select(
        "record_key",
        F.variant_get("r", "$.trajectory_id", "string").alias("trajectory_id"),
        F.variant_get("r", "$.goal", "string").alias("goal"),
        _flag(fl.field(F.col("r"), "goal_achieved")).alias("goal_achieved"),
        F.posexplode_outer(F.try_variant_get("r", "$.actions", "array<variant>")).alias("pos", "a"),
    )
    action = F.col("a")
    return head.select(
        "record_key",
        "trajectory_id",
        "goal",
        "goal_achieved",
        "pos",
        F.variant_get(action, "$.action_id", "string").alias("action_id"),
        F.variant_get(action, "$.action_type", "string").alias("action_type"),
        _flag(fl.field(action, "element_visible")).alias("element_visible"),
        _flag(fl.field(action, "element_clickable")).alias("element_clickable"),
    )


def list_runs(spark: SparkSession, root: str) -> DataFrame:
    """One row per run folder: number and size of its main files, newest change.

    Only file listings are read, never contents. Samples live in a sibling
    folder and so never pass for a main file.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "part-*")
        .load(root)
        .select("path", "modificationTime", "length")
    )
    run = F.regexp_extract("path", r"/run_id=([^/]+)/main/", 1)
    return (
        files.withColumn("run_id", run)
        .where(F.col("run_id") != "")
        .groupBy("run_id")
        .agg(
            F.count("*").alias("n_files"),
            F.sum("length").alias("n_bytes"),
            F.max("modificationTime").alias("changed"),
        )
    )


def latest_run(runs: DataFrame) -> DataFrame:
    """The run changed last; equal times are decided by the later name."""
    return runs.orderBy(F.desc("changed"), F.desc("run_id")).limit(1)


def read_run(spark: SparkSession, base: str) -> DataFrame:
    """The main file of one run, of either format; trajectories or flat rows as they were stored."""
    names = spark.read.format("binaryFile").load(f"{base}/main").select("path").where("path like '%.parquet'")
    if names.limit(1).count():
        return spark.read.parquet(f"{base}/main")
    return read_trajectories(spark, f"{base}/main")
