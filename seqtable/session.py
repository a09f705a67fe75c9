"""Session settings and the shared scratch folder."""

import math
import tempfile
import uuid

from pyspark.sql import SparkSession


def build(master: str | None = None, app: str = "seqtable", **settings: str) -> SparkSession:
    """A session with the settings the jobs rely on; cluster sizes come from the launcher."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Call-site capture per column expression; slows the building of wide selects.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def size_shuffles(
    spark: SparkSession, input_bytes: int, shuffled_share: float = 0.1, partition_bytes: int = 200_000_000
) -> int:
    """Set the number of shuffle partitions from the size of the input.

    The jobs shuffle a few narrow columns, about a tenth of the input or less.
    100 TB then gives 50,000 partitions; adaptive execution merges those that
    turn out small. Never below two per core.
    """
    needed = math.ceil(input_bytes * shuffled_share / partition_bytes)
    partitions = max(needed, 2 * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return partitions


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster's spark.checkpoint.dir.

    Where the setting is missing, a local session gets a temporary folder of its
    own (tests); on a cluster this is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="seqtable-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that no other job uses."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
