"""Raw records on a file stream: conversion, removal of copies, validation with two outputs.

    records = unique_records(planned_records(read_response_stream(spark, path)), "7 days")
    ingest_valid(records, target, progress)

A record is parsed, checked, fixed and planned within its row: once for its
fingerprint, and again if it is no copy, as the planned form is many times the size
of the text and only the text goes through the shuffle to the state. Copies are told
by the fingerprint that the batch job uses; the state holds one fingerprint for as
long as the watermark asks. Everything that needs more than a row (validation) runs
on one micro-batch, in which records are whole. Outputs are written under the number
of the batch, so a batch that is run again after a failure replaces what it wrote.
"""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seqtable.functions.staging import computed_once
from seqtable.operators import checks, dedup
from seqtable.operators.convert import content_of, convert, plan_conversion, rejects
from seqtable.operators.records import check_and_fix, outline
from seqtable.session import new_folder
from seqtable.sources.raw import parse_responses

RESPONSES = (
    "record_id STRING, workflow_type STRING, goal STRING, user_type STRING, device_type STRING, "
    "browser_type STRING, num_actions INT, base_ms BIGINT, raw_text STRING"
)
#: Reject reason of records that convert but break rules of validation; their ``errors`` are the codes.
INVALID = "invalid"
#: What `planned_records` adds to a response.
PLANNED = ["parsed", "errors_before", "errors_after", "fix_outcome", "effective", "kept", "failed_actions", "reject_reason"]
#: Removes a query's shuffle files when it ends, rather than when the driver next collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Keeps state on the executors' disks, with changes alone in the checkpoint.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def responses_to_actions(responses: DataFrame) -> DataFrame:
    """Parse, check, fix and convert; the same rows for a table and for a stream.

    Everything happens within a row, so a stream keeps no state for it.
    """
    return convert(planned_records(responses), "record_id", "base_ms")


def responses_to_rejects(responses: DataFrame) -> DataFrame:
    """What does not convert, with text, reason and errors."""
    return rejects(planned_records(responses), "record_id")


def planned_records(responses: DataFrame) -> DataFrame:
    """One row per record, ready for conversion or with a reject reason."""
    checked = check_and_fix(outline(parse_responses(responses)))
    return plan_conversion(checked, "record_id", "num_actions", "user_type")


def read_response_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(RESPONSES).option("maxFilesPerTrigger", files_per_batch).json(path)
    )


def unique_records(planned: DataFrame, within: str) -> DataFrame:
    """Planned records without copies that came before, in the stream's order.

    Two records are copies if their converted actions have the fingerprint of
    `dedup.fingerprints`. A copy is dropped as long as the watermark (the
    greatest ``base_ms`` so far, less ``within``) hasn't passed the time of the first
    one; after that its fingerprint is forgotten and a copy comes through. Records
    that don't convert are told apart by their id. On a table the watermark has no
    effect, and one copy of all remains.

    On a stream what was planned stays out of the shuffle to the state, and what
    remains is planned again.
    """
    marked = computed_once(planned.withColumn("_content", content_of(F.col("kept"), "record_id")), "_content")
    mark = dedup.fingerprint_in_row(F.col("_content"), F.col("workflow_type"), F.col("goal"))
    marked = marked.withColumn("fingerprint", F.when(F.col("reject_reason").isNull(), mark).otherwise(F.concat(F.lit("record:"), "record_id")))
    marked = computed_once(marked, "fingerprint").drop("_content").withColumn("at", F.timestamp_millis("base_ms"))
    if not planned.isStreaming:
        return marked.dropDuplicates(["fingerprint"])
    first = marked.drop(*PLANNED).withWatermark("at", within).dropDuplicatesWithinWatermark(["fingerprint"])
    return planned_records(first).select(*marked.columns)


def accepted_and_rejected(planned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Action rows of the records that convert and are valid, and one row for each other record.

    Rejects have record_id, raw_text, reject_reason and errors (of structure, or the
    codes of broken rules).
    """
    actions = convert(planned, "record_id", "base_ms").drop("fingerprint", "at")
    verdicts = checks.validate(actions)
    broken = checks.rejected(verdicts).select("trajectory_id", "reasons")
    named = actions.where("pos = 0").select("trajectory_id", "record_id").join(broken, "trajectory_id")
    invalid = planned.join(named, "record_id").select("record_id", "raw_text", F.lit(INVALID).alias("reject_reason"), F.col("reasons").alias("errors"))
    return checks.keep_valid(actions, verdicts), rejects(planned, "record_id").unionByName(invalid)


def _start(rows: DataFrame, progress: str, write) -> StreamingQuery:
    return rows.writeStream.option("checkpointLocation", progress).outputMode("append").trigger(availableNow=True).foreachBatch(write).start()


def use_state_on_disk(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """In here a query's shuffle files go when it ends; a frame that is evaluated again shuffles again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def _staged(batch: DataFrame, folder: str) -> DataFrame:
    """The batch as read from ``folder``, with what its outputs need; replaces the batch there."""
    o = F.col("effective")
    used = F.when(o.isNotNull(), F.struct(o["domain"].alias("domain"), o["goal_achieved"].alias("goal_achieved")))
    rows = batch.drop("errors_after").withColumn("effective", used)
    rows.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    return batch.sparkSession.read.schema(rows.schema).parquet(folder)


def ingest_valid(planned: DataFrame, target: str, progress: str) -> None:
    """Write what is available to ``target``/accepted and ``target``/rejected, and stop.

    Both outputs of a batch come from one evaluation of its records and are
    partitioned by ``batch_id``; the batch counts as done when both are written.
    The records of a batch are kept in the scratch folder until the next one.
    """
    scratch = new_folder(planned.sparkSession, "batch")

    def write(batch: DataFrame, batch_id: int) -> None:
        with shuffles_removed(batch.sparkSession):
            for name, rows in zip(("accepted", "rejected"), accepted_and_rejected(_staged(batch, scratch)), strict=True):
                rows.write.mode("overwrite").parquet(f"{target}/{name}/batch_id={batch_id}")

    use_state_on_disk(planned.sparkSession)
    _start(planned, progress, write).awaitTermination()


def ingest_available(responses: DataFrame, target: str, checkpoint: str, rejected: str | None = None) -> None:
    """Append everything not yet ingested to ``target``, rejects to ``rejected``, and stop.

    The file sinks commit each batch once, so a restarted run neither loses nor
    repeats records.
    """
    outputs = [(responses_to_actions(responses), target, checkpoint)]
    if rejected:
        outputs.append((responses_to_rejects(responses), rejected, checkpoint + "-rejects"))
    for rows, path, progress in outputs:
        query = (
            rows.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", progress)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
