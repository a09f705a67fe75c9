"""Sessions of users on an event stream, with late events set apart.

Two steps, each a stream of its own. The gate splits what comes in: events older
than its watermark go to a side output, the rest on to the sessions. The sessions
step groups with ``session_window`` and hands a session on when the watermark has
passed its end. It reads what the gate wrote, in the gate's order and with the same
delay, so Spark has no late event left to drop silently.
"""

from datetime import datetime, timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtable.streaming.ingest import use_state_on_disk


def _micros(length: timedelta) -> int:
    return length // timedelta(microseconds=1)


def gate(events: DataFrame, time: str, delay: timedelta, target: str, progress: str) -> None:
    """Split what is available of a stream into ``target``/on_time and ``target``/late, and stop.

    An event is late if it is older than the watermark: the greatest time of all
    earlier batches, less ``delay``. (A later one can't belong to a session that was
    handed on before.) Each batch leaves its greatest time in ``target``/marks; batches
    write under their number, so one that is run again finds the same watermark and
    replaces its output. Events without a time are on time; they have no session.
    """
    spark = events.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.DISK_ONLY)
        try:
            marks = _marks(spark, target).where(F.col("batch_id") < batch_id)
            passed = marks.agg(F.max("greatest_us")).first()[0]
            at = F.unix_micros(time)
            late = F.lit(False) if passed is None else F.coalesce(at < passed - _micros(delay), F.lit(False))
            batch.where(~late).write.mode("overwrite").parquet(f"{target}/on_time/batch_id={batch_id}")
            batch.where(late).write.mode("overwrite").parquet(f"{target}/late/batch_id={batch_id}")
            batch.agg(F.max(at).alias("greatest_us")).coalesce(1).write.mode("overwrite").json(f"{target}/marks/batch_id={batch_id}")
        finally:
            batch.unpersist()

    query = events.writeStream.option("checkpointLocation", progress).trigger(availableNow=True).foreachBatch(write)
    query.start().awaitTermination()


def _marks(spark: SparkSession, target: str) -> DataFrame:
    """(batch_id, greatest_us) of the batches so far; one short row each."""
    schema = "greatest_us BIGINT, batch_id BIGINT"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/marks")
    if not path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(f"{target}/marks")


def sessions(events: DataFrame, user: str, time: str, gap: timedelta, delay: timedelta) -> DataFrame:
    """(user, start, end, n) of sessions: an event joins if it comes at most ``gap`` after the one before.

    ``end`` is the time of the last event. On a stream a session appears once it can't
    grow any more; on a table all appear. Spark merges sessions before the shuffle as
    well, so a busy user sends a few rows for each task.
    """
    # session_window ends just before its length is over; a microsecond more lets an event after exactly `gap` join.
    width = f"{_micros(gap) + 1} microseconds"
    rows = events.withWatermark(time, f"{_micros(delay)} microseconds") if events.isStreaming else events
    grouped = rows.groupBy(user, F.session_window(time, width).alias("_window"))
    return grouped.agg(F.min(time).alias("start"), F.max(time).alias("end"), F.count("*").alias("n")).drop("_window")


def ingest_sessions(events: DataFrame, user: str, time: str, gap: timedelta, delay: timedelta, target: str, progress: str) -> None:
    """Gate what is available of a stream, append the finished sessions to ``target``/sessions, and stop."""
    spark = events.sparkSession
    gate(events, time, delay, target, f"{progress}/gate")
    use_state_on_disk(spark)
    spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    schema = spark.read.parquet(f"{target}/on_time").drop("batch_id").schema
    passed = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{target}/on_time")
    query = (
        sessions(passed, user, time, gap, delay)
        .writeStream.format("parquet")
        .option("path", f"{target}/sessions")
        .option("checkpointLocation", f"{progress}/sessions")
        .outputMode("append")
        .trigger(availableNow=True)
    )
    query.start().awaitTermination()


def close_all(at: datetime, delay: timedelta, gap: timedelta) -> datetime:
    """A time that, once seen, lets every session up to ``at`` end."""
    return at + delay + 2 * gap
