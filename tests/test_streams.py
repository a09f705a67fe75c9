"""Streams: copies, sessions, late events, restarts."""

import itertools
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from seqtable.operators import dedup
from seqtable.operators.ordered import with_sessions
from seqtable.plans import views
from seqtable.streaming import ingest, sessions

FOLDER = "/root/testdata/sf0.001"
HOUR = timedelta(hours=1)
BASE = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def responses(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("responses"))
    views.raw_responses(spark, FOLDER).where(F.crc32("record_id") % 8 == 0).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def run(spark, base):
    planned = ingest.planned_records(ingest.read_response_stream(spark, base + "/in", 1))
    ingest.ingest_valid(ingest.unique_records(planned, "10 days"), base, base + "/progress")


def put(rows, base):
    rows.coalesce(1).write.mode("append").json(base + "/in")


def later(rows, days):
    return rows.withColumn("base_ms", F.col("base_ms") + days * 86_400_000)


def outcome(spark, base):
    accepted = spark.read.parquet(base + "/accepted").groupBy("record_id").agg(F.count("*").alias("n")).collect()
    rejected = spark.read.parquet(base + "/rejected").select("record_id", "reject_reason", "errors").collect()
    return sorted(map(tuple, accepted)), sorted((r.record_id, r.reject_reason, tuple(r.errors)) for r in rejected)


@pytest.fixture(scope="module")
def batch_outcome(responses):
    good, bad = ingest.accepted_and_rejected(ingest.unique_records(ingest.planned_records(responses), "10 days"))
    accepted = good.groupBy("record_id").agg(F.count("*").alias("n")).collect()
    return sorted(map(tuple, accepted)), sorted((r.record_id, r.reject_reason, tuple(r.errors)) for r in bad.collect())


def test_fingerprint_in_the_row_is_that_of_the_flat_rows(responses):
    planned = ingest.planned_records(responses)
    flat = {r.trajectory_id: r.fingerprint for r in dedup.fingerprints(ingest.convert(planned, "record_id", "base_ms")).collect()}
    marked = ingest.unique_records(planned, "1 day").where("reject_reason is null").select("fingerprint").collect()
    assert {r.fingerprint for r in marked} == set(flat.values())


def test_copies_in_later_files_and_after_restarts(spark, tmp_path, responses, batch_outcome):
    base = str(tmp_path)
    put(responses, base)
    put(later(responses, 1), base)
    run(spark, base)
    once = outcome(spark, base)
    assert once == batch_outcome and once[0] and any(r[1] == ingest.INVALID for r in once[1])
    put(later(responses, 2), base)  # after a restart
    run(spark, base)
    assert outcome(spark, base) == once


def test_a_copy_beyond_the_watermark_comes_through(spark, tmp_path, responses):
    base = str(tmp_path)
    one = responses.where("raw_text not like '```%'").orderBy("record_id").limit(1)
    one = spark.createDataFrame(one.collect(), one.schema)
    other = one.withColumn("record_id", F.lit("other")).withColumn("goal", F.lit("another goal"))
    put(one, base)
    run(spark, base)
    put(later(other, 40), base)  # moves the watermark far beyond the first record
    run(spark, base)
    put(later(one, 39), base)
    run(spark, base)
    accepted, rejected = outcome(spark, base)
    names = [r[0] for r in accepted] + [r[0] for r in rejected]
    planned = spark.read.parquet(base + "/accepted").select("record_id", "base_ms", "batch_id").distinct().count()
    assert sorted(set(names)) == sorted(["other", one.first().record_id])
    assert planned + len(rejected) == 3


def test_a_batch_that_failed_half_way_is_replaced(spark, tmp_path, responses, batch_outcome, monkeypatch):
    base = str(tmp_path)
    put(responses, base)
    whole = ingest.accepted_and_rejected

    def half(batch):
        good, bad = whole(batch)
        return good, bad.select(F.raise_error(F.lit("lost")).cast("string").alias("record_id"))

    monkeypatch.setattr(ingest, "accepted_and_rejected", half)
    with pytest.raises(Exception, match="lost"):
        run(spark, base)
    assert spark.read.parquet(base + "/accepted").count()  # written, but the batch isn't done
    monkeypatch.setattr(ingest, "accepted_and_rejected", whole)
    run(spark, base)
    assert outcome(spark, base) == batch_outcome


def _nodes(plan):
    yield plan
    for i in range(plan.children().size()):
        yield from _nodes(plan.children().apply(i))


def test_only_responses_go_to_the_state(spark, tmp_path):
    planned = ingest.planned_records(ingest.read_response_stream(spark, str(tmp_path)))
    found = ingest.unique_records(planned, "1 day")
    state, = (n for n in _nodes(found._jdf.queryExecution().analyzed()) if n.nodeName() == "DeduplicateWithinWatermark")
    names = {state.output().apply(i).name() for i in range(state.output().size())}
    assert names == {c.split()[0] for c in ingest.RESPONSES.split(", ")} | {"fingerprint", "at"}
    assert found.columns == [*planned.columns, "fingerprint", "at"]


def test_a_batch_leaves_no_shuffle_files_of_its_outputs(spark, tmp_path, responses):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size())}

    before, setting = files(), spark.conf.get(ingest.SHUFFLE_CLEANUP)
    put(responses, str(tmp_path))
    run(spark, str(tmp_path))
    ids = {n.split("_")[1] for n in files() - before if n.startswith("shuffle_")}
    assert len(ids) <= 2  # the state steps of the batch and of the one that moves the watermark
    assert spark.conf.get(ingest.SHUFFLE_CLEANUP) == setting


# --- sessions -----------------------------------------------------------------------

EVENTS = "user long, ts timestamp"


def feed(spark, base, rows):
    spark.createDataFrame([(u, BASE + t) for u, t in rows], EVENTS).coalesce(1).write.mode("append").parquet(base + "/in")
    stream = spark.readStream.schema(EVENTS).parquet(base + "/in")
    sessions.ingest_sessions(stream, "user", "ts", 2 * HOUR, HOUR, base, base + "/progress")


def seen(spark, base, name="sessions"):
    return spark.read.parquet(f"{base}/{name}")


def test_sessions_late_events_and_restarts(spark, tmp_path):
    base = str(tmp_path)
    feed(spark, base, [(1, 0 * HOUR), (1, 2 * HOUR), (1, 4.1 * HOUR), (2, 1 * HOUR)])  # exactly the gap joins
    feed(spark, base, [(1, 7 * HOUR), (2, 5 * HOUR), (3, 20 * HOUR)])
    feed(spark, base, [(1, 18.9 * HOUR), (3, 19 * HOUR), (3, 21 * HOUR)])  # the watermark is at 19
    assert [tuple(r)[:2] for r in seen(spark, base, "late").collect()] == [(1, BASE + 18.9 * HOUR)]
    feed(spark, base, [(None, sessions.close_all(BASE + 21 * HOUR, HOUR, 2 * HOUR) - BASE)])
    found = sorted((r.user, r.start - BASE, r.end - BASE, r.n) for r in seen(spark, base).collect())
    want = [(1, 0, 2, 2), (1, 4.1, 4.1, 1), (1, 7, 7, 1), (2, 1, 1, 1), (2, 5, 5, 1), (3, 19, 21, 3)]
    assert found == [(u, a * HOUR, b * HOUR, n) for u, a, b, n in want]


def test_sessions_of_all_events_are_those_of_the_batch_job(spark, tmp_path):
    base = str(tmp_path)
    rows = views.events(spark, FOLDER).select("user_id", "ts_us", "event_id")
    gap = timedelta(hours=12)
    numbered = with_sessions(rows, "user_id", "ts_us", "event_id", views.SESSION_GAP_US)
    want = numbered.groupBy("user_id", "sess").agg(F.min("ts_us").alias("a"), F.max("ts_us").alias("b"), F.count("*").alias("n"))
    want = sorted((r.user_id, r.a, r.b, r.n) for r in want.collect())
    rows = rows.select(F.col("user_id").alias("user"), F.timestamp_micros("ts_us").alias("ts"))
    found = sessions.sessions(rows, "user", "ts", gap, HOUR)
    assert sorted((r.user, r.a, r.b, r.n) for r in found.select("user", F.unix_micros("start").alias("a"), F.unix_micros("end").alias("b"), "n").collect()) == want
    last = max(b for _, _, b, _ in want)
    times = sorted(r.ts for r in rows.collect())
    cuts = [times[0], times[len(times) // 2], times[-1] + HOUR]
    for low, high in itertools.pairwise(cuts):
        rows.where((F.col("ts") >= low) & (F.col("ts") < high)).write.mode("append").parquet(base + "/in")
        sessions.ingest_sessions(spark.readStream.schema(EVENTS).parquet(base + "/in"), "user", "ts", gap, HOUR, base, base + "/p")
    end = datetime(1970, 1, 1) + timedelta(microseconds=last)
    spark.createDataFrame([(None, sessions.close_all(end, HOUR, gap))], EVENTS).write.mode("append").parquet(base + "/in")
    sessions.ingest_sessions(spark.readStream.schema(EVENTS).parquet(base + "/in"), "user", "ts", gap, HOUR, base, base + "/p")
    got = seen(spark, base).select("user", F.unix_micros("start").alias("a"), F.unix_micros("end").alias("b"), "n").collect()
    assert sorted(map(tuple, got)) == want
    assert seen(spark, base, "late").count() == 0


def test_a_gate_batch_run_again_gives_the_same(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    feed(spark, base, [(1, 10 * HOUR)])
    marks = sessions._marks
    monkeypatch.setattr(sessions, "_marks", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        feed(spark, base, [(1, 1 * HOUR), (1, 11 * HOUR)])
    monkeypatch.setattr(sessions, "_marks", marks)
    feed(spark, base, [(2, 12 * HOUR)])
    assert [r.user for r in seen(spark, base, "late").collect()] == [1]
    assert seen(spark, base, "on_time").count() == 3
