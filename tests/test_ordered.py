"""Chunked order-dependent columns against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from seqtable import session
from seqtable.operators import ordered


@pytest.fixture(scope="module")
def sequences(spark):
    rng = random.Random(7)
    rows = []
    for key, length in {"a": 1, "b": 5, "hot": 200, "c": 16}.items():
        for pos in range(length):
            rows.append((key, pos, rng.randint(-5, 50), rng.choice([None, None, f"p{pos}"])))
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "key string, pos int, v bigint, page string").repartition(5)
    return frame, sorted(rows)


@pytest.mark.parametrize("chunk", [1, 4, 5, 1000])
def test_previous(sequences, chunk):
    frame, rows = sequences
    got = ordered.with_previous(frame, "key", "pos", {"v": "before"}, chunk).collect()
    values = {(k, p): v for k, p, v, _ in rows}
    assert len(got) == len(rows)
    assert all(r.before == values.get((r.key, r.pos - 1)) for r in got)


@pytest.mark.parametrize("chunk", [1, 4, 5, 1000])
def test_running_total_and_last_known(sequences, chunk):
    frame, rows = sequences
    both = ordered.with_running_total(frame, "key", "pos", "v", "total", chunk)
    both = ordered.with_last_known(both, "key", "pos", "page", "seen", chunk)
    expected, total, seen, last_key = {}, 0, None, None
    for key, pos, v, page in rows:
        if key != last_key:
            total, seen, last_key = 0, None, key
        total, seen = total + v, page or seen
        expected[key, pos] = (total, seen)
    got = {(r.key, r.pos): (r.total, r.seen) for r in both.collect()}
    assert got == expected


@pytest.mark.parametrize("width", [1, 3, 10])
def test_sessions(spark, width):
    """One user with half of all events; several events at one instant."""
    rng = random.Random(3)
    events = [(1, rng.randint(-50, 400)) for _ in range(150)]
    events += [(u, rng.randint(0, 400)) for u in range(2, 30) for _ in range(5)]
    rows = [(i, u, t) for i, (u, t) in enumerate(events)]
    frame = spark.createDataFrame(rows, "id bigint, user bigint, t bigint")
    got = ordered.with_sessions(frame, "user", "t", "id", gap_us=10, width_us=width).collect()
    expected, state = {}, {}
    for i, u, t in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        last, sess, pos = state.get(u, (None, 0, 0))
        sess, pos = (sess + 1, 0) if last is None or t - last > 10 else (sess, pos + 1)
        state[u] = (t, sess, pos)
        expected[i] = (sess, pos)
    assert {r.id: (r.sess, r.pos) for r in got} == expected


def test_session_bucket_wider_than_gap_is_refused(spark):
    frame = spark.range(1).select(F.col("id").alias("u"), F.col("id").alias("t"), "id")
    with pytest.raises(ValueError):
        ordered.with_sessions(frame, "u", "t", "id", gap_us=5, width_us=6)


@pytest.mark.parametrize("chunk", [1, 4, 5, 1000])
def test_keep_sequences(spark, sequences, chunk):
    frame, rows = sequences
    kept = spark.createDataFrame([("hot", 200), ("b", 5)], "key string, n bigint")
    got = ordered.keep_sequences(frame, "key", "pos", kept, "n", chunk).collect()
    assert sorted((r.key, r.pos) for r in got) == sorted((k, p) for k, p, _, _ in rows if k in ("hot", "b"))


def test_shuffles_follow_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert session.size_shuffles(spark, 100 * 10**12) == 50_000
        assert session.size_shuffles(spark, 10) == 2 * spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
