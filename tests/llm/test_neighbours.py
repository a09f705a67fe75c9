"""Recall against brute force, curve neighbours, and odd vectors."""

import itertools

import numpy as np
import pytest

from seqtable.llm import neighbours as N
from seqtable.llm import queries


@pytest.mark.parametrize(("dimensions", "bits"), [(2, 4), (3, 3), (5, 2)])
def test_curve_visits_every_cell_by_single_steps(dimensions, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dimensions)))
    keys = N.hilbert(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def brute(rows, every, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v) and len(v) == 4]
    out = []
    for q, a in good:
        if q % every == 0:
            best = sorted({(float(np.sqrt(((a - b) ** 2).sum())), i) for i, b in good if i != q})[:k]
            out += [(q, n + 1, i, s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def test_small_table_is_exact_and_odd_rows_take_no_part(spark):
    draw = np.random.default_rng(1)
    rows = [(i, draw.standard_normal(4).astype("f4").tolist()) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(30)]
    rows += [(300, None), (301, [0.0] * 4), (302, [1.0, None, 1.0, 1.0]), (303, [float("nan")] * 4), (304, [float("inf"), 1.0, 1.0, 1.0]), (305, [1.0]), (None, [1.0] * 4)]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    found = sorted(tuple(r) for r in N.search(frame, every=20, k=10, curves=3, window=200).collect())
    assert [r[:3] for r in found] == [r[:3] for r in brute(rows, 20, 10)]
    assert np.allclose([r[3] for r in found], [r[3] for r in brute(rows, 20, 10)], rtol=1e-12)
    few = frame.filter("vec_id in (0, 1, 2)")
    assert N.search(few, every=20).count() == 2
    assert N.search(frame.limit(0)).count() == 0
    true = N.brute_force(frame, 5, every=20)
    assert N.recall(N.search(frame, every=20, curves=3, window=200), true) == 1


def test_windows_split_over_pieces(spark):
    draw = np.random.default_rng(2)
    frame = spark.createDataFrame([(i, draw.standard_normal(2).tolist()) for i in range(2000)], "vec_id long, embedding array<double>")
    found = N.search(frame.repartition(7), every=100, curves=6, dimensions=2, bits=8, window=40)
    assert N.recall(found, N.brute_force(frame, 20, every=100)) > 0.95


def test_query_recall(spark):
    folder = "/root/testdata/sf0.1"
    found = queries.op1_neighbours(spark, folder)
    frame = spark.read.parquet(f"{folder}/embeddings.parquet")
    assert N.recall(found, N.brute_force(frame, 1000, every=100)) >= 0.9


def test_window_grows_with_the_table(spark):
    draw = np.random.default_rng(3)
    frame = spark.createDataFrame([(i, draw.standard_normal(16).tolist()) for i in range(4000)], "vec_id long, embedding array<double>")
    found = N.search(frame, every=20, curves=4, dimensions=8, window=30)
    assert N.recall(found, N.brute_force(frame, 200, every=20)) >= 0.9


def test_pieces_smaller_than_the_window(spark, monkeypatch):
    monkeypatch.setattr(N, "PIECE", 16)
    draw = np.random.default_rng(4)
    frame = spark.createDataFrame([(i, draw.standard_normal(4).tolist()) for i in range(300)], "vec_id long, embedding array<double>")
    found = N.search(frame, every=10, curves=1, dimensions=4, window=300)
    assert found.count() == 300 and N.recall(found, N.brute_force(frame, 30, every=10)) == 1


def test_copies_beyond_the_window(spark):
    draw = np.random.default_rng(6)
    rows = draw.standard_normal((1200, 4))
    rows[draw.permutation(1200)[:500]] = rows[0]
    rows[7] = rows[0] + 0.001
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    copies = {i for i, v in enumerate(rows) if (v == rows[0]).all()}
    found, true = N.search(frame, every=7, curves=12, dimensions=4, bits=6, window=100, asked=0), N.brute_force(frame, 200, every=7)
    of = lambda f: sorted(tuple(r)[:3] for r in f.collect() if r.query_id in copies | {7})
    assert len(of(found)) > 500 and of(found) == of(true)
    assert N.recall(found, true) > 0.95
