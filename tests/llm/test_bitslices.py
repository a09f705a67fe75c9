"""Bitmap arithmetic against plain sums, and the search against brute force."""

import numpy as np
import pytest

from seqtable.llm import bitslices as B


def brute(rows, every, k, scale=256):
    """(query_id, rank, vec_id, score) from (vec_id, vector) rows."""
    whole = [(i, [int(np.floor(float(x) * scale)) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (name, q) in enumerate(whole):
        if name is None or name % every:
            continue
        scores = [(-sum(x * y for x, y in zip(q, v, strict=True)), i is None, i or 0, i) for b, (i, v) in enumerate(whole) if b != a and len(v) == len(q)]
        out += [(name, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k])]
    return sorted(out, key=str)


def found(frame, **named):
    return sorted((tuple(r) for r in B.search(frame, **named).collect()), key=str)


def test_signed_digits():
    factors = np.arange(-200, 201)
    digits = B.signed_digits(factors)
    assert ((digits << np.arange(digits.shape[1])).sum(axis=1) == factors).all()
    assert not (digits[:, 1:] * digits[:, :-1]).any()


def test_bitmaps_add_up():
    draw = np.random.default_rng(1)
    levels = [draw.integers(0, 2**63, (n, 3, 2), np.uint64) for n in (5, 0, 11, 1, 2)]
    sums = B.add_slices(levels, 3, 2)
    bits = lambda maps: np.unpackbits(maps.view(np.uint8), axis=-1, bitorder="little").astype(int)
    want = sum((bits(level).sum(axis=0) << w) for w, level in enumerate(levels))
    assert (sum(bits(s) << j for j, s in enumerate(sums)) == want).all()


def test_selection_from_the_highest_slice():
    draw = np.random.default_rng(2)
    values = draw.integers(0, 50, (4, 128))
    sums = np.stack([np.packbits((values >> j) & 1, axis=1, bitorder="little").view(np.uint64) for j in range(6)])
    allowed = np.full((4, 2), 2**64 - 1, np.uint64)
    allowed[3] = [7, 0]
    kth = B.select_top(sums, allowed, 5)
    for q in range(3):
        assert kth[q] == sorted(values[q])[-5]
    assert kth[3] == 0  # fewer than five rows
    rows = np.unpackbits(B.at_least(sums, allowed, kth).view(np.uint8), axis=1, bitorder="little")
    assert (rows[:3] == (values[:3] >= kth[:3, None])).all() and rows[3].sum() == 3


@pytest.mark.parametrize("spread", [1, 3, 40, 5000])
def test_candidates_hold_all_of_the_best(spread):
    draw = np.random.default_rng(spread)
    vectors = draw.integers(-spread, spread + 1, (700, 12))
    queries = draw.integers(-spread, spread + 1, (40, 12))
    for q, rows in B.candidates(B.Lane(vectors), queries, np.full(40, -1), 5):
        scores = vectors @ queries[q]
        assert set(np.flatnonzero(scores >= np.sort(scores)[-5])) <= set(rows)
        if spread > 3:
            assert len(rows) < 400  # and leave most others out


def rows_of(n, size, seed, spread=0.12):
    draw = np.random.default_rng(seed)
    return [(i, [float(np.float32(x)) for x in draw.normal(0, spread, size)]) for i in range(n)]


ODD = [(900, None), (950, []), (951, []), (1000, [0.0] * 8), (1050, [None] + [0.1] * 7), (1100, [float("nan")] * 8), (1150, [float("inf")] * 8)]
ODD += [(None, [0.5] * 8), (1200, [1.0, 2.0]), (1201, [-1.0, 2.0]), (1250, [3.0] * 8), (1250, [3.0] * 8), (1251, [300.5] * 8)]


def test_odd_rows_ties_and_copies_against_brute_force(spark):
    rows = rows_of(300, 8, 3) + ODD + [(2000 + i, [0.25] * 8) for i in range(120)] + rows_of(50, 8, 3)
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, row int")
    assert found(frame, every=50, k=5) == brute(rows, 50, 5)


def test_lanes_and_blocks_against_brute_force(spark):
    rows = rows_of(900, 16, 4)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert found(frame, every=5, k=7, lane=100, queries=30) == brute(rows, 5, 7)


def test_few_rows_and_empty_table(spark):
    schema = "vec_id long, embedding array<float>"
    rows = rows_of(3, 4, 5)
    assert found(spark.createDataFrame(rows, schema), every=2, k=5) == brute(rows, 2, 5)
    assert found(spark.createDataFrame(rows[:1], schema), every=2, k=5) == []
    assert found(spark.createDataFrame([], schema), every=2, k=5) == []


def test_scores_beyond_64_bits_are_an_error(spark):
    frame = spark.createDataFrame([(0, [1e12]), (1, [1e12])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        B.search(frame, every=1, k=1).collect()


def test_query(spark):
    from seqtable.llm.queries import op13_top_products

    folder = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = op13_top_products(spark, folder)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    names = np.array([i for i, _ in rows])
    whole = np.floor(np.array([v for _, v in rows], float) * 256).astype(np.int64)
    want = []
    for a in np.flatnonzero(names % 50 == 0):
        scores = whole @ whole[a]
        others = np.delete(np.arange(len(names)), a)
        top = others[np.lexsort((names[others], -scores[others]))[:5]]
        want += [(names[a], r + 1, names[b], scores[b]) for r, b in enumerate(top)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
