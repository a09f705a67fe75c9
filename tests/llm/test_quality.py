"""Gradients against differences, chunks that cover every byte, and held-out accuracy."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from seqtable.llm import quality as Q


def test_chunks_cover_every_byte():
    texts = ["", "x", "y" * Q.CHUNK, "z" * (Q.CHUNK + 1), "é" * 5000, None]
    data, offsets = Q.utf8(pa.array(texts))
    starts, ends, n = Q.cut(data, offsets)
    covered = np.zeros(len(data), bool)
    for a, b in zip(starts, ends, strict=True):
        covered[a:b] = True
        assert 0 <= b - a <= Q.CHUNK
    assert covered.all() and n[0] == n[1] == n[2] == n[5] == 1 and n[3] == 2
    assert bytes(Q.chunk_bytes(data, starts, ends)[1][:2]) == b"x\0"


def test_gradients(monkeypatch):
    monkeypatch.setattr(Q, "CHUNK", 40)
    draw = np.random.default_rng(0)
    net = Q.Network.new()
    for name in net.names:
        setattr(net, name, getattr(net, name).astype(np.float64) + (0.1 if "bias" in name else 0))
    raw = draw.integers(1, 90, (5, 40)).astype(np.uint8)
    raw[4, 20:] = 0
    n, labels, weights = np.array([2, 3]), np.array([0.0, 1.0]), np.array([1.5, 0.5])

    def loss():
        p = net.combine(net.features(raw), n)
        return -(weights * (labels * np.log(p) + (1 - labels) * np.log(1 - p))).mean()

    for name, found in zip(net.names, net.gradients(raw, n, labels, weights), strict=True):
        value = getattr(net, name)
        places = [i for i in map(tuple, np.argwhere(np.abs(found) > 1e-4))][::7][:12]
        for i in places:
            kept, value_at = value[i], []
            for step in (1e-5, -1e-5):
                value[i] = kept + step
                value_at.append(loss())
            value[i] = kept
            assert (value_at[0] - value_at[1]) / 2e-5 == pytest.approx(found[i], rel=2e-2, abs=1e-6), (name, i)


def test_held_out_accuracy_and_rows(spark):
    from seqtable.llm.queries import op3_quality

    folder = "/root/testdata/sf0.1"
    found = op3_quality(spark, folder)
    rows = found.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out").collect()
    right = np.mean([r.predicted == r.quality for r in rows])
    clean = np.mean([r.predicted for r in rows if r.quality == 1])
    assert right > 0.95 and clean > 0.97
    every = found.collect()
    assert len(every) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in every)


def test_odd_rows(spark):
    rows = [(i, f"plain text number {i} " * 9, 1) for i in range(40)] + [(50 + i, "### $$$ !!! " * (i + 1), 0) for i in range(40)]
    rows += [(None, None, 2), (200, "", 0), (1, rows[1][1], 3), (300, "é" * 200_000, 0)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(r[0], r[2], 0) for r in rows if r[2] in (0, 1)] + [(None, 1, 0), (3, None, 0), (999, 1, 0), (1, 1, 1)], "doc_id long, quality int, score int")
    network = Q.fit(documents, labels)
    scores = {(r.doc_id, r.score) for r in Q.score(documents, network, ["doc_id"]).collect()}
    assert network.trained and len({k for k, _ in scores}) == 83
    of = {k: s for k, s in scores}
    assert of[5] > 0.5 > of[60]
    assert Q.score(documents.limit(0), network, ["doc_id"]).count() == 0
    blank = Q.fit(documents, labels.filter("quality = 1"))
    assert {r.score for r in Q.score(documents, blank, ["doc_id"]).collect()} == {0.5}


def plain_score(net, text):
    """One window after the other, in double precision."""
    data = (text or "").encode()
    vectors = net.vectors.astype(float)
    vectors[0] = 0
    features, start = [], 0
    while True:
        chunk = data[start : start + 512]
        padded = chunk + b"\0" * (512 - len(chunk))
        seen = [vectors[b] for b in padded]
        top = np.max([np.concatenate(seen[p : p + 8]) @ net.filters for p in range(0, 512 - 8 + 1, 2)], axis=0)
        given = np.append(np.maximum(top + net.bias, 0), sum(b != 0 for b in chunk) / 512)
        features.append(np.maximum(given @ net.hidden + net.hidden_bias, 0))
        if start + 512 >= len(data):
            break
        start += 512 - 64
    joined = np.concatenate([np.mean(features, axis=0), np.max(features, axis=0)])
    return 1 / (1 + np.exp(-(joined @ net.last[:-1] + net.last[-1])))


def test_query_against_a_plain_forward_pass(spark, monkeypatch):
    from seqtable.llm import queries

    networks, fit = [], Q.fit
    monkeypatch.setattr(Q, "fit", lambda *a, **k: networks.append(fit(*a, **k)) or networks[-1])
    folder = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in queries.op3_quality(spark, folder).collect()}
    documents = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(found) == len(documents)
    for d in sorted(documents, key=lambda d: len(d.text or ""))[:150]:
        got = found[d.doc_id]
        assert abs(got.score - plain_score(networks[0], d.text)) < 1e-4
        assert got.held_out == (zlib.crc32(str(d.doc_id).encode()) % 3 == 1) and got.predicted == (got.score >= 0.5)
