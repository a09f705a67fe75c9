"""Against all pairs of sets in plain Python, and against SQL."""

import random

import numpy as np
import pyarrow as pa
import pytest

from seqtable.llm import near_dups as N
from seqtable.llm import queries
from seqtable.llm.graph import components

from .compare import check


def shingles(text, size):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\f\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(documents, size, part, whole):
    """Group name by row: the smallest key among connected rows."""
    sets = [shingles(t, size) for _, t in documents]
    group = list(range(len(sets)))
    for x in range(len(sets)):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if both and whole * both >= part * len(sets[x] | sets[y]):
                old, new = group[x], group[y]
                group = [new if g == old else g for g in group]
    names = {g: min((documents[i][0] for i in range(len(sets)) if group[i] == g and documents[i][0] is not None), default=None) for g in group}
    return [(documents[i][0], len(sets[i]), names[group[i]]) for i in range(len(sets))], group


def families(draw, n):
    vocabulary = [f"w{i}" for i in range(300)]
    out = []
    for _ in range(n):
        base = [draw.choice(vocabulary) for _ in range(draw.choice([1, 2, 4, 30, 120, 300]))]
        for _ in range(draw.choice([1, 1, 3, 12])):
            copy = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 40))):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            out.append(" ".join(copy))
    return out


ODD = [None, "", " \n ", "one", "ONE", "one two", "é ñ", "a b c d e f", "a b c d e f"]


def frame(spark, documents):
    return spark.createDataFrame([(k, t, "x", 1) for k, t in documents], "doc_id long, text string, label string, component_id int")


@pytest.mark.parametrize(("size", "part", "blocks"), [(3, 85, N.BLOCK_BYTES), (5, 80, N.BLOCK_BYTES), (3, 85, 2000)])
def test_against_all_pairs(spark, monkeypatch, size, part, blocks):
    monkeypatch.setattr(N, "BLOCK_BYTES", blocks)
    texts = families(random.Random(size + blocks), 40) + ODD * 2
    documents = [(None if i % 17 == 5 else 1000 - i, t) for i, t in enumerate(texts)]
    found = N.groups(frame(spark, documents), size=size, part=part).collect()
    want, _ = brute(documents, size, part, 100)
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in found)


def test_keep_one(spark):
    texts = families(random.Random(1), 20) + ODD
    documents = [(None if i % 17 == 5 else 1000 - i, t) for i, t in enumerate(texts)]
    documents += documents[:30]
    _, group = brute(documents, 5, 80, 100)
    docs = frame(spark, documents)
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    by = {}
    for i, (k, t) in enumerate(documents):
        if shingles(t, 5):
            by.setdefault(group[i], []).append((k is None, k or 0))
    full = [r for r in rows if shingles(r[1], 5)]
    assert sorted((k is None, k or 0) for k, _ in full) == sorted(min(keys) for keys in by.values())
    assert len(rows) - len(full) == sum(not shingles(t, 5) for _, t in documents)


def test_empty_table(spark):
    assert N.groups(frame(spark, []).limit(0)).count() == 0
    assert N.keep_one(frame(spark, []).limit(0)).count() == 0


def test_signature_estimates_similarity():
    draw = np.random.default_rng(3)
    base = draw.integers(0, 2**63, 1000, dtype=np.uint64)
    other = np.concatenate([base[:800], draw.integers(0, 2**63, 200, dtype=np.uint64)])
    sig = N.Signer(200, 6).signature(np.concatenate([base, other]), np.array([0, 1000]))
    assert abs((sig[:, 0] == sig[:, 1]).mean() - 800 / 1200) < 0.05


def test_packed_sets_keep_equality():
    shingles_, n = N.shingle_sets(pa.array(["a b c d", None, "x", "a b c d"]), 3)
    assert n.tolist() == [2, 0, 1, 2] and shingles_[:2].tolist() == shingles_[3:].tolist()


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (201, 200)]
    found = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    want = {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200}
    assert {r.node: r.label for r in found} == want


def test_query_against_sql(spark):
    check(spark, queries.op8_near_dups, queries.OP8_SQL, "/root/testdata/sf0.01")
