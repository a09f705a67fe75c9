"""Sums over segmentations against enumeration; accuracy on held-out documents; odd input."""

import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest

from seqtable.llm import language as L

PATH = public_tokenizers.path("piece_bpe_32k.model")


def cuts(word):
    for marks in itertools.product((0, 1), repeat=len(word) - 1):
        places = [0, *[i + 1 for i, m in enumerate(marks) if m], len(word)]
        yield [word[a:b] for a, b in itertools.pairwise(places)]


@pytest.fixture
def small():
    pieces = sorted(["▁", "▁a", "a", "b", "ab", "ba", "abb", "é", "▁ab"])
    chances = np.random.default_rng(0).random((len(pieces) + 1, 2))
    return L.Model(["x", "y"], np.log([0.5, 0.5]), pieces, chances / chances.sum(axis=0))


@pytest.mark.parametrize("plain", [L.PLAIN, 0])
def test_scores_and_expected_counts_by_enumeration(small, monkeypatch, plain):
    monkeypatch.setattr(L, "PLAIN", plain)  # 0: all words take the way of long ones
    words = ["▁abba", "▁", "▁aéb", "▁zab", "bab"]
    place = {p: i for i, p in enumerate(small.pieces)}

    def uses(word):
        """Every segmentation's pieces and its probability in each language."""
        for parts in cuts(word):
            ids = [place.get(p, len(place) if len(p) == 1 else None) for p in parts]
            if None not in ids:
                yield ids, np.prod(small.chances[ids], axis=0)

    forward = L.Forward(small)
    totals = [sum(p for _, p in uses(w)) for w in words]
    assert np.allclose(np.exp(forward.scores(words)), totals)
    counts = np.random.default_rng(1).integers(0, 5, (len(words), 2)).astype(float)
    want = np.zeros_like(small.chances)
    for word, total, count in zip(words, totals, counts, strict=True):
        for ids, p in uses(word):
            for i in ids:
                want[i] += count * p / total
    assert np.allclose(forward.expected(words, counts), want)


def plain_score(model, word):
    """Logarithms of the sums over all segmentations, one letter after the other."""
    place = {p: i for i, p in enumerate(model.pieces)}
    logs, longest = np.log(model.chances), max(map(len, model.pieces))
    sums = [np.zeros(logs.shape[1])]
    for end in range(1, len(word) + 1):
        terms = []
        for start in range(max(0, end - longest), end):
            piece = place.get(word[start:end], len(place) if start == end - 1 else None)
            if piece is not None:
                terms.append(sums[start] + logs[piece])
        sums.append(np.logaddexp.reduce(terms))
    return sums[-1]


@pytest.mark.parametrize("n", [38, 39, 40, 41, 80, 10_000])
def test_long_words_are_summed_whole(small, n):
    draw = np.random.default_rng(n)
    words = ["▁" + "".join(draw.choice(list("abéz"), n)), "▁" + "ab" * (n // 2), "▁" + "a" * n]
    got = L.Forward(small).scores(words)
    assert np.allclose(got, [plain_score(small, w) for w in words], rtol=1e-10)


def test_expected_counts_of_long_words(small):
    """The two ways agree where both can be taken, and the counts of a very long word spell it."""
    words = ["▁" + "abba" * 9, "▁" + "zéab" * 9]
    counts = np.array([[2.0, 0.0], [1.0, 3.0]])
    forward = L.Forward(small)
    plain, out = forward.expected(words, counts), np.zeros_like(small.chances)
    for k, w in enumerate(words):
        forward._long_expected(np.array([list(map(ord, w))], np.uint64), counts[k : k + 1], out)
    assert np.allclose(plain, out)
    word = "▁" + "abzé" * 600
    uses = forward.expected([word], np.array([[1.0, 1.0]]))
    lengths = np.array([*map(len, small.pieces), 1])
    assert np.allclose(lengths @ uses, len(word))


def test_query_against_a_plain_version(spark, monkeypatch):
    from seqtable.llm import queries

    models = []
    fit = L.fit
    monkeypatch.setattr(L, "fit", lambda *a, **k: models.append(fit(*a, **k)) or models[-1])
    folder = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in queries.op6_language(spark, folder).collect()}
    known: dict[str, np.ndarray] = {}
    for d in spark.read.parquet(f"{folder}/documents.parquet").collect():
        words = ["▁" + "".join(filter(str.isalpha, w)) for w in L.LETTERS.findall((d.text or "").lower())]
        words = [w for w in words if w != "▁"]
        for w in set(words) - known.keys():
            known[w] = plain_score(models[0], w)
        got = found[d.doc_id]
        assert got.held_out == (zlib.crc32(str(d.doc_id).encode()) % 5 == 0)
        if not words:
            assert (got.lang_pred, got.score) == ("und", 0)
            continue
        sums = models[0].priors + sum(known[w] for w in words)
        assert got.lang_pred == models[0].languages[int(sums.argmax())]
        assert np.isclose(got.score, 1 / np.exp(sums - sums.max()).sum())


def test_hash_of_pieces_is_unique():
    pieces = L.vocabulary(PATH)
    keys = [L.Forward._hash(np.array([list(map(ord, p))], np.uint64))[0] for p in pieces]
    assert len(set(keys)) == len(pieces) > 5000


def test_accuracy_and_query(spark):
    from seqtable.llm.queries import op6_language

    folder = "/root/testdata/sf0.01"
    rows = op6_language(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id").collect()
    assert len(rows) == 1000
    judged = [r for r in rows if r.held_out and r.lang]
    assert len(judged) > 150 and sum(r.lang == r.lang_pred for r in judged) / len(judged) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    rows = [(1, "der die das und ist", "de", 1), (2, "the of and is to", "en", 1), (3, None, "en", 2), (4, "", None, 2), (5, "123 ²  _", "en", 2)]
    rows += [(None, "the the", None, 3), (6, "a" * 100_000, None, 3), (2, "the of and is to", "en", 1), (7, "中文 İß", None, 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    model = L.fit(frame, PATH)
    assert model.languages == ["de", "en"]
    found = L.predict(frame, model, ["doc_id"]).collect()
    got = sorted((r.doc_id or 0, r.lang_pred) for r in found)
    assert [x for x in got if x[0] in (0, 1, 2, 3, 4, 5)] == [(0, "en"), (1, "de"), (2, "en"), (2, "en"), (3, "und"), (4, "und"), (5, "und")]
    kept = L.keep_known(frame, model, 0.5)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {None, 1, 2, 6, 7}
    empty = frame.limit(0)
    assert L.predict(empty, model, ["doc_id"]).count() == 0
    blank = L.fit(empty, PATH)
    assert {r.lang_pred for r in L.predict(frame, blank, ["doc_id"]).collect()} == {"und"}
