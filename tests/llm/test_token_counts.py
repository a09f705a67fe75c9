"""Against plain dynamic programming over each word."""

import math
import random
import re

import public_tokenizers

from seqtable.llm import queries
from seqtable.llm import token_counts as T

PATH = public_tokenizers.path("piece_bpe_32k.model")


def brute(word, rank):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        ways = []
        for start in range(max(0, end - 16), end):
            piece, (score, n) = word[start:end], best[start]
            if piece in rank:
                ways.append((score - math.log(rank[piece] + 1), -(-n + -1)))
            elif len(piece) == 1:
                width = len(piece.encode())
                ways.append((score - width * math.log(len(rank) + 256.0), n + width))
        best.append(max(ways, key=lambda x: (x[0], -x[1])))
    return best[-1][1]


def total(text, rank):
    words = re.findall(r"[^ \t\n\v\f\r]+", text or "")
    return sum(brute(s, rank) for w in words for s in T.sections(w))


def test_words_against_plain_search():
    pieces = T.vocabulary(PATH)
    rank = {p: i for i, p in enumerate(pieces)}
    assert max(map(len, pieces)) <= 16
    draw = random.Random(0)
    words = ["", "▁", "▁the", "▁zzzz\U0001f600é", "▁" + "ab" * 120]
    words += ["▁" + "".join(draw.choice("thenaing ërCS1.,中") for _ in range(draw.randint(0, 24))) for _ in range(1500)]
    assert T.Trie(pieces).counts(words).tolist() == [brute(w, rank) for w in words]


def test_prefixes_are_shared(monkeypatch):
    trie, sizes = T.Trie(["a", "b", "ab"]), []
    find = trie.table.find
    monkeypatch.setattr(trie.table, "find", lambda keys: sizes.append(len(keys)) or find(keys))
    trie.counts(["aaaa" + x for x in "ab"] * 50)
    assert max(sizes) == 2


def test_rows(spark):
    rows = [(1, None), (None, ""), (2, " \n"), (3, "the the  end"), (3, "the the  end"), (4, "x" * 1000), (5, "word " * 20_000)]
    frame = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_tokens string")
    rank = {p: i for i, p in enumerate(T.vocabulary(PATH))}
    found = T.count(frame, PATH, ["doc_id"]).collect()
    assert sorted(map(str, [(r.doc_id, r.n_tokens) for r in found])) == sorted(map(str, [(i, total(t, rank)) for i, t in rows]))
    assert T.count(frame.limit(0), PATH, ["doc_id"]).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rank = {p: i for i, p in enumerate(T.vocabulary(PATH))}
    found = {r.doc_id: r.n_tokens for r in queries.op5_token_counts(spark, folder).collect()}
    documents = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert found == {d.doc_id: total(d.text, rank) for d in documents}


def test_long_runs_are_not_cut():
    pieces = T.vocabulary(PATH)
    rank, draw = {p: i for i, p in enumerate(pieces)}, random.Random(1)
    words = ["".join(draw.choice(letters) for _ in range(n)) for letters in ("abcdefghijABCDEF0123+/", "中文的是不了人我😀", "thenaing") for n in (254, 255, 256, 257, 700, 3000)]
    words += ["international" * 100, "information" * 80]
    want = [brute(T.BEGIN + w, rank) for w in words]
    assert T.Counter(pieces)(words)[0].tolist() == want
    cut = [sum(brute(m[i : i + 256], rank) for i in range(0, len(m), 256)) for m in (T.BEGIN + w for w in words)]
    assert cut != want
