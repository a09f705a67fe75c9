"""Against the public encoder, and exact round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from seqtable.llm import byte_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["", None, "a" * 5000, "ab" * 700, " " * 900 + "x", "!?" * 800, "中文" * 600, "it's  'tis\n\n\t x", "naïve Ünder1234\x85 y", "é́'ll"]


@pytest.fixture(scope="module")
def public():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.load(PATH).ids, special_tokens={})


def texts():
    draw = random.Random(5)
    letters = "ab 'ést中\n\t \x1c\x85　123!?.\U0001f600́ lveREDñ"
    return ODD + ["".join(draw.choice(letters) for _ in range(draw.randint(0, 60))) for _ in range(3000)]


def test_same_ids_as_the_public_encoder(public):
    found = byte_bpe.Encoder(byte_bpe.load(PATH), public_tokenizers.PATTERN).encode(texts())
    for text, ids in zip(texts(), found, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == public.encode_ordinary(text or ""), repr(text)[:80]


def test_matrix_and_heap_agree():
    ranks = byte_bpe.load(PATH)
    words = [w for w in {(t or "").encode()[:200] for t in texts()} if w]
    assert byte_bpe.merge_matrix(ranks, words) == [byte_bpe.merge_heap(ranks, w) for w in words]


def test_frames_keep_rows_and_round_trip(spark, public):
    rows = [(i % 7 or None, t, "x") for i, t in enumerate(ODD * 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encoded = byte_bpe.encode(frame, PATH, public_tokenizers.PATTERN, ["doc_id"])
    decoded = byte_bpe.decode(encoded, PATH, ["doc_id", "n_tokens"]).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    expected = [(i, len(public.encode_ordinary(t or "")), (t or "").encode()) for i, t, _ in rows]
    assert sorted(((r.doc_id, r.n_tokens, bytes(r.decoded)) for r in decoded), key=key) == sorted(expected, key=key)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.encode(frame, PATH, public_tokenizers.PATTERN, ["doc_id"]).count() == 0


def test_query_against_public_encoder(spark, public):
    from seqtable.llm.queries import op10_byte_bpe

    folder = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in op10_byte_bpe(spark, folder).collect()}
    documents = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(found) == len(documents)
    for d in documents:
        ids = np.array(public.encode_ordinary(d.text or ""), "<u4")
        got = found[d.doc_id]
        assert got.n_tokens == len(ids) and got.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert got.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
