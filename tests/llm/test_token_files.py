"""Exact round trips, the tokenizer's own ids, and damaged files."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from seqtable import session
from seqtable.llm import mixing, queries
from seqtable.llm import token_files as T

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "it's (don't) A=B.\n\tÉÇ é ≠ x", "中文 123 a1b2 \x1c\x85 y", "İΣς!?'s", "<|endoftext|> x", "a <|startoftext|>b", "word " * 3000]


def own(text):
    return [*T.tokens(PATH).tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_same_ids_as_the_tokenizer():
    draw = random.Random(4)
    letters = "ab 'ést中\n\t \x1c\x85　123!?.=-_\U0001f600̸́ lveREDñ"
    texts = ODD + ["".join(draw.choice(letters) for _ in range(draw.randint(0, 60))) for _ in range(3000)]
    for text, raw in zip(texts, T.tokens(PATH)(texts), strict=True):
        assert np.frombuffer(raw, "<u2").tolist() == own(text)[:-1], repr(text)


def test_every_character_beside_every_border():
    borders = [" ", "\n", ".", ",", "!", "?", ")", "(", "-", "'", '"', "a", "7"]
    letters = [chr(c) for c in [*range(1, 0x3100), *range(0xA640, 0xABFF), *range(0xF900, 0x10000)] if not 0xD800 <= c < 0xE000]
    texts = [f"x{c}{b}{b}{c} a{c}b{b}" for c in letters for b in borders]
    found = T.Tokens(PATH)
    for start in range(0, len(texts), 20_000):
        some = texts[start : start + 20_000]
        want = found.tokenizer.encode_batch_fast(some, add_special_tokens=False)
        for text, raw, ids in zip(some, found(some), want, strict=True):
            assert np.frombuffer(raw, "<u2").tolist() == ids.ids, repr(text)


def test_dotted_capital_i_through_the_files(spark):
    rows = [(1, "KİTABİ, x", 0), (2, "nowİ?", 0), (3, "y", 0)]
    found = sorted(T.read(spark, files(spark, rows), T.all_ids, "ids binary").collect())
    start = 0
    for r, (k, t, _) in zip(found, rows, strict=True):
        assert (r.key, r.start, np.frombuffer(r.ids, "<u4").tolist()) == (k, start, own(t))
        start += r.n_tokens


def test_many_rows_of_one_key_stay_in_order_and_split(spark):
    rows = [(None, f"text {k % 700:03}", 0) for k in range(3000)] + [(7, "x", 0)]
    merge = "spark.sql.adaptive.coalescePartitions.enabled"  # would put so few rows together again
    spark.conf.set(merge, "false")
    folder = files(spark, rows)
    spark.conf.set(merge, "true")
    found = sorted(T.read(spark, folder, T.all_ids, "ids binary").collect(), key=lambda r: r.start)
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in found] == [own(t) for _, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[1]))]
    assert spark.read.parquet(folder).select("part").distinct().count() > 1


@pytest.mark.parametrize("kind", ["same", "random", "large", "ramp", "words"])
def test_blocks_round_trip(kind):
    draw = np.random.default_rng(2)
    sizes = [1, 2, 700, 2048, 3]
    of = {
        "same": lambda n: np.full(n, 7),
        "random": lambda n: draw.integers(0, 65536, n),
        "large": lambda n: np.full(n, 65535) - draw.integers(0, 2, n),
        "ramp": lambda n: np.arange(n) % 65536,
        "words": lambda n: (draw.zipf(1.3, n) * 37) % 50_000,
    }[kind]
    blocks = [of(n).astype(np.uint16) for n in sizes]
    coded = mixing.encode_blocks(blocks)
    found = mixing.decode_blocks(coded, np.array(sizes))
    assert all((a == b).all() for a, b in zip(blocks, found, strict=True))
    if kind == "same":
        assert len(coded[3]) < 200
    assert mixing.encode_blocks([]) == [] and mixing.decode_blocks([], np.zeros(0, np.int64)) == []


@pytest.mark.parametrize("lanes", [3, mixing.LANES])
def test_blocks_by_the_counts_of_their_container(monkeypatch, lanes):
    monkeypatch.setattr(mixing, "LANES", lanes)
    draw = np.random.default_rng(3)
    ids = np.minimum(draw.zipf(1.2, 16_000), 40_000).astype(np.uint16)  # no id tells of the next
    part = np.unique(ids, return_counts=True)[1] / len(ids)
    blocks = [ids[i : i + 2000] for i in range(0, len(ids), 2000)]
    slots = mixing.shares(ids)
    assert slots.sum() == mixing.SLOTS and (slots[ids] > 0).all()
    coded = mixing.encode_blocks(blocks, slots)
    assert 8 * sum(map(len, coded)) < 1.05 * len(ids) * -(part * np.log2(part)).sum()
    found = mixing.decode_blocks(coded, np.full(8, 2000), slots)
    assert all((a == b).all() for a, b in zip(blocks, found, strict=True))
    alone = mixing.decode_blocks(coded[5:6], np.array([2000]), slots)
    assert (alone[0] == blocks[5]).all()
    with pytest.raises(ValueError, match="without a slot"):
        mixing.encode_blocks([np.array([65_000])], slots)


def test_guesses_that_agree_add_up():
    pattern = np.tile(np.arange(500, dtype=np.uint16), 4)  # both contexts tell the next id after the first 500
    ids = np.random.default_rng(5).integers(0, 500, 2000).astype(np.uint16)
    slots = mixing.shares(np.concatenate([pattern, ids]))
    known, drawn = mixing.encode_blocks([pattern, ids], slots)
    assert len(known) < 0.45 * len(drawn)


def test_pieces_alike_in_their_first_bytes(monkeypatch):
    monkeypatch.setattr(T, "KNOWN", 20)  # forgets between calls
    found = T.Tokens(PATH)
    texts = ["a\0 a a\0\0 \0", *("x" * n + " " + "xy" * n for n in range(40)), "中" * 30 + "1 " + "中" * 30 + "2", None, ""]
    for _ in range(2):
        for text, raw in zip(texts, found(texts), strict=True):
            assert np.frombuffer(raw, "<u2").tolist() == own(text)[:-1], repr(text)


def test_pieces_of_one_hash_are_told_apart(monkeypatch):
    def crowded(data, begins, lengths):
        keys = hashed(data, begins, lengths)
        keys[-1] = 7
        return keys

    hashed = T.words
    monkeypatch.setattr(T, "words", crowded)
    texts = ["one two three, four", "four three five!"]
    for text, raw in zip(texts, T.Tokens(PATH)(texts), strict=True):
        assert np.frombuffer(raw, "<u2").tolist() == own(text)[:-1]


def files(spark, rows):
    folder = session.new_folder(spark, "test-tokens")
    frame = spark.createDataFrame(rows, "doc_id long, text string, start int")
    T.write(frame.repartition(3), folder, PATH, 2)
    return folder


@pytest.mark.parametrize("container", [T.CONTAINER, 2500])
def test_files_round_trip_in_order(spark, monkeypatch, container):
    monkeypatch.setattr(T, "CONTAINER", container)
    rows = [(k if k else None, t, 0) for k, t in enumerate(ODD)] + [(3, ODD[3], 0)]
    found = sorted(T.read(spark, files(spark, rows), T.all_ids, "ids binary").collect(), key=lambda r: r.start)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    start = 0
    for r, (k, t, _) in zip(found, want, strict=True):
        assert (r.key, r.start, np.frombuffer(r.ids, "<u4").tolist()) == (k, start, own(t))
        start += r.n_tokens


def test_empty_table(spark):
    assert T.read(spark, files(spark, []), T.all_ids, "ids binary").count() == 0


def test_damage_is_found():
    blocks = [{"n": n, "crc": c, "payload": p} for n, c, p in T.packed([np.arange(3000, dtype="<u2").tobytes()])]
    assert len(T.unpacked(blocks, "x")) == 3000
    blocks[1]["payload"] = blocks[1]["payload"][:40] + b"\x01\x02" + blocks[1]["payload"][42:]
    with pytest.raises(ValueError, match="block 1 of container x"):
        T.unpacked(blocks, "x")


def test_query(spark):
    folder, start = "/root/testdata/sf0.001", 0
    found = sorted(queries.op2_token_files(spark, folder).collect())
    documents = sorted(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    for r, d in zip(found, documents, strict=True):
        ids = own(d.text)
        assert [r[n] for n in names] == [d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())]
        start += len(ids)
