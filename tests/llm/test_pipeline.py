"""Every stage against brute force on a small fixture, each written and read again."""

import random

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline as P
from seqtable.llm import byte_bpe, credentials

from .test_contamination import brute as brute_hits
from .test_near_dups import brute as brute_groups
from .test_near_dups import shingles


def sentence(draw, n):
    common = "the and of to in is that for with was".split()
    return " ".join(draw.choice(common) if draw.random() < 0.5 else draw.choice("aeiou") + draw.choice("nrst") + str(draw.choice("ing ed er".split())) + draw.choice("bcdfgh") for _ in range(n))


def fixture():
    draw = random.Random(8)
    item = sentence(draw, 30)
    texts = [sentence(draw, draw.choice([8, 40, 200])) for _ in range(30)]
    texts += [t + " tail" for t in texts[10:16]] + texts[:4]
    texts += [sentence(draw, 60) + " " + item + " " + sentence(draw, 60), item, sentence(draw, 3000) + " " + item]
    texts += ["", None, "123 456 !!", sentence(draw, 40) + " password=abcdefgh12 " + sentence(draw, 9)]
    documents = [(1000 + i, t, "en" if i % 3 else None, None if i % 7 == 0 else "src0", len(t or "") if i % 5 else None) for i, t in enumerate(texts)]
    documents += [(None, sentence(draw, 50), "en", "src1", 3), documents[20], documents[20]]
    return documents, [(1, item), (2, None), (None, "x")]


def plain(r):
    return tuple(bytes(v) if isinstance(v, bytearray) else v for v in r)


def test_stages(spark, tmp_path):
    documents, items = fixture()
    folder = str(tmp_path)
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    want = [d for d in documents if d[1] and any(c.isalpha() for c in d[1])]
    steps = [want]
    _, group = brute_groups([d[:2] for d in want], 5, 80, 100)
    best = {}
    for d, g in zip(want, group, strict=True):
        assert shingles(d[1], 5)
        best[g] = min(best.get(g, d), d, key=lambda x: (x[0] is None, x[0] or 0))
    steps.append(list(best.values()))
    hits = {(r[0]): r for r in brute_hits([d[:2] for d in steps[-1]], items)}
    steps.append([d for d in steps[-1] if not (hits[d[0]][2] > 0 and 20 * hits[d[0]][2] >= hits[d[0]][1])])
    masked = [(d[0], credentials.masked(d[1]), *d[2:4], d[4]) for d in steps[-1]]
    steps.append([(*m[:4], len(m[1]) if m[1] != d[1] else m[4]) for m, d in zip(masked, steps[-1], strict=True)])
    assert [len(documents), *map(len, steps)] == sorted([len(documents), *map(len, steps)], reverse=True) and len(set(map(len, steps[:3]))) == 3
    assert steps[3] != steps[2] and any("[secret]" in d[1] for d in steps[3])
    ranks = byte_bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken")).ids
    public = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = [np.array(public.encode_ordinary(d[1]), "<u4") for d in steps[-1]]
    steps.append([(d[0], d[2], d[3], d[4], len(i), i.tobytes(), True) for d, i in zip(steps[-1], ids, strict=True)])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(P.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        assert k == 4 or docs.columns == columns, name
        assert sorted(map(str, map(plain, docs.collect()))) == sorted(map(str, steps[k])), name
    assert sorted(map(str, map(plain, P.run(spark, folder).collect()))) == sorted(map(str, steps[4]))


def test_empty_tables_and_extra_columns(spark, tmp_path):
    folder = str(tmp_path)
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, items string, label int, spans int, __text int")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert P.run(spark, folder).count() == 0
    one = spark.createDataFrame([(1, "the of and", "en", "s", 10, "a", 5, 6, 7)], docs.schema)
    for name, stage in P.STAGES[:4]:
        found = stage(spark, one, folder)
        assert found.columns == one.columns and found.collect() == one.collect(), name
