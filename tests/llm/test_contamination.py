"""Against all pairs of windows in plain Python, and against SQL."""

import random
import re

import pytest

from seqtable.llm import contamination as C
from seqtable.llm import queries

from .compare import check

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(documents, items, window=13):
    out = []
    wins = {(i, tuple(w[k : k + window])) for i, t in items if (w := tokens(t)) and i is not None for k in range(max(1, len(w) - window + 1))}
    for doc_id, text in documents:
        words, hit, names = tokens(text), set(), set()
        for item, win in wins:
            for k in range(len(words) - len(win) + 1):
                if tuple(words[k : k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    names.add(str(item))
        out.append((doc_id, len(words), len(hit), sorted(names)))
    return sorted(out, key=str)


def rows(spark, documents, items, **options):
    d = spark.createDataFrame([(a, b, "x") for a, b in documents], "doc_id long, text string, items string")
    b = spark.createDataFrame(items, "item_id long, text string")
    found = C.find(d, b, ["doc_id"], **options).withColumn("n", C.n_hit(C.F.col("hits"))).collect()
    return sorted(((r.doc_id, r.n_words, r.n, r["items"]) for r in found), key=str)


@pytest.mark.parametrize("block_words", [C.BLOCK_WORDS, 40])
def test_against_all_windows(spark, block_words):
    draw = random.Random(2)
    vocabulary = ["alpha", "Beta", "g", "éa", "12", "the", "the"]
    text = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    items = [(i, text(draw.choice([1, 2, 3, 5, 12, 13, 14, 20]))) for i in range(12)] + [(3, text(15)), (None, text(14)), (40, None), (41, ""), (42, "!?")]
    documents = [(i, text(draw.randint(0, 60))) for i in range(40)]
    documents += [(50 + k, f"{text(5)}, {(t or str()).upper()}! {text(4)}") for k, (_, t) in enumerate(items)]
    documents += [(90, None), (None, items[7][1]), (91, ""), (91, ""), (92, " ".join([items[5][1] or "x"] * 30))]
    assert rows(spark, documents, items, block_words=block_words) == brute(documents, items)


def test_empty_tables(spark):
    assert rows(spark, [], [(1, "a b")]) == []
    assert rows(spark, [(1, "a b")], []) == [(1, 2, 0, [])]


def test_texts_do_not_run_into_each_other(spark):
    assert rows(spark, [(1, "a b"), (2, "c d")], [(7, "b c")]) == [(1, 2, 0, []), (2, 2, 0, [])]


def test_query_against_sql(spark):
    assert any(r[0] for r in check(spark, queries.op7_contamination, queries.OP7_SQL, "/root/testdata/sf0.001"))
    check(spark, queries.op7_contamination, queries.OP7_SQL, "/root/testdata/sf0.01")
