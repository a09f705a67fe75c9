"""Products against dense matrices, and the query against a plain version made of the public tokenizers."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from seqtable.llm import alignment as A
from seqtable.llm.csr import Csr, product_sizes, products

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
ODD = ["", None, " ", "a", "  two  blanks ", "▁a", "a ▁b", "<s>x</s><unk>", "<|endoftext|>", "<0x41>", "中文字符\U0001f600é́", "a\x00b", "\n\n\t x\r\n", "ﬁ ½ \xa0　", "a" * 3000, "x " * 2000]


def dense(m):
    out = np.zeros((m.rows, m.width), int)
    for r in range(m.rows):
        out[r, m.columns[m.starts[r] : m.starts[r + 1]]] = 1
    return out


def drawn(draw, rows, width):
    columns = [np.flatnonzero(draw.random(width) < 0.3) for _ in range(rows)]
    starts = np.cumsum([0, *map(len, columns)])
    return Csr(starts, np.concatenate([np.zeros(0, np.int64), *columns]), width)


@pytest.mark.parametrize("flops", [1, 7, 1 << 20])
def test_products_against_dense_matrices(flops):
    draw = np.random.default_rng(1)
    for n, k, m in [(5, 7, 6), (1, 1, 1), (8, 3, 9), (4, 0, 3), (0, 5, 2), (20, 30, 25)]:
        a, b = drawn(draw, n, k), drawn(draw, m, k)
        want = dense(a) @ dense(b).T
        got = np.zeros_like(want)
        for rows, columns, values in products(a, b.transposed(), flops):
            got[rows, columns] += values
        assert (got == want).all()
        assert (dense(a.transposed()) == dense(a).T).all()
        assert (product_sizes(a, b.transposed()) >= (want > 0).sum(axis=1)).all()


class Plain:
    """Token bytes and places straight from the files."""

    def __init__(self):
        self.a = Tokenizer.from_file(PATHS[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        other = [b for b in range(256) if b not in kept]
        self.letter = {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(other)}

    def spans(self, text):
        """(id, first byte, end) of both; none where the bytes aren't a blank and the text."""
        if not text:
            return [], []
        whole, out = (" " + text).encode(), []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        raws = [bytes(self.letter[c] for c in self.a.id_to_token(i)) for i in a], []
        b = self.b.encode(text)
        for i in b:
            piece = self.b.id_to_piece(i)
            raws[1].append(bytes.fromhex(piece[3:5]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        if b"".join(raws[0]) != whole or b"".join(raws[1]) != whole:
            return [], []
        for ids, raw in zip((a, b), raws, strict=True):
            at, spans = 0, []
            for i, r in zip(ids, raw, strict=True):
                spans.append((i, at, at + len(r)))
                at += len(r)
            out.append(spans)
        return tuple(out)

    @staticmethod
    def links(a, b):
        out, first = [], 0
        for i, start, end in a:
            while first < len(b) and b[first][2] <= start:
                first += 1
            k = first
            while k < len(b) and b[k][1] < end:
                out.append((i, start, b[k][0], b[k][1], min(end, b[k][2]) - max(start, b[k][1])))
                k += 1
        return out

    @staticmethod
    def groups(a, b):
        cuts = {e for _, _, e in a} & {e for _, _, e in b}
        out, low = [], 0
        for high in sorted(cuts):
            out.append([[i for i, s, e in side if low <= s and e <= high] for side in (a[:], b[:])])
            a, b = ([t for t in side if t[1] >= high] for side in (a, b))
            low = high
        return out

    def rows(self, documents):
        spans = [(key, *self.spans(text)) for key, text in documents]
        links = [self.links(a, b) for _, a, b in spans]
        count = Counter((x[0], x[2]) for own in links for x in own)
        best = {}
        for (_, b), n in count.items():
            best[b] = max(best.get(b, 0), n)
        out = []
        for (key, a, b), own in zip(spans, links, strict=True):
            groups = self.groups(a, b)
            written = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
            counts = [(count[x[0], x[2]], best[x[2]]) for x in own]
            digest = hashlib.sha256(written.encode()).hexdigest() if a else ""
            sums = len(own), sum(n == top for n, top in counts), sum(n for n, _ in counts)
            out.append((key, len(a), len(b), len(groups), *sums, digest, sum(len(x) * len(y) for x, y in groups)))
        return out


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links"]
key = lambda r: (r[0] is not None, r)


def texts():
    draw = random.Random(6)
    letters = "ab 'ést中\n\t \x1c\x85　123!?.\U0001f600́ lveREDñ▁"
    return ODD + ["".join(draw.choice(letters) for _ in range(draw.randint(0, 60))) for _ in range(300)]


@pytest.mark.parametrize("hot", [0, 40, 1 << 20])
def test_any_number_of_hot_pairs_gives_the_same(spark, hot):
    rows = [(k % 50 or None, t, "x") for k, t in enumerate(texts() + ODD)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, pairs string")
    aligned = A.align(frame, *PATHS, ["doc_id"]).cache()
    found = A.weigh(aligned, A.pair_counts(aligned), ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_group_links"], hot).collect()
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "n_group_links"]
    want = [r[:7] + r[8:] for r in Plain().rows([r[:2] for r in rows])]
    assert sorted((tuple(r[n] for n in names) for r in found), key=lambda r: (r[0] is not None, r[0] or 0, r[1:])) == sorted(
        want, key=lambda r: (r[0] is not None, r[0] or 0, r[1:])
    )
    aligned.unpersist()


def test_new_pieces_are_encoded_by_the_line():
    own, handed = A.Vocabularies(*PATHS), []
    plain = own.b

    class Counted:
        def encode(self, texts, **options):
            handed.extend(texts)
            return plain.encode(texts, **options)

    own.b = Counted()
    words = [f"w{k}," for k in range(4000)]
    words[7], words[300], words[2000] = "", "\u2581x", "\u4e2d\n\u00e9"
    for drop in ("", "\u2581x"):
        text = " ".join(w for w in words if w != drop or not drop)
        (a, b), want = own.encode([text])[0], Plain().spans(text)
        assert [np.frombuffer(x, "<u4").tolist() for x in (a, b)] == [[i for i, _, _ in side] for side in want]
        assert bool(b) == bool(drop)
    assert len(handed) < 2 * A.LINE


def test_listed_links(spark):
    rows = [(k, t) for k, t in enumerate(texts()[:80])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    plain = Plain()
    want, together = [], []
    for k, t in rows:
        a, b = plain.spans(t)
        want += [(k, i, s, j, r, n) for i, s, j, r, n in plain.links(a, b)]
        together += [(k, i, j) for g in plain.groups(a, b) for i in g[0] for j in g[1]]
    assert sorted(map(tuple, A.links(frame, *PATHS).collect())) == sorted(want)
    assert sorted((r.doc_id, r.a, r.b) for r in A.group_links(frame, *PATHS).collect()) == sorted(together)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    aligned = A.align(frame, *PATHS, ["doc_id"])
    assert A.weigh(aligned, A.pair_counts(aligned), ["doc_id"]).count() == 0
    assert A.links(frame, *PATHS).count() == 0


def test_query(spark):
    from seqtable.llm.queries import op12_alignment

    folder = "/root/testdata/sf0.001"
    found = op12_alignment(spark, folder)
    assert found.columns == NAMES
    documents = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert sorted(map(tuple, found.collect())) == sorted(Plain().rows(documents))
