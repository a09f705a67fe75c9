"""Alignment of the tokens that two tokenizers make of the same text.

Both tokenizers cut the bytes of a blank and the text. Token-byte incidence
matrices A and B (one row for a token, ones at its bytes, compressed rows) give
the links: A·Bᵀ by Gustavson's method has a non-zero for each pair of tokens that
overlap, with the number of bytes they share. Where tokens of both end, the text
is cut into groups; the product of the token-group matrices has a non-zero for
each pair of tokens of one group.

    align(documents, ...)       counts and links of each document, as id pairs with their times
    pair_counts(aligned)        how many links of the whole corpus hold an id pair linked
    weigh(aligned, counts)      of each document: links that are their B id's most usual, sum of counts
    links(documents, ...)       one row per link, with byte places and shared bytes
    group_links(documents, ...) one row per pair of tokens of one group

Pairs of ids are counted by Spark over the whole corpus. The most frequent ones, HOT
at most, are sent to the tasks; all others are joined by shuffle. A frequent pair
has no rows in that join, so no key of it is hot.

Results for odd input: a text that is null or empty, or whose tokens don't spell a
blank and the text (the character U+2581 reads as a blank), has no tokens: zeros,
no pairs and empty groups. Repeated rows and null ids are rows of their own. Extra
columns don't matter. An empty table gives an empty one.
"""

import functools
import itertools
import json
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtable import session
from seqtable.llm import byte_bpe
from seqtable.llm.csr import Csr, product_sizes, products
from seqtable.llm.tables import HashTable
from seqtable.llm.texts import map_texts, slices

#: Id pairs sent to the tasks at most (16 bytes each).
HOT = 1 << 20
#: Id pairs a task counts in memory before it hands them on.
HELD = 1 << 20
#: Pieces of text of which a worker keeps the ids, for each tokenizer.
KNOWN = 60_000
#: Pieces that the second tokenizer encodes as one line.
LINE = 256
_PART = np.int64(1) << np.int64(32)
_BLANKED = re.compile(" +[^ ]*").findall


class JsonRanks(byte_bpe.Ranks):
    """The ranks of a byte-level vocabulary kept as JSON: merges in order, each of which made the next id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as lines:
            held = json.load(lines)
        model, letters = held["model"], _byte_letters()
        own = {t["id"] for t in held["added_tokens"]}
        spell = lambda t: bytes(letters[c] for c in t)
        self.ids = {spell(t): i for t, i in model["vocab"].items() if i not in own}
        self.tokens = [b""] * (max(self.ids.values()) + 1)
        for token, i in self.ids.items():
            self.tokens[i] = token
        self.single = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = ([self.ids[spell(p[side])] for p in pairs] for side in (0, 1))
        whole = [self.ids[spell(a + b)] for a, b in pairs]
        if any(y <= x for x, y in itertools.pairwise(whole)):
            raise ValueError("ids of merged tokens must ascend with their merges")
        # Any two tokens that make a third merge at its rank, as the heap of long words has it.
        table = {(self.ids.get(t[:cut]), self.ids.get(t[cut:])): i for t, i in self.ids.items() for cut in range(1, len(t))}
        table = {pair: i for pair, i in table.items() if None not in pair} | dict(zip(zip(left, right, strict=True), whole, strict=True))
        left, right = np.array(list(table), np.int64).T
        self.table = HashTable(byte_bpe._pair(left, right), np.array(list(table.values()), np.int32))


class Vocabularies:
    """The two tokenizers, the bytes of their tokens, and decimal ids with the sign that follows them."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        ranks = JsonRanks(path_a)
        self.a = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a, self.bytes_b = ranks.tokens, [self._piece(i) for i in range(self.b.get_piece_size())]
        self.length_a = np.array([len(t) for t in self.bytes_a])
        self.length_b = np.array([len(t) for t in self.bytes_b])
        # No piece of B has a blank behind another character, so blanks begin what can be encoded by itself.
        within = any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(self.b.get_piece_size()))
        self.lined = not within
        self.blank = [self.b.piece_to_id("▁")]
        self.cache_b = Pieces(_unblanked if self.lined else lambda t: [t[1:]] if t else [], self._ids_b)
        self.most = max(len(self.bytes_a), len(self.bytes_b))
        self.signed = pa.array([f"{i}{sign}".encode() for sign in (",", "|", ";") for i in range(self.most)], pa.large_binary())

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    def _ids_b(self, pieces: list[str]) -> list[bytes | None]:
        """Ids (little-endian 32-bit) of a blank and each piece; null where their bytes aren't those. The tokenizer adds the first blank itself."""
        ids = self._of_lines([p for p in pieces if p.strip(" ")]) if self.lined else {}
        left = [p for p in pieces if p not in ids]
        for piece, found in zip(left, self.b.encode(left, num_threads=1), strict=True):
            ids[piece] = _packed(found if piece else self.blank, self.bytes_b, " " + piece)
        return [ids[p] for p in pieces]

    def _of_lines(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pieces that stand in one line as they would alone; without those of a line whose bytes differ."""
        out = {}
        lines = [pieces[i : i + LINE] for i in range(0, len(pieces), LINE)]
        for line, ids in zip(lines, self.b.encode([" ".join(line) for line in lines], num_threads=1), strict=True):
            raw = [p.encode() for p in line]
            spelled = b"".join(map(self.bytes_b.__getitem__, ids))
            ends = np.cumsum(self.length_b[ids])
            wanted = np.cumsum(np.array([len(r) for r in raw]) + 1)
            stops = np.searchsorted(ends, wanted)
            if spelled == b" " + b" ".join(raw) and (ends[stops] == wanted).all():
                packed, stops = np.array(ids, "<u4").tobytes(), (4 * stops + 4).tolist()
                out.update((p, packed[start:stop]) for p, start, stop in zip(line, [0, *stops], stops, strict=False))
        return out

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """Ids of both for each text; both empty where the text has no tokens by the rule above."""
        spaced = [" " + t if t else "" for t in texts]
        sides = self.a.encode(spaced), self.cache_b(spaced)
        return [(b"", b"") if b is None else (a, b) for a, b in zip(*sides, strict=True)]


def _packed(ids: list[int], tokens: list[bytes], piece: str) -> bytes | None:
    return np.array(ids, "<u4").tobytes() if b"".join(map(tokens.__getitem__, ids)) == piece.encode() else None


def _unblanked(text: str) -> list[str]:
    """Blanks and what follows them in a text that begins with one, each without its first blank."""
    if "  " in text or text.endswith(" "):
        return [p[1:] for p in _BLANKED(text)]
    return text[1:].split(" ") if text else []


class Pieces:
    """Ids of texts put together from those of their pieces; a piece met lately isn't encoded again."""

    def __init__(self, cut: Callable[[str], list[str]], learn: Callable[[list[str]], list[bytes | None]]):
        self.cut, self.learn = cut, learn
        self.known: dict[str, bytes | None] = {}
        self.older: dict[str, bytes | None] = {}

    def __call__(self, texts: list[str]) -> list[bytes | None]:
        split = [self.cut(t) for t in texts]
        if len(self.known) > KNOWN:
            self.known, self.older = {}, self.known
        new = set().union(*split).difference(self.known)
        met = new.intersection(self.older)
        self.known.update((p, self.older[p]) for p in met)
        new = list(new - met)
        self.known.update(zip(new, self.learn(new), strict=True))
        out = []
        for pieces in split:
            ids = [self.known[p] for p in pieces]
            out.append(None if None in ids else b"".join(ids))
        return out


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes are themselves, the rest follow from U+0100."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@functools.lru_cache(maxsize=1)
def load(path_a: str, path_b: str) -> Vocabularies:
    """One for each worker process."""
    return Vocabularies(path_a, path_b)


class Slice(NamedTuple):
    """The tokens of some texts one after the other, and the matrices over all their bytes."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    text_a: np.ndarray  # text of each token
    text_b: np.ndarray
    by_byte_a: Csr
    by_byte_b: Csr
    by_group_a: Csr
    by_group_b: Csr
    n: int

    def overlaps(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks of (A token, B token, shared bytes)."""
        return products(self.by_byte_a, self.by_byte_b.transposed())

    def together(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Blocks of (A token, B token, 1) of tokens in one group."""
        return products(self.by_group_a, self.by_group_b.transposed())

    def groups_of_texts(self) -> np.ndarray:
        """Number of groups of each text."""
        first = np.diff(self.by_group_a.columns, prepend=-1) > 0
        return np.bincount(self.text_a[first], minlength=self.n)


def matrices(own: Vocabularies, encoded: list[tuple[bytes, bytes]]) -> Slice:
    sides = []
    for side, lengths in ((0, own.length_a), (1, own.length_b)):
        sizes = np.array([len(e[side]) // 4 for e in encoded], np.int64)
        ids = np.frombuffer(b"".join([e[side] for e in encoded]), "<u4").astype(np.int64)
        sides.append((ids, np.repeat(np.arange(len(encoded)), sizes), np.cumsum(lengths[ids])))
    (ids_a, text_a, ends_a), (ids_b, text_b, ends_b) = sides
    size = int(ends_a[-1]) if len(ends_a) else 0
    last = np.zeros((2, size), bool)  # bytes that end a token
    last[0, ends_a - 1] = last[1, ends_b - 1] = True
    group = np.cumsum(last[0] & last[1]) - (last[0] & last[1])  # of each byte
    n_groups = int(group[-1]) + 1 if size else 0
    return Slice(
        ids_a,
        ids_b,
        text_a,
        text_b,
        Csr.of_runs(own.length_a[ids_a], size),
        Csr.of_runs(own.length_b[ids_b], size),
        Csr.of_single(group[ends_a - 1], n_groups),
        Csr.of_single(group[ends_b - 1], n_groups),
        len(encoded),
    )


def _pairs(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, id pair) in order, with the links of each."""
    bits_b, bits = (int(ids.max(initial=0)).bit_length() for ids in (part.ids_b, part.ids_a))
    bits += bits_b
    if bits + part.n.bit_length() > 63:  # no slice has so many texts with vocabularies of some 100,000 ids
        raise ValueError("texts and ids of a slice don't fit 63 bits")
    keys = [part.text_a[a] << bits | part.ids_a[a] << bits_b | part.ids_b[b] for a, b, _ in part.overlaps()]
    key = np.sort(np.concatenate([np.zeros(0, np.int64), *keys]))
    new = np.flatnonzero(np.diff(key, prepend=-1))
    pair = key[new] & ((1 << bits) - 1)
    return key[new] >> bits, (pair >> bits_b) * _PART + (pair & ((1 << bits_b) - 1)), np.diff(new, append=len(key))


def _written(own: Vocabularies, part: Slice) -> list[bytes]:
    """Groups of each text as `a1,a2|b1;a3|b2,b3`."""
    group_a, group_b = part.by_group_a.columns, part.by_group_b.columns
    count_a, count_b = (np.bincount(g, minlength=part.by_group_a.width) for g in (group_a, group_b))
    before_a, before_b = np.cumsum(count_a), np.cumsum(count_b)
    signed = np.empty(len(group_a) + len(group_b), np.int64)
    last_a = np.diff(group_a, append=-1) != 0
    last_b = np.diff(group_b, append=-1) != 0
    signed[np.arange(len(group_a)) + (before_b - count_b)[group_a]] = part.ids_a + own.most * last_a
    signed[np.arange(len(group_b)) + before_a[group_b]] = part.ids_b + 2 * own.most * last_b
    ends = np.cumsum(np.bincount(part.text_a, minlength=part.n) + np.bincount(part.text_b, minlength=part.n))
    # Arrow lays the strings it takes one after the other, which is the text.
    spelled = own.signed.take(pa.array(signed))
    _, offsets, data = spelled.buffers()
    stops = np.frombuffer(offsets, np.int64, len(signed) + 1)[ends].tolist()
    whole = data.to_pybytes() if data else b""
    return [whole[start : max(start, stop - 1)] for start, stop in zip([0, *stops], stops, strict=False)]


def align(documents: DataFrame, path_a: str, path_b: str, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep`, then

    n_a, n_b, n_groups, n_links, n_group_links   counts
    groups                                       `a1,a2|b1;a3|b2,b3`: ids in order, cut into groups
    pairs, times                                 linked id pairs (A id · 2^32 + B id) and their links
    """

    def prepare():
        own = load(path_a, path_b)

        def work(texts: pa.Array) -> list:
            part = matrices(own, own.encode(texts.to_pylist()))
            owner, codes, times = _pairs(part)
            together = product_sizes(part.by_group_a, part.by_group_b.transposed())
            ends = np.searchsorted(owner, np.arange(part.n + 1)).astype(np.int32)
            return [
                np.bincount(part.text_a, minlength=part.n),
                np.bincount(part.text_b, minlength=part.n),
                part.groups_of_texts(),
                np.bincount(owner, times, minlength=part.n).astype(np.int64),
                np.bincount(part.text_a, together, minlength=part.n).astype(np.int64),
                [w.decode() for w in _written(own, part)],
                pa.ListArray.from_arrays(ends, pa.array(codes)),
                pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32))),
            ]

        return work

    made = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_group_links bigint, groups string, pairs array<bigint>, times array<int>"
    return map_texts(documents, keep, text, made, prepare)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): links of the whole corpus by id pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out():
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])

        for batch in batches:
            for rows in _pieces(batch):
                new, where = np.unique(np.concatenate([pairs, rows.column(0).flatten().to_numpy(zero_copy_only=False)]), return_inverse=True)
                weights = np.concatenate([counts, rows.column(1).flatten().to_numpy(zero_copy_only=False)])
                pairs, counts = new, _summed(where, weights, len(new))
                if len(pairs) > HELD:
                    yield out()
                    pairs, counts = pairs[:0], counts[:0]
        yield out()

    partial = aligned.select("pairs", "times").mapInArrow(run, "pair bigint, n bigint")
    return partial.groupBy("pair").agg(F.sum("n").alias("n"))


def _summed(where: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    np.add.at(out, where, weights)
    return out


def _pieces(batch: pa.RecordBatch, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows in runs of at most `most` pairs, but for a longer row."""
    ends = np.cumsum(np.diff(batch.column(0).offsets.to_numpy()), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        used = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, used + most, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _hot(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs with as many links as a power of two that at most `most` pairs reach, in order, and their links."""
    level = F.length(F.bin("n"))
    rows = sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True)  # 64 rows at most
    reached, least = 0, 64
    for row in rows:
        reached += row["count"]
        if reached > most:
            break
        least = row.level
    table = counts.filter(level >= least).toArrow()
    pairs, n = (table.column(c).to_numpy() for c in ("pair", "n"))
    order = np.argsort(pairs)
    return pairs[order], n[order]


def weigh(aligned: DataFrame, counts: DataFrame, keep: list[str], hot: int = HOT) -> DataFrame:
    """Columns `keep`, n_best (links of the highest count of their B id) and count_sum (counts of all links).

    `aligned` and `counts` are read twice or more, so they should be written tables.
    """
    spark = aligned.sparkSession
    best = counts.groupBy((F.col("pair") % (1 << 32)).alias("b")).agg(F.max("n").alias("best"))
    found = best.toArrow()  # one row for an id of B's vocabulary
    best_of = np.zeros(1 + max(found.column("b").to_pylist(), default=0), np.int64)
    best_of[found.column("b").to_numpy()] = found.column("best").to_numpy()
    sent = spark.sparkContext.broadcast((*_hot(counts, hot), best_of))
    rows = aligned.select(F.monotonically_increasing_id().alias("row"), "pairs", "times", *[F.struct(*keep).alias("kept")])
    schema = "row bigint, n_best bigint, count_sum bigint, cold array<bigint>, cold_times array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, top = sent.value
        for batch in batches:
            for part in _pieces(pa.RecordBatch.from_arrays(batch.columns[1:3] + [batch.column(0), batch.column(3)], names=["p", "t", "r", "k"])):
                sizes = np.diff(part.column(0).offsets.to_numpy())
                code, times = (part.column(i).flatten().to_numpy(zero_copy_only=False) for i in (0, 1))
                owner = np.repeat(np.arange(part.num_rows), sizes)
                at = np.searchsorted(pairs, code)
                known = np.zeros(len(code), bool)
                inside = at < len(pairs)
                known[inside] = pairs[at[inside]] == code[inside]
                count = n[at[known]]
                sums = _summed(owner[known], times[known] * count, part.num_rows)
                wins = _summed(owner[known], times[known] * (count == top[code[known] % _PART]), part.num_rows)
                ends = np.zeros(part.num_rows + 1, np.int32)
                np.cumsum(np.bincount(owner[~known], minlength=part.num_rows), out=ends[1:])
                cold = [pa.ListArray.from_arrays(ends, pa.array(x[~known])) for x in (code, times)]
                yield pa.RecordBatch.from_arrays([part.column(2), pa.array(wins), pa.array(sums), *cold, part.column(3)], names=names)

    kept = rows.schema["kept"].dataType.simpleString()
    names = ["row", "n_best", "count_sum", "cold", "cold_times", "kept"]
    folder = session.new_folder(spark, "alignment")
    rows.mapInArrow(run, f"{schema}, kept {kept}").write.parquet(folder)
    rows = spark.read.parquet(folder)
    cold = rows.select("row", F.explode(F.arrays_zip("cold", "cold_times")).alias("c")).select("row", F.col("c.cold").alias("pair"), F.col("c.cold_times").alias("times"))
    cold = cold.join(counts, "pair").join(F.broadcast(best) if len(best_of) <= 1 << 20 else best, F.col("pair") % (1 << 32) == F.col("b"))
    cold = cold.groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
    )
    sums = [(F.col(a) + F.coalesce(b, F.lit(0))).alias(a) for a, b in (("n_best", "more_best"), ("count_sum", "more_sum"))]
    return rows.join(cold, "row", "left").select("kept.*", *sums)


def _listed(
    documents: DataFrame, path_a: str, path_b: str, key: str, text: str, blocks: Callable[[Slice], Iterator[tuple]]
) -> DataFrame:
    """One row for each non-zero of a product, in blocks of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = load(path_a, path_b)
        for batch in batches:
            for rows in slices(batch, 1):
                part = matrices(own, own.encode(rows.column(1).to_pylist()))
                for a, b, shared in blocks(part):
                    columns = [rows.column(0).take(pa.array(part.text_a[a]))]
                    for ids, text_of, starts, at in (
                        (part.ids_a, part.text_a, part.by_byte_a.starts, a),
                        (part.ids_b, part.text_b, part.by_byte_b.starts, b),
                    ):
                        begins = starts[np.searchsorted(text_of, np.arange(part.n))]
                        columns += [pa.array(ids[at].astype(np.int32)), pa.array(starts[at] - begins[text_of[at]])]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(shared.astype(np.int32))], names=names)

    names = [key, "a", "start_a", "b", "start_b", "shared"]
    chosen = documents.select(documents[key], documents[text].alias("_" + key + "_text"))
    return chosen.mapInArrow(run, f"`{key}` {documents.schema[key].dataType.simpleString()}, a int, start_a bigint, b int, start_b bigint, shared int")


def links(documents: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per overlapping pair of tokens: key, ids, first bytes (in blank and text) and shared bytes."""
    return _listed(documents, path_a, path_b, key, text, Slice.overlaps)


def group_links(documents: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per pair of tokens of one group; `shared` is 1. Comes in blocks, as a group's pairs grow with its square."""
    return _listed(documents, path_a, path_b, key, text, Slice.together)
