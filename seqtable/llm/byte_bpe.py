"""Byte-level BPE encoding and decoding by a public rank file.

Pre-tokens are grouped by length into padded numpy matrices, one row each. In
every round each row merges its leftmost pair of least rank; pair ranks come from
a hash table, merged rows close up and finished rows leave the matrix.

Only distinct pieces of text between borders are encoded; a task keeps those
it has met, up to a bound, after which those not met lately go.

Results for odd input: null and empty texts give no ids; repeated rows, null ids
of rows and extra columns are left as they are; an empty table gives an empty one.
"""

import base64
import functools
import heapq
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from seqtable.llm.tables import HashTable
from seqtable.llm.texts import map_texts

#: White space as Unicode defines it, as in the public encoders' regular expressions.
SPACE = r"\t-\r \x85\xa0  -     　"
#: Longer pre-tokens are merged with a heap: a matrix would need the square of the length.
MATRIX_BYTES = 256
#: Matrix cells at once, and known pieces of text a task keeps.
CELLS, KNOWN = 1 << 18, 80_000
_NONE = np.int32(2**31 - 1)


class Ranks:
    """A rank file: token bytes by id, ids by bytes, and the ranks of all mergeable pairs."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ids = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens: list[bytes] = [b""] * (max(self.ids.values()) + 1)
        for token, rank in self.ids.items():
            self.tokens[rank] = token
        self.single = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        left, right, whole = [], [], []
        for token, rank in self.ids.items():
            for cut in range(1, len(token)):
                a, b = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), whole.append(rank)
        self.table = HashTable(_pair(np.array(left, np.int64), np.array(right, np.int64)), np.array(whole, np.int32))

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each merged pair, or the largest number; negative ids are padding."""
        rank = self.table.find(_pair(a.astype(np.int64), b.astype(np.int64)))
        rank[(rank < 0) | (a < 0) | (b < 0)] = _NONE
        return rank


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a + 1).astype(np.uint64) << np.uint64(32)) | (b + 1).astype(np.uint64)


@functools.lru_cache(maxsize=2)
def load(path: str) -> Ranks:
    return Ranks(path)


def merge_matrix(ranks: Ranks, words: list[bytes]) -> list[bytes]:
    """Ids (little-endian 32-bit) of words of at most MATRIX_BYTES bytes, by rounds of merges over padded matrices."""
    out = [b""] * len(words)
    lengths = np.array([len(w) for w in words], np.int64)
    order = np.argsort(lengths, kind="stable")
    ordered, start = lengths[order], 0
    while start < len(order):
        width = -(-int(ordered[start]) // 4) * 4  # one matrix holds four neighbouring lengths
        stop = min(int(np.searchsorted(ordered, width, side="right")), start + CELLS // width)
        rows, size = order[start:stop], ordered[start:stop].copy()
        raw = b"".join([words[i].ljust(width, b"\0") for i in rows])
        ids = ranks.single[np.frombuffer(raw, np.uint8).reshape(len(rows), width)]
        ids[np.arange(width) >= size[:, None]] = -1
        ranked = ranks.pair_ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), width - 1)
        while True:
            at = ranked.argmin(axis=1)  # the leftmost of the least
            least = ranked[np.arange(len(rows)), at]
            done = least == _NONE
            if done.any():
                ended, ends = ids[done].astype("<u4").tobytes(), 4 * size[done]
                for k, (row, end) in enumerate(zip(rows[done].tolist(), ends.tolist(), strict=True)):
                    out[row] = ended[4 * k * ids.shape[1] : 4 * k * ids.shape[1] + end]
                go = ~done
                rows, ids, ranked, size, at, least = rows[go], ids[go], ranked[go], size[go], at[go], least[go]
                if not len(rows):
                    break
            line = np.arange(len(rows))
            ids[line, at] = least
            width = int(size.max())
            cols = np.arange(width)
            ids = np.take_along_axis(ids, np.minimum(cols + (cols > at[:, None]), width - 1), axis=1)
            size -= 1
            ids[line, size] = -1
            # The pair at `at` has gone; the pairs to its right move one place left.
            cols = cols[:-1]
            ranked = np.take_along_axis(ranked, np.minimum(cols + (cols >= at[:, None]), width - 2), axis=1)
            ranked[line, size - 1] = _NONE
            for place in (at - 1, at):
                inside = (place >= 0) & (place + 1 < size)
                k, p = line[inside], place[inside]
                ranked[k, p] = ranks.pair_ranks(ids[k, p], ids[k, p + 1])
        start = stop
    return out


def merge_heap(ranks: Ranks, word: bytes) -> bytes:
    """Ids of one long word; the same merges in the same order, from a heap."""
    ids = ranks.single[np.frombuffer(word, np.uint8)].tolist()
    n = len(ids)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    first = ranks.pair_ranks(np.array(ids[:-1]), np.array(ids[1:]))
    heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != _NONE]
    heapq.heapify(heap)
    while heap:
        rank, i, a, b = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j < 0 or ids[j] != b:
            continue
        ids[i], ids[j] = rank, -2
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for x, y in ((before[i], i), (i, after[i])):
            if x >= 0 and y >= 0:
                whole = ranks.ids.get(ranks.tokens[ids[x]] + ranks.tokens[ids[y]])
                if whole is not None:
                    heapq.heappush(heap, (whole, x, ids[x], ids[y]))
    return np.array([i for i in ids if i >= 0], "<u4").tobytes()


class Encoder:
    """Encodes texts; holds what it has met so far."""

    def __init__(self, ranks: Ranks, pattern: str):
        self.ranks = ranks
        # Pieces end where pre-tokens end: Latin words and ASCII marks before a certain border,
        # else all up to the next white space, which `words` splits.
        latin, mark = "A-Za-zÀ-ÖØ-öø-ɏ", r"!-&(-/:-@\[-`{-~"
        self.pieces = re.compile(
            rf" ?[{latin}]+(?=[\n\r {mark}]|\Z)| ?[{mark}]+(?=[\n\r A-Za-z0-9]|\Z)| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
        ).findall
        inside = pattern.replace(r"\S", f"[^{SPACE}]").replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]")
        self.words = regex.compile(inside).findall
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> None:
        split = {p: (p,) if p.isalpha() or p[1:].isalpha() and p[0] == " " else self.words(p) for p in pieces}
        words = {w: w.encode() for ws in split.values() for w in ws}
        ranks, ids, short = self.ranks.ids, {}, []
        for word, raw in words.items():
            whole = ranks.get(raw)
            if whole is not None:
                ids[word] = whole.to_bytes(4, "little")
            elif len(raw) <= MATRIX_BYTES:
                short.append(word)
            else:
                ids[word] = merge_heap(self.ranks, raw)
        ids.update(zip(short, merge_matrix(self.ranks, [words[w] for w in short]), strict=True))
        self.known.update((p, ids[ws[0]] if len(ws) == 1 else b"".join([ids[w] for w in ws])) for p, ws in split.items())

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        split = [self.pieces(t) if t else [] for t in texts]
        if len(self.known) > KNOWN:
            self.known, self.older = {}, self.known
        new: set[str] = set().union(*split)
        new.difference_update(self.known)
        if self.older:
            met = new.intersection(self.older)
            self.known.update((p, self.older[p]) for p in met)
            new -= met
        self.learn(new)
        known = self.known
        return [b"".join([known[p] for p in pieces]) for pieces in split]


def encode(documents: DataFrame, ranks_path: str, pattern: str, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep`, `ids` (binary: ids as little-endian unsigned 32-bit integers) and `n_tokens`."""

    def prepare():
        own = Encoder(load(ranks_path), pattern)

        def work(texts: pa.Array) -> list:
            ids = own.encode(texts.to_pylist())
            return [ids, [len(i) // 4 for i in ids]]

        return work

    return map_texts(documents, keep, text, "ids binary, n_tokens bigint", prepare)


def round_trip(documents: DataFrame, ranks_path: str, pattern: str, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep`, `ids`, `n_tokens` and `decoded`: encoded and decoded again in one step of one worker."""

    def prepare():
        ranks = load(ranks_path)
        own = Encoder(ranks, pattern)

        def work(texts: pa.Array) -> list:
            ids = own.encode(texts.to_pylist())
            return [ids, [len(i) // 4 for i in ids], [spelled(ranks, i) for i in ids]]

        return work

    return map_texts(documents, keep, text, "ids binary, n_tokens bigint, decoded binary", prepare)


def spelled(ranks: Ranks, ids: bytes | None) -> bytes:
    """The bytes of ids (little-endian 32-bit numbers)."""
    tokens = ranks.tokens
    return b"".join([tokens[i] for i in np.frombuffer(ids or b"", "<u4").tolist()])


def decode(encoded: DataFrame, ranks_path: str, keep: list[str], ids: str = "ids") -> DataFrame:
    """Columns `keep` and `decoded` (binary: the bytes of the tokens); unknown ids are an error."""

    def prepare():
        ranks = load(ranks_path)
        return lambda column: [[spelled(ranks, x) for x in column.to_pylist()]]

    return map_texts(encoded, keep, ids, "decoded binary", prepare)
