"""Token counts by a unigram model, computed once for each prefix that words share.

Pieces come from a public vocabulary in order of rank; a piece's score is the
logarithm of 1 / (rank + 1), after Zipf's law. A pre-token's tokens are the
segmentation with the greatest sum of scores (ties: fewest tokens). Characters
that are no piece become one token for each byte, scored below all pieces.

Distinct pre-tokens of a slice of texts enter a trie, built level by level in
numpy. Each node stores the best score and token count of its prefix, found from
its ancestors at most one piece away; so a prefix common to many words is worked
out once, and a word's count is read at its terminal node.

Pre-tokens are runs without ASCII white space, opened by the mark of a word's
begin. Those longer than LONG characters share little; they are worked out one by
one with the scores of the last positions only, to the same result. Results for odd input: null, empty and blank texts have no tokens;
repeated rows, null ids and extra columns are left as they are; an empty table
gives an empty one.
"""

import functools
import math
import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from seqtable.llm.tables import HashTable, mixed
from seqtable.llm.texts import map_texts

#: Longer pre-tokens stay out of the trie.
LONG = 256
#: Pre-tokens a worker keeps the counts of.
KNOWN = 150_000
BEGIN = "▁"
_BASE = np.uint64(1000003)
_SPLIT = re.compile(r"[^ \t\n\v\f\r]+").findall


def vocabulary(path: str) -> list[str]:
    """Normal pieces of a sentencepiece model in their order."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


class Trie:
    """Best segmentations of many words at a time."""

    def __init__(self, pieces: list[str]):
        self.scores = -np.log(np.arange(1, len(pieces) + 1, dtype=np.float64))
        self.byte_score = -np.log(len(pieces) + 256.0)
        self.longest = max(map(len, pieces))
        self.score_of = dict(zip(pieces, self.scores.tolist(), strict=True))
        keys = np.array([self._hash(p) for p in pieces], np.uint64)
        self.table = HashTable(mixed(keys), np.arange(len(pieces), dtype=np.int32))

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_BASE) + ord(c)) % (1 << 64)
        return h

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each word."""
        size = np.array([len(w) for w in words], np.int64)
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        first = np.cumsum(size) - size
        power = _powers(self.longest)
        # One entry for each level: its nodes' prefix hash, score, count and parent.
        hashes, best, least, parents = [np.zeros(1, np.uint64)], [np.zeros(1)], [np.zeros(1, np.int64)], []
        out, here = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        left = np.flatnonzero(size > 0)
        depth = 0
        while len(left):
            code = codes[first[left] + depth]
            _, node, word_node = np.unique((here[left].astype(np.uint64) << np.uint64(21)) | code, return_index=True, return_inverse=True)
            parent, own = here[left[node]], code[node]
            depth += 1
            parents.append(parent)
            hashes.append(hashes[-1][parent] * _BASE + own)
            score, count = np.full(len(node), -np.inf), np.zeros(len(node), np.int64)
            ancestor = np.arange(len(node))
            for length in range(1, min(depth, self.longest) + 1):
                ancestor = parents[depth - length][ancestor]
                piece = self.table.find(mixed(hashes[depth] - hashes[depth - length][ancestor] * power[length]))
                tokens = np.ones(len(node), np.int64)
                gain = np.where(piece >= 0, self.scores[piece], -np.inf)
                if length == 1:  # no piece: its bytes
                    width = 1 + (own > 0x7F).astype(np.int64) + (own > 0x7FF) + (own > 0xFFFF)
                    tokens = np.where(piece >= 0, 1, width)
                    gain = np.where(piece >= 0, gain, width * self.byte_score)
                there, used = best[depth - length][ancestor] + gain, least[depth - length][ancestor] + tokens
                better = (there > score) | ((there == score) & (used < count))
                score, count = np.where(better, there, score), np.where(better, used, count)
            best.append(score)
            least.append(count)
            here[left] = word_node
            ended = size[left] == depth
            out[left[ended]] = count[word_node[ended]]
            left = left[~ended]
        return out


    def count_long(self, word: str) -> int:
        """Tokens of one word; memory for the last `longest` positions besides the word."""
        score_of, longest, byte_score = self.score_of.get, self.longest, float(self.byte_score)
        best, least = [0.0], [0]  # of the last positions
        for end in range(1, len(word) + 1):
            score, count = -math.inf, 0
            for length in range(1, len(best) + 1):
                gain, tokens = score_of(word[end - length : end]), 1
                if gain is None:
                    if length > 1:
                        continue
                    code = ord(word[end - 1])
                    tokens = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
                    gain = tokens * byte_score
                there, used = best[-length] + gain, least[-length] + tokens
                if there > score or there == score and used < count:
                    score, count = there, used
            best.append(score)
            least.append(count)
            if len(best) > longest:
                del best[0], least[0]
        return least[-1]


def _powers(n: int) -> np.ndarray:
    power = np.ones(n + 1, np.uint64)
    power[1:] = np.multiply.accumulate(np.full(n, _BASE))
    return power


def sections(word: str) -> list[str]:
    """Parts that count separately: the marked pre-token as a whole, whatever its length."""
    return [BEGIN + word]


class Counter:
    """Counts tokens of texts; keeps the counts of pre-tokens it has met."""

    def __init__(self, pieces: list[str]):
        self.trie = Trie(pieces)
        self.known: dict[str, int] = {}

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        split = [_SPLIT(t) if t else [] for t in texts]
        if len(self.known) > KNOWN:
            self.known = {}
        new = list(set().union(*split).difference(self.known))
        short = [w for w in new if len(w) < LONG]
        tokens = self.trie.counts([p for w in short for p in sections(w)])
        self.known.update(zip(short, tokens.tolist(), strict=True))
        self.known.update((w, sum(map(self.trie.count_long, sections(w)))) for w in new if len(w) >= LONG)
        known = self.known
        return np.array([sum([known[w] for w in ws]) for ws in split], np.int64), np.array([len(ws) for ws in split], np.int64)


@functools.lru_cache(maxsize=1)
def counter(path: str) -> Counter:
    """One for each worker process."""
    return Counter(vocabulary(path))


def count(documents: DataFrame, vocabulary_path: str, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep`, n_tokens and n_pretokens."""

    def prepare():
        own = counter(vocabulary_path)
        return lambda texts: list(own(texts.to_pylist()))

    return map_texts(documents, keep, text, "n_tokens bigint, n_pretokens bigint", prepare)
