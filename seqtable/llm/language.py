"""Language identification by unigram pieces, summed over all segmentations.

Pieces come from a fixed public vocabulary. Each language gives every piece a
probability; a word's probability is the sum over all ways to cut it into pieces,
found with the forward algorithm. Piece probabilities are fitted by expectation
and maximisation (expected counts from forward and backward sums) over the word
counts of a bounded sample of labelled documents. A text's language has the
largest product of prior and word probabilities; its score is the posterior.
Words of any length are summed whole; long ones in logarithms, in memory for the
last places alone (learning keeps a number for each of a word's places).

Results for odd input: a text that is null or has no letter gets `und` and score
0; without any labelled document so does every text. Rows with null labels are
not learned from. Ties go to the label that sorts first. Repeated rows, null ids
and extra columns are left as they are; an empty table gives an empty one.
"""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtable import session
from seqtable.llm.tables import HashTable, mixed
from seqtable.llm.texts import map_rows, map_texts

UNKNOWN = "und"
#: Labelled documents per language that are learned from, as an expected number.
SAMPLE = 1000
ROUNDS = 3
SMOOTHING = 0.1
#: Words of more letters are summed in logarithms, as their probabilities leave the range of doubles; and letters of such words at once.
PLAIN, LETTERS_AT_ONCE = 40, 1 << 20
#: Words a task keeps the scores of.
KNOWN = 100_000
BEGIN = "▁"
LETTERS = re.compile(r"[^\W\d_]+")


def vocabulary(path: str) -> list[str]:
    """Pieces of a sentencepiece model that are lower-case letters, with or without the mark of a word's begin."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i) for i in range(model.get_piece_size())} | {BEGIN}
    return sorted(p for p in pieces if p == BEGIN or p.removeprefix(BEGIN).isalpha() and p == p.lower())


@dataclass
class Model:
    languages: list[str]
    priors: np.ndarray
    pieces: list[str]
    #: Probability of each piece in each language; the last row is for letters that are no piece.
    chances: np.ndarray


class Forward:
    """Forward and backward sums over all segmentations of many words at a time."""

    def __init__(self, model: Model):
        self.chances = model.chances
        self.longest = max(map(len, model.pieces))
        keys = [self._hash(np.array([list(map(ord, p))], np.uint64))[0] for p in model.pieces]
        self.table = HashTable(mixed(np.array(keys, np.uint64)), np.arange(len(keys), dtype=np.int32))
        with np.errstate(divide="ignore"):
            self.logs = np.log(np.concatenate([model.chances, np.zeros((1, model.chances.shape[1]))]))  # place -1: no piece

    @staticmethod
    def _hash(codes: np.ndarray) -> np.ndarray:
        h = np.zeros(len(codes), np.uint64)
        for column in codes.T:
            h = h * np.uint64(1000003) + column
        return h

    def cuts(self, codes: np.ndarray):
        """(start, end, piece of each word there or -1), by end, for words of equal length."""
        n = codes.shape[1]
        found: list[list] = [[] for _ in range(n + 1)]
        for start in range(n):
            h = np.zeros(len(codes), np.uint64)
            for end in range(start + 1, min(n, start + self.longest) + 1):
                h = h * np.uint64(1000003) + codes[:, end - 1]
                piece = self.table.find(mixed(h))
                if end == start + 1:
                    piece[piece < 0] = len(self.chances) - 1
                found[end].append((start, piece))
        return found

    def ending(self, codes: np.ndarray):
        """For each place of words of equal length: the pieces that end there, one letter first, the longest last (-1: none)."""
        hashes = np.zeros((0, len(codes)), np.uint64)
        for column in codes.T:
            hashes = np.concatenate([np.zeros((1, len(codes)), np.uint64), hashes[: self.longest - 1]])
            hashes = hashes * np.uint64(1000003) + column
            piece = self.table.find(mixed(hashes.ravel())).reshape(hashes.shape)
            piece[0, piece[0] < 0] = len(self.chances) - 1
            yield piece

    def _long_scores(self, codes: np.ndarray) -> np.ndarray:
        """Logarithms of the sums, from those of the last `longest` places; for words of any length."""
        before = np.zeros((1, len(codes), self.chances.shape[1]))  # the last place first
        for piece in self.ending(codes):
            total = _log_sum(before[: len(piece)] + self.logs[piece])
            before = np.concatenate([total[None], before[: self.longest - 1]])
        return before[0]

    def _long_expected(self, codes: np.ndarray, weight: np.ndarray, out: np.ndarray) -> None:
        n, rows = codes.shape[1], len(codes)
        pieces = np.full((n, self.longest, rows), -1, np.int32)
        ahead, back = np.zeros((n + 1, *weight.shape)), np.zeros((n + 1, *weight.shape))
        for end, piece in enumerate(self.ending(codes), 1):
            pieces[end - 1, : len(piece)] = piece
            ahead[end] = _log_sum(ahead[end - len(piece) : end][::-1] + self.logs[piece])
        for start in range(n - 1, -1, -1):
            reach = np.arange(min(self.longest, n - start))
            back[start] = _log_sum(back[start + 1 + reach] + self.logs[pieces[start + reach, reach]])
        for end in range(1, n + 1):
            for k in range(min(self.longest, end)):
                piece = pieces[end - 1, k]
                hit = np.flatnonzero(piece >= 0)
                if len(hit):
                    share = weight[hit] * np.exp(ahead[end - 1 - k, hit] + self.logs[piece[hit]] + back[end, hit] - ahead[n, hit])
                    np.add.at(out, piece[hit], share)

    def _chance(self, piece: np.ndarray) -> np.ndarray:
        chance = self.chances[piece]
        chance[piece < 0] = 0
        return chance

    def scores(self, words: list[str]) -> np.ndarray:
        """Logarithm of each word's probability, a column per language."""
        out = np.zeros((len(words), self.chances.shape[1]))
        for rows, codes in by_length(words):
            if codes.shape[1] > PLAIN:
                out[rows] = self._long_scores(codes)
                continue
            sums = [np.ones((len(rows), out.shape[1]))]
            for end, cuts in enumerate(self.cuts(codes)[1:], 1):
                total = np.zeros_like(sums[0])
                for start, piece in cuts:
                    hit = np.flatnonzero(piece >= 0)
                    if len(hit) == len(piece):
                        total += sums[start] * self.chances[piece]
                    elif len(hit):
                        total[hit] += sums[start][hit] * self.chances[piece[hit]]
                sums.append(total)
            out[rows] = np.log(sums[-1])
        return out

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece in each language; counts: words by languages."""
        out = np.zeros_like(self.chances)
        for rows, codes in by_length(words):
            if codes.shape[1] > PLAIN:
                self._long_expected(codes, counts[rows], out)
                continue
            n, cuts, weight = codes.shape[1], self.cuts(codes), counts[rows]
            ahead = [np.ones_like(weight)] + [np.zeros_like(weight) for _ in range(n)]
            back = [np.zeros_like(weight) for _ in range(n)] + [np.ones_like(weight)]
            for end in range(1, n + 1):
                for start, piece in cuts[end]:
                    ahead[end] += ahead[start] * self._chance(piece)
            for end in range(n, 0, -1):
                for start, piece in cuts[end]:
                    back[start] += back[end] * self._chance(piece)
            for end in range(1, n + 1):
                for start, piece in cuts[end]:
                    share = weight * ahead[start] * self._chance(piece) * back[end] / ahead[n]
                    hit = piece >= 0
                    for k in range(out.shape[1]):
                        out[:, k] += np.bincount(piece[hit], share[hit, k], len(out))
        return out


def _log_sum(terms: np.ndarray) -> np.ndarray:
    """Logarithm of the sum of exp(terms) over the first axis; one term at least is finite."""
    top = terms.max(axis=0)
    return top + np.log(np.exp(terms - top).sum(axis=0))


def by_length(words: list[str], most: int = 1 << 16):
    """(places, code points) of the words, each time of words of one length; `most` words at once, fewer of long ones."""
    lengths = np.array([len(w) for w in words], np.int64)
    order = np.argsort(lengths, kind="stable")
    ordered, start = lengths[order], 0
    while start < len(order):
        n = int(ordered[start])
        at_once = most if n <= PLAIN else max(1, LETTERS_AT_ONCE // n)
        stop = min(int(np.searchsorted(ordered, n, side="right")), start + at_once)
        rows = order[start:stop]
        if n:
            raw = "".join([words[i] for i in rows]).encode("utf-32-le", "surrogatepass")
            yield rows, np.frombuffer(raw, np.uint32).reshape(len(rows), n).astype(np.uint64)
        start = stop


def marked(word: str) -> str:
    """The word's letters behind the mark of its begin; empty if it has none."""
    if not word.isalpha():
        word = "".join(filter(str.isalpha, word))
    return BEGIN + word if word else ""


def fit(
    documents: DataFrame, vocabulary_path: str, label: str = "lang", text: str = "text", key: str = "doc_id", sample: int = SAMPLE, rounds: int = ROUNDS
) -> Model:
    """Learn from the rows of `documents` whose label is known: about `sample` documents of each label."""
    spark = documents.sparkSession
    rows = documents.select(documents[key].alias("key"), documents[text].alias("text"), documents[label].alias("label"))
    rows = rows.filter("label is not null and text is not null")
    sizes = sorted(tuple(r) for r in rows.groupBy("label").agg(F.count(F.lit(1))).collect())  # a row for each language
    languages, pieces = [x for x, _ in sizes], vocabulary(vocabulary_path)
    count = np.array([n for _, n in sizes], float)
    chances = np.full((len(pieces) + 1, len(languages)), 1 / (len(pieces) + 1))
    model = Model(languages, np.log(count / count.sum()) if len(count) else count, pieces, chances)
    if not languages:
        return model
    of_label = lambda values: F.create_map(*[F.lit(x) for pair in zip(languages, values, strict=True) for x in pair])[F.col("label")]
    drawn = F.pmod(F.xxhash64("key", F.lit("language")), F.lit(1_000_000)) < of_label((1e6 * np.minimum(1, sample / count)).tolist())
    words = (
        rows.filter(drawn)
        .select(of_label(range(len(languages))).alias("label"), F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"))).alias("word"))
        .groupBy("label", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    folder = session.new_folder(spark, "language")
    words.write.parquet(folder)
    words = spark.read.parquet(folder)
    for _ in range(rounds):
        model.chances = _round(words, model)
    return model


def _round(words: DataFrame, model: Model) -> np.ndarray:
    """One round of expectation in Spark tasks and maximisation over their sums (pieces by languages)."""
    n = len(model.languages)

    def run(batches):
        forward, total = Forward(model), np.zeros_like(model.chances)
        for batch in batches:
            labels, counts = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            parts = [marked(word) for word in batch.column(1).to_pylist()]
            table = np.zeros((len(parts), n))
            table[np.arange(len(parts)), labels] = counts
            total += forward.expected(parts, table)
        piece, k = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(piece.astype(np.int32)), pa.array(k.astype(np.int32)), pa.array(total[piece, k])], ["piece", "k", "uses"])

    sums = words.select("label", "word", "n").mapInArrow(run, "piece int, k int, uses double")
    uses = np.full_like(model.chances, SMOOTHING)
    for r in sums.groupBy("piece", "k").agg(F.sum("uses").alias("uses")).collect():  # pieces x languages at most
        uses[r.piece, r.k] += r.uses
    return uses / uses.sum(axis=0)


class Guess:
    """Predicts the language of texts; keeps the scores of words it has met."""

    def __init__(self, model: Model):
        self.model, self.forward = model, Forward(model) if model.languages else None
        self.names = np.array([*model.languages, UNKNOWN], object)
        self.known: dict[str, int] = {}
        self.table = np.zeros((1, len(model.languages)))

    def learn(self, words: set[str]) -> None:
        if len(self.known) > KNOWN:
            self.known, self.table = {}, self.table[:1]
        new = [w for w in words if w not in self.known]
        parts = [marked(w) for w in new]
        sums = self.forward.scores(parts)
        lettered = np.array([bool(p) for p in parts], bool)
        places = np.zeros(len(new), np.int64)  # row 0: no letters, adds nothing
        places[lettered] = len(self.table) + np.arange(lettered.sum())
        self.table = np.concatenate([self.table, sums[lettered]])
        self.known.update(zip(new, places.tolist(), strict=True))

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        names, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        if self.forward is None or not texts:
            return names, score
        split = [LETTERS.findall(t.lower()) if t else [] for t in texts]
        words: set[str] = set().union(*split)
        if len(self.known) > KNOWN or not words <= self.known.keys():
            self.learn(words)
        known = self.known
        bounds = np.cumsum([0, *map(len, split)])
        places = np.fromiter((known[w] for ws in split for w in ws), np.int64, bounds[-1])
        sums = np.zeros((len(texts), len(self.model.languages)))
        has = np.flatnonzero(bounds[1:] > bounds[:-1])
        if len(has):
            sums[has] = np.add.reduceat(self.table[places], bounds[has])
            lettered = np.zeros(len(texts), bool)
            lettered[has] = np.add.reduceat((places > 0).astype(np.int64), bounds[has]) > 0
            sums += self.model.priors
            best = sums.argmax(axis=1)
            sums -= sums.max(axis=1, keepdims=True)
            names[lettered] = self.names[best[lettered]]
            score[lettered] = 1 / np.exp(sums[lettered]).sum(axis=1)
        return names, score


def predict(documents: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep`, `lang_pred` and `score`."""

    def prepare():
        guess = Guess(model)

        def work(texts: pa.Array) -> list:
            names, score = guess(texts.to_pylist())
            return [names.tolist(), score]

        return work

    return map_texts(documents, keep, text, "lang_pred string, score double", prepare)


def keep_known(documents: DataFrame, model: Model, least: float, text: str = "text") -> DataFrame:
    """The rows, all columns, whose language is found with a score of at least `least`."""

    def prepare():
        guess = Guess(model)

        def work(rows: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
            names, score = guess(texts.to_pylist())
            return rows.filter(pa.array((names != UNKNOWN) & (score >= least)))

        return work

    return map_rows(documents, text, prepare)


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether the checksum of the key as text leaves the remainder `fold`; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds == fold
