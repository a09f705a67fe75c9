"""Quality of texts by a byte-level convolutional network in numpy.

A text is cut into overlapping chunks that cover all its bytes. In a chunk, bytes
become learned vectors, filters slide over them, and each filter keeps its
greatest value. A small layer turns these values (and how full the chunk is) into
features; their mean and their maximum over all chunks of the text give one
probability.

Training: gradient descent on a bounded sample of labelled texts, from each of
which at most CHUNKS chunks are taken; a label weighs as the root of its share. The
result depends on the sample alone. Scoring reads every byte of every text.

Results for odd input: null and empty texts get the score of an empty chunk;
without labelled rows of both kinds every score is 0.5. Null labels or ids and
labels without a document are not learned from; a repeated label counts again.
Repeated rows, null ids and extra columns are left as they are; an empty table
gives an empty one.
"""

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtable.llm.texts import map_texts, utf8

#: Labelled texts of each label that are learned from (as an expected number), and chunks taken of each.
SAMPLE, CHUNKS = 1200, 6
CHUNK, OVERLAP, WIDTH, STRIDE = 512, 64, 8, 2
VECTOR, FILTERS, HIDDEN = 6, 32, 16
STEPS, BATCH, RATE = 320, 96, 1e-2


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all chunks in the bytes, and how many each text has (one at least)."""
    size = np.diff(offsets)
    n = np.maximum(1, -(-(size - OVERLAP) // (CHUNK - OVERLAP)))
    owner = np.repeat(np.arange(len(n)), n)
    starts = offsets[owner] + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * (CHUNK - OVERLAP)
    return starts, np.minimum(starts + CHUNK, offsets[owner + 1]), n


def chunk_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Chunks as rows of CHUNK bytes, filled up with zeros."""
    at = starts[:, None] + np.arange(CHUNK)
    inside = at < ends[:, None]
    if not len(data):
        return np.zeros(at.shape, np.uint8)
    return np.where(inside, data[np.minimum(at, len(data) - 1)], 0).astype(np.uint8)


@dataclass
class Network:
    vectors: np.ndarray = None
    filters: np.ndarray = None
    bias: np.ndarray = None
    hidden: np.ndarray = None
    hidden_bias: np.ndarray = None
    last: np.ndarray = None
    trained: bool = False
    names: tuple = field(default=("vectors", "filters", "bias", "hidden", "hidden_bias", "last"), repr=False)

    @classmethod
    def new(cls, seed: int = 7) -> "Network":
        draw = np.random.default_rng(seed)
        of = lambda *shape, by: (draw.standard_normal(shape) * by).astype(np.float32)
        return cls(
            of(256, VECTOR, by=0.5),
            of(WIDTH * VECTOR, FILTERS, by=(2 / (WIDTH * VECTOR)) ** 0.5),
            np.zeros(FILTERS, np.float32),
            of(FILTERS + 1, HIDDEN, by=(2 / FILTERS) ** 0.5),
            np.zeros(HIDDEN, np.float32),
            of(2 * HIDDEN + 1, by=0.2),
        )

    def windows(self, raw: np.ndarray) -> np.ndarray:
        """(chunks, places, width * vector): what the filters see; zero bytes are zero vectors."""
        vectors = self.vectors.copy()
        vectors[0] = 0
        seen = np.ascontiguousarray(vectors[raw]).reshape(len(raw), CHUNK * VECTOR)
        view = np.lib.stride_tricks.sliding_window_view(seen, WIDTH * VECTOR, axis=1)[:, :: STRIDE * VECTOR]
        return np.ascontiguousarray(view)

    def pooled(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        seen = self.windows(raw)
        values = (seen.reshape(-1, WIDTH * VECTOR) @ self.filters).reshape(len(raw), -1, FILTERS)
        return seen, values.argmax(axis=1), values

    def features(self, raw: np.ndarray) -> np.ndarray:
        """Features of chunks (rows of bytes), few at a time to stay in the processor's cache."""
        parts = []
        for k in range(0, len(raw), 64):
            seen = self.windows(raw[k : k + 64])
            top = (seen.reshape(-1, WIDTH * VECTOR) @ self.filters).reshape(len(seen), -1, FILTERS).max(axis=1)
            parts.append(self.layer(np.maximum(top + self.bias, 0), raw[k : k + 64])[0])
        return np.concatenate([np.zeros((0, HIDDEN), np.float32), *parts])

    def layer(self, top: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        full = (raw != 0).mean(axis=1, dtype=np.float32)[:, None]
        given = np.concatenate([top, full], axis=1)
        return np.maximum(given @ self.hidden + self.hidden_bias, 0), given

    def combine(self, features: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Probability of each text from the features of its n chunks."""
        starts = np.cumsum(n) - n
        mean = np.add.reduceat(features, starts) / n[:, None].astype(np.float32)
        most = np.maximum.reduceat(features, starts)
        score = np.concatenate([mean, most], axis=1) @ self.last[:-1] + self.last[-1]
        return 1 / (1 + np.exp(-score.astype(np.float64)))

    def score(self, texts: pa.Array) -> np.ndarray:
        if not self.trained or not len(texts):
            return np.full(len(texts), 0.5)
        data, offsets = utf8(texts)
        starts, ends, n = cut(data, offsets)
        parts = [self.features(chunk_bytes(data, starts[k : k + 1024], ends[k : k + 1024])) for k in range(0, len(starts), 1024)]
        return self.combine(np.concatenate(parts), n)

    def gradients(self, raw: np.ndarray, n: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
        seen, at, values = self.pooled(raw)
        line = np.arange(len(raw))[:, None]
        top = np.take_along_axis(values, at[:, None], axis=1)[:, 0] + self.bias
        features, given = self.layer(np.maximum(top, 0), raw)
        starts, owner = np.cumsum(n) - n, np.repeat(np.arange(len(n)), n)
        mean = np.add.reduceat(features, starts) / n[:, None]
        most = np.maximum.reduceat(features, starts)
        joined = np.concatenate([mean, most, np.ones((len(n), 1))], axis=1)
        off = (1 / (1 + np.exp(-joined @ self.last)) - labels) * weights / len(n)
        last = joined.T @ off
        by_mean = (off / n)[owner][:, None] * self.last[:HIDDEN]
        by_most = (features == most[owner]) * off[owner][:, None] * self.last[HIDDEN:-1]
        to_features = (by_mean + by_most) * (features > 0)
        hidden, hidden_bias = given.T @ to_features, to_features.sum(axis=0)
        to_top = (to_features @ self.hidden.T)[:, :FILTERS] * (top > 0)
        picked = seen[line, at]  # chunks, filters, width * vector: what the greatest values saw
        filters = np.einsum("cf,cfw->wf", to_top, picked)
        to_seen = to_top[:, :, None] * self.filters.T
        places = at[:, :, None] * STRIDE + np.arange(WIDTH)
        read = raw[line[:, :, None], places].ravel()
        flat = to_seen.reshape(-1, VECTOR)
        vectors = np.stack([np.bincount(read, flat[:, k], 256) for k in range(VECTOR)], axis=1)
        vectors[0] = 0
        return [vectors, filters, to_top.sum(axis=0), hidden, hidden_bias, last]

    def train(self, chunks: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, steps: int = STEPS, seed: int = 11) -> None:
        draw = np.random.default_rng(seed)
        moments = [[np.zeros_like(getattr(self, k), dtype=np.float64) for k in self.names] for _ in range(2)]
        turn = 0
        while turn < steps:
            order = draw.permutation(len(chunks))
            for k in range(0, len(order), BATCH)[: steps - turn]:
                some = order[k : k + BATCH]
                n = np.array([len(chunks[i]) for i in some])
                found = self.gradients(np.concatenate([chunks[i] for i in some]), n, labels[some], weights[some])
                turn += 1
                rate = RATE * min(1, turn / 20) * (1 - turn / (steps + 1)) ** 0.5
                for name, g, m, v in zip(self.names, found, *moments, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.01 * (g * g - v)
                    step = rate * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
                    setattr(self, name, (getattr(self, name) - step).astype(np.float32))
        self.trained = True


def fit(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE, most: int = CHUNKS
) -> Network:
    """Learn from about `sample` documents of each label, and at most `most` chunks of each."""
    network = Network.new()
    rows = labels.select(labels[key].alias("key"), labels[label].cast("int").alias("label")).filter("key is not null and label in (0, 1)")
    sizes = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return network
    share = F.when(F.col("label") == 1, sample / sizes[1]).otherwise(sample / sizes[0]) * 1e6
    # Twice `sample` keys are expected here: small enough to send to every task.
    chosen = rows.filter(F.pmod(F.xxhash64("key", F.lit("quality")), F.lit(1_000_000)) < share)
    texts = documents.select(documents[key].alias("key"), documents[text].alias("text")).join(F.broadcast(chosen), "key")

    def prepare():
        def work(column: pa.Array) -> list:
            data, offsets = utf8(column)
            starts, ends, n = cut(data, offsets)
            out, first = [], 0
            for count in n.tolist():
                # Evenly spread over the text.
                pick = first + np.unique(np.linspace(0, count - 1, min(count, most)).round().astype(np.int64))
                out.append(chunk_bytes(data, starts[pick], ends[pick]).tobytes())
                first += count
            return [out]

        return work

    found = map_texts(texts, ["key", "label"], "text", "chunks binary", prepare).collect()
    found.sort(key=lambda r: (r.key, r.label, bytes(r.chunks)))
    y = np.array([r.label for r in found], float)
    if len(set(y.tolist())) < 2:
        return network
    true = np.sqrt(np.array([sizes[0], sizes[1]]))
    true /= true.sum()
    weights = (true / np.bincount(y.astype(int)) * len(y))[y.astype(int)]
    network.train([np.frombuffer(r.chunks, np.uint8).reshape(-1, CHUNK) for r in found], y, weights)
    return network


def score(documents: DataFrame, network: Network, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep` and `score`."""

    def prepare():
        return lambda texts: [network.score(texts)]

    return map_texts(documents, keep, text, "score double", prepare)
