"""Exact top-k by integer inner product, with a bit-sliced index.

Vectors are quantised to integers, v = floor(256 x). The index deals all of them to
lanes of about LANE rows. Of each attribute (component) a lane holds the highest
SLICES bits, as one bitmap over its rows for each bit. A query, its components
rounded to FACTOR_BITS bits and written as sums and differences of powers of two,
adds the slices with bitmap arithmetic: full adders turn three bitmaps of one
weight into one of that weight and one of the next, until one bitmap for each bit of
the sum is left. The top rows are then selected from the most significant slice
downward. The rounding of a row's sum has a bound (Cauchy-Schwarz on both
remainders); rows within it of the k-th sum are the boundary rows, whose scores are
worked out exactly. No row that could be among the k is left out.

Queries are dealt to blocks of QUERIES. A task gets one lane and one block and hands
on k rows for each query; Spark merges these by query. Neither side is broadcast.

Results for odd input: vectors null or holding null, NaN or infinite components take
no part, as queries or candidates. Vectors are compared with those of the same number
of components only; empty ones all score 0. Repeated rows and ids are rows of their
own: a query is no candidate for itself, but its copies are. Ties go to the smaller
id, null ids last. Extra columns don't matter; an empty table gives an empty one.
Scores beyond 64 bits are an error.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqtable import session

#: Rows in a lane and queries in a block, about.
LANE, QUERIES = 1 << 15, 1 << 12
#: Bits of an attribute in the index, and of a query's factors (with the sign).
SLICES, FACTOR_BITS = 6, 7
#: Queries worked on at once: words (64 rows each) of one full set of terms.
WORDS = 1 << 19
#: Terms of exact scores at once.
TERMS = 1 << 20


def quantised(vector: Column, scale: int = 256) -> Column:
    """Integer components; null if the vector or a component is null, NaN or infinite."""
    real = F.transform(vector, lambda x: x.cast("double"))
    sound = F.forall(real, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(sound, F.transform(real, lambda x: F.floor(x * scale)))


def bits_needed(values: np.ndarray) -> int:
    """Bits of two's complement that hold all the values."""
    if not values.size:
        return 1
    return 1 + max(int(values.max()).bit_length(), int(~values.min()).bit_length(), 0)


class Lane:
    """The index of some rows: bitmaps of the high bits of every attribute, and what rounding took away."""

    def __init__(self, vectors: np.ndarray):
        self.vectors, (self.rows, self.size) = vectors, vectors.shape
        bits = bits_needed(vectors)
        self.shift = max(0, bits - SLICES)
        self.bits = bits - self.shift
        high = vectors >> self.shift
        self.middle = ((1 << self.shift) - 1) / 2
        rest = (vectors - (high << self.shift)) - self.middle
        self.rest = float(np.sqrt((rest * rest).sum(axis=1).max(initial=0)))
        self.length = float(np.sqrt((high.astype(float) ** 2).sum(axis=1).max(initial=0)))
        self.words = -(-self.rows // 64)
        self.low = -(1 << (self.bits - 1))
        stored = (high - self.low).astype(np.uint64)  # from 0
        maps = np.zeros((self.size * self.bits * 2 + 1, self.words), np.uint64)
        for j in range(self.bits):
            for d in range(self.size):
                maps[2 * (d * self.bits + j)] = self._bitmap((stored[:, d] >> np.uint64(j)) & np.uint64(1))
        #: Map 2i is slice i, 2i + 1 its complement (for factors that subtract); the last one is empty.
        maps[1::2] = ~maps[:-1:2]
        self.maps = maps
        self.all = self._bitmap(np.ones(self.rows, np.uint64))

    def _bitmap(self, ones: np.ndarray) -> np.ndarray:
        padded = np.zeros(self.words * 64, np.uint8)
        padded[: self.rows] = ones
        return np.packbits(padded, bitorder="little").view(np.uint64)


def signed_digits(factors: np.ndarray) -> np.ndarray:
    """Digits -1, 0 and 1 of integers by powers of two, lowest first, no two neighbours both set (last axis: power)."""
    left, out = factors.astype(np.int64).copy(), []
    while left.any():
        digit = np.where(left & 1, 2 - (left & 3), 0)
        out.append(digit)
        left = (left - digit) >> 1
    return np.stack(out, axis=-1) if out else np.zeros((*factors.shape, 0), np.int64)


def add_slices(levels: list[np.ndarray], queries: int, words: int) -> np.ndarray:
    """Bitmaps of the sums' bits, lowest first, from the bitmaps of each weight (terms, queries, words)."""
    sums, carried, weight = [], [], 0
    while weight < len(levels) or carried:
        terms = np.concatenate([*levels[weight : weight + 1], *carried]) if carried or weight < len(levels) else None
        carried = []
        while len(terms) > 2:
            third = len(terms) // 3
            a, b, c = terms[:third], terms[third : 2 * third], terms[2 * third : 3 * third]
            either = a ^ b
            carried.append((a & b) | (either & c))
            terms = np.concatenate([either ^ c, terms[3 * third :]])
        if len(terms) == 2:
            carried.append((terms[0] & terms[1])[None])
            terms = (terms[0] ^ terms[1])[None]
        sums.append(terms[0] if len(terms) else np.zeros((queries, words), np.uint64))
        weight += 1
    return np.stack(sums) if sums else np.zeros((0, queries, words), np.uint64)


def select_top(sums: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest sum of each query's allowed rows (0 if there are fewer), from the highest slice down."""
    sure = np.zeros_like(allowed)
    open_ = allowed.copy()
    kth = np.zeros(len(allowed), np.int64)
    for j in range(len(sums) - 1, -1, -1):
        ones = open_ & sums[j]
        enough = np.bitwise_count(sure | ones).sum(axis=1, dtype=np.int64) >= k
        kth += enough.astype(np.int64) << j
        take = enough[:, None]
        sure = np.where(take, sure, sure | ones)
        open_ = np.where(take, ones, open_ & ~sums[j])
    return kth


def at_least(sums: np.ndarray, allowed: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Allowed rows whose sum is at least the query's bound."""
    above, equal = np.zeros_like(allowed), allowed.copy()
    for j in range(len(sums) - 1, -1, -1):
        one = ((bound >> j) & 1).astype(bool)[:, None]
        above |= np.where(one, np.uint64(0), equal & sums[j])
        equal &= np.where(one, sums[j], ~sums[j])
    return above | equal


def candidates(lane: Lane, queries: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(query, rows of the lane that may be among its k best). `own` is the query's place in the lane, or -1."""
    drop = max(0, bits_needed(queries) - FACTOR_BITS)
    half = (1 << drop) >> 1
    factors = (queries + half) >> drop
    left = queries - (factors << drop)
    # score = 2^(shift + drop) · factors·high + rounding; rounding is a constant of the query, within `slack`.
    slack = np.sqrt((queries.astype(float) ** 2).sum(axis=1)) * lane.rest
    slack += np.sqrt((left.astype(float) ** 2).sum(axis=1)) * lane.length * 2.0**lane.shift
    margin = np.ceil(2 * slack * (1 + 1e-9) / 2.0 ** (lane.shift + drop)).astype(np.int64) + 1
    digits = signed_digits(factors)
    terms = max(1, int((digits != 0).sum(axis=(1, 2)).max(initial=0)) * lane.bits)
    step = max(1, WORDS // (terms * lane.words))
    for start in range(0, len(queries), step):
        some = digits[start : start + step]
        n = len(some)
        levels = []
        for weight in range(some.shape[2] + lane.bits - 1):
            named = []
            for j in range(max(0, weight - some.shape[2] + 1), min(lane.bits, weight + 1)):
                sign = some[:, :, weight - j]
                place = 2 * (np.arange(lane.size) * lane.bits + j)
                named.append(np.where(sign == 0, len(lane.maps) - 1, place + (sign < 0)))
            chosen = np.sort(np.concatenate(named, axis=1), axis=1)
            most = int((chosen < len(lane.maps) - 1).sum(axis=1).max(initial=0))
            levels.append(lane.maps[chosen[:, :most].T])
        sums = add_slices(levels, n, lane.words)
        allowed = np.repeat(lane.all[None], n, axis=0)
        mine = own[start : start + step]
        inside = np.flatnonzero(mine >= 0)
        allowed[inside, mine[inside] // 64] &= ~(np.uint64(1) << (mine[inside] % 64).astype(np.uint64))
        bound = np.maximum(select_top(sums, allowed, k) - margin[start : start + step], 0)
        found = at_least(sums, allowed, bound)
        for q in range(n):
            rows = np.unpackbits(found[q].view(np.uint8), bitorder="little")
            yield start + q, np.flatnonzero(rows)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, highest first, ties to the smaller id."""
    if len(scores) > 4 * k:
        few = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        few = np.arange(len(scores))
    return few[np.lexsort((ids[few], -scores[few]))[:k]]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.combine_chunks()
    return rows.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(rows), -1)


def _search(lane_rows: pa.Table, query_rows: pa.Table, k: int) -> pa.Table:
    """The k best of a lane for each query of a block."""
    columns: list[list] = [[], [], [], []]
    if lane_rows.num_rows and query_rows.num_rows:
        vectors, queries = _matrix(lane_rows["v"]), _matrix(query_rows["v"])
        largest = max(1, int(max(np.abs(vectors).max(initial=0), 0))) * max(1, int(np.abs(queries).max(initial=0))) * max(1, vectors.shape[1])
        if largest >= 1 << 62 or min(vectors.min(initial=0), queries.min(initial=0)) == np.iinfo(np.int64).min:
            raise OverflowError("scores exceed 64 bits")
        ids = lane_rows["id"].combine_chunks()
        order_of = ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
        place = {r: i for i, r in enumerate(lane_rows["row"].to_pylist())}
        own = np.array([place.get(r, -1) for r in query_rows["row"].to_pylist()], np.int64)
        names = query_rows["row"].combine_chunks()
        for q, rows in candidates(Lane(vectors), queries, own, k):
            scores = np.concatenate([vectors[rows[i : i + TERMS]] @ queries[q] for i in range(0, max(len(rows), 1), TERMS)])
            top = best(scores, order_of[rows], k)
            columns[0].append(names[q].as_py()), columns[1].append(len(top))
            columns[2].append(rows[top]), columns[3].append(scores[top])
    if not columns[0]:
        return pa.table({"row": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
    rows = np.repeat(np.array(columns[0], np.int64), columns[1])
    return pa.table({"row": pa.array(rows), "vec_id": ids.take(pa.array(np.concatenate(columns[2]))), "score": pa.array(np.concatenate(columns[3]))})


def search(
    vectors: DataFrame, every: int, k: int, key: str = "vec_id", vector: str = "embedding", lane: int = LANE, queries: int = QUERIES
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest scores of each vector whose id is divisible by `every`."""
    spark = vectors.sparkSession
    folder = session.new_folder(spark, "bitslices")
    rows = vectors.select(vectors[key].cast("bigint").alias("id"), quantised(vectors[vector]).alias("v")).filter("v is not null")
    rows.select(F.monotonically_increasing_id().alias("row"), "id", "v").write.parquet(folder)
    rows = spark.read.parquet(folder).withColumn("size", F.size("v"))
    asked = F.col("id") % every == 0
    n, n_asked = rows.agg(F.count("*"), F.count_if(asked)).first()
    # Small tables still give every core a lane; beyond that the number of lanes follows the rows.
    lanes = max(-(-n // lane), min(2 * spark.sparkContext.defaultParallelism, -(-n // 2048)), 1)
    blocks = max(-(-n_asked // queries), 1)
    dealt = F.xxhash64("row")
    index = rows.withColumn("lane", F.pmod(dealt, F.lit(lanes)))
    sought = rows.filter(asked).withColumn("block", F.pmod(dealt, F.lit(blocks)))
    index = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    sought = sought.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(lanes - 1).cast("bigint"))))
    tile = ["size", "lane", "block"]
    index, sought = (f.select(*tile, "row", "id", "v").groupBy(*tile) for f in (index, sought))
    found = index.cogroup(sought).applyInArrow(lambda a, b: _search(a, b, k), "row bigint, vec_id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    found = found.withColumn("rank", place).filter(F.col("rank") <= k)
    names = rows.filter(asked).select("row", F.col("id").alias("query_id"))
    return found.join(names, "row").select("query_id", "rank", "vec_id", "score")
