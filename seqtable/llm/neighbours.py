"""Nearest neighbours by several shifted Hilbert orderings of projected vectors.

Equal vectors are one group, with its k + 1 smallest ids (as many as any answer can
take from it); only groups are ordered and compared, and the ids are put in when
the nearest are merged. So copies neither fill windows nor hide each other.

Each of CURVES orderings projects the vectors at random on DIMENSIONS axes, shifts
and scales them to a grid, and sorts by the place on a Hilbert curve. Vectors that
are close often stand close in some ordering. For a query, all vectors at most a
window of places before or after it in any ordering are compared exactly (Euclidean
distance in double precision), and the nearest of all orderings are merged.

The window is measured on each table: the true neighbours of at most ASKED queries
are found by brute force, and the window is the smallest, WINDOW at least, that
holds the share TARGET of them in some ordering. It grows with the table as far as
the data needs it, up to the whole table.

Spark sorts by range partitions of (curve, key), so a task holds no curve as a
whole; places follow from the sizes of the partitions. These sizes, and queries,
neighbours and places of the sample, are all that reaches the driver. Orderings are
cut into pieces of at most PIECE places, which bounds every task's group however
wide the window is.

The grid is fitted on a bounded sample of vectors; every vector is indexed. `recall`
measures the share of true neighbours found for other queries than the sample's.

Results for odd input: vectors that are null, zero, hold null or non-finite
components or have another length than most take no part, nor do null ids; a
repeated id counts once, with its nearest vector; equal distances go to the
smaller id; an empty table gives an empty one.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqtable import session
from seqtable.llm.texts import groups_of

CURVES, DIMENSIONS, BITS, WINDOW = 32, 12, 3, 640
#: Most places of an ordering in one group of a task.
PIECE = 8192
#: Queries that the window is measured with, and the share of their true neighbours it must hold (0.9 is asked for; the rest is for the sample's error).
ASKED, TARGET = 100, 0.95
#: Parts that the copies of a vector are dealt out to, at least.
SALTS = 64
#: Distinct vectors that the grid is fitted on, as an expected number.
SAMPLE = 2000
SPREAD = 2.5


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of grid cells (below 2 ** bits); fits 63 bits."""
    x = cells.astype(np.uint64).T.copy()
    for q in (1 << b for b in range(bits - 1, 0, -1)):  # turn and mirror the cubes, largest first
        low = np.uint64(q - 1)
        for i in range(len(x)):
            flip = (x[i] & np.uint64(q)) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
    for i in range(1, len(x)):  # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        turn ^= np.where(x[-1] & np.uint64(q), np.uint64(q - 1), np.uint64(0))
    x ^= turn
    key = np.zeros_like(turn)
    for bit in range(bits - 1, -1, -1):
        for row in x:
            key = (key << np.uint64(1)) | ((row >> np.uint64(bit)) & np.uint64(1))
    return key.astype(np.int64)


@dataclass
class Curves:
    """Projections and grids of all orderings."""

    axes: np.ndarray  # curves, length, dimensions
    low: np.ndarray
    step: np.ndarray
    bits: int

    @classmethod
    def fit(cls, sample: np.ndarray, curves: int, dimensions: int, bits: int, seed: int = 5) -> "Curves":
        draw = np.random.default_rng(seed)
        length = sample.shape[1]
        dimensions = min(dimensions, length)
        axes = np.stack([np.linalg.qr(draw.standard_normal((length, dimensions)))[0] for _ in range(curves)])
        seen = np.einsum("nl,cld->cnd", sample, axes)
        middle, wide = seen.mean(axis=1), np.maximum(seen.std(axis=1), 1e-12)
        low = middle - SPREAD * wide + (draw.random(middle.shape) - 0.5) * wide  # each curve's grid is shifted
        return cls(axes, low, 2 * SPREAD * wide / (1 << bits), bits)

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """(curves, vectors) places."""
        out = np.empty((len(self.axes), len(vectors)), np.int64)
        for c, axes in enumerate(self.axes):
            cells = np.clip((vectors @ axes - self.low[c]) / self.step[c], 0, (1 << self.bits) - 1)
            out[c] = hilbert(cells.astype(np.int64), self.bits)
        return out


def usable(vector: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0), F.lit(False))


def vectors_of(frame: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector) of the rows that take part."""
    rows = frame.select(frame[key].cast("bigint").alias("id"), frame[vector].alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), "length").limit(1).collect()
    return rows.filter(F.size("vector") == (most[0].length if most else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _raw(rows: DataFrame) -> DataFrame:
    """(id, raw): vectors as bytes, with one zero."""

    def run(batches):
        for batch in batches:
            raw = pa.array([row.tobytes() for row in _matrix(batch.column(1)) + 0], pa.binary())  # -0.0 + 0 is 0.0
            yield pa.RecordBatch.from_arrays([batch.column(0), raw], names=["id", "raw"])

    return rows.mapInArrow(run, "id bigint, raw binary")


def _salt(ids: Column, salts: int) -> Column:
    """Deals the ids of one vector out, so that no task gets all copies."""
    return F.pmod(F.xxhash64(ids, F.lit("salt")), F.lit(salts)).alias("salt")


def _groups(raws: DataFrame, every: int, k: int, salts: int) -> DataFrame:
    """(id, asks, ids, raw) of each distinct vector: a number, whether it has a query, its k + 1 smallest ids."""
    asks = (F.col("id") % every == 0).alias("asks")
    some = raws.select("raw", "id", _salt(F.col("id"), salts), asks).groupBy("raw", "salt")
    some = some.agg(F.max("asks").alias("asks"), F.slice(F.sort_array(F.collect_set("id")), 1, k + 1).alias("ids"))
    least = F.slice(F.sort_array(F.flatten(F.collect_list("ids"))), 1, k + 1)
    found = some.groupBy("raw").agg(F.max("asks").alias("asks"), least.alias("ids"))
    return found.select(F.monotonically_increasing_id().alias("id"), "asks", "ids", "raw")


def _vectors(raw: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)


GROUP = "id bigint, asks boolean, ids array<bigint>, raw binary"


def _ordered(groups: DataFrame, curves: Curves, kind: str) -> DataFrame:
    """Groups with curve and key, one row for each curve."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                for c, places in enumerate(curves.keys(_vectors(part.column(3).to_pylist(), kind))):
                    curve = np.full(len(places), c, np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(curve), pa.array(places), *part.columns], names=["curve", "key", *part.schema.names])

    return groups.select("id", "asks", "ids", "raw").mapInArrow(run, f"curve int, key bigint, {GROUP}")


def _placed(ordered: DataFrame) -> DataFrame:
    """Rows sorted over all range partitions, with the partition and the place among its rows of the same curve."""

    def run(batches):
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            curve = batch.column(0).to_numpy()
            local = np.empty(len(curve), np.int64)
            for c in np.unique(curve).tolist():
                mine = np.flatnonzero(curve == c)
                local[mine] = seen.get(c, 0) + np.arange(len(mine))
                seen[c] = seen.get(c, 0) + len(mine)
            parts = np.full(len(curve), part, np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(parts), pa.array(local), *batch.columns[2:]], names=["curve", "part", "local", *batch.schema.names[2:]])

    rows = ordered.repartitionByRange("curve", "key", "id").sortWithinPartitions("curve", "key", "id")
    return rows.mapInArrow(run, f"curve int, part int, local bigint, {GROUP}")


def _pieces(placed: DataFrame, base: dict[tuple[int, int], int], window: int, size: int) -> DataFrame:
    """Members of each piece (`size` places) of a curve, and the asking groups whose windows may reach into it."""
    span = -(-window // size)

    def run(batches):
        for batch in batches:
            curve, part, local = (batch.column(i).to_numpy() for i in range(3))
            place = local + np.array([base[k] for k in zip(part.tolist(), curve.tolist(), strict=True)], np.int64)
            piece, asks = place // size, np.flatnonzero(batch.column(4).to_numpy(zero_copy_only=False))

            def rows(take, to, role):
                at = pa.array(take)
                return pa.RecordBatch.from_arrays(
                    [pa.array(curve[take]), pa.array(to), pa.array(np.full(len(take), role)), pa.array(place[take]), *(batch.column(i).take(at) for i in (3, 5, 6))],
                    names=["curve", "piece", "asks", "place", "id", "ids", "raw"],
                )

            yield rows(np.arange(len(place)), piece, False)
            for step in range(-span, span + 1):
                into = asks[piece[asks] + step >= 0]
                yield rows(into, piece[into] + step, True)

    return placed.mapInArrow(run, "curve int, piece bigint, asks boolean, place bigint, id bigint, ids array<bigint>, raw binary")


def _gaps(points: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared distances (points, rows) by one matrix product, and what covers their rounding."""
    one, other = (points**2).sum(axis=1), (matrix**2).sum(axis=1)
    return one[:, None] + other - 2 * points @ matrix.T, 1e-9 * (one.max(initial=0) + other.max(initial=0))


def _close(gap: np.ndarray, slack: float, k: int) -> np.ndarray:
    """Places among which the k nearest are, ties included; gaps that aren't numbers stay."""
    if len(gap) <= k:
        return np.arange(len(gap))
    return np.flatnonzero(~(gap > np.partition(gap, k - 1)[k - 1] + 2 * slack))


def _nearest(pieces: DataFrame, window: int, k: int, kind: str) -> DataFrame:
    """The k nearest ids of each asking group in each piece; rows are grouped by piece."""

    def found(rows: pa.Table) -> pa.RecordBatch | None:
        asks, place, own = (rows.column(c).to_numpy() for c in ("asks", "place", "id"))
        n = int(np.count_nonzero(~asks))  # members come first, by place
        matrix, place_of = _vectors(rows.column("raw").to_pylist(), kind), place[:n]
        lists = rows.column("ids").to_pylist()[:n]
        sizes, flat = np.array([len(x) for x in lists], np.int64), np.array([i for x in lists for i in x], np.int64)
        first = np.cumsum(sizes) - sizes
        out = []
        for start in range(n, len(own), 64):
            points = matrix[start : start + 64]
            gaps, slack = _gaps(points, matrix[:n])
            for q, gap in enumerate(gaps, start):
                low, high = np.searchsorted(place_of, [place[q] - window, place[q] + window + 1])
                most = k
                while True:
                    near = low + _close(gap[low:high], slack, most)
                    score = np.sqrt(((matrix[near] - matrix[q]) ** 2).sum(axis=1))
                    if len(near) > most:
                        best = np.flatnonzero(score <= np.partition(score, most - 1)[most - 1])
                        near, score = near[best], score[best]
                    size = sizes[near]
                    of = np.repeat(np.arange(len(near)), size)
                    ids = flat[first[near][of] + np.arange(len(of)) - (np.cumsum(size) - size)[of]]
                    order = np.lexsort((ids, score[of]))
                    ids, score = ids[order], score[of][order]
                    best = np.sort(np.unique(ids, return_index=True)[1])[:k]
                    if len(best) == k or most >= high - low:
                        break
                    most *= 2  # ids that are repeated with other vectors
                out.append((np.full(len(best), own[q]), ids[best], score[best]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["of", "vec_id", "score"]) if out else None

    def run(batches):
        for rows in groups_of(batches, 2):
            if (best := found(rows)) is not None:
                yield best

    rows = pieces.repartition("curve", "piece").sortWithinPartitions("curve", "piece", "asks", "place")
    return rows.mapInArrow(run, "of bigint, vec_id bigint, score double")


def _reach(groups: DataFrame, placed: DataFrame, base: dict[tuple[int, int], int], k: int, kind: str, asked: int, target: float) -> int:
    """The smallest window that holds the share `target` of the true neighbours, without equal vectors, of at most `asked` queries."""
    drawn = groups.filter("asks").orderBy(F.xxhash64("raw", F.lit("asked")), "raw").limit(asked).collect()
    if not drawn:
        return 0
    names, points = [r.id for r in drawn], _vectors([r.raw for r in drawn], kind)

    def run(batches):
        for batch in batches:
            ids, matrix = batch.column(0).to_numpy(), _vectors(batch.column(3).to_pylist(), kind)
            lists = batch.column(2).to_pylist()
            least, sizes = np.array([x[0] for x in lists]), np.array([len(x) for x in lists])
            gaps, slack = _gaps(points, matrix)
            for q, gap in enumerate(gaps):
                near = _close(gap, slack, k)
                score = np.sqrt(((matrix[near] - points[q]) ** 2).sum(axis=1))
                best = np.lexsort((least[near], score))[:k]
                near = near[best]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(best), names[q])), pa.array(ids[near]), pa.array(score[best]), pa.array(least[near]), pa.array(sizes[near])],
                    names=["of", "id", "score", "least", "size"],
                )

    best = F.row_number().over(Window.partitionBy("of").orderBy("score", "least"))
    true = groups.select("id", "asks", "ids", "raw").mapInArrow(run, "of bigint, id bigint, score double, least bigint, size bigint")
    true = true.withColumn("rank", best).filter(F.col("rank") <= k)
    left, pairs = dict.fromkeys(names, k), []
    for r in sorted(true.collect(), key=lambda r: (r.of, r["rank"])):  # asked x k at most
        take = min(left[r.of], r.size)
        left[r.of] -= take
        if r.id != r.of:
            pairs += [(r.of, r.id)] * take
    places: dict[int, dict[int, int]] = {}
    for r in placed.filter(F.col("id").isin(sorted({i for pair in pairs for i in pair}))).select("id", "curve", "part", "local").collect():
        places.setdefault(r.id, {})[r.curve] = base[r.part, r.curve] + r.local
    apart = sorted(min(abs(place - places[i][c]) for c, place in places[q].items()) for q, i in pairs)
    return apart[min(int(np.ceil(target * len(apart))), len(apart)) - 1] if apart else 0


def search(
    frame: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 50, k: int = 10,
    curves: int = CURVES, dimensions: int = DIMENSIONS, bits: int = BITS, window: int = WINDOW, sample: int = SAMPLE,
    asked: int = ASKED, target: float = TARGET,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k nearest found of each row whose id is divisible by `every`; `window` is the least."""
    spark = frame.sparkSession
    rows = vectors_of(frame, key, vector)
    kind = "<f4" if dict(rows.dtypes)["vector"] == "array<float>" else "<f8"
    if kind == "<f8":
        rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    raws = _raw(rows)
    folder = session.new_folder(spark, "vectors")
    _groups(raws, every, k, SALTS + rows.count() // 100_000).write.parquet(folder)
    groups = spark.read.parquet(folder)
    count = groups.count()
    fitted = groups.filter(F.pmod(F.xxhash64("raw", F.lit("grid")), F.lit(1_000_000)) < 1e6 * sample / max(count, 1)) if count > sample else groups
    points = [r.raw for r in fitted.orderBy("raw").collect()] or [r.raw for r in groups.limit(sample).collect()]
    if not points:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    folder = session.new_folder(spark, "curves")
    _placed(_ordered(groups, Curves.fit(_vectors(points, kind), curves, dimensions, bits), kind)).write.parquet(folder)
    placed = spark.read.parquet(folder)
    base, total = {}, {}
    for r in sorted(placed.groupBy("part", "curve").agg(F.count(F.lit(1)).alias("n")).collect()):  # partitions and curves
        base[r.part, r.curve] = total.get(r.curve, 0)
        total[r.curve] = base[r.part, r.curve] + r.n
    window = max(window, _reach(groups, placed, base, k, kind, asked, target))
    # One more than asked for: a group's list holds the query's own id.
    found = _nearest(_pieces(placed, base, window, min(window, PIECE)), window, k + 1, kind)
    found = found.groupBy("of", "vec_id").agg(F.min("score").alias("score"))
    # At most k + 1 rows of each group and of each piece its windows reach meet here.
    best = F.row_number().over(Window.partitionBy("of").orderBy("score", "vec_id"))
    found = found.withColumn("rank", best).filter(F.col("rank") <= k + 1)
    lists = found.groupBy("of").agg(F.collect_list(F.struct("score", "vec_id")).alias("near"))
    lists = lists.join(groups.filter("asks").select(F.col("id").alias("of"), "raw"), "of")
    lists = lists.select("raw", "near", F.explode(F.expr(f"sequence(0L, {SALTS // 4 - 1}L)")).alias("salt"))
    queries = raws.filter(F.col("id") % every == 0).select("raw", F.col("id").alias("query_id"), _salt(F.col("id"), SALTS // 4))
    each = queries.join(lists, ["raw", "salt"]).select("query_id", F.inline("near")).filter("vec_id <> query_id")
    each = each.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return each.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def brute_force(frame: DataFrame, queries: int, key: str = "vec_id", vector: str = "embedding", every: int = 50, k: int = 10) -> DataFrame:
    """The true k nearest of the `queries` smallest query ids; these few vectors are sent to all tasks."""
    rows = vectors_of(frame, key, vector)
    asked = rows.filter(F.col("id") % every == 0).orderBy("id").limit(queries).collect()
    points = {r.id: np.array(r.vector, np.float64) for r in asked}

    def run(batches):
        for batch in batches:
            ids, matrix = batch.column(0).to_numpy(), _matrix(batch.column(1)).astype(np.float64)
            for q, point in points.items():
                score = np.sqrt(((matrix - point) ** 2).sum(axis=1))
                score[ids == q] = np.inf
                best = np.lexsort((ids, score))[:k]
                best = best[np.isfinite(score[best])]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(best), q)), pa.array(ids[best]), pa.array(score[best])], names=["query_id", "vec_id", "score"])

    found = rows.mapInArrow(run, "query_id bigint, vec_id bigint, score double").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def recall(found: DataFrame, true: DataFrame) -> float:
    """Share of the true neighbours (by brute force, for some queries) among those found."""
    r = true.join(found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left").agg(F.count("hit").alias("hit"), F.count(F.lit(1)).alias("n")).first()
    return r.hit / r.n if r.n else 1.0
