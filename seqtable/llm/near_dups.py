"""Near duplicates by word shingles: min-max hashing for candidates, full sets for links.

Each document becomes the set of its word shingles. Under each of P permutations
both the least and the greatest shingle are kept, so 2 P signature values cost P
hash evaluations; the share of equal values estimates the similarity without
bias and with less variance than 2 P independent minima would. Bands of ROWS
values are hashed; sets with an equal band are candidates. The number of bands
follows from the threshold: a pair at the threshold is missed with a probability
of at most MISS.

1. Rows with equal sets are one node (digest of the set); copies are never
   compared or paired.
2. All rows of a band bucket belong to a cluster: connected components of the
   edges from each member to the bucket's least member.
3. A cluster is split by hash into blocks of bounded bytes; each pair of blocks is
   a cell, and a task compares the candidates in its cells. Members already found
   connected there are not compared again, so a group of n copies of one text
   costs about n comparisons. A link needs the exact similarity of the two sets.
4. Connected components of the links.

Shingles are compared as 40-bit numbers; two sets of 1000 shingles have one in
two million chances that a count is off by one.

Results for odd input: null texts and texts without words have an empty set and
are linked with nothing; fewer words than a shingle make one shingle; equal rows
are in one group (they count separately); a null id counts in a group but does not name it (a group of
null ids alone has a null name); an empty table gives an empty one.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtable import session
from seqtable.llm.graph import components
from seqtable.llm.tables import mixed
from seqtable.llm.texts import groups_of, map_texts
from seqtable.llm.words import SOLID, runs, words

ROWS, MISS = 6, 1e-6
#: Bytes of sets in a block, and elements hashed at once.
BLOCK_BYTES, ELEMENTS = 4 << 20, 1 << 18
#: Up to so many rows with candidates (20 bytes each) are sent to the tasks that read the sets; more are joined by shuffle.
SENT = 500_000
_SEED = 20_240


def bands_for(threshold: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands of `rows` values so that sets at the threshold share none with a chance of at most `miss`."""
    return 1 if threshold >= 1 else math.ceil(math.log(miss) / math.log(1 - threshold**rows))


class Signer:
    """Band keys of sets from the least and greatest of each permutation."""

    def __init__(self, bands: int, rows: int = ROWS):
        self.bands, self.rows = bands, rows
        draw = np.random.default_rng(_SEED)
        self.factors = draw.integers(0, 2**63, -(-bands * rows // 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def signature(self, shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Sets by values; the sets lie one after the other from `starts`."""
        out = np.empty((2 * len(self.factors), len(starts)), np.uint64)
        for k, factor in enumerate(self.factors):
            values = shingles * factor
            out[2 * k] = np.minimum.reduceat(values, starts)
            out[2 * k + 1] = np.maximum.reduceat(values, starts)
        return out

    def keys(self, shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """(sets, bands) numbers; equal in a band if its values are."""
        signature = self.signature(shingles, starts)
        out = np.zeros((len(starts), self.bands), np.uint64)
        for band in range(self.bands):
            h = np.full(len(starts), band, np.uint64)
            for k in range(band * self.rows, (band + 1) * self.rows):
                h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + signature[k])
            out[:, band] = h
        return out


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, one text after the other, sorted; and their numbers."""
    numbers, bounds = words(texts, SOLID)
    n_words = np.diff(bounds)
    parts = []
    every = runs(numbers, size)
    for a, b, n in zip(bounds[:-1].tolist(), bounds[1:].tolist(), n_words.tolist(), strict=True):
        # Fewer words than a shingle: the whole sequence, told apart from longer runs by its length.
        parts.append(np.unique(every[a : b - size + 1]) if n >= size else mixed(runs(numbers[a:b], n) + np.uint64(n)) if n else numbers[:0])
    return np.concatenate([numbers[:0], *parts]), np.array([len(p) for p in parts], np.int64)


def sign(documents: DataFrame, keep: list[str], text: str, size: int, bands: int) -> DataFrame:
    """Columns `keep`, n_shingles, digest (null for an empty set), bands and the set in 5 bytes a shingle."""

    def prepare():
        signer = Signer(bands)

        def work(texts: pa.Array) -> list:
            shingles, n = shingle_sets(texts, size)
            ends = np.cumsum(n)
            starts, full = ends - n, np.flatnonzero(n)
            keys = np.zeros((len(n), bands), np.uint64)
            done = 0
            while done < len(full):  # few enough elements at once to stay in the processor's cache
                stop = max(done + 1, int(np.searchsorted(ends[full], starts[full[done]] + ELEMENTS, side="right")))
                some = full[done:stop]
                low = starts[some[0]]
                keys[some] = signer.keys(shingles[low : ends[some[-1]]], starts[some] - low)
                done = stop
            raw = np.ascontiguousarray(shingles.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, 3:]
            sets = [raw[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            digests = [xxhash.xxh3_128_digest(shingles[a:b].tobytes()) if a < b else None for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            offsets = pa.array(np.arange(len(n) + 1, dtype=np.int32) * bands)
            return [n, digests, pa.ListArray.from_arrays(offsets, pa.array(keys.view(np.int64).ravel())), sets]

        return work

    return map_texts(documents, keep, text, "n_shingles bigint, digest binary, bands array<bigint>, shingles binary", prepare)


def unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, 3:] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


class Cell:
    """Links between the candidates of one cell."""

    def __init__(self, sides: np.ndarray, bands: np.ndarray, sets: list[bytes], same: bool, part: int, whole: int):
        self.sides, self.bands, self.same, self.part, self.whole = sides, bands, same, part, whole
        self.sizes = np.array([len(s) // 5 for s in sets], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        _, self.elements = np.unique(unpacked(b"".join(sets)), return_inverse=True)
        self.marks = np.zeros(int(self.elements.max(initial=0)) + 1, np.int64)
        self.group = np.arange(len(sets))

    def common(self, x: int, others: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of set x with others."""
        mine = self.elements[self.starts[x] : self.starts[x] + self.sizes[x]]
        self.marks[mine] = 1
        size = self.sizes[others]
        first = np.cumsum(size) - size
        at = np.repeat(self.starts[others] - first, size) + np.arange(size.sum())
        out = np.add.reduceat(self.marks[self.elements[at]], first)
        self.marks[mine] = 0
        return out

    def links(self) -> Iterator[tuple[int, int]]:
        """Pairs of linked members, as many as it takes to connect all that are linked."""
        for band in range(self.bands.shape[1]):
            keys = self.bands[:, band]
            order = np.argsort(keys, kind="stable")
            cuts = np.flatnonzero(np.diff(keys[order])) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
            many = ends - starts > 1
            for a, b in zip(starts[many].tolist(), ends[many].tolist(), strict=True):
                yield from self._bucket(order[a:b], band)

    def _bucket(self, members: np.ndarray, band: int) -> Iterator[tuple[int, int]]:
        for k, x in enumerate(members[:-1].tolist()):
            others = members[k + 1 :]
            others = others[self.group[others] != self.group[x]]
            if not self.same:
                others = others[self.sides[others] != self.sides[x]]
            if not len(others):
                continue
            small, large = np.minimum(self.sizes[others], self.sizes[x]), np.maximum(self.sizes[others], self.sizes[x])
            others = others[self.whole * small >= self.part * large]
            # Compared only in the first band they share.
            others = others[(self.bands[others] == self.bands[x]).argmax(axis=1) == band]
            if not len(others):
                continue
            both = self.common(x, others)
            for y in others[self.whole * both >= self.part * (self.sizes[others] + self.sizes[x] - both)].tolist():
                if self.group[y] != self.group[x]:
                    self.group[self.group == self.group[y]] = self.group[x]
                    yield x, y


def compare_cells(cells: DataFrame, part: int, whole: int) -> DataFrame:
    """Links (a, b) from rows (cluster, i, j, side, row, bands, shingles), sorted by cell within partitions."""

    def run(batches):
        for rows in groups_of(batches, 3):
            rows = rows.combine_chunks()
            name = rows["row"].to_numpy()
            bands = rows["bands"].combine_chunks().flatten().to_numpy().reshape(len(name), -1)
            cell = Cell(rows["side"].to_numpy(), bands, rows["shingles"].to_pylist(), rows["i"][0] == rows["j"][0], part, whole)
            pairs = np.array(list(cell.links()), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(name[pairs[:, 0]]), pa.array(name[pairs[:, 1]])], names=["a", "b"])

    return cells.mapInArrow(run, "a bigint, b bigint")


def link(signed: DataFrame, part: int, whole: int) -> DataFrame:
    """(row, label) of the nodes that are linked; a node is the first row of a digest.

    `signed` is a written table with a number `row` for each row.
    """
    spark = signed.sparkSession
    folder = session.new_folder(spark, "near-dups")
    keyed = signed.select("row", F.explode("bands").alias("band")).filter("band <> 0")  # 0: the set is empty
    buckets = keyed.groupBy("band").agg(F.min("row").alias("least"), F.max("row").alias("most")).filter("least < most")
    stars = keyed.join(buckets.select("band", "least"), "band").filter("row > least").select("row", "least").distinct()
    components(stars, "row", "least").write.parquet(f"{folder}/clusters")
    clusters = spark.read.parquet(f"{folder}/clusters").withColumnsRenamed({"node": "row", "label": "cluster"})
    few = clusters.count() <= SENT
    sent = F.broadcast if few else lambda frame: frame
    # Copies lie in one cluster; the first of each digest stands for them.
    named = signed.select("row", "digest", F.length("shingles").alias("bytes"), F.size("bands").alias("n_bands")).join(sent(clusters), "row")
    named.groupBy("cluster", "digest").agg(F.min("row").alias("row"), F.max(F.col("bytes") + 8 * F.col("n_bands")).alias("bytes")).write.parquet(
        f"{folder}/members"
    )
    members = spark.read.parquet(f"{folder}/members")
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.sum("bytes") / BLOCK_BYTES).cast("int").alias("blocks"))
    members = members.join(sizes.filter("n > 1"), "cluster").select("cluster", "row", "blocks")
    sets = signed.select("row", "bands", "shingles").join(sent(members), "row")
    cells = (
        sets.withColumn("side", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("cluster", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "row", "bands", "shingles")
        .repartition("cluster", "i", "j")
        .sortWithinPartitions("cluster", "i", "j", "row")
    )
    compare_cells(cells, part, whole).write.parquet(f"{folder}/links")
    return components(spark.read.parquet(f"{folder}/links"), "a", "b").withColumnsRenamed({"node": "row"})


def groups(documents: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, part: int = 80, whole: int = 100) -> DataFrame:
    """One row per document: the key, n_shingles, text_hash, label and component_id, the smallest key of its group.

    Linked are documents whose sets satisfy whole * intersection >= part * union.
    The label names the group too, without regard to keys; null for empty sets.
    """
    spark = documents.sparkSession
    folder = session.new_folder(spark, "signed")
    rows = documents.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    signed = sign(rows, ["key", "text_hash"], "text", size, bands_for(part / whole))
    signed.withColumn("row", F.monotonically_increasing_id()).write.parquet(folder)
    signed = spark.read.parquet(folder)
    labels = link(signed, part, whole)
    nodes = signed.filter("digest is not null").groupBy("digest").agg(F.min("key").alias("key"), F.min("row").alias("row"))
    nodes = nodes.join(labels, "row", "left").withColumn("label", F.coalesce("label", "row"))
    named = nodes.join(nodes.groupBy("label").agg(F.min("key").alias("component")), "label").select("digest", "label", "component")
    found = signed.select("key", "text_hash", "n_shingles", "digest").join(named, "digest", "left")
    return found.select(
        F.col("key").alias(key),
        "n_shingles",
        "text_hash",
        "label",
        F.when(F.col("digest").isNull(), F.col("key")).otherwise(F.col("component")).alias("component_id"),
    )


def keep_one(documents: DataFrame, key: str = "doc_id", text: str = "text", **options: int) -> DataFrame:
    """The rows, all columns, without those that near-duplicate another row that stays.

    Of each group the row with the smallest key stays (null keys last; ties: the
    smallest hash of the text, then any one of equal rows); empty texts all stay.
    """
    spark = documents.sparkSession
    folder = session.new_folder(spark, "kept")
    groups(documents, key, text, **options).write.parquet(f"{folder}/groups")
    found = spark.read.parquet(f"{folder}/groups")
    found = found.select("label", F.struct(F.col(key).isNull().alias("unnamed"), F.col(key).alias("key"), "text_hash").alias("id"))
    best = found.filter("label is not null").groupBy("label").agg(F.min_by("id", "id").alias("id"), F.count(F.lit(1)).alias("n"))
    times = found.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    named = best.select("id").join(times.withColumnRenamed("id", "again"), F.col("id") == F.col("again"))
    empty = found.filter("label is null").select("id").distinct()
    stay = named.select("id", (F.col("n") > 1).alias("again")).union(empty.select("id", F.lit(False)))
    stay.select(F.col("id.key").alias("__key"), F.col("id.text_hash").alias("__hash"), F.col("again").alias("__again")).write.parquet(f"{folder}/stay")
    stay = spark.read.parquet(f"{folder}/stay")

    def joined(some: DataFrame) -> DataFrame:
        return documents.join(some, documents[key].eqNullSafe(some["__key"]) & (F.xxhash64(documents[text]) == some["__hash"]))

    columns = [documents[c] for c in documents.columns]
    kept = joined(stay.filter("not __again")).select(*columns)
    repeated = stay.filter("__again")
    if repeated.limit(1).count():  # a row whose key and text come twice
        kept = kept.union(joined(repeated).dropDuplicates(["__key", "__hash"]).select(*columns))
    return kept
