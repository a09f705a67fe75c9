"""Near-duplicate trajectories: an exact set-similarity join, and the groups its links make.

Sets of tokens are compared by Jaccard similarity. Trajectories with equal sets are
one class, named by its smallest id; classes are joined, members only listed:

    membership(tokens)        (trajectory_id, class_id, n): every trajectory
    linked_classes(tokens)    pairs of classes that are similar enough
    groups(tokens)            (trajectory_id, group_id): what links connect
    keep_one(actions, groups) one trajectory of each group

The join goes by a common order of all tokens, rarest first. Two sets of sizes
n <= m can only reach similarity t if t m <= n and they share one of the first
n - ceil(t n) + 1 tokens of the one and m - ceil(t m) + 1 of the other; the place of the
first shared one must leave enough tokens behind it, and the tokens of both must
agree well enough on counts by hash (a bit each for short sets, HISTOGRAM buckets for
others). What is left is compared exactly. Short sets carry all their tokens to where
they meet and are compared there; of the tokens by which two meet only the first they
share counts, so no candidate is written and each link is found once. No window or
task holds a whole trajectory: places within a long one come from counts of pieces,
its tokens are compared in parts. A token that many first parts share is split by
salt and by size.

Links can be as many as pairs of classes. Groups need only what they connect, so each
task keeps a tree of each component among its links and the links' number by class;
no table of links is written.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqtable.functions.staging import computed_once
from seqtable.operators.components import components
from seqtable.operators.ordered import with_running_total
from seqtable.session import new_folder

THRESHOLD_PERCENT = 90
#: Sets up to this many tokens are compared where they meet, larger ones after that.
SHORT = 64
#: Sets up to this many tokens are compared as one array, larger ones in parts.
ARRAY = 4096
HISTOGRAM = 16
#: Bits, in words of 64, that show which tokens a short set may hold.
WORDS = 2
#: Links that a task looks at together, and links of trees that it keeps.
TOGETHER, KEPT = 1_000_000, 500_000
#: Rows of one token and size that meet in one task, about, on the side that is split.
SALTED = 10_000


def token_sets(actions: DataFrame) -> DataFrame:
    """(trajectory_id, workflow_type, token): what each action is, numbered by occurrence, so repeats count."""
    content = F.to_json(F.struct("action_type", "element_type", "url"), {"ignoreNullFields": "false"})
    rows = actions.select("trajectory_id", "workflow_type", "pos", content.alias("_what"), F.lit(1).alias("_one"))
    rows = rows.withColumn("_key", F.concat_ws("|", "trajectory_id", "_what"))
    rows = with_running_total(rows, "_key", "pos", "_one", "_nth")
    return rows.select("trajectory_id", "workflow_type", F.xxhash64("_what", "_nth").alias("token"))


def membership(tokens: DataFrame) -> DataFrame:
    """(trajectory_id, workflow_type, class_id, n): every trajectory with its class and set size."""
    sets = tokens.groupBy("workflow_type", "trajectory_id").agg(
        F.count("*").alias("n"), F.bit_xor("token").alias("_x"), F.sum(F.shiftrightunsigned("token", 20)).alias("_s")
    )
    content = ["workflow_type", "n", "_x", "_s"]
    named = sets.groupBy(*content).agg(F.min("trajectory_id").alias("class_id"))
    same = F.lit(True)
    for c in content:
        same &= F.col(f"s.{c}").eqNullSafe(F.col(f"c.{c}"))
    return sets.alias("s").join(named.alias("c"), same).select("trajectory_id", "s.workflow_type", "class_id", "s.n")


def _places(sets: DataFrame) -> DataFrame:
    """Adds ``place`` (from 0): the token's place in its set by (level, token); level is the size of its use as a power of two."""
    inside = Window.partitionBy("class_id").orderBy("level", "token")
    short = sets.where(F.col("n") <= ARRAY).withColumn("place", F.row_number().over(inside) - 1)
    long = sets.where(F.col("n") > ARRAY).withColumn("_piece", F.shiftrightunsigned(F.col("token").bitwiseXOR(F.lit(-(2**63))), 54))
    counts = long.groupBy("class_id", "level", "_piece").agg(F.count("*").alias("_n"))  # 1024 pieces a level
    before = Window.partitionBy("class_id").orderBy("level", "_piece").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("class_id", "level", "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    piece = Window.partitionBy("class_id", "level", "_piece").orderBy("token")
    long = long.join(counts, ["class_id", "level", "_piece"]).withColumn("place", F.row_number().over(piece) - 1 + F.col("_before"))
    return short.unionByName(long.drop("_piece", "_before"))


def _enough(percent: int, a: str, b: str) -> Column:
    """Tokens that sets of sizes a and b must share: the least c with 100 c >= percent (a + b - c)."""
    return F.expr(f"cast(({percent} * ({a} + {b}) + {99 + percent}) div {100 + percent} as bigint)")


def _ranked(sets: DataFrame) -> DataFrame:
    """Adds ``uses`` of the token in its workflow and their ``level``, the power of two."""
    uses = sets.groupBy("workflow_type", "token").agg(F.count("*").alias("uses")).where("uses > 1")
    known = F.col("s.workflow_type").eqNullSafe(F.col("u.workflow_type")) & (F.col("s.token") == F.col("u.token"))
    ranked = sets.alias("s").join(uses.alias("u"), known, "left").select("s.*", F.coalesce("uses", F.lit(1)).alias("uses"))
    return ranked.withColumn("level", F.length(F.bin("uses")))


def _first_part(percent: int) -> str:
    """Tokens of a set of n that one of another set must be among."""
    return f"n - cast(({percent} * n + 99) div 100 as bigint) + 1"


def _met(first: DataFrame, percent: int, carried: list[str], more: Column) -> DataFrame:
    """(a, na, b, nb, token): classes that may be similar enough, at each token they meet by; na <= nb.

    The ``carried`` columns come along as <name>_a and <name>_b, and ``more`` is a condition on them.
    """
    # Sizes that can be similar lie in one band or in two neighbouring ones.
    band = F.floor(F.log("n") / math.log(100 / min(percent, 99)) + 1e-9).cast("int")
    salts = F.ceil(F.col("uses") / SALTED).cast("int")
    first = first.select("workflow_type", "token", "class_id", "n", "place", *carried, band.alias("band"), salts.alias("salts"))
    left = first.select(
        "workflow_type", "token", F.col("class_id").alias("a"), F.col("n").alias("na"), F.col("place").alias("pa"), *[F.col(c).alias(f"{c}_a") for c in carried],
        F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"), F.pmod(F.xxhash64("class_id"), "salts").alias("salt"),
    )
    right = first.select(
        F.col("workflow_type").alias("_w"), F.col("token").alias("_t"), F.col("band").alias("_band"),
        F.col("class_id").alias("b"), F.col("n").alias("nb"), F.col("place").alias("pb"), *[F.col(c).alias(f"{c}_b") for c in carried],
        F.explode(F.sequence(F.lit(0).cast("bigint"), (F.col("salts") - 1).cast("bigint"))).alias("_salt"),
    )
    met = (
        F.col("workflow_type").eqNullSafe(F.col("_w"))
        & (F.col("token") == F.col("_t"))
        & (F.col("band") == F.col("_band"))
        & (F.col("salt") == F.col("_salt"))
        & F.expr(f"(na < nb or na = nb and a < b) and 100 * na >= {percent} * nb")
        & (F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) >= _enough(percent, "na", "nb"))
        & more
    )
    return left.join(right, met).select("a", "na", "b", "nb", "token", *[f"{c}_{x}" for c in carried for x in "ab"])


def _candidates(sets: DataFrame, percent: int) -> DataFrame:
    """(a, na, b, nb): pairs of classes, one at least not short, that may be similar enough, each once; na <= nb."""
    # No set much smaller than the least long one meets it.
    near = sets.where(F.expr(f"100 * n >= {percent} * {SHORT}"))
    first = _places(_ranked(near)).where(F.expr(f"place < {_first_part(percent)} and uses > 1"))
    return _met(first, percent, [], F.col("nb") > SHORT).select("a", "na", "b", "nb").distinct()


def _short_links(sets: DataFrame, percent: int) -> DataFrame:
    """(a, na, b, nb, both, members_a, members_b): similar pairs of short sets, each once."""
    bit = F.pmod("token", F.lit(64 * WORDS))
    word = lambda i: F.when(bit.between(64 * i, 64 * i + 63), F.expr(f"shiftleft(1L, cast(pmod(token, {64 * WORDS}) - {64 * i} as int))")).otherwise(0)
    words = [F.bit_or(word(i)).alias(f"bits{i}") for i in range(WORDS)]
    listed = F.array_sort(F.collect_list(F.struct("level", "token", "uses"))).alias("_t")
    short = _ranked(sets.where(F.col("n") <= SHORT)).groupBy("workflow_type", "class_id", "n", "members").agg(listed, *words)
    first = F.slice("_t", F.lit(1), F.expr(f"cast({_first_part(percent)} as int)"))
    carried = ["tokens", "members", *[f"bits{i}" for i in range(WORDS)]]
    first = short.select("workflow_type", "class_id", "n", F.col("_t.token").alias("tokens"), *carried[1:], F.posexplode(first).alias("place", "_f"))
    first = first.select("*", "_f.token", "_f.uses").where("uses > 1")
    lacking = lambda x, y: sum((F.bit_count(F.col(f"bits{i}_{x}").bitwiseAND(F.bitwise_not(f"bits{i}_{y}"))) for i in range(WORDS)), F.lit(0))
    most = F.least(F.col("na") - lacking("a", "b"), F.col("nb") - lacking("b", "a"))
    met = _met(first, percent, carried, most >= _enough(percent, "na", "nb"))
    met = computed_once(met.withColumn("_shared", F.array_intersect("tokens_a", "tokens_b")), "_shared")
    both = F.size("_shared").cast("bigint")
    # Shared tokens keep the common order; the first of them is in the first parts of both.
    met = met.where(F.col("_shared")[0] == F.col("token")).select("a", "na", "b", "nb", both.alias("both"), "members_a", "members_b")
    return met.where(_similar(percent))


def _histograms(sets: DataFrame) -> DataFrame:
    """(class_id, histogram): tokens of each class by hash bucket."""
    bucket = F.pmod("token", F.lit(HISTOGRAM))
    return sets.groupBy("class_id").agg(F.array(*[F.count_if(bucket == i) for i in range(HISTOGRAM)]).alias("histogram"))


def _similar(percent: int) -> str:
    return f"100 * both >= {percent} * (na + nb - both)"


def _shared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs with ``both``, the number of tokens they share."""
    arrays = sets.where(F.col("n") <= ARRAY).groupBy("class_id").agg(F.collect_list("token").alias("tokens"))
    mine = arrays.withColumnsRenamed({"class_id": "a", "tokens": "_mine"})
    theirs = arrays.withColumnsRenamed({"class_id": "b", "tokens": "_theirs"})
    both = F.size(F.array_intersect("_mine", "_theirs")).cast("bigint")
    short = pairs.where(F.col("nb") <= ARRAY).join(mine, "a").join(theirs, "b").select("a", "na", "b", "nb", both.alias("both"))
    # Long sets: parts of some ARRAY tokens by hash, as many for both of a pair.
    parts = F.ceil(F.col("nb") / ARRAY).cast("int")
    long = pairs.where(F.col("nb") > ARRAY).withColumn("parts", parts)
    needed = long.select(F.explode(F.array(F.struct(F.col("a").alias("class_id"), "parts"), F.struct(F.col("b").alias("class_id"), "parts"))).alias("x")).select("x.*").distinct()
    cut = sets.join(needed, "class_id").groupBy("class_id", "parts", F.pmod("token", F.col("parts")).alias("part")).agg(F.collect_list("token").alias("tokens"))
    mine = cut.withColumnsRenamed({"class_id": "a", "tokens": "_mine"})
    theirs = cut.withColumnsRenamed({"class_id": "b", "tokens": "_theirs"})
    long = long.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), (F.col("parts") - 1).cast("bigint"))))
    long = long.join(mine, ["a", "parts", "part"]).join(theirs, ["b", "parts", "part"]).select("a", "na", "b", "nb", both.alias("both"))
    return short.unionByName(long.groupBy("a", "na", "b", "nb").agg(F.sum("both").alias("both")))


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, similarity, members_a, members_b), a < b, of class sets (class_id, workflow_type, token, n, members)."""
    pairs = _candidates(sets, percent)
    long = sets.where(F.expr(f"100 * n >= {percent} * {SHORT}"))
    histograms = _histograms(long)
    mine, theirs = (histograms.withColumnsRenamed({"class_id": c, "histogram": f"_{c}"}) for c in ("a", "b"))
    most = F.aggregate(F.zip_with("_a", "_b", lambda x, y: F.least(x, y)), F.lit(0).cast("bigint"), lambda s, x: s + x)
    pairs = pairs.join(mine, "a").join(theirs, "b").where(most >= _enough(percent, "na", "nb")).drop("_a", "_b")
    found = _shared(pairs, long).where(_similar(percent))
    sizes = long.groupBy("class_id").agg(F.min("members").alias("members"))
    for c in ("a", "b"):
        found = found.join(sizes.withColumnsRenamed({"class_id": c, "members": f"members_{c}"}), c)
    found = _short_links(sets, percent).unionByName(found)
    similarity = F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))
    ordered = F.col("a") < F.col("b")
    size = lambda x, y: F.when(ordered, F.col(f"members_{x}")).otherwise(F.col(f"members_{y}"))
    return found.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), similarity.alias("similarity"), size("a", "b").alias("members_a"), size("b", "a").alias("members_b")
    )


def _named(members: DataFrame, percent: int) -> DataFrame:
    """(class_id, n, members): the classes that can be similar to another."""
    named = members.groupBy("class_id", "n").agg(F.count("*").alias("members"))
    # Where no other size can be similar enough, equal sets are one class already.
    return named.where(f"n * 100 >= (n + 1) * {percent} or (n - 1) * 100 >= n * {percent}")


def linked_classes(tokens: DataFrame, members: DataFrame, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """(a, b, similarity, members_a, members_b), a < b: all pairs of classes of one workflow with similarity ``percent`` / 100 or more,
    and the number of trajectories in each class.

    Both inputs are read several times, so they should be written tables.
    """
    return _links(tokens.withColumnRenamed("trajectory_id", "class_id").join(_named(members, percent), "class_id"), percent)


def _trees(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ends of some links, and the smallest end that these links connect each with."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least, now = np.minimum(label[x], label[y]), label.copy()
        np.minimum.at(now, label[x], least)
        np.minimum.at(now, label[y], least)
        while (now[now] != now).any():
            now = now[now]
        if (now == label).all():
            return nodes, nodes[label]
        label = now


def _tied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, other, links): links a, b as a tree of each component among them, and the links of each node."""
    empty = np.zeros(0, np.int64)
    names = ["node", "other", "links"]
    kept, held, n_held = (empty, empty), [], 0

    def out(node: np.ndarray, other: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (node, other, links)], names=names)

    def reduced() -> Iterator[pa.RecordBatch]:
        nonlocal kept, held, n_held
        a, b = (np.concatenate([h[i] for h in held] or [empty]) for i in (0, 1))
        held, n_held = [], 0
        nodes, counts = np.unique(np.concatenate([a, b]), return_counts=True)
        yield out(nodes, nodes, counts)
        nodes, least = _trees(np.concatenate([kept[0], a]), np.concatenate([kept[1], b]))
        kept = nodes[nodes != least], least[nodes != least]
        if len(kept[0]) > KEPT:
            yield out(*kept, np.zeros(len(kept[0]), np.int64))
            kept = empty, empty

    for batch in batches:
        held.append(tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)))
        n_held += batch.num_rows
        if n_held >= TOGETHER:
            yield from reduced()
    yield from reduced()
    yield out(*kept, np.zeros(len(kept[0]), np.int64))


def _written(actions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tokens and membership of all trajectories, written to the shared folder."""
    spark, folder = actions.sparkSession, new_folder(actions.sparkSession, "similar")
    token_sets(actions).write.parquet(f"{folder}/tokens")
    tokens = spark.read.parquet(f"{folder}/tokens")
    membership(tokens).write.parquet(f"{folder}/members")
    return tokens, spark.read.parquet(f"{folder}/members")


def near_duplicates(actions: DataFrame, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """(a, b, members_a, members_b, similarity): linked classes with the number of trajectories in each; see `near_groups`."""
    tokens, members = _written(actions)
    return linked_classes(tokens, members, percent).select("a", "b", "members_a", "members_b", "similarity")


def near_groups(actions: DataFrame, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """(trajectory_id, class_id, group_id, links): every trajectory, its class, the smallest id that links connect it with,
    and the number of classes its class is linked with.
    """
    tokens, members = _written(actions)
    spark, folder = actions.sparkSession, new_folder(actions.sparkSession, "links")
    # Numbers in the order of the ids stand for them.
    named = _named(members, percent).orderBy("class_id").withColumn("number", F.monotonically_increasing_id())
    named.write.parquet(f"{folder}/classes")
    named = spark.read.parquet(f"{folder}/classes")
    sets = tokens.withColumnRenamed("trajectory_id", "class_id").join(named, "class_id").drop("class_id").withColumnRenamed("number", "class_id")
    links = _links(sets, percent).select("a", "b")
    links.mapInArrow(_tied, "node bigint, other bigint, links bigint").write.parquet(f"{folder}/trees")
    trees = spark.read.parquet(f"{folder}/trees")
    ends = trees.groupBy("node").agg(F.sum("links").alias("links"))
    found = components(trees.where("node <> other"), "node", "other")
    names = named.select("class_id", F.col("number").alias("node"))
    groups = names.withColumnsRenamed({"class_id": "group_id", "node": "component"})
    found = names.join(found, "node").join(ends, "node").join(groups, "component").select("class_id", "group_id", "links")
    return members.join(found, "class_id", "left").select(
        "trajectory_id", "class_id", F.coalesce("group_id", "class_id").alias("group_id"), F.coalesce("links", F.lit(0)).cast("bigint").alias("links")
    )


def keep_one(actions: DataFrame, groups: DataFrame) -> DataFrame:
    """Action rows of the trajectories that give their group its name."""
    return actions.join(groups.where("trajectory_id = group_id").select("trajectory_id"), "trajectory_id", "left_semi")
