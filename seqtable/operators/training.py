"""Training examples, features and mixes made from trajectories."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtable.functions import draw
from seqtable.operators.ordered import with_next, with_recent
from seqtable.operators.shape import is_backtrack, time_us

SPLITS: Mapping[str, float] = {"train": 0.70, "validation": 0.15, "test": 0.15}
CONTEXT = 3
EXAMPLE_LENGTH = 10
LOW_CONFIDENCE = 0.5


def split_of(key: Column, shares: Mapping[str, float] = SPLITS) -> Column:
    """The part a trajectory belongs to, fixed by its id, so that none is in two."""
    return draw.pick_weighted(draw.uniform("split", key), shares)


def next_action_examples(actions: DataFrame, n: int = CONTEXT) -> DataFrame:
    """The types of up to n actions before (oldest first), and the type and element that follow."""
    before = [f"_{i}" for i in range(1, n + 1)]
    rows = actions.select("trajectory_id", "pos", "action_type", "element_type")
    rows = with_recent(rows, "trajectory_id", "pos", {"action_type": before})
    return rows.where("pos > 0").select(
        "trajectory_id",
        "pos",
        F.concat_ws(" > ", *reversed(before)).alias("context"),
        F.col("action_type").alias("next_type"),
        F.col("element_type").alias("next_element"),
    )


def time_to_next(actions: DataFrame) -> DataFrame:
    """Seconds until the next action of the trajectory; its last action has none."""
    rows = with_next(actions.select("trajectory_id", "pos", time_us().alias("_at")), "trajectory_id", "pos", {"_at": "_next"})
    return rows.where(F.col("_next").isNotNull()).select("trajectory_id", "pos", ((F.col("_next") - F.col("_at")) / F.lit(1e6)).alias("seconds"))


def intent_examples(actions: DataFrame, length: int = EXAMPLE_LENGTH) -> DataFrame:
    """Sequences of at most ``length`` action types with the goal as label; longer trajectories give several."""
    part = F.expr(f"cast(pos div {length} as int)")
    return (
        actions.groupBy("trajectory_id", "goal", part.alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", "action_type"))).alias("_steps"))
        .select("trajectory_id", "part", F.array_join(F.col("_steps")["action_type"], " ").alias("sequence"), F.col("goal").alias("label"))
    )


def exploration_features(actions: DataFrame) -> DataFrame:
    """Per trajectory the shares of backtracks, low confidence, missing intent and unintended actions."""
    share = lambda c: F.count_if(F.coalesce(c, F.lit(False))) / F.count("*")
    return actions.groupBy("trajectory_id").agg(
        share(is_backtrack()).alias("backtrack_share"),
        share(F.col("confidence") < LOW_CONFIDENCE).alias("low_confidence_share"),
        share(F.coalesce("user_intent", F.lit("")) == "").alias("no_intent_share"),
        share(~F.col("is_intentional")).alias("unintended_share"),
    )


def hybrid_union(**sources: DataFrame) -> DataFrame:
    """Rows of several sources under one schema, with the source's name; columns a source lacks are null."""
    out = None
    for name, rows in sources.items():
        part = rows.withColumn("source", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def sequence_diversity(actions: DataFrame) -> DataFrame:
    """Per goal: trajectories, distinct sequences of action types, and the entropy of the types in bits.

    A sequence is known by the xor of its positioned types' hashes, so nothing is collected.
    """
    digest = F.sha2(F.concat_ws("|", F.col("pos"), F.col("action_type")), 256)
    words = [F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("bigint") for i in range(2)]
    each = actions.groupBy("trajectory_id", "goal").agg(F.count("*").alias("_n"), *[F.bit_xor(w).alias(f"_w{i}") for i, w in enumerate(words)])
    sequences = each.groupBy("goal", "_n", "_w0", "_w1").agg(F.count("*").alias("_copies"))
    sequences = sequences.groupBy("goal").agg(F.sum("_copies").alias("trajectories"), F.count("*").alias("sequences"))
    kinds = actions.groupBy("goal", "action_type").agg(F.count("*").alias("n"))
    n = F.col("n").cast("double")
    entropy = kinds.groupBy("goal").agg((F.log2(F.sum(n)) - F.sum(n * F.log2(n)) / F.sum(n)).alias("entropy"))
    return sequences.join(entropy, "goal").select(
        "goal", "trajectories", "sequences", (F.col("sequences") / F.col("trajectories")).alias("diversity"), "entropy"
    )
