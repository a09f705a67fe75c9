"""Analysis of stored datasets: broken actions, failed goals, shortened runs.

Input is flat action rows; a trajectory without actions may come as one row with
null ``pos``, which counts as a trajectory but not as an action. Where rows carry a
``record_key`` (each stored line has its own), it tells trajectories with the same
id apart.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqtable import constants as K


def _flag(name: str):
    """Missing counts as true."""
    return F.coalesce(F.col(name), F.lit(True))


def _keys(actions: DataFrame, *names: str) -> list[str]:
    return [*(["record_key"] if "record_key" in actions.columns else []), *names]


def error_totals(actions: DataFrame) -> DataFrame:
    hidden, blocked = ~_flag("element_visible"), ~_flag("element_clickable")
    return actions.agg(
        F.count("pos").alias("total_actions"),
        F.count_if(hidden).alias("actions_with_element_visible_false"),
        F.count_if(blocked).alias("actions_with_element_clickable_false"),
        F.count_if(hidden & blocked).alias("actions_with_both_false"),
    )


def error_actions(actions: DataFrame) -> DataFrame:
    """Failing actions; one failing both tests is listed once for each."""
    tests = F.array_compact(
        F.array(
            F.when(~_flag("element_visible"), F.lit("element_visible")),
            F.when(~_flag("element_clickable"), F.lit("element_clickable")),
        )
    )
    return actions.select(
        "trajectory_id", "pos", "action_id", "action_type", "element_visible", "element_clickable",
        F.lit("").alias("context"), F.explode(tests).alias("failed_test"),
    )


def error_trajectories(actions: DataFrame) -> DataFrame:
    """Trajectories with at least one failing action."""
    hidden, blocked = ~_flag("element_visible"), ~_flag("element_clickable")
    return (
        actions.groupBy(*_keys(actions, "trajectory_id", "goal", "goal_achieved"))
        .agg(
            F.count_if(hidden | blocked).alias("error_count"),
            F.count("pos").alias("action_count"),
            (F.count_if(hidden) + F.count_if(blocked)).alias("listed_actions"),
        )
        .where("error_count > 0")
    )


def failed_goals(actions: DataFrame) -> DataFrame:
    """Trajectories that missed their goal, with the type of their last action."""
    return (
        actions.where(~_flag("goal_achieved"))
        .groupBy(*_keys(actions, "trajectory_id", "goal"))
        .agg(
            F.count("pos").alias("action_count"),
            F.max_by("action_type", "pos").alias("last_action_type"),
        )
    )


def skipped_steps(actions: DataFrame, limit: int = K.SHORTCUT_MAX_ACTIONS) -> DataFrame:
    """Trajectories that reached their goal in few actions, with the sequence of types.

    Trajectories are counted first; only the rows of short ones are collected,
    whatever their positions are.
    """
    reached = actions.where(_flag("goal_achieved"))
    key = _keys(actions, "trajectory_id")[0]
    short = reached.groupBy(*_keys(actions, "trajectory_id", "goal")).agg(F.count("pos").alias("action_count")).where(F.col("action_count") <= limit)
    steps = (
        reached.join(short.select(key), key, "left_semi")
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "action_type")))).alias("_steps"))
    )
    return short.join(steps, key).select(
        *_keys(actions, "trajectory_id", "goal"), "action_count", F.array_join(F.col("_steps")["action_type"], " -> ").alias("actions")
    )


def samples(actions: DataFrame, n: int = K.REPORT_SAMPLES) -> DataFrame:
    """The first trajectories (by id) of each list of the report.

    ``row_number() <= n`` keeps only n rows per list and task before the shuffle.
    """
    lists = {
        "errors": error_trajectories(actions),
        "failed_goals": failed_goals(actions),
        "skipped_steps": skipped_steps(actions),
    }
    rows = None
    for name, df in lists.items():
        part = df.select(F.lit(name).alias("category"), "trajectory_id", "goal", "action_count")
        rows = part if rows is None else rows.unionByName(part)
    first = Window.partitionBy("category").orderBy("trajectory_id")
    return (
        rows.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= n)
    )
