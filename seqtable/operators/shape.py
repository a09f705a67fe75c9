"""Flat action rows, nested trajectories, and per-trajectory measures.

The working form is the flat table: one row per action with ``trajectory_id``,
``pos`` and the trajectory's own attributes repeated. Per-trajectory results come
from aggregates of constant size, which combine before the shuffle, so the
length of a trajectory never matters.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtable import constants as K
from seqtable.schema import ACTION_COLUMNS, ACTION_TYPES_BY_COLUMN, FLAT_HEADER

PART_LENGTH = 1000  # of the layout that cuts long trajectories into numbered parts


def time_us(timestamp: Column | str = "timestamp") -> Column:
    """Millisecond floats as whole microseconds, so sums do not depend on order; NaN becomes null."""
    at = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    return F.round(at * 1000).try_cast("bigint")


def is_backtrack() -> Column:
    return F.col("action_type").isin(K.BACKTRACK_TYPES)


def is_error() -> Column:
    """Target not visible or not clickable; scroll and wait are never clickable. An unknown flag is no error."""
    return ~F.coalesce("element_visible", F.lit(True)) | ~F.coalesce("element_clickable", F.lit(True))


def _count_if(condition: Column) -> Column:
    return F.sum(condition.cast("bigint"))


def measure(actions: DataFrame, header: Sequence[str] = ()) -> DataFrame:
    """One row per trajectory: counts and first/last times.

    Header columns are grouping keys: they are constant within a trajectory, and
    text in an aggregation buffer would force a sort-based aggregate. Stored start,
    end and duration are used where rows carry them; else they follow from the actions.
    """
    at = time_us()
    if "start_time" in actions.columns:
        start, end = F.max(time_us("start_time")), F.max(time_us("end_time"))
        duration = F.max(F.round(F.col("duration") * 1e6).try_cast("bigint"))
    else:
        start, end = F.min(at), F.max(at)
        duration = end - start
    targeted = is_error() & ~F.col("action_type").isin("scroll", "wait")
    return actions.groupBy("trajectory_id", *header).agg(
        F.count("*").alias("action_count"),
        F.min_by(at, "pos").alias("first_us"),
        F.max_by(at, "pos").alias("last_us"),
        start.alias("start_us"),
        end.alias("end_us"),
        duration.alias("duration_us"),
        _count_if(is_backtrack()).alias("backtrack_count"),
        _count_if(is_error()).alias("error_count"),
        _count_if(targeted).alias("error_count_targeted"),
        _count_if(F.coalesce("is_intentional", F.lit(False))).alias("intentional_count"),
        F.sum(F.col("confidence").cast("decimal(18,6)")).alias("confidence_sum"),
    )


def mean_interval_seconds() -> Column:
    """Mean gap between consecutive actions; the gaps telescope to last - first."""
    n = F.col("action_count")
    return F.when(n < 2, F.lit(0.0)).otherwise(
        (F.col("last_us") - F.col("first_us")) / F.greatest(n - 1, F.lit(1)) / F.lit(1e6)
    )


def trajectory_metrics(actions: DataFrame, header: Sequence[str] = ()) -> DataFrame:
    return measure(actions, header).select(
        "trajectory_id",
        *header,
        "action_count",
        mean_interval_seconds().alias("avg_action_interval"),
        "backtrack_count",
        "error_count",
        "error_count_targeted",
        (F.col("duration_us") / F.lit(1e6)).alias("duration"),
    )


def flatten(trajectories: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Nested trajectories to flat rows; ``pos`` keeps the list order.

    Trajectories without actions vanish unless ``keep_empty`` is set. Their own
    session becomes ``trajectory_session_id``, beside that of each action.
    """
    header = [c for c in trajectories.columns if c not in ("actions", "session_id")]
    own = [F.col("session_id").alias("trajectory_session_id")] if "session_id" in trajectories.columns else []
    explode = F.posexplode_outer if keep_empty else F.posexplode
    rows = trajectories.select(*header, *own, explode("actions").alias("pos", "_action"))
    return rows.select(*[c for c in rows.columns if c != "_action"], "_action.*")


def flat_table(actions: DataFrame) -> DataFrame:
    """The stored flat layout: trajectory attributes prefixed, then ``pos`` and the action."""
    prefixed = [F.col(c).alias(f"trajectory_{c}") for c in FLAT_HEADER]
    return actions.select("trajectory_id", *prefixed, "pos", *ACTION_COLUMNS)


def from_flat_table(rows: DataFrame) -> DataFrame:
    """Inverse of :func:`flat_table`."""
    header = [F.col(f"trajectory_{c}").alias(c) for c in FLAT_HEADER]
    return rows.select("trajectory_id", *header, "pos", *ACTION_COLUMNS)


def _action_struct() -> Column:
    return F.struct(*[F.col(n).cast(t).alias(n) for n, t in ACTION_TYPES_BY_COLUMN.items()])


def nest(
    actions: DataFrame, header: Sequence[str] = (), part_length: int | None = PART_LENGTH
) -> DataFrame:
    """Flat rows to arrays of actions in ``pos`` order.

    The key of the result is (trajectory_id, part): a row holds the actions at
    ``part_length`` positions, so a trajectory of any length stays whole without
    becoming one huge value. With None a trajectory is one row, and has no ``part``.
    """
    rows = actions if part_length is None else actions.withColumn("part", F.expr(f"cast(pos div {part_length} as int)"))
    return (
        rows.groupBy("trajectory_id", *header, *([] if part_length is None else ["part"]))
        .agg(F.array_sort(F.collect_list(F.struct("pos", _action_struct().alias("action")))).alias("_sorted"))
        .withColumn("actions", F.col("_sorted.action"))
        .drop("_sorted")
    )


def unnest(parts: DataFrame, part_length: int = PART_LENGTH) -> DataFrame:
    """Inverse of :func:`nest`."""
    header = [c for c in parts.columns if c not in ("actions", "part")]
    rows = parts.select(*header, "part", F.posexplode("actions").alias("_i", "_action"))
    pos = (F.col("part") * part_length + F.col("_i")).cast("int")
    return rows.select(*header, pos.alias("pos"), "_action.*")


def to_records(valid_actions: DataFrame) -> DataFrame:
    """Complete 18-column trajectory records, one row each.

    Meant for validated trajectories, which have at most ten actions; a longer one
    is one record as well. Stored times, session and success indicators are kept.
    """
    header = [
        "workflow_type", "domain", "user_type", "device_type", "browser_type",
        "goal", "goal_achieved",
    ]
    n = F.size("actions")
    if "start_time" in valid_actions.columns:
        header += ["start_time", "end_time"]
        start, end = F.col("start_time"), F.col("end_time")
    else:
        start, end = F.array_min("actions.timestamp"), F.array_max("actions.timestamp")
    span = time_us(end) - time_us(start)
    if "duration" in valid_actions.columns:
        header.append("duration")
        span = F.round(F.col("duration") * 1e6).try_cast("bigint")
    session, indicators = F.element_at("actions", 1)["session_id"], F.array().cast("array<string>")
    if "trajectory_session_id" in valid_actions.columns:
        header.append("trajectory_session_id")
        session = F.coalesce("trajectory_session_id", session)
    if "success_indicators" in valid_actions.columns:
        header.append("success_indicators")
        indicators = F.coalesce("success_indicators", indicators)
    last, first = (time_us(F.element_at("actions", i)["timestamp"]) for i in (-1, 1))
    mean_us = (last - first) / F.greatest(n - 1, F.lit(1))
    known = lambda flag: F.coalesce(flag, F.lit(True))
    bad = F.filter("actions", lambda a: ~known(a["element_visible"]) | ~known(a["element_clickable"]))
    back = F.filter("actions", lambda a: a["action_type"].isin(K.BACKTRACK_TYPES))
    return (
        nest(valid_actions, header, None)
        .select(
            "trajectory_id",
            session.alias("session_id"),
            "actions",
            "workflow_type",
            "domain",
            start.alias("start_time"),
            end.alias("end_time"),
            (span / F.lit(1e6)).alias("duration"),
            "user_type",
            "device_type",
            "browser_type",
            "goal",
            "goal_achieved",
            indicators.alias("success_indicators"),
            n.alias("action_count"),
            F.when(n < 2, 0.0).otherwise(mean_us / F.lit(1e6)).alias("avg_action_interval"),
            F.size(back).alias("backtrack_count"),
            F.size(bad).alias("error_count"),
        )
    )
