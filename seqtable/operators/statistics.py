"""Dataset statistics and distributions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtable import constants as K
from seqtable.operators.shape import mean_interval_seconds

PROFILE_COLUMNS = ["workflow_type", "user_type", "device_type", "browser_type"]


def _ratio(part: Column, whole: Column) -> Column:
    """A quotient that is 0 when there is nothing to divide by."""
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def dataset_statistics(measures: DataFrame) -> DataFrame:
    """One row of unrounded statistics over per-trajectory measures."""
    n, actions = F.count("*"), F.coalesce(F.sum("action_count"), F.lit(0))
    gaps = F.sum(F.greatest(F.col("action_count") - 1, F.lit(0)))
    gap_us = F.sum(F.when(F.col("action_count") >= 2, F.col("last_us") - F.col("first_us")).otherwise(0))
    mean_us = F.sum(F.round(mean_interval_seconds() * 1e6, 3).cast("decimal(28,3)"))
    return measures.agg(
        n.alias("n_trajectories"),
        actions.alias("n_actions"),
        _ratio(actions, n).alias("avg_trajectory_length"),
        _ratio(F.sum(F.col("goal_achieved").cast("bigint")), n).alias("goal_achievement_rate"),
        (_ratio(F.sum("duration_us"), n) / 1e6).alias("avg_trajectory_duration_seconds"),
        (_ratio(gap_us, gaps) / 1e6).alias("avg_action_interval_seconds"),
        _ratio(F.sum("intentional_count"), actions).alias("intentional_action_ratio"),
        _ratio(F.sum("error_count"), actions).alias("error_rate"),
        _ratio(F.sum("confidence_sum"), actions).alias("avg_confidence"),
        _ratio(F.sum("backtrack_count"), n).alias("avg_backtrack_per_trajectory"),
        _ratio(actions, n).alias("avg_action_count"),
        (_ratio(mean_us, n) / 1e6).alias("avg_action_interval_across_trajectories"),
        _ratio(F.sum("error_count"), n).alias("avg_error_count_per_trajectory"),
    )


def counts_of(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Value counts of several columns in one pass, as rows (metric, key, n); nulls are left out."""
    pairs = F.array(
        *[F.struct(F.lit(name).alias("metric"), c.cast("string").alias("key")) for name, c in columns.items()]
    )
    return (
        df.select(F.inline(pairs))
        .where(F.col("key").isNotNull())
        .groupBy("metric", "key")
        .agg(F.count("*").alias("n"))
    )


def trajectory_distributions(measures: DataFrame) -> DataFrame:
    columns = {"trajectory_length": F.col("action_count")}
    columns |= {c: F.col(c) for c in PROFILE_COLUMNS}
    return counts_of(measures, columns)


def action_distributions(actions: DataFrame) -> DataFrame:
    """Counts per action type, and per element type where there is one."""
    element = F.when(F.col("element_type") != "", F.col("element_type"))
    return counts_of(actions, {"action_type": F.col("action_type"), "element_type": element})


def length_bands(measures: DataFrame) -> DataFrame:
    """Trajectories per length band next to the intended mix; other lengths under ``other``."""
    n = F.col("action_count")
    band, target = F.lit("other"), F.lit(0.0)
    for name, (low, high, share) in K.LENGTH_BANDS.items():
        band = F.when(n.between(low, high), F.lit(name)).otherwise(band)
        target = F.when(F.col("band") == name, F.lit(share)).otherwise(target)
    return (
        measures.groupBy(band.alias("band"))
        .agg(F.count("*").alias("n"))
        .withColumn("target_share", target)
    )


def render(row: dict, distributions: list[dict]) -> dict:
    """The printable report: two or three decimals, distributions as nested counts."""
    three = {"goal_achievement_rate", "intentional_action_ratio", "error_rate", "avg_confidence"}
    report = {
        k: round(v, 3 if k in three else 2) if isinstance(v, float) else v for k, v in row.items()
    }
    if not report["n_trajectories"]:
        return {"n_trajectories": 0, "n_actions": 0}
    for d in distributions:
        report.setdefault(f"{d['metric']}_distribution", {})[d["key"]] = d["n"]
    return report
