"""Repairs of trajectories: clocks, selectors, action ids; text limits."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtable import constants as K
from seqtable.functions import text
from seqtable.operators.ordered import with_previous, with_running_total
from seqtable.operators.shape import time_us

MAX_INTERVAL_MS = 3_600_000
MIN_INTERVAL_MS = 1
MAX_TEXT = 10_000


def repair_timeline(actions: DataFrame) -> DataFrame:
    """Times whose intervals are at least a millisecond and at most an hour.

    Intervals that are zero, negative or unknown become one millisecond, longer
    ones an hour; later actions move along. The first time stays (null counts as 0).
    """
    rows = actions.select("trajectory_id", "pos", F.round(time_us() / 1000).cast("bigint").alias("old_ms"))
    rows = with_previous(rows, "trajectory_id", "pos", {"old_ms": "_before"})
    gap = F.col("old_ms") - F.col("_before")
    mended = F.when(F.coalesce(gap, F.lit(0)) < MIN_INTERVAL_MS, MIN_INTERVAL_MS).otherwise(F.least(gap, F.lit(MAX_INTERVAL_MS)))
    step = F.when(F.col("pos") == 0, F.coalesce("old_ms", F.lit(0))).otherwise(mended).cast("bigint")
    fault = F.when(F.col("pos") == 0, None).when(gap.isNull(), "unknown").when(gap < 0, "negative").when(gap == 0, "equal")
    rows = rows.select("trajectory_id", "pos", "old_ms", step.alias("_step"), fault.when(gap > MAX_INTERVAL_MS, "too_long").alias("repair"))
    return with_running_total(rows, "trajectory_id", "pos", "_step", "new_ms").drop("_step")


def usable_selector() -> Column:
    s = F.col("element_selector")
    return (F.coalesce(s, F.lit("")) != "") & ~text.is_unsafe_selector(s) & (F.length(s) <= K.MAX_SELECTOR_LENGTH)


def repair_selectors(actions: DataFrame) -> DataFrame:
    """Selectors that are empty, unsafe or too long, replaced from the element's id, its text, or its type.

    ``inferred_fields`` names the column where a value was put in; actions without an element stay as they are.
    """
    given = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c))
    fallback = F.coalesce(F.concat(F.lit("#"), given("element_id")), given("element_text"), given("element_type"))
    broken = ~F.coalesce(usable_selector(), F.lit(False)) & fallback.isNotNull()
    return actions.select(
        "trajectory_id",
        "pos",
        F.when(broken, fallback).otherwise(F.col("element_selector")).alias("element_selector"),
        F.when(broken, F.array(F.lit("element_selector"))).otherwise(F.array().cast("array<string>")).alias("inferred_fields"),
    )


def repair_action_ids(actions: DataFrame) -> DataFrame:
    """Later uses of an action id within a trajectory get a number behind it; ids are unique afterwards.

    Numbers go on from the largest that an id of the trajectory already has behind the
    same id (``a, a, a_2`` gives ``a, a_3, a_2``), so no new id is an old one; the part
    before the last underscore and the number tell new ones apart. A null id counts
    as an empty one. Uses are counted with a running total over chunks, so an id that
    a long trajectory repeats endlessly is spread over many tasks.
    """
    own = F.coalesce("action_id", F.lit(""))
    use = lambda name: F.to_json(F.struct("trajectory_id", name.alias("id")), {"ignoreNullFields": "false"})
    rows = actions.select("trajectory_id", "pos", "action_id", use(own).alias("_use"), F.lit(1).alias("_one"))
    rows = with_running_total(rows, "_use", "pos", "_one", "_nth")
    # Only a number without leading zeros can look like a new one.
    numbered = actions.select(
        "trajectory_id",
        F.regexp_extract(own, r"(?s)^(.*)_[1-9][0-9]{0,36}$", 1).alias("_base"),
        F.regexp_extract(own, r"_([1-9][0-9]{0,36})$", 1).try_cast("decimal(38,0)").alias("_number"),
    ).where("_number is not null")
    largest = numbered.groupBy(use(F.col("_base")).alias("_use")).agg(F.max("_number").alias("_largest"))
    rows = rows.join(largest, "_use", "left")
    again = F.col("_nth") > 1
    number = F.greatest(F.coalesce("_largest", F.lit(1)), F.lit(1)) + F.col("_nth") - 1
    return rows.select(
        "trajectory_id",
        "pos",
        F.when(again, F.concat(own, F.lit("_"), number.cast("decimal(38,0)").cast("string"))).otherwise(F.col("action_id")).alias("action_id"),
        again.alias("renamed"),
    )


def text_limits(rows: DataFrame, key: str, columns: dict[str, int]) -> DataFrame:
    """The key, and for each text longer than its limit a reason (column:length); nothing is cut."""
    broken = [F.when(F.length(c) > n, F.concat(F.lit(f"{c}:"), F.length(c))) for c, n in columns.items()]
    reasons = F.array_compact(F.array(*broken))
    return rows.select(key, reasons.alias("reasons"), (F.size(reasons) == 0).alias("accepted"))
