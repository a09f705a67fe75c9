"""Validation of trajectories with reason codes.

Every rule on a single action is a boolean column. The failing rules of a row
are folded into one integer (one bit per rule), and ``bit_or`` merges rows, so
a trajectory's verdict travels as a few numbers however long it is.
"""

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtable import constants as K
from seqtable.functions import text
from seqtable.operators.ordered import with_last_known, with_previous
from seqtable.operators.shape import time_us

ActionRules = Mapping[str, Callable[[], Column]]


def _empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) == ""


def _axis(name: str) -> Column:
    return F.col("coordinates")[name]


def _has_coordinates() -> Column:
    """An empty object counts as absent."""
    return _axis("x").isNotNull() | _axis("y").isNotNull()


def _axis_any(test: Callable[[Column], Column]) -> Column:
    return F.coalesce(test(_axis("x")), F.lit(False)) | F.coalesce(test(_axis("y")), F.lit(False))


# Rules on one action, true when broken. Extend by passing a larger mapping.
ACTION_RULES: ActionRules = {
    "BAD_TIMESTAMP": lambda: F.col("timestamp").isNull()
    | F.isnan("timestamp")
    | (F.col("timestamp") <= 0),
    "NO_ACTION_TYPE": lambda: _empty("action_type"),
    "NO_URL": lambda: _empty("url"),
    "NO_ACTION_ID": lambda: _empty("action_id"),
    "UNKNOWN_ACTION_TYPE": lambda: ~_empty("action_type")
    & ~F.col("action_type").isin(K.ACTION_TYPES),
    "SELECT_WITHOUT_OPTION": lambda: (F.col("action_type") == "select")
    & F.col("option_index").isNull(),
    "SCROLL_WITHOUT_COORDINATES": lambda: (F.col("action_type") == "scroll") & ~_has_coordinates(),
    "COORDINATES_INCOMPLETE": lambda: _has_coordinates()
    & (_axis("x").isNull() | _axis("y").isNull()),
    "COORDINATES_NEGATIVE": lambda: _axis_any(lambda v: v < 0),
    "COORDINATES_TOO_LARGE": lambda: _axis_any(lambda v: v > K.MAX_COORDINATE),
    "BAD_CONFIDENCE": lambda: F.col("confidence").isNull()
    | F.isnan("confidence")
    | ~F.col("confidence").between(0, 1),
    "BAD_URL": lambda: ~_empty("url") & ~text.is_web_url(F.col("url")),
    "UNSAFE_SELECTOR": lambda: text.is_unsafe_selector(F.col("element_selector")),
    "LONG_SELECTOR": lambda: F.coalesce(
        F.length("element_selector") > K.MAX_SELECTOR_LENGTH, F.lit(False)
    ),
}

# Rules on a whole trajectory, in report order before the action rules.
TRAJECTORY_RULES = [
    "ACTION_COUNT", "START_NOT_BEFORE_END", "NEGATIVE_DURATION",
    "TIMESTAMP_DECREASES", "DUPLICATE_ACTION_ID",
]


def _as_bits(rules: ActionRules) -> Column:
    bits = F.lit(0).cast("bigint")
    for i, rule in enumerate(rules.values()):
        broken = F.coalesce(rule(), F.lit(False))
        bits = bits.bitwiseOR(F.when(broken, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return bits


def validate(actions: DataFrame, rules: ActionRules = ACTION_RULES) -> DataFrame:
    """One row per trajectory: ``reasons`` (codes of all broken rules) and ``valid``.

    Columns start_time, end_time and duration are used when the rows carry them,
    and derived from the action times otherwise.
    """
    narrow = {
        "at": F.col("timestamp"),
        "at_us": time_us(),
        "broken": _as_bits(rules),
    }
    stored = "start_time" in actions.columns
    bounds = ["start_time", "end_time", "duration"] if stored else []
    rows = actions.select(
        "trajectory_id", "pos", "action_id", *bounds, *[c.alias(n) for n, c in narrow.items()]
    )
    rows = with_previous(rows, "trajectory_id", "pos", {"at": "before"})
    # Grouping by action id first spreads one long trajectory over many tasks
    # and leaves nothing but counts for the group by trajectory.
    per_id = rows.groupBy("trajectory_id", "action_id").agg(
        F.count("*").alias("n"),
        F.bit_or("broken").alias("broken"),
        F.max(F.coalesce(F.col("at") < F.col("before"), F.lit(False))).alias("decreases"),
        F.min("at_us").alias("first"),
        F.max("at_us").alias("last"),
        *[F.max(b).alias(b) for b in bounds],
    )
    whole = per_id.groupBy("trajectory_id").agg(
        F.sum("n").alias("action_count"),
        F.bit_or("broken").alias("broken"),
        F.max("decreases").alias("decreases"),
        (F.max("n") > 1).alias("repeats"),
        F.min("first").alias("start_us"),
        F.max("last").alias("end_us"),
        *[F.max(b).alias(b) for b in bounds],
    )
    start, end = (F.col(c) for c in (("start_time", "end_time") if stored else ("start_us", "end_us")))
    negative = (F.col("duration") < 0) if stored else (end < start)
    conditions = [
        ~F.col("action_count").between(K.MIN_ACTIONS, K.MAX_ACTIONS),
        F.coalesce(start >= end, F.lit(True)),
        F.coalesce(negative, F.lit(False)),
        F.col("decreases"),
        F.col("repeats"),
    ]
    codes = [F.when(c, F.lit(code)) for code, c in zip(TRAJECTORY_RULES, conditions)]
    codes += [
        F.when(F.col("broken").bitwiseAND(F.lit(1 << i)) != 0, F.lit(code))
        for i, code in enumerate(rules)
    ]
    return whole.select(
        "trajectory_id",
        "action_count",
        "start_us",
        F.array_compact(F.array(*codes)).alias("reasons"),
    ).withColumn("valid", F.size("reasons") == 0)


def keep_valid(actions: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Action rows of the valid trajectories, at whatever positions.

    Adaptive execution splits the partitions of a long (hence invalid) trajectory
    in this join; what comes out has ten rows per trajectory at most.
    """
    valid = verdicts.where("valid").select("trajectory_id")
    return actions.join(valid, "trajectory_id", "left_semi")


def rejected(verdicts: DataFrame) -> DataFrame:
    return verdicts.where("not valid")


def report(verdicts: DataFrame) -> DataFrame:
    """Totals and pass rate (0 for an empty dataset)."""
    n, ok = F.count("*"), F.count_if("valid")
    return verdicts.agg(
        n.alias("total_trajectories"),
        ok.alias("valid"),
        (n - ok).alias("invalid"),
        F.when(n > 0, ok / n).otherwise(0.0).alias("validation_pass_rate"),
    )


def reason_counts(verdicts: DataFrame) -> DataFrame:
    """Number of trajectories per broken rule."""
    return (
        verdicts.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))
    )


def first_errors(verdicts: DataFrame, n: int = K.REPORT_ERRORS) -> DataFrame:
    """The first failing trajectories with their position in the dataset, unknown times first.

    Only the n chosen rows are placed (they pass the driver): each by counting the
    rows before it, in one aggregate over all verdicts that numbers nothing.
    """
    spark = verdicts.sparkSession
    at = F.coalesce("start_us", F.lit(-(2**63)))
    first = verdicts.where("not valid").select(at.alias("at"), "trajectory_id", F.array_join("reasons", ",").alias("reasons"))
    rows = first.orderBy("at", "trajectory_id").limit(n).collect()
    before = [F.count_if((at < r["at"]) | ((at == r["at"]) & (F.col("trajectory_id") < r.trajectory_id))) for r in rows]
    index = verdicts.agg(*[c.alias(f"n{i}") for i, c in enumerate(before)]).first() if rows else []
    found = [(i, r.trajectory_id, r.reasons) for i, r in zip(index, rows)]
    return spark.createDataFrame(found, "index bigint, trajectory_id string, reasons string")


def warnings(actions: DataFrame) -> DataFrame:
    """Rows that look odd but stay valid: typing nothing, or a page change without navigation."""
    kind, url = F.col("action_type"), F.col("url")
    rows = actions.select(
        "trajectory_id", "pos", "action_type", "url", "value",
        F.when(kind == "navigate", url).alias("opened"),
    )
    rows = with_last_known(rows, "trajectory_id", "pos", "opened", "page")
    empty_type = (kind == "type") & _empty("value")
    moved = (kind != "navigate") & (F.coalesce("page", F.lit("")) != "") & ~url.eqNullSafe(F.col("page"))
    flags = F.array_compact(
        F.array(F.when(empty_type, F.lit("W_EMPTY_TYPE")), F.when(moved, F.lit("W_URL_CHANGE")))
    )
    return rows.select("trajectory_id", "pos", F.explode(flags).alias("warning"))
