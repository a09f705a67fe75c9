"""Rules on what a trajectory means: order of steps, sites, timing, completeness."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtable import constants as K
from seqtable.operators.ordered import with_last_known, with_previous, with_running_total
from seqtable.operators.shape import time_us

LOOP_LENGTH = 5
#: Element types each action type may have; types not listed may have any.
ALLOWED_ELEMENTS: Mapping[str, Sequence[str]] = {
    "type": ("input", "textarea"),
    "select": ("select",),
    "submit": ("form", "button", "input"),
    "click": ("button", "a", "input", "div", "span", "img"),
}
#: (later, earlier): the first of the former must not come before the first of the latter.
INTENT_ORDER: Sequence[tuple[str, str]] = (("checkout", "add_to_cart"),)
#: Seconds since the action before, least and most, that are plausible.
INTERVAL_SECONDS: Mapping[str, tuple[float, float]] = {
    "navigate": (0.2, 3600.0),
    "click": (0.1, 1800.0),
    "type": (0.5, 3600.0),
    "scroll": (0.05, 900.0),
    "wait": (0.1, 3600.0),
    "select": (0.3, 1800.0),
    "submit": (0.3, 1800.0),
}
REQUIRED_STEPS: Mapping[str, Sequence[str]] = {
    "e_commerce": ("navigate", "click", "select"),
    "form_filling": ("type", "submit"),
    "research": ("navigate", "scroll"),
}


def navigation_loops(actions: DataFrame, longest: int = LOOP_LENGTH) -> DataFrame:
    """Runs of more than ``longest`` consecutive back and forward actions, with start and length."""
    back = F.col("action_type").isin(K.BACKTRACK_TYPES)
    rows = actions.select("trajectory_id", "pos", back.alias("_back"), (~back).cast("int").alias("_break"))
    rows = with_running_total(rows, "trajectory_id", "pos", "_break", "_run").where("_back")
    return (
        rows.groupBy("trajectory_id", "_run")
        .agg(F.min("pos").alias("start_pos"), F.count("*").alias("length"))
        .where(F.col("length") > longest)
        .drop("_run")
    )


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1))


def semantic_rules(
    actions: DataFrame,
    intent_order: Sequence[tuple[str, str]] = INTENT_ORDER,
    allowed: Mapping[str, Sequence[str]] = ALLOWED_ELEMENTS,
) -> DataFrame:
    """Trajectories that break a rule, with the codes of all broken ones.

    SUBMIT_BEFORE_TYPE (nothing typed before a submit), EARLY_<intent>, HOST_CHANGE
    (another site than the last known one, without navigating there), BAD_ELEMENT (no such action on it).
    """
    kind, intent, site = F.col("action_type"), F.col("user_intent"), F.nullif(host(F.col("url")), F.lit(""))
    rows = actions.select("trajectory_id", "pos", "action_type", "element_type", "user_intent", site.alias("_host"))
    rows = with_previous(rows, "trajectory_id", "pos", {"_host": "_last"})
    rows = with_last_known(rows, "trajectory_id", "pos", "_last", "_site")
    moved = (kind != "navigate") & (F.col("_host") != F.col("_site"))
    fits = F.lit(True)
    for name, elements in allowed.items():
        fits = F.when(kind == name, F.coalesce(F.col("element_type").isin(*elements), F.lit(False))).otherwise(fits)
    first = lambda condition: F.min(F.when(condition, F.col("pos")))
    wanted = sorted({x for pair in intent_order for x in pair})
    each = rows.groupBy("trajectory_id").agg(
        first(kind == "submit").alias("_submit"),
        first(kind == "type").alias("_type"),
        F.max(F.coalesce(moved, F.lit(False))).alias("_moved"),
        F.max(~fits).alias("_misfit"),
        *[first(intent == x).alias(f"_intent_{i}") for i, x in enumerate(wanted)],
    )
    at = lambda x: F.col(f"_intent_{wanted.index(x)}")
    codes = [F.when(F.col("_submit") < F.coalesce("_type", F.lit(2**31 - 1)), "SUBMIT_BEFORE_TYPE")]
    codes += [F.when(at(late) < F.coalesce(at(early), F.lit(2**31 - 1)), f"EARLY_{late.upper()}") for late, early in intent_order]
    codes += [F.when(F.col("_moved"), "HOST_CHANGE"), F.when(F.col("_misfit"), "BAD_ELEMENT")]
    return each.select("trajectory_id", F.array_compact(F.array(*codes)).alias("reasons")).where(F.size("reasons") > 0)


def temporal_realism(actions: DataFrame, bounds: Mapping[str, tuple[float, float]] = INTERVAL_SECONDS) -> DataFrame:
    """Per action type: intervals to the action before, and how many are implausibly short or long."""
    rows = with_previous(actions.select("trajectory_id", "pos", "action_type", time_us().alias("_at")), "trajectory_id", "pos", {"_at": "_before"})
    seconds = (F.col("_at") - F.col("_before")) / F.lit(1e6)
    low, high = F.lit(None).cast("double"), F.lit(None).cast("double")
    for name, (least, most) in bounds.items():
        low = F.when(F.col("action_type") == name, least).otherwise(low)
        high = F.when(F.col("action_type") == name, most).otherwise(high)
    return (
        rows.where(F.col("_before").isNotNull())
        .groupBy("action_type")
        .agg(F.count("*").alias("intervals"), F.count_if(seconds < low).alias("too_short"), F.count_if(seconds > high).alias("too_long"))
    )


def workflow_completeness(actions: DataFrame, required: Mapping[str, Sequence[str]] = REQUIRED_STEPS) -> DataFrame:
    """Trajectories that lack steps their workflow needs, with the missing types."""
    steps = sorted({x for xs in required.values() for x in xs})
    seen = actions.groupBy("trajectory_id", "workflow_type").agg(
        *[F.max(F.coalesce(F.col("action_type") == x, F.lit(False))).alias(f"_has_{i}") for i, x in enumerate(steps)]
    )
    needs = lambda x: F.col("workflow_type").isin([w for w, xs in required.items() if x in xs])
    missing = F.array_compact(F.array(*[F.when(needs(x) & ~F.col(f"_has_{i}"), x) for i, x in enumerate(steps)]))
    return seen.select("trajectory_id", "workflow_type", F.array_join(missing, ",").alias("missing")).where("missing <> ''")


def misplaced_actions(actions: DataFrame, allowed: DataFrame) -> DataFrame:
    """Actions on elements that a table (action_type, element_type) doesn't allow; types it doesn't name may have any.

    A left anti join on the pair, so the table may have any size.
    """
    named = allowed.select("action_type").distinct()
    pairs = allowed.select("action_type", F.coalesce("element_type", F.lit("")).alias("_element")).distinct()
    rows = actions.select("trajectory_id", "pos", "action_type", "element_type", F.coalesce("element_type", F.lit("")).alias("_element"))
    return rows.join(named, "action_type", "left_semi").join(pairs, ["action_type", "_element"], "left_anti").drop("_element")


def missing_steps(actions: DataFrame, required: DataFrame) -> DataFrame:
    """(trajectory_id, workflow_type, action_type): steps a table (workflow_type, action_type) requires and a trajectory lacks.

    What is required of each trajectory, without what it has: the plan is the same
    for three workflows and for thousands.
    """
    required = required.select("workflow_type", "action_type").distinct()
    seen = actions.select("trajectory_id", "workflow_type", "action_type").distinct()
    due = seen.select("trajectory_id", "workflow_type").distinct().join(required, "workflow_type")
    return due.join(seen.select("trajectory_id", "action_type"), ["trajectory_id", "action_type"], "left_anti").select(
        "trajectory_id", "workflow_type", "action_type"
    )


#: Interval bins: this many for each doubling of the seconds, from a millisecond to some 35 years.
BINS, LEAST_BIN, MOST_BIN = 4, -40, 120


def _bin(seconds: Column) -> Column:
    """The bin of an interval; all below a millisecond (negative ones too) are in the first, all above in the last."""
    at = F.floor(F.log2(F.greatest(seconds, F.lit(2.0 ** (LEAST_BIN / BINS)))) * BINS)
    return F.least(F.greatest(at, F.lit(LEAST_BIN)), F.lit(MOST_BIN)).cast("int")


def interval_bands(actions: DataFrame, bands: DataFrame) -> DataFrame:
    """Intervals to the action before, counted by the bands they fall into.

    ``bands`` has (action_type, band, low, high) in seconds, both ends included; null
    is an open end, and bands may overlap. An interval in no band counts once under a
    null ``band``. Bands are laid out over bins of a fixed logarithmic scale and
    joined on (action type, bin), so an interval only meets bands near it.
    """
    rows = with_previous(actions.select("trajectory_id", "pos", "action_type", time_us().alias("_at")), "trajectory_id", "pos", {"_at": "_before"})
    seconds = (F.col("_at") - F.col("_before")) / F.lit(1e6)
    # Equal intervals of a type fall into the same bands: count them first.
    rows = rows.where("_at is not null and _before is not null").groupBy("action_type", seconds.alias("seconds")).agg(F.count("*").alias("n"))
    rows = rows.withColumn("_bin", _bin(F.col("seconds")))
    low = F.when(F.col("low").isNull(), LEAST_BIN).otherwise(_bin(F.col("low")))
    high = F.when(F.col("high").isNull(), MOST_BIN).otherwise(_bin(F.col("high")))
    laid = bands.where("coalesce(low <= high, true)").select(
        F.col("action_type").alias("_type"), "band", "low", "high", F.explode(F.sequence(low, high)).alias("_place")
    )
    inside = F.coalesce(F.col("seconds") >= F.col("low"), F.lit(True)) & F.coalesce(F.col("seconds") <= F.col("high"), F.lit(True))
    joined = rows.join(laid, (F.col("action_type") == F.col("_type")) & (F.col("_bin") == F.col("_place")) & inside, "left")
    return joined.groupBy("action_type", "band").agg(
        F.sum("n").alias("intervals"), F.min("seconds").alias("shortest"), F.max("seconds").alias("longest")
    )
