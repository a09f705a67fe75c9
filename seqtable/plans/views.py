"""Interaction sequences derived from the event table.

Every event becomes one action; a user's events form sessions that end after
twelve quiet hours. The mapping plants rule violations (bad URLs, repeated ids,
values out of range, ...) at known places so each rule has something to find.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtable import constants as K
from seqtable.operators.ordered import with_sessions

SESSION_GAP_US = 720 * 60 * 1_000_000
EVENT_TYPES = ["view", "click", "signup", "purchase", "error"]
SITE_GROUPS = 3
HEADER = ["workflow_type", "domain", "user_type", "device_type", "browser_type", "goal", "goal_achieved"]


# Stated here so that opening a table reads no file footers.
TABLES = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def _nth(values: list[str], i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (i + 1).cast("int"))


def _nth_of(key: Column, i: Column, choices: dict[str, list[str]]) -> Column:
    found = F.lit(None).cast("string")
    for name, values in choices.items():
        found = F.when(key == name, _nth(values, i)).otherwise(found)
    return found


def _utc_micros(spark: SparkSession, name: str) -> Column:
    """Microseconds of a zoneless time read as UTC, whatever the session's zone.

    Shifting the zone costs far more than the cast, so it is left out where the
    session runs in UTC anyway.
    """
    zone = spark.conf.get("spark.sql.session.timeZone")
    local = F.col(name)
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z"):
        local = F.convert_timezone(F.lit("UTC"), F.lit(zone), local)
    return F.unix_micros(local.cast("timestamp"))


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with time in microseconds, the number in ``props`` and the type's index."""
    kind = F.col("event_type")
    tix = F.array_position(F.array(*[F.lit(t) for t in EVENT_TYPES]), kind) - 1
    return table(spark, folder, "events").select(
        "event_id",
        "user_id",
        "event_type",
        _utc_micros(spark, "ts").alias("ts_us"),
        F.regexp_extract("props", r"[0-9]+", 0).cast("int").alias("k"),
        tix.cast("int").alias("tix"),
    )


def action_type() -> Column:
    k, kind = F.col("k"), F.col("event_type")
    view = (
        F.when(k % 10 == 0, "back").when(k % 10 == 1, "scroll").when(k % 10 == 2, "wait").otherwise("navigate")
    )
    return (
        F.when(k == 99, "tap")
        .when(k == 89, "forward")
        .when(k == 79, "hover")
        .when(k == 69, "refresh")
        .when(k == 59, "drag_drop")
        .when(kind == "view", view)
        .when(kind == "signup", F.when(k % 2 == 0, "type").otherwise("submit"))
        .when(kind == "purchase", "select")
        .otherwise("click")
    )


def _target_columns() -> dict[str, Column]:
    k, kind, act = F.col("k"), F.col("event_type"), F.col("action_type")
    element = (
        F.when(act == "scroll", "body")
        .when(act == "select", "select")
        .when(act == "submit", "form")
        .when(act == "type", "input")
        .when(act == "click", F.when(kind == "error", "link").otherwise("button"))
        .when(act == "tap", "button")
        .otherwise("")
    )
    selector = (
        F.when(k == 96, 'a[href="javascript:void(0)"]')
        .when(k == 88, F.repeat(F.lit("x"), F.lit(501)))
        .when(act.isin("navigate", "back", "wait"), "")
        .when(act == "scroll", "body")
        .when(act == "submit", "form")
        .otherwise(F.concat(F.lit("#el-"), F.col("tix")))
    )
    return {"element_type": element, "element_selector": selector}


def event_actions(spark: SparkSession, folder: str) -> DataFrame:
    """Action columns that depend on the event alone (no session, no page lookup)."""
    return (
        events(spark, folder).withColumn("action_type", action_type()).withColumns(_target_columns())
    )


def _site_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The URL per (site group, event type), from all pages: 15 rows, whatever the size of ``pages``."""
    n = len(EVENT_TYPES) * SITE_GROUPS
    return (
        table(spark, folder, "pages")
        .groupBy(F.pmod("page_id", F.lit(n)).alias("page_id"))
        .agg(F.min("url").alias("page_url"))
    )


def profile_columns() -> dict[str, Column]:
    """Trajectory attributes as functions of the user and the session number."""
    user, sess = F.col("user_id"), F.col("sess")
    workflow = _nth(K.WORKFLOW_TYPES, user % 3)
    return {
        "workflow_type": workflow,
        "domain": _nth_of(workflow, user % 3, K.WORKFLOW_DOMAINS),
        "user_type": _nth(K.USER_TYPES, F.floor(user / 3) % 3),
        "device_type": _nth(K.DEVICE_TYPES, F.floor(user / 9) % 3),
        "browser_type": _nth(K.BROWSER_TYPES, F.floor(user / 27) % 3),
        "goal": _nth_of(workflow, user % 4, K.WORKFLOW_GOALS),
        "goal_achieved": (user + sess) % 3 != 0,
    }


def actions(spark: SparkSession, folder: str) -> DataFrame:
    """The flat action table: trajectory attributes, ``pos`` and the 22 action columns.

    The unprefixed helper columns user_id, sess, k, tix and event_type stay
    available to queries; unused ones are pruned from the plan.
    """
    # Derived columns come after the shuffle, which then carries six narrow columns.
    rows = with_sessions(events(spark, folder), "user_id", "ts_us", "event_id", SESSION_GAP_US)
    rows = rows.withColumn("action_type", action_type()).withColumns(_target_columns())
    rows = rows.withColumn("page_id", F.col("tix") + len(EVENT_TYPES) * (F.col("user_id") % SITE_GROUPS))
    rows = rows.join(F.broadcast(_site_pages(spark, folder)), "page_id", "left")
    k, kind, act = F.col("k"), F.col("event_type"), F.col("action_type")
    failed = kind == "error"
    who = F.concat_ws("_", "user_id", "sess")
    numbered = F.concat(F.lit("action_"), F.lpad((F.col("pos") + 1).cast("string"), 3, "0"))
    long_numbered = F.concat(F.lit("action_"), F.col("pos") + 1)
    return rows.select(
        "user_id", "sess", "k", "tix", "event_type", "ts_us",
        F.concat(F.lit("traj_"), who).alias("trajectory_id"),
        *[c.alias(n) for n, c in profile_columns().items()],
        "pos",
        (F.col("ts_us") / 1000.0).alias("timestamp"),
        "action_type",
        F.when(k == 97, "action_001")
        .when(k == 98, "")
        .when(F.col("pos") < 999, numbered)
        .otherwise(long_numbered)
        .alias("action_id"),
        "element_type",
        "element_selector",
        F.when(k == 95, "ftp://bad").otherwise(F.col("page_url")).alias("url"),
        F.concat(F.lit("Page "), F.col("tix")).alias("page_title"),
        F.lit(None).cast("string").alias("element_text"),
        F.lit(None).cast("string").alias("element_id"),
        F.array(F.lit("btn"), kind).alias("element_classes"),
        F.when(act == "type", F.concat(F.lit(" User"), F.col("user_id") % 7, F.lit("@Example.com "))).alias("value"),
        F.when((act == "select") & (k != 94), k % 5).alias("option_index"),
        F.when(
            act == "scroll",
            F.struct(F.lit(0).alias("x"), F.when(k == 91, 20000).otherwise(100 + 4 * k).alias("y")),
        ).alias("coordinates"),
        (k % 4 != 0).alias("is_intentional"),
        F.when(k == 93, 1.5).otherwise(k / 100.0).alias("confidence"),
        kind.alias("user_intent"),
        F.lit(None).cast("string").alias("dom_snapshot"),
        (~(failed & (k % 2 == 0))).alias("element_visible"),
        (~(act.isin("scroll", "wait") | (failed & (k % 3 == 0)))).alias("element_clickable"),
        F.concat(F.lit("session_"), who).alias("session_id"),
        F.concat(F.lit("tab_"), F.col("user_id")).alias("tab_id"),
        F.lit(None).cast("string").alias("frame_id"),
    )


def raw_action_fields() -> list[Column]:
    """The loosely typed fields of one raw action; null means the key is missing.

    Fields whose JSON type varies from row to row are variants.
    """
    k, act, kind = F.col("k"), F.col("action_type"), F.col("event_type")
    clicked, failed = act == "click", kind == "error"
    loose = lambda c: c.cast("variant")
    fields = {
        "action_type": F.when(k % 6 == 0, F.upper(act)).otherwise(act),
        "url": F.when(k % 11 != 0, F.col("url")),
        "page_title": F.when(k % 13 != 0, F.col("page_title")),
        "element_type": F.when(F.col("element_type") != "", F.col("element_type")),
        "context": F.concat(F.when(k % 4 == 0, "Add to Cart ").otherwise("step "), F.col("tix")),
        "user_intent": kind,
        "is_intentional": F.when(k % 19 == 0, loose(F.lit("false"))).otherwise(loose(k % 4 != 0)),
        "element_selector": F.when(
            (k % 3 != 0) & (F.col("element_selector") != ""), F.col("element_selector")
        ),
        "element_id": F.when(clicked & (k % 2 == 0), F.concat(F.lit("el-"), F.col("tix"))),
        "element_classes": F.when(
            clicked, F.when(k % 2 == 1, loose(F.lit("btn"))).otherwise(loose(F.array(F.lit("btn"), kind)))
        ),
        "value": F.when((act == "type") & (k % 4 == 0), F.col("value")),
        "field_type": F.when((act == "type") & (k % 8 == 0), "email"),
        "option_index": F.when(k % 7 == 0, loose(F.col("option_index").cast("string"))).otherwise(
            loose(F.col("option_index"))
        ),
        "coordinates": F.col("coordinates"),
        "duration": F.when((act == "wait") & (k % 4 == 0), k),
        "element_visible": F.when(failed, F.col("element_visible")),
        "element_clickable": F.when(failed, F.col("element_clickable")),
    }
    return [c.alias(n) for n, c in fields.items()]


def raw_responses(spark: SparkSession, folder: str) -> DataFrame:
    """Stored model responses: one text per session.

    Some are fenced, some cut short, and the actions carry the usual defects:
    wrong case, missing or malformed URLs, numbers as text, flags as text.
    """
    rows = actions(spark, folder)
    text = F.to_json(F.struct(*raw_action_fields()))
    user, sess = F.col("user_id"), F.col("sess")
    broken = (user + sess) % 23 == 0
    keys = ["trajectory_id", "user_id", "sess", "workflow_type", "goal", "user_type", "device_type", "browser_type"]
    grouped = (
        rows.select(*keys, "domain", "pos", "ts_us", text.alias("text"))
        .groupBy(*keys, "domain")
        .agg(
            F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("_items"),
            F.min("ts_us").alias("base_us"),
        )
    )
    reached = (user + sess) % 3 != 0
    head = F.to_json(
        F.struct(
            F.when(user % 7 != 0, F.col("domain")).alias("domain"),
            F.col("goal"),
            F.when(user % 11 == 0, F.lit("false").cast("variant"))
            .otherwise(reached.cast("variant"))
            .alias("goal_achieved"),
        )
    )
    body = F.concat(
        F.substring(head, F.lit(1), F.length(head) - 1),
        F.lit(',"actions":['),
        F.array_join(F.col("_items.text"), ","),
        F.lit("]}"),
    )
    whole = F.col("body")
    raw = (
        F.when(broken, F.substring(whole, F.lit(1), F.length(whole) - 3))
        .when(user % 5 == 0, F.concat(F.lit("```json\n"), whole, F.lit("\n```")))
        .otherwise(whole)
    )
    return grouped.withColumn("body", body).select(
        F.concat(F.lit("record_"), F.col("trajectory_id")).alias("record_id"),
        "workflow_type", "goal", "user_type", "device_type", "browser_type",
        (F.lit(K.MIN_ACTIONS) + (user + sess) % 8).cast("int").alias("num_actions"),
        F.floor(F.col("base_us") / 1000).cast("bigint").alias("base_ms"),
        raw.alias("raw_text"),
    )
