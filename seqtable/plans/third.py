"""Registered queries of streams, rule tables, near-duplicate groups, clashing ids and file places, each with its SQL."""

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtable.operators import checks, dedup, records, repair, rules, shape, similar
from seqtable.plans import views
from seqtable.plans.oracles import ACTIONS, EVENTS, GOOD, RAW, VERDICTS, _content, _WEB
from seqtable.plans.oracles import ORACLES as FIRST
from seqtable.plans.registry import Query, _valid_actions
from seqtable.plans.second import _HOST
from seqtable.session import new_folder
from seqtable.sources import jsonl, raw
from seqtable.streaming import ingest
from seqtable.streaming import sessions as streamed

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__], ORACLES[fn.__name__] = fn, sql
        return fn

    return register


# --- near duplicates ----------------------------------------------------------------

_SETS = """, tokens AS (
  SELECT trajectory_id, workflow_type, action_type || '|' || element_type || '|' || coalesce(url, '-') || '|' ||
    row_number() OVER (PARTITION BY trajectory_id, action_type, element_type, url ORDER BY pos) AS token FROM src),
sets AS (
  SELECT trajectory_id, workflow_type, count(*) AS n, string_agg(token, chr(1) ORDER BY token) AS content FROM tokens GROUP BY ALL),
classes AS (SELECT *, min(trajectory_id) OVER (PARTITION BY workflow_type, n, content) AS class_id FROM sets),
kept AS (SELECT t.*, n FROM tokens t JOIN classes USING (trajectory_id, workflow_type) WHERE trajectory_id = class_id),
links AS (
  SELECT x.trajectory_id AS a, y.trajectory_id AS b, x.n AS na, y.n AS nb, count(*) AS c
  FROM kept x JOIN kept y ON x.workflow_type = y.workflow_type AND x.token = y.token AND x.trajectory_id <> y.trajectory_id
  GROUP BY ALL HAVING 100 * count(*) >= 60 * (x.n + y.n - count(*))),
reach AS (
  SELECT trajectory_id AS class_id, trajectory_id AS other FROM classes WHERE trajectory_id = class_id
  UNION SELECT class_id, b FROM reach JOIN links ON a = other),
named AS (SELECT class_id, min(other) AS group_id FROM reach GROUP BY class_id),
grouped AS (
  SELECT trajectory_id, class_id, group_id, (SELECT count(*) FROM links WHERE a = class_id) AS links
  FROM classes JOIN named USING (class_id))"""
_RECURSIVE = ACTIONS.replace("WITH ", "WITH RECURSIVE ", 1)


@query(_RECURSIVE + ", src AS (SELECT * FROM fx)" + _SETS + " SELECT trajectory_id, class_id, group_id, links FROM grouped")
def near_duplicate_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Every trajectory with its class of equal sets and its group; at 0.6, as the derived sessions are short."""
    return similar.near_groups(views.actions(spark, folder), percent=60)


_FIRST_COPIES = f""", marked AS (
  SELECT trajectory_id, workflow_type, goal, min(ts_us) AS began, string_agg({_content(True)}, chr(2) ORDER BY pos) AS content
  FROM fx GROUP BY trajectory_id, workflow_type, goal),
firsts AS (SELECT arg_min(trajectory_id, (began, trajectory_id)) AS trajectory_id FROM marked GROUP BY workflow_type, goal, content),
src AS (SELECT * FROM fx WHERE trajectory_id IN (SELECT trajectory_id FROM firsts))"""


@query(
    _RECURSIVE
    + _FIRST_COPIES
    + _SETS
    + """ SELECT (SELECT count(*) FROM traj) AS original_count, (SELECT count(*) FROM traj) - count(*) AS exact_duplicates_count,
  count(*) FILTER (trajectory_id <> group_id) AS near_duplicates_count, count(*) FILTER (trajectory_id = group_id) AS final_count,
  (SELECT count(*) FROM src WHERE trajectory_id IN (SELECT group_id FROM grouped)) AS actions_left FROM grouped"""
)
def dedup_near(spark: SparkSession, folder: str) -> DataFrame:
    """Exact copies go first, then all but one of each group of near duplicates."""
    scratch = new_folder(spark, "first-copies")
    rows = views.actions(spark, folder)
    marked = dedup.fingerprints(rows)
    dedup.keep_first(rows, marked).select("trajectory_id", "workflow_type", "pos", "action_type", "element_type", "url").write.parquet(scratch)
    rows = spark.read.parquet(scratch)
    groups = similar.near_groups(rows, percent=60)
    left = similar.keep_one(rows, groups).agg(F.count("*").alias("actions_left"))
    counts = dedup.dedup_stats(marked, groups=groups)
    none = F.lit(0).cast("bigint")
    both = counts.withColumn("actions_left", none).unionByName(left.select(*[none.alias(c) for c in counts.columns], "actions_left"))
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])


# --- rule tables --------------------------------------------------------------------

# Bands that overlap and are open at an end, and one that is nowhere.
BANDS = [
    ("navigate", "any", None, None), ("navigate", "short", None, 3600.0), ("navigate", "day", 600.0, 86_400.0), ("click", "short", 0.1, 1800.0),
    ("click", "hours", 1800.0, 36_000.0), ("click", "long", 7200.0, None), ("type", "never", 10.0, 5.0), ("select", "exact", 0.0, 0.0), ("scroll", "quiet", 20_000.0, None),
]
_as_sql = lambda v: "NULL::DOUBLE" if v is None else f"{v!r}::DOUBLE" if isinstance(v, float) else f"'{v}'"
_values = lambda rows: ", ".join("(" + ", ".join(map(_as_sql, r)) + ")" for r in rows)


@query(
    ACTIONS
    + f""", looked AS (
  SELECT trajectory_id, pos, action_type, (ts_us - lag(ts_us) OVER (PARTITION BY trajectory_id ORDER BY pos))::DOUBLE / 1e6 AS s FROM fx)
SELECT l.action_type, band, count(*)::BIGINT AS intervals, min(s) AS shortest, max(s) AS longest
FROM looked l LEFT JOIN (VALUES {_values(BANDS)}) b(action_type, band, low, high)
  ON l.action_type = b.action_type AND (low IS NULL OR s >= low) AND (high IS NULL OR s <= high)
WHERE s IS NOT NULL GROUP BY l.action_type, band"""
)
def interval_bands(spark: SparkSession, folder: str) -> DataFrame:
    bands = spark.createDataFrame(BANDS, "action_type string, band string, low double, high double")
    return rules.interval_bands(views.actions(spark, folder), bands)


PAIRS = [("type", "input"), ("submit", "form"), ("click", "button"), ("scroll", "")]


@query(
    ACTIONS
    + f""", pairs AS (SELECT * FROM (VALUES {_values(PAIRS)}) p(action_type, element_type))
SELECT trajectory_id, pos, action_type, element_type FROM fx WHERE action_type IN (SELECT action_type FROM pairs)
  AND NOT EXISTS (SELECT 1 FROM pairs p WHERE p.action_type = fx.action_type AND p.element_type = coalesce(fx.element_type, ''))"""
)
def misplaced_actions(spark: SparkSession, folder: str) -> DataFrame:
    return rules.misplaced_actions(views.actions(spark, folder), spark.createDataFrame(PAIRS, "action_type string, element_type string"))


STEPS = [(w, x) for w, xs in rules.REQUIRED_STEPS.items() for x in xs] + [("research", "hover"), ("unknown", "click")]


@query(
    ACTIONS
    + f"""SELECT trajectory_id, workflow_type, step AS action_type FROM traj JOIN (VALUES {_values(STEPS)}) need(workflow_type, step) USING (workflow_type)
WHERE NOT EXISTS (SELECT 1 FROM fx WHERE fx.trajectory_id = traj.trajectory_id AND fx.action_type = step)"""
)
def missing_steps(spark: SparkSession, folder: str) -> DataFrame:
    return rules.missing_steps(views.actions(spark, folder), spark.createDataFrame(STEPS, "workflow_type string, action_type string"))


@query(
    ACTIONS
    + f""", hosts AS (SELECT *, nullif(CASE WHEN action_type IN ('wait', 'scroll', 'select') THEN NULL ELSE {_HOST} END, '') AS host FROM fx),
looked AS (
  SELECT *, last_value(host IGNORE NULLS) OVER (PARTITION BY trajectory_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM hosts)
SELECT DISTINCT trajectory_id FROM looked WHERE action_type <> 'navigate' AND host <> before"""
)
def host_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Where some actions between carry no URL."""
    gaps = F.when(~F.col("action_type").isin("wait", "scroll", "select"), F.col("url"))
    found = rules.semantic_rules(views.actions(spark, folder).withColumn("url", gaps), (), {})
    return found.where(F.array_contains("reasons", "HOST_CHANGE")).select("trajectory_id")


# --- ids ----------------------------------------------------------------------------


@query(
    ACTIONS
    + """, named AS (
  SELECT trajectory_id, pos, CASE k % 6 WHEN 0 THEN 'a' WHEN 1 THEN 'a_2' WHEN 2 THEN 'a_3' WHEN 3 THEN NULL WHEN 4 THEN '' ELSE 'b_01' END AS action_id FROM fx),
nth AS (SELECT *, coalesce(action_id, '') AS own, row_number() OVER (PARTITION BY trajectory_id, coalesce(action_id, '') ORDER BY pos) AS n FROM named),
numbers AS (
  SELECT trajectory_id, regexp_extract(own, '^(.*)_[1-9][0-9]*$', 1) AS own, max(regexp_extract(own, '_([1-9][0-9]*)$', 1)::BIGINT) AS most
  FROM nth WHERE regexp_matches(own, '_[1-9][0-9]*$') GROUP BY ALL)
SELECT trajectory_id, pos, CASE WHEN n > 1 THEN own || '_' || (coalesce(most, 1) + n - 1) ELSE action_id END AS action_id, n > 1 AS renamed
FROM nth LEFT JOIN numbers USING (trajectory_id, own)"""
)
def repair_clashing_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids that repeat, and others that look like a repaired one."""
    k = F.col("k") % 6
    named = F.when(k == 0, "a").when(k == 1, "a_2").when(k == 2, "a_3").when(k == 4, "").when(k == 5, "b_01")
    return repair.repair_action_ids(views.actions(spark, folder).withColumn("action_id", named))


# --- files --------------------------------------------------------------------------


@query(
    GOOD
    + """SELECT DISTINCT trajectory_id, user_id % 5 = 0 AS broken, false AS blank_before, 1::BIGINT AS lines_at_place FROM good"""
)
def quarantine_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Stored records behind blank lines, those of every fifth user cut short: each line once, under a place of its own."""
    path = new_folder(spark, "lines")
    records = shape.to_records(_valid_actions(spark, folder))
    whole = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    cut = F.regexp_extract("trajectory_id", r"^traj_([0-9]+)_", 1).cast("bigint") % 5 == 0
    line = F.when(cut, F.substring(whole, F.lit(1), F.length(whole) - 20)).otherwise(whole)
    records.select(F.concat(F.lit("\n"), line).alias("value")).write.text(path)
    rows, broken = jsonl.quarantine(jsonl.read_placed(spark, path))
    named = F.regexp_extract("broken_line", '"trajectory_id":"([^"]*)"', 1)
    both = rows.select("file", "line", "trajectory_id", F.lit(False).alias("broken")).unionByName(
        broken.select("file", "line", named.alias("trajectory_id"), F.lit(True).alias("broken"))
    )
    places = both.groupBy("file", "line").agg(F.count("*").alias("lines_at_place"))
    return both.join(places, ["file", "line"]).select("trajectory_id", "broken", (F.col("line") % 2 == 0).alias("blank_before"), "lines_at_place")


# --- streams ------------------------------------------------------------------------


@query(
    ACTIONS
    + f""", conv AS ({FIRST["convert_raw_actions"]}),
heads AS (SELECT 'record_' || trajectory_id AS record_id, workflow_type, goal FROM traj),
marked AS (
  SELECT c.trajectory_id, workflow_type, goal, string_agg(action_type, ' ' ORDER BY pos) AS steps, 
    string_agg({_content(True)}, chr(2) ORDER BY pos) AS content, count(*) BETWEEN 3 AND 10 AND count(DISTINCT action_id) = count(*)
    AND bool_and(action_type <> 'tap' AND coalesce({_WEB}, false) AND coalesce(element_selector, '') NOT ILIKE '%javascript:%'
      AND length(coalesce(element_selector, '')) <= 500 AND (action_type <> 'select' OR option_index IS NOT NULL)
      AND (action_type <> 'scroll' OR (x BETWEEN 0 AND 10000 AND y BETWEEN 0 AND 10000))) AS good
  FROM conv c JOIN heads USING (record_id) GROUP BY c.trajectory_id, workflow_type, goal),
kept AS (SELECT workflow_type, goal, any_value(steps) AS steps, any_value(good) AS good FROM marked GROUP BY workflow_type, goal, content),
sizes AS (
  SELECT record_id, (user_id + sess) % 23 = 0 AS broken, count(*) FILTER (i < 3 + (user_id + sess) % 8) AS kept FROM ({RAW} SELECT * FROM raw)
  GROUP BY record_id, user_id, sess)
SELECT CASE WHEN good THEN 'accepted' ELSE 'invalid' END AS outcome, CASE WHEN good THEN workflow_type || ': ' || steps ELSE '' END AS what,
  count(*) AS n FROM kept GROUP BY ALL
UNION ALL SELECT CASE WHEN broken THEN 'unparsable' ELSE 'too_few_actions' END, '', count(*) FROM sizes WHERE broken OR kept < 3 GROUP BY 1"""
)
def stream_valid(spark: SparkSession, folder: str) -> DataFrame:
    """Responses on a stream, each sent again an hour later: converted, copies dropped, validated; what became of them."""
    base = new_folder(spark, "stream-valid")
    with ingest.shuffles_removed(spark):
        views.raw_responses(spark, folder).write.option("compression", "gzip").json(base + "/in")
    sent = spark.read.schema(ingest.RESPONSES).json(base + "/in")
    sent.withColumn("base_ms", F.col("base_ms") + 3_600_000).write.mode("append").option("compression", "gzip").json(base + "/in")
    planned = ingest.planned_records(ingest.read_response_stream(spark, base + "/in"))
    ingest.ingest_valid(ingest.unique_records(planned, "365 days"), base, base + "/progress")
    step = F.array_sort(F.collect_list(F.struct("pos", "action_type")))["action_type"]  # ten actions at most
    accepted = spark.read.parquet(base + "/accepted").groupBy("trajectory_id", "workflow_type").agg(F.array_join(step, " ").alias("steps"))
    what = F.concat_ws(": ", "workflow_type", "steps").alias("what")
    outcomes = accepted.select(F.lit("accepted").alias("outcome"), what).unionByName(
        spark.read.parquet(base + "/rejected").select(F.col("reject_reason").alias("outcome"), F.lit("").alias("what"))
    )
    return outcomes.groupBy("outcome", "what").agg(F.count("*").alias("n"))


SESSION_GAP, DELAY = timedelta(hours=12), timedelta(days=2)


@query(
    EVENTS
    + """, held AS (SELECT max(ts_us) - 2 * 86400000000 AS passed FROM ev WHERE k <> 99),
kept AS (SELECT * FROM ev WHERE NOT (k = 99 AND ts_us < (SELECT passed FROM held))),
gaps AS (SELECT *, ts_us - lag(ts_us) OVER (PARTITION BY user_id ORDER BY ts_us, event_id) AS gap FROM kept),
numbered AS (SELECT *, sum(CASE WHEN gap <= 43200000000 THEN 0 ELSE 1 END)
  OVER (PARTITION BY user_id ORDER BY ts_us, event_id ROWS UNBOUNDED PRECEDING) AS sess FROM gaps)
SELECT 'session' AS kind, user_id, min(ts_us) AS start_us, max(ts_us) AS end_us, count(*) AS n FROM numbered GROUP BY user_id, sess
UNION ALL SELECT 'late', user_id, min(ts_us), max(ts_us), count(*) FROM ev WHERE k = 99 AND ts_us < (SELECT passed FROM held) GROUP BY user_id"""
)
def stream_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions of all events, fed in two halves by time; some events are held back to the end, where most are late."""
    base = new_folder(spark, "stream-sessions")
    rows = views.events(spark, folder).select("user_id", F.timestamp_micros("ts_us").alias("ts"), "k")
    rows.write.parquet(base + "/events")
    rows = spark.read.parquet(base + "/events")
    first, last = rows.agg(F.min("ts"), F.max("ts")).first()
    half, held = first + (last - first) / 2, F.coalesce(F.col("k") == 99, F.lit(False))
    end = spark.createDataFrame([(None, streamed.close_all(last, DELAY, SESSION_GAP), None)], rows.schema)
    for part in (rows.where(~held & (F.col("ts") < half)), rows.where(~held & (F.col("ts") >= half)), rows.where(held).unionByName(end)):
        part.write.mode("append").parquet(base + "/in")
        stream = spark.readStream.schema(rows.schema).parquet(base + "/in")
        streamed.ingest_sessions(stream, "user_id", "ts", SESSION_GAP, DELAY, base, base + "/progress")
    late = spark.read.parquet(base + "/late").groupBy("user_id").agg(F.min("ts").alias("start"), F.max("ts").alias("end"), F.count("*").alias("n"))
    both = spark.read.parquet(base + "/sessions").withColumn("kind", F.lit("session")).unionByName(late.withColumn("kind", F.lit("late")))
    return both.select("kind", "user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n")


# --- rules that the derived tables don't break ----------------------------------------

_PLANTED = ACTIONS + """, planted AS (SELECT * REPLACE (
    CASE k WHEN 11 THEN -5.0::DOUBLE WHEN 12 THEN NULL WHEN 13 THEN "timestamp" - 864000000.0::DOUBLE ELSE "timestamp" END AS "timestamp",
    CASE WHEN k = 14 THEN '' ELSE action_type END AS action_type, CASE k WHEN 15 THEN '' WHEN 16 THEN NULL ELSE url END AS url,
    CASE WHEN k IN (21, 31) THEN NULL WHEN k = 41 THEN 0 ELSE x END AS x, CASE k WHEN 21 THEN NULL WHEN 31 THEN 1 WHEN 41 THEN -1 ELSE y END AS y)
  FROM fx)"""
_LOOKED = (
    VERDICTS.removeprefix(ACTIONS)
    .replace("FROM fx)", "FROM planted)", 1)
    .replace("WHEN min(ts_us) >= max(ts_us)", "WHEN any_value(user_id) % 19 = 0")
    .replace("WHEN max(ts_us) < min(ts_us)", "WHEN any_value(user_id) % 17 = 0")
)


@query(_PLANTED + _LOOKED + "SELECT trajectory_id, action_count, reasons FROM verdicts")
def validate_planted(spark: SparkSession, folder: str) -> DataFrame:
    """Actions with faults that the derived table lacks: times, types, URLs, coordinates, stored bounds."""
    k, user = F.col("k"), F.col("user_id")
    spot = lambda x, y: F.struct(F.lit(x).cast("int").alias("x"), F.lit(y).cast("int").alias("y"))
    rows = views.actions(spark, folder).withColumns(
        {
            "timestamp": F.when(k == 11, -5.0).when(k == 12, None).when(k == 13, F.col("timestamp") - 864_000_000.0).otherwise(F.col("timestamp")),
            "action_type": F.when(k == 14, "").otherwise(F.col("action_type")),
            "url": F.when(k == 15, "").when(k == 16, None).otherwise(F.col("url")),
            "coordinates": F.when(k == 21, None).when(k == 31, spot(None, 1)).when(k == 41, spot(0, -1)).otherwise(F.col("coordinates")),
            "start_time": F.lit(1.0),
            "end_time": F.when(user % 19 == 0, 1.0).otherwise(2.0),
            "duration": F.when(user % 17 == 0, -1.0).otherwise(1.0),
        }
    )
    found = checks.validate(rows)
    return found.select("trajectory_id", "action_count", F.array_join("reasons", ",").alias("reasons"))


_ACTION = '{"action_type":"click","url":"https://a.com/","page_title":"P","element_type":"button","context":"c"}'
_SCROLL = '{"action_type":"scroll","url":"https://a.com/","coordinates":%s}'
# Text of a record, its errors, those left after the fix, outcome, and the domain that conversion sees.
STRUCTURES: list[tuple[str, str, str, str, str | None]] = [
    ("[1, 2]", "Trajectory structure must be a dictionary", "Trajectory structure must be a dictionary", "failed", None),
    ('{"goal":"x"}', "Missing required field: 'actions'", "'actions' list cannot be empty", "not_improved", None),
    ('{"domain":7,"actions":[%s]}' % _ACTION, "'domain' must be a string", "", "fixed", "7"),
    ('{"domain":"shop","actions":[%s]}' % _ACTION, "", "", "clean", "shop"),
    ('{"actions":5}', "'actions' must be a list", "'actions' list cannot be empty", "not_improved", None),
    ('{"actions":[]}', "'actions' list cannot be empty", "'actions' list cannot be empty", "not_improved", None),
    ('{"actions":[3,%s]}' % _ACTION, "Action[0]: Action must be a dictionary", "Action[0]: Action must be a dictionary", "failed", None),
    ('{"actions":[%s]}' % _ACTION.replace('"P"', "3").replace('"c"', "[4]"), "Action[0]: 'page_title' must be a string\nAction[0]: 'context' must be a string", "", "fixed", None),
    ('{"actions":[%s]}' % _ACTION.replace('"button"', "false"), "Action[0]: 'element_type' must be a string", "", "fixed", None),
    ('{"actions":[%s]}' % (_SCROLL % 5), "Action[0]: 'scroll' action 'coordinates' must be a dictionary", "Action[0]: 'scroll' action 'coordinates' must be a dictionary", "not_improved", None),
    ('{"domain":1.5,"actions":[%s]}' % (_SCROLL % '{"x":1}'), "'domain' must be a string\nAction[0]: 'scroll' action 'coordinates' must have 'x' and 'y'",
     "Action[0]: 'scroll' action 'coordinates' must have 'x' and 'y'", "improved", "1.5"),
]
_quoted = lambda v: "NULL::VARCHAR" if v is None else "'" + v.replace("'", "''") + "'"
_cases = ", ".join(f"({i}, {', '.join(_quoted(v) for v in row[1:])})" for i, row in enumerate(STRUCTURES))


@query(
    f"""SELECT event_id, errors_before, errors_after, fix_outcome, domain
FROM events JOIN (VALUES {_cases}) c(i, errors_before, errors_after, fix_outcome, domain) ON i = event_id % {len(STRUCTURES)}"""
)
def structure_planted(spark: SparkSession, folder: str) -> DataFrame:
    """A record for each event, with one of the structural faults that the derived responses lack."""
    texts = F.array(*[F.lit(row[0]) for row in STRUCTURES])
    rows = views.events(spark, folder).select("event_id", F.element_at(texts, (F.col("event_id") % len(STRUCTURES) + 1).cast("int")).alias("raw_text"))
    checked = records.check_and_fix(records.outline(raw.parse_responses(rows)))
    errors = [F.array_join(c, "\n").alias(c) for c in ("errors_before", "errors_after")]
    return checked.select("event_id", *errors, "fix_outcome", F.col("effective.domain.text").alias("domain"))
