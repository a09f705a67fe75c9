"""Registered queries of repairs, rules, privacy, training data and near duplicates, each with its SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtable.functions import privacy
from seqtable.operators import analysis, checks, dedup, records, repair, rules, shape, similar, statistics, training
from seqtable.plans import views
from seqtable.plans.oracles import ACTIONS, GOOD, RAW, _content, _u, _WEB
from seqtable.plans.oracles import ORACLES as FIRST
from seqtable.plans.registry import Query, _planned, _valid_actions, convert, rounded
from seqtable.session import new_folder
from seqtable.sources import jsonl, raw, sinks

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The derived view's own vocabulary for the rules.
INTENTS = (("purchase", "view"),)
ELEMENTS = {"type": ("input",), "select": ("select",), "submit": ("form",), "click": ("button",)}


def query(sql: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        ORACLES[fn.__name__] = sql
        return fn

    return register


# --- repairs ------------------------------------------------------------------------


@query(
    ACTIONS
    + """, gap AS (
  SELECT trajectory_id, pos, round(ts_us / 1000.0)::BIGINT AS old_ms FROM fx),
steps AS (
  SELECT *, old_ms - lag(old_ms) OVER (PARTITION BY trajectory_id ORDER BY pos) AS d FROM gap),
fixed AS (
  SELECT *, CASE WHEN pos = 0 THEN old_ms WHEN coalesce(d, 0) < 1 THEN 1 ELSE least(d, 3600000) END AS step,
    CASE WHEN pos = 0 THEN NULL WHEN d IS NULL THEN 'unknown' WHEN d < 0 THEN 'negative' WHEN d = 0 THEN 'equal'
      WHEN d > 3600000 THEN 'too_long' END AS repair FROM steps)
SELECT trajectory_id, pos, old_ms, repair,
  (sum(step) OVER (PARTITION BY trajectory_id ORDER BY pos ROWS UNBOUNDED PRECEDING))::BIGINT AS new_ms FROM fixed"""
)
def repair_timeline(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repair_timeline(views.actions(spark, folder))


@query(
    ACTIONS
    + """, looked AS (
  SELECT *, NOT (coalesce(element_selector, '') <> '' AND lower(element_selector) NOT LIKE '%javascript:%'
    AND lower(element_selector) NOT LIKE '%data:%' AND lower(element_selector) NOT LIKE '%vbscript:%'
    AND length(element_selector) <= 500) AND element_type <> '' AS broken FROM fx)
SELECT trajectory_id, pos, CASE WHEN broken THEN element_type ELSE element_selector END AS element_selector,
  CASE WHEN broken THEN 'element_selector' ELSE '' END AS inferred_fields FROM looked"""
)
def repair_selectors(spark: SparkSession, folder: str) -> DataFrame:
    found = repair.repair_selectors(views.actions(spark, folder))
    return found.withColumn("inferred_fields", F.array_join("inferred_fields", ","))


@query(
    ACTIONS
    + """, nth AS (
  SELECT trajectory_id, pos, action_id, row_number() OVER (PARTITION BY trajectory_id, action_id ORDER BY pos) AS n FROM fx)
SELECT trajectory_id, pos, CASE WHEN n > 1 THEN action_id || '_' || n ELSE action_id END AS action_id, n > 1 AS renamed FROM nth"""
)
def repair_action_ids(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repair_action_ids(views.actions(spark, folder))


@query(
    RAW
    + """, named AS (
  SELECT record_id, i::INTEGER AS "index", concat_ws(',', CASE WHEN coalesce(raw_url, '') = '' THEN 'url' END,
    CASE WHEN coalesce(raw_title, '') = '' THEN 'page_title' END,
    CASE WHEN action_type = 'select' AND option_index IS NULL THEN 'option_index' END) AS inferred_fields
  FROM raw WHERE (user_id + sess) % 23 <> 0)
SELECT * FROM named WHERE inferred_fields <> ''"""
)
def inferred_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Fields of raw actions that conversion fills with defaults."""
    outlined = records.outline(raw.parse_responses(views.raw_responses(spark, folder)))
    rows = outlined.select("record_id", F.posexplode("outline.actions").alias("index", "a"))
    named = rows.select("record_id", "index", F.array_join(records.inferred_fields(F.col("a")), ",").alias("inferred_fields"))
    return named.where("inferred_fields <> ''")


@query(
    """SELECT doc_id, CASE WHEN length(text) > 10000 THEN 'text:' || length(text) ELSE '' END AS reasons,
  coalesce(length(text), 0) <= 10000 AS accepted FROM documents"""
)
def text_limits(spark: SparkSession, folder: str) -> DataFrame:
    found = repair.text_limits(views.table(spark, folder, "documents"), "doc_id", {"text": repair.MAX_TEXT})
    return found.withColumn("reasons", F.array_join("reasons", ","))


# --- rules --------------------------------------------------------------------------


@query(
    ACTIONS
    + """, marked AS (
  SELECT trajectory_id, pos, action_type IN ('back', 'forward') AS back,
    sum(CASE WHEN action_type IN ('back', 'forward') THEN 0 ELSE 1 END)
      OVER (PARTITION BY trajectory_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM fx)
SELECT trajectory_id, min(pos) AS start_pos, count(*) AS length FROM marked WHERE back
GROUP BY trajectory_id, run HAVING count(*) > 1"""
)
def navigation_loops(spark: SparkSession, folder: str) -> DataFrame:
    """Longer than one here: the derived sessions are short."""
    return rules.navigation_loops(views.actions(spark, folder), longest=1)


_HOST = "lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1))"


@query(
    ACTIONS
    + f""", hosts AS (SELECT *, coalesce({_HOST}, '') AS host FROM fx),
looked AS (
  SELECT *, last_value(nullif(host, '') IGNORE NULLS) OVER (PARTITION BY trajectory_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM hosts),
each AS (
  SELECT trajectory_id, min(CASE WHEN action_type = 'submit' THEN pos END) AS s, min(CASE WHEN action_type = 'type' THEN pos END) AS t,
    min(CASE WHEN user_intent = 'purchase' THEN pos END) AS late, min(CASE WHEN user_intent = 'view' THEN pos END) AS early,
    bool_or(action_type <> 'navigate' AND host <> '' AND coalesce(before, '') <> '' AND host <> before) AS moved,
    bool_or((action_type = 'type' AND element_type <> 'input') OR (action_type = 'select' AND element_type <> 'select')
      OR (action_type = 'submit' AND element_type <> 'form') OR (action_type = 'click' AND element_type <> 'button')) AS misfit
  FROM looked GROUP BY trajectory_id),
coded AS (
  SELECT trajectory_id, concat_ws(',', CASE WHEN s < coalesce(t, 2147483647) THEN 'SUBMIT_BEFORE_TYPE' END,
    CASE WHEN late < coalesce(early, 2147483647) THEN 'EARLY_PURCHASE' END, CASE WHEN moved THEN 'HOST_CHANGE' END,
    CASE WHEN misfit THEN 'BAD_ELEMENT' END) AS reasons FROM each)
SELECT * FROM coded WHERE reasons <> ''"""
)
def semantic_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = rules.semantic_rules(views.actions(spark, folder), INTENTS, ELEMENTS)
    return found.withColumn("reasons", F.array_join("reasons", ","))


_bounds = ", ".join(f"('{k}', {a!r}::DOUBLE, {b!r}::DOUBLE)" for k, (a, b) in rules.INTERVAL_SECONDS.items())


@query(
    ACTIONS
    + f""", looked AS (
  SELECT action_type, (ts_us - lag(ts_us) OVER (PARTITION BY trajectory_id ORDER BY pos))::DOUBLE / 1e6 AS s FROM fx)
SELECT action_type, count(*) AS intervals, count(*) FILTER (s < low) AS too_short, count(*) FILTER (s > high) AS too_long
FROM looked LEFT JOIN (VALUES {_bounds}) b(action_type, low, high) USING (action_type) WHERE s IS NOT NULL GROUP BY action_type"""
)
def temporal_realism(spark: SparkSession, folder: str) -> DataFrame:
    return rules.temporal_realism(views.actions(spark, folder))


_needs = ", ".join(f"('{w}', '{x}')" for w, xs in rules.REQUIRED_STEPS.items() for x in xs)


@query(
    ACTIONS
    + f"""SELECT trajectory_id, workflow_type, string_agg(step, ',' ORDER BY step) AS missing
FROM traj JOIN (VALUES {_needs}) need(workflow_type, step) USING (workflow_type)
WHERE NOT EXISTS (SELECT 1 FROM fx WHERE fx.trajectory_id = traj.trajectory_id AND fx.action_type = step)
GROUP BY trajectory_id, workflow_type"""
)
def workflow_completeness(spark: SparkSession, folder: str) -> DataFrame:
    return rules.workflow_completeness(views.actions(spark, folder))


# --- privacy ------------------------------------------------------------------------


_any = "'" + privacy.ANY_KIND.replace("'", "''") + "'"
_of_kind = " ".join("WHEN regexp_full_match(f, '{}') THEN {}".format(
    p.replace("'", "''"),
    f"CASE WHEN {_sound} THEN '{k}' END" if (_sound := {
        "card": "list_sum(list_transform(range(length(_digits)), lambda i: (CASE WHEN (length(_digits) - i) % 2 = 0 THEN 2 * _digits[i + 1]::INTEGER - "
        "CASE WHEN _digits[i + 1]::INTEGER > 4 THEN 9 ELSE 0 END ELSE _digits[i + 1]::INTEGER END))) % 10 = 0",
        "ip": "len(list_filter(string_split(f, '.'), lambda x: x::INTEGER > 255)) = 0",
    }.get(k, "").replace("_digits", "regexp_replace(f, '[^0-9]', '', 'g')")) else f"'{k}'",
) for k, p in privacy.KINDS.items())


def _redacted_sql(source: str, column: str, keep: str) -> str:
    """The finds of one scan, each looked at by itself, and the text put together again."""
    counts = ", ".join(f"(count(*) FILTER (kind = '{k}'))::BIGINT AS n_{k}" for k in privacy.KINDS)
    return f"""scanned AS (
  SELECT {keep}, regexp_extract_all({column}, {_any}) AS finds, string_split_regex({column}, {_any}) AS rest FROM {source}),
finds AS (SELECT {keep}, i, finds[i] AS f FROM (SELECT *, unnest(range(1, len(finds) + 1)) AS i FROM scanned)),
kinds AS (SELECT {keep}, i, f, CASE {_of_kind} END AS kind FROM finds),
told AS (
  SELECT {keep}, list(coalesce('[' || kind || ']', f) ORDER BY i) AS shown, {counts} FROM kinds GROUP BY {keep}),
whole AS (
  SELECT {keep}, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in privacy.KINDS)}, CASE WHEN rest IS NULL THEN NULL WHEN shown IS NULL THEN rest[1]
    ELSE rest[1] || array_to_string(list_transform(range(1, len(shown) + 1), lambda i: shown[i] || rest[i + 1]), '') END AS redacted
  FROM scanned LEFT JOIN told USING ({keep}))"""


@query(f"WITH {_redacted_sql('documents', 'text', 'doc_id')} SELECT * EXCLUDE (redacted), sha256(redacted) AS redacted_sha256 FROM whole")
def redact_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = privacy.redact(views.table(spark, folder, "documents").select("doc_id", "text"), "text", "redacted")
    return found.select("doc_id", *[f"n_{k}" for k in privacy.KINDS], F.sha2("redacted", 256).alias("redacted_sha256"))


@query(
    ACTIONS
    + f""", typed AS (SELECT * FROM fx WHERE "value" IS NOT NULL), {_redacted_sql('typed', '"value"', 'trajectory_id, pos')}
SELECT * RENAME (redacted AS "value") FROM whole"""
)
def redact_values(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.actions(spark, folder).where(F.col("value").isNotNull()).select("trajectory_id", "pos", "value")
    found = privacy.redact(rows, "value", "redacted")
    return found.select("trajectory_id", "pos", *[f"n_{k}" for k in privacy.KINDS], F.col("redacted").alias("value"))


# --- training data ------------------------------------------------------------------

_split = _u("split", "trajectory_id")


@query(
    ACTIONS
    + f"SELECT trajectory_id, CASE WHEN {_split} < 0.7::DOUBLE THEN 'train' WHEN {_split} < 0.85::DOUBLE THEN 'validation' ELSE 'test' END AS split FROM traj"
)
def split_assign(spark: SparkSession, folder: str) -> DataFrame:
    rows = shape.measure(views.actions(spark, folder))
    return rows.select("trajectory_id", training.split_of(F.col("trajectory_id")).alias("split"))


@query(
    ACTIONS
    + """, looked AS (
  SELECT trajectory_id, pos, action_type, element_type, concat_ws(' > ', lag(action_type, 3) OVER w, lag(action_type, 2) OVER w,
    lag(action_type, 1) OVER w) AS context FROM fx WINDOW w AS (PARTITION BY trajectory_id ORDER BY pos))
SELECT trajectory_id, pos, context, action_type AS next_type, element_type AS next_element FROM looked WHERE pos > 0"""
)
def next_action_examples(spark: SparkSession, folder: str) -> DataFrame:
    return training.next_action_examples(views.actions(spark, folder))


@query(
    ACTIONS
    + """, looked AS (
  SELECT trajectory_id, pos, lead(ts_us) OVER (PARTITION BY trajectory_id ORDER BY pos) - ts_us AS d FROM fx)
SELECT trajectory_id, pos, d::DOUBLE / 1e6 AS seconds FROM looked WHERE d IS NOT NULL"""
)
def time_to_next(spark: SparkSession, folder: str) -> DataFrame:
    return training.time_to_next(views.actions(spark, folder))


@query(
    ACTIONS
    + """SELECT trajectory_id, (pos // 10)::INTEGER AS part, string_agg(action_type, ' ' ORDER BY pos) AS sequence, goal AS label
FROM fx GROUP BY trajectory_id, goal, pos // 10"""
)
def intent_examples(spark: SparkSession, folder: str) -> DataFrame:
    return training.intent_examples(views.actions(spark, folder))


@query(
    ACTIONS
    + """SELECT trajectory_id, (count(*) FILTER (action_type IN ('back', 'forward')))::DOUBLE / count(*) AS backtrack_share,
  (count(*) FILTER (confidence < 0.5))::DOUBLE / count(*) AS low_confidence_share,
  (count(*) FILTER (coalesce(user_intent, '') = ''))::DOUBLE / count(*) AS no_intent_share,
  (count(*) FILTER (NOT is_intentional))::DOUBLE / count(*) AS unintended_share FROM fx GROUP BY trajectory_id"""
)
def exploration_features(spark: SparkSession, folder: str) -> DataFrame:
    return training.exploration_features(views.actions(spark, folder))


@query(
    FIRST["convert_raw_actions"].replace("SELECT record_id, 'traj_' ||", "SELECT 'synthetic' AS source, record_id, 'traj_' ||")
    .partition("FROM clocked WHERE kept >= 3")[0]
    .replace("SELECT 'synthetic' AS source", "SELECT source, trajectory_id, pos, action_type, url, confidence, has_record FROM (SELECT 'synthetic' AS source")
    + """, 1.0::DOUBLE AS confidence, true AS has_record FROM clocked WHERE kept >= 3)
UNION ALL SELECT 'real', trajectory_id, pos, action_type, url, confidence, false FROM fx"""
)
def hybrid_union(spark: SparkSession, folder: str) -> DataFrame:
    """Converted responses and observed sessions under one schema."""
    synthetic = convert.convert(_planned(spark, folder), "record_id", "base_ms")
    both = training.hybrid_union(synthetic=synthetic, real=views.actions(spark, folder))
    return both.select("source", "trajectory_id", "pos", "action_type", "url", "confidence", F.col("record_id").isNotNull().alias("has_record"))


@query(
    ACTIONS
    + """, sequences AS (
  SELECT trajectory_id, goal, string_agg(action_type, '|' ORDER BY pos) AS s FROM fx GROUP BY trajectory_id, goal),
kinds AS (SELECT goal, action_type, count(*)::DOUBLE AS n FROM fx GROUP BY goal, action_type),
entropies AS (SELECT goal, round(log2(sum(n)) - sum(n * log2(n)) / sum(n), 9) AS entropy FROM kinds GROUP BY goal)
SELECT goal, count(*) AS trajectories, count(DISTINCT s) AS sequences, count(DISTINCT s)::DOUBLE / count(*) AS diversity,
  any_value(entropy) AS entropy FROM sequences JOIN entropies USING (goal) GROUP BY goal"""
)
def sequence_diversity(spark: SparkSession, folder: str) -> DataFrame:
    return training.sequence_diversity(views.actions(spark, folder)).withColumn("entropy", F.round("entropy", 9))


# --- near duplicates ----------------------------------------------------------------


@query(
    ACTIONS
    + """, tokens AS (
  SELECT trajectory_id, workflow_type, action_type || '|' || element_type || '|' || coalesce(url, '-') || '|' ||
    row_number() OVER (PARTITION BY trajectory_id, action_type, element_type, url ORDER BY pos) AS token FROM fx),
sets AS (
  SELECT trajectory_id, workflow_type, count(*) AS n, string_agg(token, chr(1) ORDER BY token) AS content FROM tokens GROUP BY ALL),
classes AS (SELECT min(trajectory_id) AS trajectory_id, workflow_type, n, count(*) AS members FROM sets GROUP BY workflow_type, n, content),
kept AS (SELECT t.*, n, members FROM tokens t JOIN classes USING (trajectory_id, workflow_type)),
pairs AS (
  SELECT x.trajectory_id AS a, y.trajectory_id AS b, x.members AS members_a, y.members AS members_b, x.n AS na, y.n AS nb, count(*) AS c
  FROM kept x JOIN kept y ON x.workflow_type = y.workflow_type AND x.token = y.token AND x.trajectory_id < y.trajectory_id GROUP BY ALL)
SELECT a, b, members_a, members_b, c::DOUBLE / (na + nb - c) AS similarity FROM pairs WHERE 100 * c >= 60 * (na + nb - c)"""
)
def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """At 0.6 here: the derived sessions are short, so 0.9 finds few."""
    return similar.near_duplicates(views.actions(spark, folder), percent=60)


# --- the whole chain ----------------------------------------------------------------


@query(
    ACTIONS
    + f""", conv AS ({FIRST["convert_raw_actions"]}),
heads AS (SELECT 'record_' || trajectory_id AS record_id, workflow_type, goal FROM traj),
marked AS (
  SELECT c.trajectory_id, workflow_type, goal, min("timestamp") AS began, string_agg({_content(True)}, chr(2) ORDER BY pos) AS content
  FROM conv c JOIN heads USING (record_id) GROUP BY c.trajectory_id, workflow_type, goal),
kept AS (SELECT arg_min(trajectory_id, (began, trajectory_id)) AS trajectory_id FROM marked GROUP BY workflow_type, goal, content),
good AS (
  SELECT trajectory_id, count(*) AS n, max(duration) AS duration, bool_and(goal_achieved) AS reached,
    (max("timestamp") - min("timestamp")) / 1000 AS gap, count(*) FILTER (is_intentional) AS intended,
    count(*) FILTER (NOT element_visible OR NOT element_clickable) AS errors,
    count(*) FILTER (action_type IN ('back', 'forward')) AS backs
  FROM conv WHERE trajectory_id IN (SELECT trajectory_id FROM kept) GROUP BY trajectory_id
  HAVING count(*) BETWEEN 3 AND 10 AND max(start_time) < max(end_time) AND count(DISTINCT action_id) = count(*)
    AND bool_and("timestamp" > 0 AND action_type <> 'tap' AND coalesce({_WEB}, false) AND coalesce(element_selector, '') NOT ILIKE '%javascript:%'
      AND length(coalesce(element_selector, '')) <= 500 AND (action_type <> 'select' OR option_index IS NOT NULL)
      AND (action_type <> 'scroll' OR (x BETWEEN 0 AND 10000 AND y BETWEEN 0 AND 10000))))
SELECT count(*) AS n_trajectories, sum(n)::BIGINT AS n_actions, round(sum(n)::DOUBLE / count(*), 6) AS avg_trajectory_length,
  round((count(*) FILTER (reached))::DOUBLE / count(*), 6) AS goal_achievement_rate,
  round(avg(duration), 6) AS avg_trajectory_duration_seconds, round(sum(gap) / sum(n - 1), 6) AS avg_action_interval_seconds,
  round(sum(intended)::DOUBLE / sum(n), 6) AS intentional_action_ratio, round(sum(errors)::DOUBLE / sum(n), 6) AS error_rate,
  1.0::DOUBLE AS avg_confidence, round(sum(backs)::DOUBLE / count(*), 6) AS avg_backtrack_per_trajectory,
  round(sum(n)::DOUBLE / count(*), 6) AS avg_action_count, round(avg(gap / (n - 1)), 6) AS avg_action_interval_across_trajectories,
  round(sum(errors)::DOUBLE / count(*), 6) AS avg_error_count_per_trajectory FROM good"""
)
def pipeline_end_to_end(spark: SparkSession, folder: str) -> DataFrame:
    """Raw responses to statistics: parse, fix, convert, drop copies, validate, measure."""
    scratch = new_folder(spark, "converted")
    convert.convert(_planned(spark, folder), "record_id", "base_ms").write.parquet(scratch)  # evaluated once
    rows = spark.read.parquet(scratch)
    rows = dedup.keep_first(rows, dedup.fingerprints(rows))
    rows = checks.keep_valid(rows, checks.validate(rows))
    stats = statistics.dataset_statistics(shape.measure(rows, [*statistics.PROFILE_COLUMNS, "goal_achieved"]))
    return rounded(stats, *[c for c in stats.columns if c not in ("n_trajectories", "n_actions")])


@query(
    RAW
    + """, sizes AS (
  SELECT record_id, (user_id + sess) % 23 = 0 AS broken, count(*) FILTER (i < 3 + (user_id + sess) % 8) AS kept
  FROM raw GROUP BY record_id, user_id, sess)
SELECT record_id, CASE WHEN broken THEN 'unparsable' ELSE 'too_few_actions' END AS reject_reason, NOT broken AS looked_into
FROM sizes WHERE broken OR kept < 3"""
)
def pipeline_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """What the chain leaves out at conversion, as its side table has it."""
    found = convert.rejects(_planned(spark, folder), "record_id")
    return found.select("record_id", "reject_reason", (F.col("reject_reason") != "unparsable").alias("looked_into"))


@query(
    GOOD
    + """, lines AS (
  SELECT 'traj_' || user_id AS trajectory_id, trajectory_id AS line, goal, goal_achieved, count(*) AS action_count,
    count(*) FILTER (NOT element_visible OR NOT element_clickable) AS errors, arg_max(action_type, pos) AS last_type,
    string_agg(action_type, ' -> ' ORDER BY pos) AS steps FROM good GROUP BY user_id, trajectory_id, goal, goal_achieved)
SELECT 'failed_goals' AS list, trajectory_id, goal, action_count, last_type AS detail FROM lines WHERE NOT goal_achieved
UNION ALL SELECT 'skipped_steps', trajectory_id, goal, action_count, steps FROM lines WHERE goal_achieved AND action_count <= 5
UNION ALL SELECT 'errors', trajectory_id, goal, action_count, errors::VARCHAR FROM lines WHERE errors > 0"""
)
def analyze_stored_lists(spark: SparkSession, folder: str) -> DataFrame:
    """The lists of the analysis, from stored lines whose ids collide (one id per user)."""
    path = new_folder(spark, "colliding")
    records = shape.to_records(_valid_actions(spark, folder))
    user = F.regexp_extract("trajectory_id", r"^(traj_[0-9]+)_", 1)
    sinks.write_jsonl(records.withColumn("trajectory_id", user), path)
    rows = jsonl.read_for_analysis(spark, path)
    parts = {
        "failed_goals": analysis.failed_goals(rows).withColumn("detail", F.col("last_action_type")),
        "skipped_steps": analysis.skipped_steps(rows).withColumn("detail", F.col("actions")),
        "errors": analysis.error_trajectories(rows).withColumn("detail", F.col("error_count").cast("string")),
    }
    out = None
    for name, part in parts.items():
        part = part.select(F.lit(name).alias("list"), "trajectory_id", "goal", "action_count", "detail")
        out = part if out is None else out.unionByName(part)
    return out
