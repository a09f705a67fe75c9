"""The registered queries as plain SQL over the same tables, for checking results."""

from seqtable import constants as K
from seqtable.functions.text import WHITESPACE_CLASS

ORACLES: dict[str, str] = {}


def _list(values) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


# --- scalar helpers ----------------------------------------------------------


def _strip(x: str) -> str:
    return f"trim({x}, '{K.WHITESPACE}')"


def _norm_text(x: str) -> str:
    return f"coalesce({_strip(f'lower({x})')}, '')"


def _bare_url(x: str) -> str:
    return f"coalesce(replace(replace({_strip(f'lower({x})')}, 'https://', ''), 'http://', ''), '')"


def _norm_url(x: str) -> str:
    return f"rtrim({_bare_url(x)}, '/')"


def _norm_selector(x: str) -> str:
    return f"coalesce(regexp_replace({_strip(f'lower({x})')}, '{WHITESPACE_CLASS}+', ' ', 'g'), '')"


def _words(x: str) -> str:
    return (
        f"len(list_filter(regexp_split_to_array({_strip(x)}, '{WHITESPACE_CLASS}+'), lambda w: w <> ''))"
    )


def _u(purpose: str, *key: str) -> str:
    text = " || '|' || ".join(f"({k})::VARCHAR" for k in key)
    return f"(('0x' || substr(md5('42|{purpose}|' || {text}), 1, 8))::UBIGINT / 4294967296.0::DOUBLE)"


def _d(x: float) -> str:
    return f"{float(x)!r}::DOUBLE"


def _between(u: str, low: str, high: str) -> str:
    return f"({low} + {u} * ({high} - {low}))"


def _by(user: str, table: dict, side: int | None = None) -> str:
    arms = " ".join(
        f"WHEN '{k}' THEN {_d(v if side is None else v[side])}" for k, v in table.items()
    )
    return f"(CASE {user} {arms} END)"


def _decision(user: str, u: str, important: str) -> str:
    low, high = _by(user, K.DECISION_SECONDS, 0), _by(user, K.DECISION_SECONDS, 1)
    a, b = K.IMPORTANT_FACTORS
    low = f"(CASE WHEN {important} THEN {low} * {_d(a)} ELSE {low} END)"
    high = f"(CASE WHEN {important} THEN {high} * {_d(b)} ELSE {high} END)"
    return _between(u, low, high)


def _seconds(kind: str, user: str, text: str, important: str, waited: str, step: str, wpm: str) -> str:
    nav, scr = K.NAVIGATE_SECONDS, K.SCROLL_SECONDS
    speed = _between(wpm, _by(user, K.TYPING_WPM, 0), _by(user, K.TYPING_WPM, 1))
    reading = _between(step, _by(user, K.READING_SECONDS, 0), _by(user, K.READING_SECONDS, 1))
    return f"""CASE {kind}
      WHEN 'navigate' THEN {_between(step, _d(nav[0]), _d(nav[1]))}
      WHEN 'type' THEN {_words(text)} / {speed} * 60 + {_decision(user, step, 'false')}
      WHEN 'scroll' THEN {_between(step, _d(scr[0]), _d(scr[1]))}
      WHEN 'wait' THEN coalesce({waited}, {reading})
      ELSE {_decision(user, step, important)} END"""


# --- the derived tables --------------------------------------------------------

_GOALS = "CASE user_id % 3 " + " ".join(
    f"WHEN {i} THEN {_list(K.WORKFLOW_GOALS[w])}[(user_id % 4 + 1)::INT]" for i, w in enumerate(K.WORKFLOW_TYPES)
) + " END"
_DOMAINS = "CASE user_id % 3 " + " ".join(
    f"WHEN {i} THEN {_list(K.WORKFLOW_DOMAINS[w])}[(user_id % 3 + 1)::INT]" for i, w in enumerate(K.WORKFLOW_TYPES)
) + " END"

EVENTS = """WITH ev AS (
  SELECT event_id, user_id, event_type, epoch_us(ts) AS ts_us,
    regexp_extract(props, '[0-9]+')::INTEGER AS k,
    (list_position(['view', 'click', 'signup', 'purchase', 'error'], event_type) - 1)::INTEGER AS tix
  FROM events),
act AS (
  SELECT *, CASE
    WHEN k = 99 THEN 'tap' WHEN k = 89 THEN 'forward' WHEN k = 79 THEN 'hover' WHEN k = 69 THEN 'refresh' WHEN k = 59 THEN 'drag_drop'
    WHEN event_type = 'view' THEN CASE k % 10 WHEN 0 THEN 'back' WHEN 1 THEN 'scroll' WHEN 2 THEN 'wait' ELSE 'navigate' END
    WHEN event_type = 'signup' THEN CASE k % 2 WHEN 0 THEN 'type' ELSE 'submit' END
    WHEN event_type = 'purchase' THEN 'select'
    ELSE 'click' END AS action_type
  FROM ev),
elements AS (
  SELECT *, CASE
    WHEN action_type = 'scroll' THEN 'body' WHEN action_type = 'select' THEN 'select'
    WHEN action_type = 'submit' THEN 'form' WHEN action_type = 'type' THEN 'input'
    WHEN action_type = 'click' THEN CASE WHEN event_type = 'error' THEN 'link' ELSE 'button' END
    WHEN action_type = 'tap' THEN 'button' ELSE '' END AS element_type
  FROM act)
"""

ACTIONS = EVENTS + f""", gaps AS (
  SELECT *, ts_us - lag(ts_us) OVER (PARTITION BY user_id ORDER BY ts_us, event_id) AS gap FROM elements),
sessions AS (
  SELECT *, (sum(CASE WHEN gap <= 43200000000 THEN 0 ELSE 1 END)
    OVER (PARTITION BY user_id ORDER BY ts_us, event_id ROWS UNBOUNDED PRECEDING))::BIGINT AS sess FROM gaps),
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY user_id, sess ORDER BY ts_us, event_id) - 1)::INTEGER AS pos FROM sessions),
fx AS (
  SELECT user_id, sess, k, tix, event_type, ts_us, pos, action_type, element_type,
    'traj_' || user_id || '_' || sess AS trajectory_id,
    {_list(K.WORKFLOW_TYPES)}[(user_id % 3 + 1)::INT] AS workflow_type,
    {_DOMAINS} AS domain,
    {_list(K.USER_TYPES)}[(user_id // 3 % 3 + 1)::INT] AS user_type,
    {_list(K.DEVICE_TYPES)}[(user_id // 9 % 3 + 1)::INT] AS device_type,
    {_list(K.BROWSER_TYPES)}[(user_id // 27 % 3 + 1)::INT] AS browser_type,
    {_GOALS} AS goal,
    (user_id + sess) % 3 <> 0 AS goal_achieved,
    ts_us / 1000.0::DOUBLE AS "timestamp",
    CASE WHEN k = 97 THEN 'action_001' WHEN k = 98 THEN '' WHEN pos < 999 THEN 'action_' || lpad((pos + 1)::VARCHAR, 3, '0')
      ELSE 'action_' || (pos + 1) END AS action_id,
    CASE WHEN k = 96 THEN 'a[href="javascript:void(0)"]' WHEN k = 88 THEN repeat('x', 501) WHEN action_type IN ('navigate', 'back', 'wait') THEN ''
      WHEN action_type = 'scroll' THEN 'body' WHEN action_type = 'submit' THEN 'form' ELSE '#el-' || tix END AS element_selector,
    CASE WHEN k = 95 THEN 'ftp://bad' ELSE p.url END AS url,
    'Page ' || tix AS page_title,
    'btn,' || event_type AS element_classes,
    CASE WHEN action_type = 'type' THEN ' User' || (user_id % 7) || '@Example.com ' END AS "value",
    CASE WHEN action_type = 'select' AND k <> 94 THEN k % 5 END AS option_index,
    CASE WHEN action_type = 'scroll' THEN 0 END AS x,
    CASE WHEN action_type = 'scroll' THEN CASE WHEN k = 91 THEN 20000 ELSE 100 + 4 * k END END AS y,
    k % 4 <> 0 AS is_intentional,
    CASE WHEN k = 93 THEN 1.5::DOUBLE ELSE k / 100.0::DOUBLE END AS confidence,
    event_type AS user_intent,
    NOT (event_type = 'error' AND k % 2 = 0) AS element_visible,
    NOT (action_type IN ('scroll', 'wait') OR (event_type = 'error' AND k % 3 = 0)) AS element_clickable,
    'session_' || user_id || '_' || sess AS session_id,
    'tab_' || user_id AS tab_id
  FROM placed LEFT JOIN (SELECT page_id % 15 AS page_id, min(url) AS url FROM pages GROUP BY 1) p ON p.page_id = tix + 5 * (user_id % 3)),
traj AS (
  SELECT trajectory_id, user_id, sess, workflow_type, domain, user_type, device_type, browser_type, goal, goal_achieved,
    count(*) AS n, min(ts_us) AS start_us, max(ts_us) AS end_us,
    count(*) FILTER (action_type IN ('back', 'forward')) AS backtracks,
    count(*) FILTER (NOT element_visible OR NOT element_clickable) AS errors,
    count(*) FILTER ((NOT element_visible OR NOT element_clickable) AND action_type NOT IN ('scroll', 'wait')) AS targeted,
    count(*) FILTER (is_intentional) AS intentional,
    sum(confidence::DECIMAL(18,6)) AS confidence_sum,
    CASE WHEN count(*) < 2 THEN 0.0::DOUBLE ELSE (max(ts_us) - min(ts_us))::DOUBLE / (count(*) - 1) / 1e6 END AS mean_interval
  FROM fx GROUP BY ALL)
"""

# --- statistics --------------------------------------------------------------------

ORACLES["action_type_distribution"] = EVENTS + "SELECT action_type, count(*) AS n FROM elements GROUP BY 1"

ORACLES["dataset_statistics"] = ACTIONS + """SELECT count(*) AS n_trajectories, sum(n)::BIGINT AS n_actions,
  round(sum(n)::DOUBLE / count(*), 6) AS avg_trajectory_length,
  round((count(*) FILTER (goal_achieved))::DOUBLE / count(*), 6) AS goal_achievement_rate,
  round(sum(end_us - start_us)::DOUBLE / count(*) / 1e6, 6) AS avg_trajectory_duration_seconds,
  round(sum(end_us - start_us)::DOUBLE / sum(n - 1) / 1e6, 6) AS avg_action_interval_seconds,
  round(sum(intentional)::DOUBLE / sum(n), 6) AS intentional_action_ratio,
  round(sum(errors)::DOUBLE / sum(n), 6) AS error_rate,
  round(sum(confidence_sum)::DOUBLE / sum(n), 6) AS avg_confidence,
  round(sum(backtracks)::DOUBLE / count(*), 6) AS avg_backtrack_per_trajectory,
  round(sum(n)::DOUBLE / count(*), 6) AS avg_action_count,
  round(avg(mean_interval), 6) AS avg_action_interval_across_trajectories,
  round(sum(errors)::DOUBLE / count(*), 6) AS avg_error_count_per_trajectory
FROM traj"""

ORACLES["distributions"] = ACTIONS + """
SELECT 'trajectory_length' AS metric, n::VARCHAR AS "key", count(*) AS n FROM traj GROUP BY ALL
UNION ALL SELECT 'workflow_type', workflow_type, count(*) FROM traj GROUP BY ALL
UNION ALL SELECT 'user_type', user_type, count(*) FROM traj GROUP BY ALL
UNION ALL SELECT 'device_type', device_type, count(*) FROM traj GROUP BY ALL
UNION ALL SELECT 'browser_type', browser_type, count(*) FROM traj GROUP BY ALL
UNION ALL SELECT 'action_type', action_type, count(*) FROM elements GROUP BY ALL
UNION ALL SELECT 'element_type', element_type, count(*) FROM elements WHERE element_type <> '' GROUP BY ALL"""
ORACLES["distributions"] = ORACLES["distributions"].replace(
    """SELECT 'trajectory_length' AS metric, n::VARCHAR AS "key", count(*) AS n FROM traj GROUP BY ALL""",
    """SELECT 'trajectory_length' AS metric, len AS "key", count(*) AS n FROM (SELECT n::VARCHAR AS len FROM traj) GROUP BY ALL""",
)

ORACLES["trajectory_metrics"] = ACTIONS + """SELECT trajectory_id, n AS action_count,
  mean_interval AS avg_action_interval, backtracks AS backtrack_count, errors AS error_count,
  targeted AS error_count_targeted, (end_us - start_us)::DOUBLE / 1e6 AS duration FROM traj"""

ORACLES["length_band_mix"] = ACTIONS + """SELECT band, count(*) AS n, any_value(share) AS target_share FROM (
  SELECT CASE WHEN n BETWEEN 3 AND 4 THEN '3-4' WHEN n BETWEEN 5 AND 6 THEN '5-6' WHEN n BETWEEN 7 AND 8 THEN '7-8'
    WHEN n BETWEEN 9 AND 10 THEN '9-10' ELSE 'other' END AS band,
    CASE WHEN n BETWEEN 3 AND 4 THEN 0.2::DOUBLE WHEN n BETWEEN 5 AND 6 THEN 0.4::DOUBLE WHEN n BETWEEN 7 AND 8 THEN 0.3::DOUBLE
    WHEN n BETWEEN 9 AND 10 THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END AS share FROM traj) GROUP BY band"""

# --- shape ---------------------------------------------------------------------------

_FLAT = """trajectory_id, workflow_type AS trajectory_workflow_type, domain AS trajectory_domain,
  user_type AS trajectory_user_type, goal AS trajectory_goal, goal_achieved AS trajectory_goal_achieved"""

ORACLES["flatten_actions"] = ACTIONS + f"""SELECT {_FLAT}, pos, "timestamp", action_type, action_id, element_type,
  element_selector, url, page_title, NULL::VARCHAR AS element_text, NULL::VARCHAR AS element_id, element_classes, "value",
  option_index, x, y, is_intentional, confidence, user_intent, NULL::VARCHAR AS dom_snapshot, element_visible,
  element_clickable, session_id, tab_id, NULL::VARCHAR AS frame_id FROM fx"""

ORACLES["nest_actions"] = ACTIONS + """SELECT trajectory_id, goal, pos // 1000 AS part, count(*)::INTEGER AS n,
  string_agg(action_type, ' -> ' ORDER BY pos) AS action_types, string_agg(action_id, ',' ORDER BY pos) AS action_ids,
  arg_min("timestamp", pos) AS first_timestamp FROM fx GROUP BY trajectory_id, goal, pos // 1000"""

# --- validation -------------------------------------------------------------------------

_URL = "'" + K.URL_PATTERN.replace("'", "''") + "'"
_WEB = f"coalesce(regexp_matches(url, {_URL}), false)"
VERDICTS = ACTIONS + f""", looked AS (
  SELECT *, lag("timestamp") OVER (PARTITION BY trajectory_id ORDER BY pos) AS before,
    count(*) OVER (PARTITION BY trajectory_id, action_id) AS same_id FROM fx),
verdicts AS (
  SELECT trajectory_id, count(*) AS action_count, min(ts_us) AS start_us, concat_ws(',',
    CASE WHEN count(*) NOT BETWEEN 3 AND 10 THEN 'ACTION_COUNT' END,
    CASE WHEN min(ts_us) >= max(ts_us) THEN 'START_NOT_BEFORE_END' END,
    CASE WHEN max(ts_us) < min(ts_us) THEN 'NEGATIVE_DURATION' END,
    CASE WHEN bool_or("timestamp" < before) THEN 'TIMESTAMP_DECREASES' END,
    CASE WHEN max(same_id) > 1 THEN 'DUPLICATE_ACTION_ID' END,
    CASE WHEN bool_or("timestamp" IS NULL OR "timestamp" <= 0) THEN 'BAD_TIMESTAMP' END,
    CASE WHEN bool_or(coalesce(action_type, '') = '') THEN 'NO_ACTION_TYPE' END,
    CASE WHEN bool_or(coalesce(url, '') = '') THEN 'NO_URL' END,
    CASE WHEN bool_or(coalesce(action_id, '') = '') THEN 'NO_ACTION_ID' END,
    CASE WHEN bool_or(action_type <> '' AND action_type NOT IN {_in(K.ACTION_TYPES)}) THEN 'UNKNOWN_ACTION_TYPE' END,
    CASE WHEN bool_or(action_type = 'select' AND option_index IS NULL) THEN 'SELECT_WITHOUT_OPTION' END,
    CASE WHEN bool_or(action_type = 'scroll' AND x IS NULL AND y IS NULL) THEN 'SCROLL_WITHOUT_COORDINATES' END,
    CASE WHEN bool_or((x IS NULL) <> (y IS NULL)) THEN 'COORDINATES_INCOMPLETE' END,
    CASE WHEN bool_or(x < 0 OR y < 0) THEN 'COORDINATES_NEGATIVE' END,
    CASE WHEN bool_or(x > 10000 OR y > 10000) THEN 'COORDINATES_TOO_LARGE' END,
    CASE WHEN bool_or(confidence IS NULL OR confidence NOT BETWEEN 0 AND 1) THEN 'BAD_CONFIDENCE' END,
    CASE WHEN bool_or(coalesce(url, '') <> '' AND NOT {_WEB}) THEN 'BAD_URL' END,
    CASE WHEN bool_or(lower(element_selector) LIKE '%javascript:%' OR lower(element_selector) LIKE '%data:%'
      OR lower(element_selector) LIKE '%vbscript:%') THEN 'UNSAFE_SELECTOR' END,
    CASE WHEN bool_or(length(element_selector) > 500) THEN 'LONG_SELECTOR' END) AS reasons
  FROM looked GROUP BY trajectory_id)
"""
_REPORT = """SELECT count(*) AS total_trajectories, count(*) FILTER (reasons = '') AS valid,
  count(*) FILTER (reasons <> '') AS invalid,
  round((count(*) FILTER (reasons = ''))::DOUBLE / count(*), 6) AS validation_pass_rate FROM """

ORACLES["validate_trajectories"] = VERDICTS + (
    "SELECT trajectory_id, action_count, reasons, reasons = '' AS valid FROM verdicts"
)
ORACLES["validation_report"] = VERDICTS + _REPORT + "verdicts"
ORACLES["validation_reasons"] = VERDICTS + """SELECT reason, count(*) AS n FROM (
  SELECT unnest(string_split(reasons, ',')) AS reason FROM verdicts WHERE reasons <> '') GROUP BY reason"""
ORACLES["validation_errors"] = VERDICTS + """SELECT "index", trajectory_id, reasons FROM (
  SELECT *, row_number() OVER (ORDER BY start_us, trajectory_id) - 1 AS "index" FROM verdicts)
  WHERE reasons <> '' ORDER BY "index" LIMIT 10"""
ORACLES["validation_warnings"] = ACTIONS + """, pages_open AS (
  SELECT *, last_value(CASE WHEN action_type = 'navigate' THEN url END IGNORE NULLS) OVER (
    PARTITION BY trajectory_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS page FROM fx)
SELECT trajectory_id, pos, 'W_EMPTY_TYPE' AS warning FROM fx WHERE action_type = 'type' AND coalesce("value", '') = ''
UNION ALL
SELECT trajectory_id, pos, 'W_URL_CHANGE' FROM pages_open
WHERE action_type <> 'navigate' AND coalesce(page, '') <> '' AND url IS DISTINCT FROM page"""
ORACLES["url_quality"] = f"SELECT page_id, url, {_WEB} AS valid FROM pages"

# --- text -----------------------------------------------------------------------------------

ORACLES["normalize_urls"] = f"""SELECT page_id, {_norm_url('url')} AS normalized,
  CASE WHEN instr({_bare_url('url')}, '/') > 0
    THEN rtrim(substr({_bare_url('url')}, instr({_bare_url('url')}, '/')), '/') ELSE '' END AS path FROM pages"""
ORACLES["text_normal_forms"] = f"""SELECT doc_id, sha256({_norm_text('text')}) AS text_sha256,
  length({_norm_text('text')})::INTEGER AS text_length, sha256({_norm_selector('text')}) AS folded_sha256,
  length({_norm_selector('text')})::INTEGER AS folded_length, {_words('text')}::INTEGER AS words,
  replace(lower(source), ' ', '-') AS source_slug, lang FROM documents"""

# --- duplicates --------------------------------------------------------------------------------


def _content(normalized: bool) -> str:
    url, title, selector, value = "coalesce(url, '-')", "page_title", "element_selector", '"value"'
    if normalized:
        url, title, selector = _norm_url("url"), _norm_text("page_title"), _norm_selector("element_selector")
        value = f"""CASE WHEN "value" <> '' THEN {_norm_text('"value"')} ELSE "value" END"""
    parts = ["action_type", "element_type", selector, url, title, f"coalesce('=' || {value}, '-')", "coalesce(option_index::VARCHAR, '-')"]
    return " || chr(1) || ".join(f"({p})" for p in parts)


def _classes(normalized: bool) -> str:
    return f"""SELECT trajectory_id, workflow_type, goal, min(ts_us) AS start_us,
  string_agg({_content(normalized)}, chr(2) ORDER BY pos) AS content FROM fx GROUP BY trajectory_id, workflow_type, goal"""


COPIES = ACTIONS + f""", marked AS ({_classes(True)}),
ranked AS (
  SELECT *, first_value(trajectory_id) OVER w AS first_id, count(*) OVER (PARTITION BY workflow_type, goal, content) AS copies
  FROM marked WINDOW w AS (PARTITION BY workflow_type, goal, content ORDER BY start_us, trajectory_id))
"""

ORACLES["trajectory_fingerprint"] = ACTIONS + f""", both_forms AS (
  SELECT true AS normalized, * FROM ({_classes(True)}) UNION ALL SELECT false, * FROM ({_classes(False)}))
SELECT normalized, first_id AS trajectory_id, count(*) AS copies FROM (
  SELECT normalized, workflow_type, goal, content, first_value(trajectory_id) OVER (
    PARTITION BY normalized, workflow_type, goal, content ORDER BY start_us, trajectory_id) AS first_id FROM both_forms)
GROUP BY normalized, first_id"""
ORACLES["dedup_exact"] = COPIES + """SELECT trajectory_id, pos, action_type, url FROM fx
WHERE trajectory_id IN (SELECT first_id FROM ranked)"""
ORACLES["duplicate_pairs"] = COPIES + """SELECT trajectory_id, first_id AS duplicate_of, workflow_type, goal
FROM ranked WHERE trajectory_id <> first_id"""
ORACLES["dedup_stats"] = COPIES + """SELECT count(*) AS original_count,
  count(*) FILTER (trajectory_id <> first_id) AS exact_duplicates_count, 0::BIGINT AS near_duplicates_count,
  count(*) FILTER (trajectory_id = first_id) AS final_count, true AS enabled FROM ranked
UNION ALL SELECT count(*), 0, 0, count(*), false FROM ranked"""
ORACLES["dedup_then_validate"] = VERDICTS + f""", marked AS ({_classes(True)}),
kept AS (SELECT arg_min(trajectory_id, (start_us, trajectory_id)) AS trajectory_id FROM marked GROUP BY workflow_type, goal, content)
{_REPORT} verdicts WHERE trajectory_id IN (SELECT trajectory_id FROM kept)"""

# --- analysis ------------------------------------------------------------------------------------

_TOTALS = """SELECT count(*) AS total_actions,
  count(*) FILTER (NOT element_visible) AS actions_with_element_visible_false,
  count(*) FILTER (NOT element_clickable) AS actions_with_element_clickable_false,
  count(*) FILTER (NOT element_visible AND NOT element_clickable) AS actions_with_both_false FROM fx"""
ORACLES["analyze_error_totals"] = ACTIONS + _TOTALS
ORACLES["analyze_error_trajectories"] = ACTIONS + """SELECT trajectory_id, goal, goal_achieved,
  count(*) FILTER (NOT element_visible OR NOT element_clickable) AS error_count, count(*) AS action_count,
  count(*) FILTER (NOT element_visible) + count(*) FILTER (NOT element_clickable) AS listed_actions
FROM fx GROUP BY trajectory_id, goal, goal_achieved HAVING error_count > 0"""
_LISTED = "SELECT trajectory_id, pos, action_id, action_type, element_visible, element_clickable, '' AS context, "
ORACLES["analyze_error_actions"] = ACTIONS + f"""
{_LISTED} 'element_visible' AS failed_test FROM fx WHERE NOT element_visible
UNION ALL {_LISTED} 'element_clickable' FROM fx WHERE NOT element_clickable"""
LISTS = ACTIONS + """, failed AS (
  SELECT trajectory_id, goal, count(*) AS action_count, arg_max(action_type, pos) AS last_action_type
  FROM fx WHERE NOT goal_achieved GROUP BY trajectory_id, goal),
skipped AS (
  SELECT trajectory_id, goal, count(*) AS action_count, string_agg(action_type, ' -> ' ORDER BY pos) AS actions
  FROM fx WHERE goal_achieved GROUP BY trajectory_id, goal HAVING count(*) <= 5)
"""
ORACLES["analyze_failed_goals"] = LISTS + "SELECT * FROM failed"
ORACLES["analyze_skipped_steps"] = LISTS + "SELECT * FROM skipped"
ORACLES["analyze_samples"] = LISTS + """SELECT category, trajectory_id, goal, action_count, "rank" FROM (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY trajectory_id)::INTEGER AS "rank" FROM (
    SELECT 'errors' AS category, trajectory_id, goal, n AS action_count FROM traj WHERE errors > 0
    UNION ALL SELECT 'failed_goals', trajectory_id, goal, action_count FROM failed
    UNION ALL SELECT 'skipped_steps', trajectory_id, goal, action_count FROM skipped)) WHERE "rank" <= 3"""

# --- assignment --------------------------------------------------------------------------------------


def _pick(values, u: str) -> str:
    return f"{_list(values)}[(floor({u} * {len(values)}) + 1)::INT]"


def _mix(u: str) -> str:
    return (
        f"CASE WHEN {u} < 0.4::DOUBLE THEN 'e_commerce' WHEN {u} < 0.7::DOUBLE THEN 'form_filling' ELSE 'research' END"
    )


ORACLES["assign_weighted"] = ACTIONS + (
    f"SELECT trajectory_id, {_mix(_u('workflow', 'trajectory_id'))} AS workflow_type FROM traj"
)
_goal_pick = "CASE workflow_type " + " ".join(
    f"WHEN '{w}' THEN {_pick(goals, _u('goal', 'trajectory_id'))}" for w, goals in K.WORKFLOW_GOALS.items()
) + " END"
ORACLES["assign_uniform"] = ACTIONS + f""", drawn AS (
  SELECT trajectory_id, user_id, user_type AS own_type, {_mix(_u('workflow', 'trajectory_id'))} AS workflow_type FROM traj)
SELECT trajectory_id, workflow_type, {_goal_pick} AS goal,
  CASE WHEN user_id % 4 = 0 THEN own_type ELSE {_pick(K.USER_TYPES, _u('user', 'trajectory_id'))} END AS user_type,
  {_pick(K.DEVICE_TYPES, _u('device', 'trajectory_id'))} AS device_type,
  {_pick(K.BROWSER_TYPES, _u('browser', 'trajectory_id'))} AS browser_type,
  (3 + floor({_u('length', 'trajectory_id')} * 8))::INTEGER AS num_actions FROM drawn"""

# --- timeline -----------------------------------------------------------------------------------------

_important = "action_type IN ('submit', 'click') AND k % 4 = 0"
_offset = _seconds(
    "action_type", "user_type", "coalesce(\"value\", 'text')", _important,
    "CASE WHEN k % 4 = 0 THEN k::DOUBLE END",
    _u("step", "trajectory_id", "pos"), _u("wpm", "trajectory_id", "pos"),
)
ORACLES["impute_timeline"] = ACTIONS + f""", timed AS (
  SELECT trajectory_id, pos, round(({_offset}) * 1000)::BIGINT AS offset_ms FROM fx)
SELECT trajectory_id, pos, offset_ms, elapsed_ms, 1704067200000 + elapsed_ms AS imputed_ms FROM (
  SELECT *, (sum(offset_ms) OVER (PARTITION BY trajectory_id ORDER BY pos ROWS UNBOUNDED PRECEDING))::BIGINT AS elapsed_ms FROM timed)"""

_half = "0.5::DOUBLE"
_mid_wpm = _between(_half, _by("user_type", K.TYPING_WPM, 0), _by("user_type", K.TYPING_WPM, 1))
_factor = f"{_by('level', K.COMPLEXITY_FACTORS)}"
ORACLES["expected_durations"] = ACTIONS + f""", leveled AS (
  SELECT *, {_list(K.COMPLEXITY_FACTORS)}[k % 3 + 1] AS level FROM fx)
SELECT trajectory_id, pos, round({_mid_wpm}, 6) AS typing_wpm,
  round({_words('coalesce("value", ' + "'')")} / {_mid_wpm} * 60, 6) AS typing_seconds,
  round({_decision('user_type', _half, _important)}, 6) AS decision_seconds,
  round({_between(_half, _by('user_type', K.READING_SECONDS, 0) + ' * ' + _factor, _by('user_type', K.READING_SECONDS, 1) + ' * ' + _factor)}, 6) AS reading_seconds
FROM leveled"""

# --- raw records ----------------------------------------------------------------------------------------

_unknown = K.ACTION_ERRORS["unknown_action_type"]
_types_text = str(K.ACTION_TYPES).replace("'", "''")


def _bad_type(kind: str) -> str:
    head, middle, _ = _unknown.replace("'", "''").split("%s")
    return f"'{head}' || {kind} || '{middle}{_types_text}'"


def _say(code: str) -> str:
    return "'" + K.ACTION_ERRORS[code].replace("'", "''") + "'"


def _errors(kind: str, url: str, option_is_text: str, flag_is_text: str) -> str:
    arms = [
        f"CASE WHEN {kind} NOT IN {_in(K.ACTION_TYPES)} THEN {_bad_type(kind)} END",
        f"CASE WHEN {url} IS NULL THEN {_say('no_url')} END",
        f"CASE WHEN {url} <> '' AND NOT regexp_matches({url}, {_URL}) THEN {_say('url_format')} END",
        f"CASE WHEN {kind} = 'type' AND k % 4 <> 0 THEN {_say('type_without_value')} END",
        f"CASE WHEN {kind} = 'select' AND option_index IS NOT NULL AND {option_is_text} THEN {_say('option_index')} END",
        f"CASE WHEN {flag_is_text} THEN {_say('is_intentional')} END",
    ]
    return "concat_ws(chr(10), " + ", ".join(f"'Action[' || i || ']: ' || ({a})" for a in arms) + ")"


_top = "CASE WHEN user_id % 11 = 0 THEN '" + K.RECORD_ERRORS["goal_achieved"].replace("'", "''") + "' END"
RAW = ACTIONS + f""", raw AS (
  SELECT *, 'record_' || trajectory_id AS record_id, pos AS i,
    CASE WHEN k % 6 = 0 THEN upper(action_type) ELSE action_type END AS raw_type,
    CASE WHEN k % 11 <> 0 THEN url END AS raw_url,
    CASE WHEN k % 13 <> 0 THEN page_title END AS raw_title,
    CASE WHEN k % 4 = 0 THEN 'Add to Cart ' ELSE 'step ' END || tix AS context
  FROM fx),
lines AS (
  SELECT *, {_errors('raw_type', 'raw_url', 'k % 7 = 0', 'k % 19 = 0')} AS before,
    {_errors('action_type', "coalesce(raw_url, 'https://example.com')", 'false', 'false')} AS after FROM raw),
recs AS (
  SELECT record_id, user_id, sess, count(*) AS n, min(ts_us) // 1000 AS base_ms,
    concat_ws(chr(10), {_top}, string_agg(before, chr(10) ORDER BY i) FILTER (before <> '')) AS errors_before,
    coalesce(string_agg(after, chr(10) ORDER BY i) FILTER (after <> ''), '') AS errors_after,
    count(*) FILTER (before <> '') AS bad
  FROM lines WHERE (user_id + sess) % 23 <> 0 GROUP BY record_id, user_id, sess),
known AS (SELECT *, errors_before = '' AS clean FROM recs)
"""


def _n(x: str) -> str:
    return f"CASE WHEN {x} = '' THEN 0 ELSE len(string_split({x}, chr(10))) END"


ORACLES["structure_errors"] = RAW + f"""SELECT record_id, errors_before,
  CASE WHEN clean THEN '' ELSE errors_after END AS errors_after,
  CASE WHEN clean THEN 'clean' WHEN errors_after = '' THEN 'fixed'
    WHEN {_n('errors_after')} < {_n('errors_before')} THEN 'improved' ELSE 'not_improved' END AS fix_outcome FROM known"""

EFFECTIVE = RAW + """, effective AS (
  SELECT raw.record_id, i, clean, user_id, sess, k, tix, event_type, user_type, workflow_type, base_ms, n,
    CASE WHEN user_id % 7 <> 0 THEN domain END AS raw_domain,
    CASE WHEN user_id % 11 = 0 THEN true ELSE goal_achieved END AS goal_achieved,
    CASE WHEN clean THEN raw_type ELSE lower(raw_type) END AS action_type,
    CASE WHEN clean THEN raw_url ELSE coalesce(raw_url, 'https://example.com') END AS url,
    CASE WHEN clean THEN raw_title ELSE coalesce(raw_title, 'Page') END AS page_title,
    nullif(element_type, '') AS element_type, event_type AS user_intent, context,
    CASE WHEN k % 19 = 0 THEN true ELSE is_intentional END AS is_intentional,
    option_index, x, y, element_selector, "value", element_visible, element_clickable
  FROM raw JOIN (SELECT record_id, clean, base_ms, n FROM known) USING (record_id))
"""
ORACLES["normalize_raw"] = EFFECTIVE + """SELECT record_id, raw_domain AS domain, goal_achieved, i::INTEGER AS "index",
  action_type, url, page_title, element_type, user_intent, context, is_intentional, option_index::VARCHAR AS option_index
FROM effective"""

_goal_json = "CASE WHEN user_id % 11 = 0 THEN '\"false\"' WHEN (user_id + sess) % 3 <> 0 THEN 'true' ELSE 'false' END"
_member = lambda name, value: f"""'"{name}":' || {value}"""
_text = lambda value: f"""'"' || replace({value}, '"', '\\"') || '"'"""
_flag = lambda value: f"CASE WHEN {value} THEN 'true' ELSE 'false' END"
_raw_members = ", ".join(
    [
        _member("action_type", _text("raw_type")),
        _member("url", _text("raw_url")),
        _member("page_title", _text("raw_title")),
        _member("element_type", _text("nullif(element_type, '')")),
        _member("context", _text("context")),
        _member("user_intent", _text("event_type")),
        _member("is_intentional", f"CASE WHEN k % 19 = 0 THEN '\"false\"' ELSE {_flag('k % 4 <> 0')} END"),
        _member("element_selector", _text("CASE WHEN k % 3 <> 0 THEN nullif(element_selector, '') END")),
        _member("element_id", _text("CASE WHEN action_type = 'click' AND k % 2 = 0 THEN 'el-' || tix END")),
        _member(
            "element_classes",
            "CASE WHEN action_type = 'click' THEN CASE WHEN k % 2 = 1 THEN '\"btn\"' "
            "ELSE '[\"btn\",\"' || event_type || '\"]' END END",
        ),
        _member("value", _text("CASE WHEN k % 4 = 0 THEN \"value\" END")),
        _member("field_type", "CASE WHEN action_type = 'type' AND k % 8 = 0 THEN '\"email\"' END"),
        _member("option_index", "CASE WHEN k % 7 = 0 THEN '\"' || option_index || '\"' ELSE option_index::VARCHAR END"),
        _member("coordinates", "'{\"x\":' || x || ',\"y\":' || y || '}'"),
        _member("duration", "CASE WHEN action_type = 'wait' AND k % 4 = 0 THEN k::VARCHAR END"),
        _member("element_visible", f"CASE WHEN event_type = 'error' THEN {_flag('element_visible')} END"),
        _member("element_clickable", f"CASE WHEN event_type = 'error' THEN {_flag('element_clickable')} END"),
    ]
)
ORACLES["parse_raw_responses"] = RAW + f""", bodies AS (
  SELECT record_id, user_id, sess, any_value(goal) AS goal, count(*) AS n, '{{' || concat_ws(',',
    CASE WHEN user_id % 7 <> 0 THEN '"domain":"' || any_value(domain) || '"' END,
    '"goal":"' || any_value(goal) || '"', '"goal_achieved":' || {_goal_json},
    '"actions":[' || string_agg('{{' || concat_ws(',', {_raw_members}) || '}}', ',' ORDER BY i) || ']') || '}}' AS body
  FROM raw GROUP BY record_id, user_id, sess)
SELECT record_id, (user_id + sess) % 23 <> 0 AS parsed,
  (length(body) - CASE WHEN (user_id + sess) % 23 = 0 THEN 3 ELSE 0 END)::INTEGER AS json_length,
  CASE WHEN (user_id + sess) % 23 <> 0 THEN goal END AS goal,
  CASE WHEN (user_id + sess) % 23 <> 0 THEN n::INTEGER END AS n_actions FROM bodies"""

_steps = _seconds(
    "action_type", "user_type", "CASE WHEN k % 4 = 0 THEN \"value\" ELSE 'text' END", _important,
    "CASE WHEN k % 4 = 0 THEN k::DOUBLE END", _u("step", "record_id", "i"), _u("wpm", "record_id", "i"),
)
_domain_pick = "CASE workflow_type " + " ".join(
    f"WHEN '{w}' THEN {_pick(d, _u('domain', 'record_id'))}" for w, d in K.WORKFLOW_DOMAINS.items()
) + " END"
_field = "CASE WHEN k % 8 = 0 THEN 'email' ELSE 'text' END"
_given = "CASE WHEN k % 3 <> 0 THEN nullif(element_selector, '') END"
ORACLES["convert_raw_actions"] = EFFECTIVE + f""", cut AS (
  SELECT *, round(({_steps}) * 1000)::BIGINT AS offset_ms FROM effective WHERE i < 3 + (user_id + sess) % 8),
clocked AS (
  SELECT *, count(*) OVER (PARTITION BY record_id) AS kept,
    (sum(offset_ms) OVER (PARTITION BY record_id))::BIGINT AS total_ms,
    (sum(offset_ms) OVER (PARTITION BY record_id ORDER BY i ROWS UNBOUNDED PRECEDING))::BIGINT AS elapsed_ms FROM cut)
SELECT record_id, 'traj_' || substr(sha256(record_id), 1, 16) AS trajectory_id,
  coalesce(raw_domain, {_domain_pick}) AS domain, goal_achieved, base_ms::DOUBLE AS start_time,
  (base_ms + total_ms)::DOUBLE AS end_time, total_ms / 1000.0::DOUBLE AS duration, i::INTEGER AS pos,
  (base_ms + elapsed_ms)::DOUBLE AS "timestamp", action_type, 'action_' || lpad((i + 1)::VARCHAR, 3, '0') AS action_id,
  CASE action_type WHEN 'navigate' THEN '' WHEN 'wait' THEN '' WHEN 'type' THEN 'input' WHEN 'scroll' THEN 'body'
    WHEN 'select' THEN 'select' WHEN 'submit' THEN 'form'
    WHEN 'click' THEN coalesce(element_type, 'button') ELSE coalesce(element_type, '') END AS element_type,
  CASE action_type WHEN 'scroll' THEN 'body' WHEN 'submit' THEN 'form'
    WHEN 'click' THEN coalesce({_given}, '#' || coalesce(element_type, 'button') || '-' || replace(lower(context), ' ', '-'))
    WHEN 'type' THEN coalesce({_given}, 'input[name=''' || {_field} || ''']')
    WHEN 'select' THEN coalesce({_given}, 'select[name=''' || replace(lower(context), ' ', '_') || ''']')
    ELSE '' END AS element_selector,
  url, coalesce(page_title, 'Page') AS page_title,
  CASE WHEN action_type = 'click' AND k % 2 = 0 THEN 'el-' || tix END AS element_id,
  CASE WHEN action_type = 'click' THEN CASE WHEN k % 2 = 1 THEN 'btn' ELSE 'btn,' || event_type END END AS element_classes,
  CASE WHEN action_type = 'type' THEN CASE WHEN k % 4 = 0 THEN "value" ELSE 'test_' || {_field} END END AS "value",
  CASE WHEN action_type = 'select' THEN coalesce(option_index, floor({_u('option', 'record_id', 'i')} * 5)::INTEGER) END AS option_index,
  x, y, is_intentional,
  CASE action_type WHEN 'navigate' THEN CASE WHEN is_intentional THEN 'navigate' END WHEN 'scroll' THEN NULL WHEN 'wait' THEN NULL
    ELSE user_intent END AS user_intent,
  CASE WHEN action_type = 'click' THEN element_visible ELSE true END AS element_visible,
  CASE WHEN action_type = 'click' THEN element_clickable ELSE action_type NOT IN ('scroll', 'wait') END AS element_clickable
FROM clocked WHERE kept >= 3"""
ORACLES["stream_ingest"] = ORACLES["convert_raw_actions"]
ORACLES["conversion_rejects"] = RAW + """, sizes AS (
  SELECT record_id, (user_id + sess) % 23 = 0 AS broken, count(*) FILTER (i < 3 + (user_id + sess) % 8) AS kept
  FROM raw GROUP BY record_id, user_id, sess)
SELECT CASE WHEN broken THEN 'unparsable' WHEN kept < 3 THEN 'too_few_actions' ELSE 'converted' END AS outcome,
  count(*) AS n, 0::BIGINT AS failed_actions FROM sizes GROUP BY 1"""

# --- sinks ----------------------------------------------------------------------------------------------------

GOOD = VERDICTS + """, good AS (
  SELECT fx.*, t.n, t.start_us, t.end_us, t.errors, t.backtracks, t.mean_interval FROM fx
  JOIN traj t USING (trajectory_id) WHERE trajectory_id IN (SELECT trajectory_id FROM verdicts WHERE reasons = ''))
"""
ORACLES["sample_head"] = GOOD + """SELECT trajectory_id, any_value(session_id) AS session_id, any_value(goal) AS goal,
  min("timestamp") AS start_time, count(*)::INTEGER AS action_count, any_value(errors)::INTEGER AS error_count,
  string_agg(action_type, ' -> ' ORDER BY pos) AS action_types
FROM good GROUP BY trajectory_id ORDER BY min(ts_us), trajectory_id LIMIT 10"""
ORACLES["dataset_metadata"] = GOOD + """SELECT '1.0' AS dataset_version, '1.0' AS schema_version,
  count(DISTINCT trajectory_id) AS total_trajectories, count(*) AS total_actions FROM good"""
ORACLES["scan_jsonl_roundtrip"] = GOOD + """SELECT trajectory_id, workflow_type, domain, user_type, device_type, browser_type,
  goal, goal_achieved, start_us / 1000.0::DOUBLE AS start_time, end_us / 1000.0::DOUBLE AS end_time,
  (end_us - start_us)::DOUBLE / 1e6 AS duration, n::INTEGER AS action_count, mean_interval AS avg_action_interval,
  backtracks::INTEGER AS backtrack_count, errors::INTEGER AS error_count, pos, "timestamp", action_type, action_id,
  element_selector, url, element_classes, "value", option_index, x, y, confidence, session_id, tab_id FROM good"""
ORACLES["analyze_stored"] = GOOD + _TOTALS.replace("FROM fx", "FROM good")
ORACLES["latest_run"] = GOOD + """SELECT '20240102_000000' AS run_id, count(DISTINCT trajectory_id) AS n_trajectories FROM good"""
ORACLES["output_manifest"] = GOOD + """SELECT 'main' AS kind, count(*) AS n_rows FROM good
UNION ALL SELECT 'sample', least(10, count(DISTINCT trajectory_id)) FROM good
UNION ALL SELECT 'metadata', 1 UNION ALL SELECT 'statistics', 1"""
