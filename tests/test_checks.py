"""Each validation rule on hand-written rows."""

import pytest
from pyspark.sql import functions as F

from seqtable.operators import analysis, checks, dedup, shape
from seqtable.schema import ACTION_TYPES_BY_COLUMN

GOOD = {
    "timestamp": 1000.0, "action_type": "click", "action_id": None, "element_type": "button",
    "element_selector": "#a", "url": "https://a.com/x", "page_title": "A", "element_text": None,
    "element_id": None, "element_classes": None, "value": None, "option_index": None,
    "coordinates": None, "is_intentional": True, "confidence": 1.0, "user_intent": None,
    "dom_snapshot": None, "element_visible": True, "element_clickable": True, "session_id": "s",
    "tab_id": "t", "frame_id": None,
}
HEAD = "trajectory_id string, workflow_type string, goal string, goal_achieved boolean, pos int, "
SCHEMA = HEAD + ", ".join(f"{n} {t}" for n, t in ACTION_TYPES_BY_COLUMN.items())


def build(spark, cases):
    """cases: id -> list of per-action overrides; header overrides under '_workflow_type' etc."""
    rows = []
    for name, changes in cases.items():
        for pos, change in enumerate(changes):
            action = GOOD | {"timestamp": 1000.0 + pos, "action_id": f"action_{pos + 1:03d}"}
            head = {"workflow_type": "research", "goal": "learn_topic", "goal_achieved": True}
            for k, v in change.items():
                (head if k.startswith("_") else action)[k.lstrip("_")] = v
            rows.append((name, head["workflow_type"], head["goal"], head["goal_achieved"], pos, *action.values()))
    return spark.createDataFrame(rows, SCHEMA)


def one(**change):
    """Three good actions, the last one changed."""
    return [{}, {}, change]


CASES = {
    "two": ([{}] * 2, ["ACTION_COUNT"]),
    "three": ([{}] * 3, []),
    "ten": ([{}] * 10, []),
    "eleven": ([{}] * 11, ["ACTION_COUNT"]),
    "all at once": ([{"timestamp": 5.0}] * 3, ["START_NOT_BEFORE_END"]),
    "equal pair": ([{"timestamp": 5.0}, {"timestamp": 5.0}, {"timestamp": 6.0}], []),
    "decreasing": (one(timestamp=1000.5), ["TIMESTAMP_DECREASES"]),
    "zero time": ([{"timestamp": 0.0}, {}, {}], ["BAD_TIMESTAMP"]),
    "null time": (one(timestamp=None), ["BAD_TIMESTAMP"]),
    "nan time": (one(timestamp=float("nan")), ["BAD_TIMESTAMP"]),
    "same id": (one(action_id="action_001"), ["DUPLICATE_ACTION_ID"]),
    "no type": (one(action_type=""), ["NO_ACTION_TYPE"]),
    "unknown type": (one(action_type="Click"), ["UNKNOWN_ACTION_TYPE"]),
    "no url": (one(url=None), ["NO_URL"]),
    "no id": (one(action_id=""), ["NO_ACTION_ID"]),
    "select 0": (one(action_type="select", option_index=0), []),
    "select": (one(action_type="select"), ["SELECT_WITHOUT_OPTION"]),
    "scroll": (one(action_type="scroll", coordinates=(0, 10)), []),
    "scroll none": (one(action_type="scroll"), ["SCROLL_WITHOUT_COORDINATES"]),
    "scroll empty": (one(action_type="scroll", coordinates=(None, None)), ["SCROLL_WITHOUT_COORDINATES"]),
    "x only": (one(coordinates=(1, None)), ["COORDINATES_INCOMPLETE"]),
    "negative": (one(coordinates=(-1, 1)), ["COORDINATES_NEGATIVE"]),
    "edge": (one(coordinates=(10000, 0)), []),
    "beyond": (one(coordinates=(0, 10001)), ["COORDINATES_TOO_LARGE"]),
    "sure": (one(confidence=0.0), []),
    "oversure": (one(confidence=1.01), ["BAD_CONFIDENCE"]),
    "null sure": (one(confidence=None), ["BAD_CONFIDENCE"]),
    "nan sure": (one(confidence=float("nan")), ["BAD_CONFIDENCE"]),
    "script": (one(element_selector="a[href='JavaScript:x']"), ["UNSAFE_SELECTOR"]),
    "data-attr": (one(element_selector="[data-testid=x]"), []),
    "long 500": (one(element_selector="x" * 500), []),
    "long 501": (one(element_selector="x" * 501), ["LONG_SELECTOR"]),
    "no selector": (one(element_selector=""), []),
    "empty value": (one(action_type="type", value=""), []),
    "two faults": (one(url="ftp://a.com", confidence=2.0), ["BAD_CONFIDENCE", "BAD_URL"]),
}
URLS = {
    "http://localhost:80": True, "http://1.2.3.4/a": True, "https://a.com?x=1": True,
    "https://a.com/#t": True, "HTTPS://A.COM/": True, "https://a.com.": True,
    "https://a.com#t": False, "https://a.technology/": False, "https://a_b.com": False,
    "http://localhost:80/x y": False, "ftp://a.com": False, "https://a.com\n": False,
}


@pytest.fixture(scope="module")
def verdicts(spark):
    cases = {k: v for k, (v, _) in CASES.items()}
    cases |= {f"url {u}": one(url=u) for u in URLS}
    rows = checks.validate(build(spark, cases)).collect()
    return {r.trajectory_id: r for r in rows}


@pytest.mark.parametrize("name", CASES)
def test_rule(verdicts, name):
    assert list(verdicts[name].reasons) == CASES[name][1]
    assert verdicts[name].valid == (not CASES[name][1])


@pytest.mark.parametrize("url", URLS)
def test_url_rule(verdicts, url):
    assert (list(verdicts[f"url {url}"].reasons) == []) is URLS[url]


def test_stored_bounds_are_used(spark):
    rows = build(spark, {"t": [{}] * 3})
    bad = rows.withColumns({"start_time": F.lit(9.0), "end_time": F.lit(8.0), "duration": F.lit(-0.001)})
    assert checks.validate(bad).first().reasons == ["START_NOT_BEFORE_END", "NEGATIVE_DURATION"]


def test_rules_can_be_added(spark):
    rules = {**checks.ACTION_RULES, "NO_TITLE": lambda: F.col("page_title") == ""}
    rows = build(spark, {"t": one(page_title="")})
    assert checks.validate(rows, rules).first().reasons == ["NO_TITLE"]


def test_long_trajectory_over_chunk_borders(spark):
    """A decrease exactly at a chunk border is still seen, and nothing else is."""
    n = 2 * 4096 + 10
    base = spark.range(n).select(F.lit("t").alias("trajectory_id"), F.col("id").cast("int").alias("pos"))
    columns = {k: F.lit(v) for k, v in GOOD.items() if v is not None}
    columns |= {k: F.lit(None).cast(ACTION_TYPES_BY_COLUMN[k]) for k, v in GOOD.items() if v is None}
    columns["action_id"] = F.concat(F.lit("a"), F.col("pos"))
    columns["timestamp"] = (F.col("pos") + 1).cast("double")
    rows = base.withColumns(columns)
    assert checks.validate(rows).first().reasons == ["ACTION_COUNT"]
    dented = rows.withColumn("timestamp", F.when(F.col("pos") == 4096, 1.0).otherwise(F.col("timestamp")))
    assert checks.validate(dented).first().reasons == ["ACTION_COUNT", "TIMESTAMP_DECREASES"]
    parts = shape.nest(rows)
    assert [len(r.actions) for r in parts.orderBy("part").collect()] == [1000] * 8 + [202]
    assert shape.unnest(parts).select("pos", "action_id").exceptAll(rows.select("pos", "action_id")).isEmpty()


def test_warnings(spark):
    opened = {"action_type": "navigate", "url": "https://b.com"}
    rows = build(spark, {"t": [{}, opened, {"action_type": "type", "value": "", "url": "https://b.com"}, {}]})
    got = {(r.pos, r.warning) for r in checks.warnings(rows).collect()}
    assert got == {(2, "W_EMPTY_TYPE"), (3, "W_URL_CHANGE")}


def test_empty_report(spark):
    empty = build(spark, {"t": [{}]}).where("false")
    row = checks.report(checks.validate(empty)).first()
    assert (row.total_trajectories, row.valid, row.validation_pass_rate) == (0, 0, 0.0)


def test_fingerprint_classes(spark):
    cases = {
        "a": [{}] * 3,
        "other ids": [{"timestamp": 9e3 + i, "action_id": f"z{i}", "coordinates": (1, 1)} for i in range(3)],
        "normal form": [{"url": " HTTP://A.com/x// ", "page_title": " a ", "element_selector": " #A  "}] * 3,
        "other goal": [{"_goal": "Learn_topic"}] * 3,
        "empty value": [{}, {}, {"value": ""}],
        "no url": [{}, {}, {"url": None}],
        "blank url": [{}, {}, {"url": " "}],
        "order": [{"element_type": "x"}, {}, {}],
        "reversed": [{}, {}, {"element_type": "x"}],
    }
    rows = build(spark, cases)
    prints = {r.trajectory_id: r.fingerprint for r in dedup.fingerprints(rows).collect()}
    assert prints["a"] == prints["other ids"] == prints["normal form"]
    assert prints["no url"] == prints["blank url"]
    assert len(set(prints.values())) == 6
    plain = {r.trajectory_id: r.fingerprint for r in dedup.fingerprints(rows, normalize=False).collect()}
    assert plain["a"] == plain["other ids"] != plain["normal form"]


def test_dedup_is_idempotent(spark):
    rows = build(spark, {f"t{i}": [{"timestamp": 100.0 + i + p} for p in range(3)] for i in range(6)})
    kept = dedup.keep_first(rows, dedup.fingerprints(rows))
    again = dedup.keep_first(kept, dedup.fingerprints(kept))
    assert {r.trajectory_id for r in kept.collect()} == {"t0"} == {r.trajectory_id for r in again.collect()}


@pytest.mark.parametrize("hot", [1, 2, 100])
def test_duplicates_with_hot_groups(spark, hot):
    """One content holds most trajectories; how many groups count as hot changes nothing."""
    cases = {f"h{i:02d}": [{"timestamp": 50.0 - i + p} for p in range(3)] for i in range(20)}
    cases |= {f"m{i}": [{"url": "https://m.com"}] * 3 for i in range(3)}
    cases |= {f"s{i}": [{"url": f"https://s{i}.com"}] * 3 for i in range(3)}
    pairs = dedup.duplicates(dedup.fingerprints(build(spark, cases)), hot).collect()
    got = {r.trajectory_id: r.duplicate_of for r in pairs}
    expected = {f"h{i:02d}": "h19" for i in range(19)} | {"m1": "m0", "m2": "m0"}
    assert got == expected and len(pairs) == len(expected)


def test_analysis(spark):
    both = {"element_visible": False, "element_clickable": False}
    cases = {
        "ok": [{}] * 3,
        "bad": [both, {"element_clickable": False}, {}],
        "failed": [{"_goal_achieved": False}] * 2 + [{"_goal_achieved": False, "action_type": "back"}],
        "long": [{}] * 6,
    }
    rows = build(spark, cases)
    listed = analysis.error_actions(rows).collect()
    assert sorted((r.pos, r.failed_test) for r in listed) == [
        (0, "element_clickable"), (0, "element_visible"), (1, "element_clickable"),
    ]
    assert analysis.failed_goals(rows).first().last_action_type == "back"
    assert {r.trajectory_id for r in analysis.skipped_steps(rows).collect()} == {"ok", "bad"}
    plan = analysis.samples(rows)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
