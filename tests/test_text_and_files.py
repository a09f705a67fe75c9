"""Text forms, draws, stored files, streaming."""

import json

import pytest
from pyspark.sql import functions as F

from seqtable import constants as K
from seqtable.functions import draw, fields, text
from seqtable.operators import analysis, assign, shape, statistics, timeline
from seqtable.plans import views
from seqtable.sources import jsonl, sinks
from seqtable.streaming import ingest

FOLDER = "/root/testdata/sf0.001"


def apply(spark, fn, values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in frame.orderBy("i").select(fn(F.col("v"))).collect()]


WORDS = ["  HTTPS://A.com/x// ", "https://a.com?r=https://b.com/", "\t\n　A  b c \x1f", "", None, "a\x85b", "Ünï  Ö", "x"]


def test_normal_forms_match_python(spark):
    def url(v):
        return (v or "").lower().strip().replace("https://", "").replace("http://", "").rstrip("/")

    assert apply(spark, text.normalize_url, WORDS) == [url(v) for v in WORDS]
    assert apply(spark, text.normalize_text, WORDS) == [(v or "").lower().strip() for v in WORDS]
    assert apply(spark, text.normalize_selector, WORDS) == [" ".join((v or "").lower().split()) for v in WORDS]
    assert apply(spark, lambda c: text.word_count(text.or_empty(c)), WORDS) == [len((v or "").split()) for v in WORDS]


def test_small_text_helpers(spark):
    assert apply(spark, text.url_path, ["https://A.com/p/q?x=1/", "a.com", None, "http://a/"]) == ["/p/q?x=1", "", "", ""]
    assert apply(spark, text.humanize, ["e_commerce"]) == ["E Commerce"]
    assert apply(spark, text.unquote, [" \"it's\" ", "'x'"]) == ["it's", "x"]
    assert apply(spark, text.slug, ["Add To Cart"]) == ["add-to-cart"]


def test_draws(spark):
    ids = spark.range(20_000).select(draw.uniform("t", F.col("id")).alias("u"))
    row = ids.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= row[0] < 0.01 and 0.99 < row[1] < 1 and abs(row[2] - 0.5) < 0.01
    shares = {
        r.w: r.n / 20_000
        for r in ids.groupBy(draw.pick_weighted(F.col("u"), K.WORKFLOW_MIX).alias("w")).agg(F.count("*").alias("n")).collect()
    }
    assert all(abs(shares[w] - share) < 0.02 for w, share in K.WORKFLOW_MIX.items())
    goals = spark.range(1).select(assign.goal_for(F.col("id"), F.lit("other"))).first()[0]
    assert goals == K.UNKNOWN_WORKFLOW_GOAL


def test_durations(spark):
    one = spark.range(1)
    zero, end = F.lit(0.0), F.lit(1.0)
    yes = F.lit(True)
    got = one.select(
        timeline.decision_seconds(F.lit("power_user"), zero, yes),
        timeline.decision_seconds(F.lit("power_user"), end, yes),
        timeline.reading_seconds(F.lit("casual"), zero, F.lit("low")),
        timeline.typing_seconds(F.lit("a b\tc"), F.lit(60.0)),
        timeline.typing_wpm(F.lit("somebody"), zero),
        timeline.decision_seconds(F.lit("somebody"), zero),
        timeline.is_important(F.lit("click"), F.lit("Open CART")),
    ).first()
    assert list(got) == [0.75, 4.0, 7.0, 3.0, 20.0, None, True]


def test_statistics_of_nothing(spark):
    empty = shape.measure(views.actions(spark, FOLDER).where("false"), [*statistics.PROFILE_COLUMNS, "goal_achieved"])
    row = statistics.dataset_statistics(empty).first().asDict()
    assert statistics.render(row, []) == {"n_trajectories": 0, "n_actions": 0}


def test_rounding_of_the_report():
    row = {"n_trajectories": 1, "n_actions": 3, "avg_action_count": 2.675, "error_rate": 0.12345}
    report = statistics.render(row, [{"metric": "action_type", "key": "click", "n": 3}])
    assert report["avg_action_count"] == 2.67 and report["error_rate"] == 0.123
    assert report["action_type_distribution"] == {"click": 3}


def test_fields_keep_their_names_beside_a_generator(spark):
    rows = spark.createDataFrame([('{"a": null, "b": [1, 2]}',)], "t string").select(F.parse_json("t").alias("r"))
    items = F.posexplode_outer(F.try_variant_get("r", "$.b", "array<variant>"))
    found = rows.select(fields.truthy(fields.field(F.col("r"), "a")), fields.is_missing(fields.field(F.col("r"), "c")), items.alias("pos", "b"))
    assert [tuple(r)[:3] for r in found.collect()] == [(False, True, 0), (False, True, 1)]


def test_reading_lines(spark, tmp_path):
    lines = [
        {"trajectory_id": "gone", "goal": "g", "actions": [{"action_id": "a", "action_type": "click"}]},
        {"trajectory_id": "null", "goal": "g", "goal_achieved": None, "actions": [
            {"action_id": "a", "action_type": "é", "element_visible": None, "element_clickable": False}]},
        {"trajectory_id": "none", "goal": "g", "goal_achieved": False, "actions": []},
    ]
    path = tmp_path / "t.jsonl"
    path.write_text("\n\n".join(json.dumps(x, ensure_ascii=False) for x in lines) + "\n{broken\n")
    typed = jsonl.read_trajectories(spark, str(path)).cache()
    assert typed.where("broken_line is not null").count() == 1
    assert typed.where("broken_line is null").count() == 3
    with pytest.raises(Exception):
        jsonl.read_trajectories(spark, str(path), fail_fast=True).collect()

    good = tmp_path / "good.jsonl"
    good.write_text("\n\n".join(json.dumps(x) for x in lines))
    rows = jsonl.read_for_analysis(spark, str(good))
    flags = {r.trajectory_id: (r.goal_achieved, r.element_visible, r.element_clickable) for r in rows.collect()}
    assert flags["gone"] == (True, True, True)
    assert flags["null"] == (False, False, False)
    failed = {r.trajectory_id: (r.action_count, r.last_action_type) for r in analysis.failed_goals(rows).collect()}
    assert failed["null"][0] == 1 and failed["none"] == (0, None)
    assert analysis.error_totals(rows).first().total_actions == 2


def test_saved_dataset(spark, tmp_path):
    rows = views.actions(spark, FOLDER).where("pos < 10")
    manifest = sinks.save_dataset(rows, str(tmp_path), "r1", "jsonl", config={"a": 1})
    assert {r.kind for r in manifest.collect()} == {"main", "metadata", "statistics"}
    text_lines = spark.read.text(str(tmp_path / "run_id=r1" / "main"))
    first = json.loads(text_lines.first()[0])
    assert len(first) == 18 and first["actions"][0]["frame_id"] is None
    meta = spark.read.json(str(tmp_path / "run_id=r1" / "metadata")).first()
    assert meta.total_trajectories == 329 and json.loads(meta.generator_config) == {"a": 1}
    with pytest.raises(Exception):
        sinks.save_dataset(rows, str(tmp_path), "r1", "jsonl")
    with pytest.raises(ValueError):
        sinks.save_dataset(rows, str(tmp_path), "r2", "csv")


def test_stream_resumes_without_repeats(spark, tmp_path):
    responses = views.raw_responses(spark, FOLDER)
    halves = [responses.where(F.crc32("record_id") % 2 == i) for i in (0, 1)]
    source, target, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    for half in halves:
        half.write.mode("append").json(source)
        ingest.ingest_available(ingest.read_response_stream(spark, source, 1), target, progress)
    ingest.ingest_available(ingest.read_response_stream(spark, source, 1), target, progress)
    batch = ingest.responses_to_actions(responses).select("trajectory_id", "pos", "timestamp", "url")
    stored = spark.read.parquet(target).select("trajectory_id", "pos", "timestamp", "url")
    assert stored.count() == batch.count()
    assert stored.exceptAll(batch).isEmpty()
