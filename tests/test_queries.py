"""Every registered query against its SQL on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from seqtable.operators import checks
from seqtable.plans import registry, second, third, views

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _rows(table):
    names = sorted(table.column_names)
    rows = [tuple(r[n] for n in names) for r in table.select(names).to_pylist()]
    return sorted(rows, key=lambda r: tuple(str(v) for v in r))


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
    return a == b


@pytest.mark.parametrize("name", sorted(registry.QUERIES | second.QUERIES | third.QUERIES))
def test_query_equals_sql(spark, database, name):
    ours = entry_points.queries()[name](spark, FOLDER).toArrow()
    theirs = database.sql(entry_points.oracle_sql()[name]).to_arrow_table()
    assert sorted(ours.column_names) == sorted(theirs.column_names)
    a, b = _rows(ours), _rows(theirs)
    assert len(a) == len(b)
    different = [(x, y) for x, y in zip(a, b) if not all(map(_same, x, y))]
    assert not different, different[:3]


def test_every_query_has_sql():
    names = set(registry.QUERIES | second.QUERIES | third.QUERIES)
    assert names <= set(entry_points.oracle_sql()) and names <= set(entry_points.queries())


def test_entry_runs(spark):
    row = entry_points.entry(spark).first()
    assert (row.n_trajectories, row.n_actions) == (329, 1000)


def test_known_profile(spark):
    """Counts taken from the description of the derived tables."""
    reasons = {r.reason: r.n for r in registry.QUERIES["validation_reasons"](spark, FOLDER).collect()}
    assert reasons == {
        "ACTION_COUNT": 187, "START_NOT_BEFORE_END": 106, "UNKNOWN_ACTION_TYPE": 8, "BAD_URL": 9,
        "UNSAFE_SELECTOR": 4, "SELECT_WITHOUT_OPTION": 3, "COORDINATES_TOO_LARGE": 1,
        "BAD_CONFIDENCE": 11, "DUPLICATE_ACTION_ID": 5, "NO_ACTION_ID": 7, "LONG_SELECTOR": 11,
    }
    report = registry.QUERIES["validation_report"](spark, FOLDER).first()
    assert (report.valid, report.total_trajectories) == (103, 329)
    stats = registry.QUERIES["dedup_stats"](spark, FOLDER).where("enabled").first()
    assert (stats.final_count, stats.exact_duplicates_count) == (293, 36)


def test_partition_count_does_not_matter(spark):
    def verdicts():
        rows = checks.validate(views.actions(spark, FOLDER)).collect()
        return sorted((r.trajectory_id, tuple(r.reasons)) for r in rows)

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(verdicts())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


def test_every_rule_of_validation_is_broken_somewhere(spark):
    found = set()
    for name in ("validate_trajectories", "validate_planted"):
        rows = entry_points.queries()[name](spark, FOLDER).select("reasons").distinct().collect()
        found |= {code for r in rows for code in r.reasons.split(",") if code}
    assert found == {*checks.TRAJECTORY_RULES, *checks.ACTION_RULES}
