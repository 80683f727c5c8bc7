"""The three end-to-end cases of the quality stage, and one bad row for each other check."""

import math

import pytest

from triagelake.operators import quality as q

ISSUE = "id long, repo string, number int, title string, state string, created_at string, updated_at string"
CLASS = "issue_id long, issue_type string, confidence double, issue_updated_at string, classifier_version string"
GOOD = (1, "owner/repo", 1, "Test issue", "open", "2026-01-01", "2026-01-02")
GOOD_CLASS = (1, "bug", 0.9, "2026-01-02", "v2")


def suite(spark, issues, classes):
    i = spark.createDataFrame(issues, ISSUE)
    c = spark.createDataFrame(classes, CLASS)
    return q.quality_suite(i, c, "v2"), i, c


def violations(results):
    return {r["check"]: r["violations"] for r in results.collect() if r["violations"]}


def test_valid_data_passes(spark):
    results, i, c = suite(spark, [GOOD], [GOOD_CLASS])
    assert len(q.gate(results)) == 8
    assert {r["status"] for r in results.collect()} == {"PASS"}
    assert tuple(q.coverage(i, c, "v2").first()) == (1, 1, 100.0)


def test_invalid_state_fails(spark):
    bad = GOOD[:4] + ("invalid",) + GOOD[5:]
    results, _, _ = suite(spark, [bad], [GOOD_CLASS])
    with pytest.raises(q.QualityError, match="checks failed: 1\nInvalid issue states: 1"):
        q.gate(results)


def test_stale_classification_fails(spark):
    results, _, _ = suite(spark, [GOOD[:6] + ("2026-01-03",)], [GOOD_CLASS])
    with pytest.raises(q.QualityError, match="Stale V2 classifications: 1"):
        q.gate(results)


@pytest.mark.parametrize(
    "issues, classes, expected",
    [
        ([GOOD, GOOD, GOOD], [GOOD_CLASS], {q.DUPLICATE_ISSUES: 1}),
        ([GOOD[:3] + (None,) + GOOD[4:]], [GOOD_CLASS], {q.MISSING_FIELDS: 1}),
        ([GOOD[:4] + (None,) + GOOD[5:]], [GOOD_CLASS], {q.MISSING_FIELDS: 1, q.INVALID_STATES: 1}),
        ([GOOD], [GOOD_CLASS, (9, *GOOD_CLASS[1:]), (None, *GOOD_CLASS[1:])], {q.ORPHANS: 2}),
        ([GOOD], [GOOD_CLASS] * 3, {q.DUPLICATE_CLASSIFICATIONS: 1}),
        ([GOOD], [(1, "spam", *GOOD_CLASS[2:])], {"Invalid V2 classes": 1}),
        ([GOOD], [(1, None, *GOOD_CLASS[2:])], {"Invalid V2 classes": 1}),
        ([GOOD], [(1, "spam", 7.0, "2026-01-02", "v1")], {}),
        ([GOOD], [(1, "spam", 7.0, "2026-01-02", None)], {}),
        ([GOOD], [(1, "bug", -0.1, *GOOD_CLASS[3:])], {"Invalid V2 confidence values": 1}),
        ([GOOD], [(1, "bug", 1.1, *GOOD_CLASS[3:])], {"Invalid V2 confidence values": 1}),
        ([GOOD], [(1, "bug", None, *GOOD_CLASS[3:])], {"Invalid V2 confidence values": 1}),
        ([GOOD], [(1, "bug", math.nan, *GOOD_CLASS[3:])], {"Invalid V2 confidence values": 1}),
        ([GOOD], [(1, "bug", 0.9, None, "v2")], {"Stale V2 classifications": 1}),
        # NULL on both sides is the same time; a NULL id never joins
        ([GOOD[:6] + (None,)], [(1, "bug", 0.9, None, "v2")], {q.MISSING_FIELDS: 1}),
        (
            [(None, *GOOD[1:]), (None, *GOOD[1:])],
            [(None, *GOOD_CLASS[1:]), (None, "bug", 0.9, "x", "v2")],
            {q.MISSING_FIELDS: 2, q.DUPLICATE_ISSUES: 1, q.ORPHANS: 2, q.DUPLICATE_CLASSIFICATIONS: 1},
        ),
        # two copies of the record, three classifications of it, one of them up to date
        (
            [GOOD, GOOD],
            [GOOD_CLASS, (1, "bug", 0.9, "old", "v2"), (1, "bug", 0.9, "older", "v2")],
            {q.DUPLICATE_ISSUES: 1, q.DUPLICATE_CLASSIFICATIONS: 1, "Stale V2 classifications": 4},
        ),
    ],
)
def test_each_check(spark, issues, classes, expected):
    results, _, _ = suite(spark, issues, classes)
    assert violations(results) == expected


def test_empty_tables_pass(spark):
    results, i, c = suite(spark, [], [])
    q.gate(results)
    assert tuple(q.coverage(i, c, "v2").first()) == (0, 0, 0.0)


def test_coverage_of_rows_and_of_ids(spark):
    _, i, c = suite(spark, [GOOD], [GOOD_CLASS, GOOD_CLASS])
    assert tuple(q.coverage(i, c, "v2").first()) == (2, 1, 200.0)
    assert tuple(q.coverage(i, c, "v2", distinct=True).first()) == (1, 1, 100.0)


def test_list_forms_agree_with_counts(spark):
    issues = [GOOD, (2, *GOOD[1:6], "later")]
    classes = [GOOD_CLASS, (2, *GOOD_CLASS[1:]), (7, *GOOD_CLASS[1:])]
    results, i, c = suite(spark, issues, classes)
    assert [r["issue_id"] for r in q.orphans(c, i).collect()] == [7]
    assert [r["issue_id"] for r in q.stale(c, i, "v2").collect()] == [2]
    assert violations(results) == {q.ORPHANS: 1, "Stale V2 classifications": 1}


def test_extra_row_checks(spark):
    i = spark.createDataFrame([GOOD], ISSUE)
    c = spark.createDataFrame([GOOD_CLASS], CLASS)
    check = q.RowCheck("Untitled", i["title"] == "Test issue")
    results = q.quality_suite(i, c, "v2", extra=[(i, [check])])
    assert violations(results) == {"Untitled": 1}


def test_one_grouping_of_both_tables(spark):
    """Keys meet in one union; neither table is joined."""
    results, _, _ = suite(spark, [GOOD], [GOOD_CLASS])
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan
