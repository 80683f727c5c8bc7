"""Joins with a key that holds most rows, and lists that fetch details late."""

import pytest
from pyspark.sql import functions as F

from triagelake.operators.analytics import lowest_examples
from triagelake.operators.joins import balanced_join, heavy_keys
from triagelake.operators.metrics import agreement_mismatches, error_listing
from triagelake.operators.quality import stale


def sides(spark):
    """A third of both sides, and more, at id 1; a NULL id; ids of one side."""
    left = [(1, f"l{i}") for i in range(40)] + [(i, "x") for i in range(2, 30)] + [(None, "n"), (None, "n")]
    right = [(1, f"r{i}") for i in range(20)] + [(i, "y") for i in range(5, 40)] + [(None, "n")]
    return spark.createDataFrame(left, "id long, a string"), spark.createDataFrame(right, "id long, b string")


@pytest.mark.parametrize("heavy", [1, 7, 39, 1000])
def test_equals_a_plain_join(spark, heavy):
    left, right = sides(spark)
    got = balanced_join(left, right, "id", heavy=heavy)
    assert sorted(got.collect()) == sorted(left.join(right, "id").collect()) and got.columns == ["id", "a", "b"]
    odd = balanced_join(left, right, "id", F.col("b") != "r3", heavy)
    assert odd.count() == left.join(right, "id").where("b <> 'r3'").count()


def test_a_heavy_key_is_dealt(spark):
    left, right = sides(spark)
    assert [tuple(r) for r in heavy_keys(left, right, "id", 7).collect()] == [(1, 6)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        dealt = balanced_join(left.repartition(4), right, "id", heavy=7)
        shares = [r["count"] for r in dealt.where("id = 1").groupBy(F.spark_partition_id()).count().collect()]
        assert sum(shares) == 800 and max(shares) <= 400 and len(shares) >= 3
    finally:
        for name in ("autoBroadcastJoinThreshold", "adaptive.enabled"):
            spark.conf.unset(f"spark.sql.{name}")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_stale_with_a_hot_id(spark):
    issues = spark.createDataFrame([(1, "u1"), (1, "u2"), (2, None), (3, "u")], "id long, updated_at string")
    data = [(1, f"u{i % 3}", "v") for i in range(30)] + [(2, "u", "v"), (3, "u", "v"), (3, "t", "w"), (4, "t", "v")]
    classes = spark.createDataFrame(data, "issue_id long, issue_updated_at string, classifier_version string")
    got = stale(classes, issues, "v", heavy=4)
    assert got.columns == ["issue_id", "issue_updated_at", "classifier_version", "updated_at"]
    assert got.where("issue_id = 1").count() == 40 and got.where("issue_id = 2").count() == 1 and got.count() == 41


def test_lowest_examples_skip_unknown_records(spark, rows):
    """The least confident classifications have no record; some records occur twice."""
    data = [(i, "bug", i / 1000, "v") for i in range(300)] + [(299, "docs", 0.299, "v"), (5, "bug", 0.9, "v")]
    classes = spark.createDataFrame(data, "issue_id long, issue_type string, confidence double, classifier_version string")
    issues = spark.createDataFrame(
        [(i, i, f"t{i}") for i in range(100, 290)] + [(100, 7, "again")], "id long, number long, title string")
    got = [tuple(r) for r in lowest_examples(issues, classes, "v", 0.5, 4).collect()]
    assert got == [(7, "again", "bug", 0.1), (100, "t100", "bug", 0.1), (101, "t101", "bug", 0.101), (102, "t102", "bug", 0.102)]
    assert lowest_examples(issues, classes, "v", 0.5, 1000).count() == 191
    assert lowest_examples(issues.limit(0), classes, "v", 0.5, 5).count() == 0


@pytest.mark.parametrize("k", [None, 3, 50])
def test_error_lists_with_copies(spark, k):
    reference = spark.createDataFrame(
        [(i, "bug" if i % 2 else "docs", "r", f"t{i}") for i in range(20)] + [(1, "bug", "r", "copy"), (1, "docs", "r", "other")],
        "issue_id long, human_type string, repo string, title string")
    predictions = spark.createDataFrame(
        [(i, "bug", i / 100) for i in range(20)] + [(1, "docs", 0.99)] * 5, "issue_id long, predicted_type string, confidence double")
    plain = reference.join(predictions, "issue_id").where("human_type <> predicted_type")
    want = sorted(((r.human_type, r.predicted_type, r.confidence, r.repo, r.title) for r in plain.collect()), key=lambda r: -r[2])
    got = [tuple(r) for r in error_listing(reference, predictions, k=k, heavy=2).collect()]
    assert [r[2] for r in got] == [r[2] for r in want[:k]] and len(got) == min(k or 99, len(want))
    assert k == 3 or sorted(got) == sorted(want)


def test_agreement_list(spark):
    issues = spark.createDataFrame([(1, "r", 11, "t1", ["bug"]), (2, "r", 12, "t2", ["docs"])],
        "id long, repo string, number long, title string, labels array<string>")
    classes = spark.createDataFrame([(1, "docs", 0.5), (2, "docs", 0.9)], "issue_id long, issue_type string, confidence double")
    for k in (None, 5):
        got = agreement_mismatches(issues, classes, ["bug", "docs"], k)
        assert got.columns == ["number", "title", "human_type", "issue_type", "confidence"]
        assert [tuple(r) for r in got.collect()] == [(11, "t1", "bug", "docs", 0.5)]
