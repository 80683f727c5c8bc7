import random

import pytest
from pyspark.sql import functions as F

from triagelake.operators.incremental import (
    admit_within_budget,
    admitted_pending,
    pending,
    recorded_spend,
    unscored,
)

ISSUES = "id long, title string, body string, updated_at string"
CLASSES = "issue_id long, issue_updated_at string, classifier_version string"


def test_pending_cases(spark, rows):
    issues = spark.createDataFrame(
        [(i, f"t{i}", "b", "new") for i in range(1, 8)] + [(8, "t8", "b", None), (9, "t9", "b", None)],
        ISSUES,
    )
    classes = spark.createDataFrame(
        [
            (1, "new", "v2"),  # up to date
            (2, "old", "v2"),  # changed
            (3, "new", "v1"),  # other version
            (4, "new", None),  # no version
            (5, None, "v2"),  # no time
            (6, "new", "v2"), (6, "old", "v2"), (6, "older", "v2"), (6, "new", "v1"),
            (8, None, "v2"),  # both without a time: up to date
            (None, "new", "v2"),
        ],
        CLASSES,
    )
    got = [r[0] for r in rows(pending(issues, classes, "v2"), "id")]
    # 6 is listed once per classification that is out of date
    assert got == [2, 3, 4, 5, 6, 6, 6, 7, 9]
    assert [r["id"] for r in pending(issues, classes, "v2", limit=6).collect()] == [2, 3, 4, 5, 6, 6]
    assert pending(issues, classes.limit(0), "v2").count() == 9


def test_pending_with_copies_and_history(spark, rows):
    """One record in many copies and versions, one id with a long history of classifications."""
    issues = spark.createDataFrame(
        [(1, "t", "b", "u1"), (1, "t", "b", "u1"), (1, "t", "b", "u2"), (2, "t", "b", "u1"),
         (None, "t", "b", "u1")], ISSUES
    )
    classes = spark.createDataFrame(
        [(1, "u1", "v2"), (1, "u1", "v2"), (1, "u0", "v2"), (None, "u1", "v2")]
        + [(2, f"h{i}", "v2") for i in range(500)] + [(2, "u1", "v2"), (2, "u1", "v1")],
        CLASSES,
    )
    got = pending(issues, classes, "v2").groupBy("id", "updated_at").count()
    assert {tuple(r) for r in got.collect()} == {
        (1, "u1", 2), (1, "u2", 3), (2, "u1", 501), (None, "u1", 1)
    }


def test_no_shuffle_on_bucketed_tables(spark):
    from triagelake.sources.tables import save_bucketed

    todo = spark.range(500).select(F.col("id").alias("issue_id"), F.lit("t").alias("title"))
    done = todo.select("issue_id").where("issue_id < 300")
    save_bucketed(todo, "todo_b", "issue_id", 4)
    save_bucketed(done, "done_b", "issue_id", 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        left = unscored(spark.table("todo_b"), spark.table("done_b"))
        plan = left._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert left.count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP TABLE todo_b")
        spark.sql("DROP TABLE done_b")


def simulated(costs, cap, reserve, price, spent):
    total, taken = 0, []
    for key, tokens in sorted(costs):
        if spent + total * price / 1e6 >= cap - reserve:
            break
        taken.append(key)
        total += tokens
    return taken


@pytest.mark.parametrize("cap", [0.0, 0.03, 1.0, 7.5, 1e6])
def test_budget_is_the_sequential_loop(spark, rows, cap):
    rng = random.Random(3)
    # ids far apart and clustered, a few very expensive rows, some free ones
    keys = rng.sample(range(10**6), 700) + [2**61 + i for i in range(300)]
    costs = [(k, rng.choice([0, 1, 900, 50_000])) for k in keys]
    df = spark.createDataFrame(costs, "id long, t long")
    usage = spark.createDataFrame(
        [("v2", 0.01), ("v2", 0.005), ("v1", 100.0)], "classifier_version string, estimated_cost_usd double"
    )
    got = admit_within_budget(df, F.col("t"), "v2", usage=usage, cap=cap, reserve=0.02, price=0.5)
    assert [r[0] for r in rows(got, "id")] == simulated(costs, cap, 0.02, 0.5, 0.015)


def test_copies_of_a_key_are_admitted_together(spark, rows):
    df = spark.createDataFrame([(1, 5)] + [(2, 1)] * 1000 + [(3, 5), (4, 5)], "id long, t long")
    got = admit_within_budget(df, F.col("t"), "v2", cap=1005.5, reserve=0.0, price=1e6)
    assert got.count() == 1002 and got.where("id = 4").count() == 0


def test_rows_without_a_key_cost_nothing(spark, rows):
    df = spark.createDataFrame([(None, 1000), (1, 5), (2, 5), (3, 5)], "id long, t long")
    got = admit_within_budget(df, F.col("t"), "v2", cap=9.0, reserve=0.0, price=1e6)
    assert rows(got, "id") == [(1,), (2,)]


def test_recorded_spend_without_rows_is_zero(spark):
    usage = spark.createDataFrame([], "classifier_version string, estimated_cost_usd double")
    assert tuple(recorded_spend(usage, "v2").first()) == ("v2", 0.0)


def test_admitted_pending_is_pending_cut_by_the_budget(spark, rows):
    issues = spark.createDataFrame([(i, "t", "x" * i, "u") for i in range(100)], ISSUES)
    classes = spark.createDataFrame([(i, "u", "v2") for i in range(0, 100, 2)], CLASSES)
    tokens = F.length("body")
    got = admitted_pending(issues, classes, "v2", tokens, cap=0.000101, reserve=0.0, price=1.0)
    assert [r[0] for r in rows(got, "id")] == simulated(
        [(i, i) for i in range(1, 100, 2)], 0.000101, 0.0, 1.0, 0.0
    )
    assert got.columns == ["id", "title", "body", "updated_at"]


def test_unscored_by_version(spark, rows):
    todo = spark.createDataFrame([(1,), (2,), (3,)], "issue_id long")
    done = spark.createDataFrame([(1, "v2"), (2, "v1")], "issue_id long, classifier_version string")
    assert rows(unscored(todo, done)) == [(3,)]
    assert rows(unscored(todo, done, "v2")) == [(2,), (3,)]
