import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from triagelake.functions.fixed import CLASSES
from triagelake.operators import analytics, metrics
from triagelake.operators.labels import (
    exact_label_class,
    label_counts,
    label_search,
    top_labels,
    weak_labels,
)

ISSUES = "id long, repo string, number long, title string, body string, state string, labels array<string>"


def issue(i, repo, labels):
    return (i, repo, i, f"t{i}", None, "open", labels)


def test_exact_label_class(spark):
    cases = [["bug"], ["docs"], ["bug", "bug"], ["bug", "docs"], [], None, ["Bug"], ["other"], [None]]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "id int, labels array<string>")
    got = [r[0] for r in df.orderBy("id").select(exact_label_class(F.col("labels"))).collect()]
    assert got == ["bug", "docs"] + [None] * 7


def test_weak_labels(spark, rows):
    df = spark.createDataFrame(
        [
            issue(1, "pytorch/pytorch", ["module: docs", "topic: docs", "triaged"]),  # one class twice
            issue(2, "pytorch/pytorch", ["feature", "module: docs"]),  # two classes
            issue(3, "pytorch/pytorch", ["triaged"]),  # none
            issue(4, "nobody/nothing", ["bug"]),  # unknown repository
            issue(5, "microsoft/vscode", ["*question", None]),
            issue(6, "microsoft/vscode", []),
            issue(7, "microsoft/vscode", None),
            issue(8, "kubernetes/kubernetes", ["bug"]),  # another repository's label
        ],
        ISSUES,
    )
    got = weak_labels(df)
    assert rows(got, "issue_id", "human_type", "body") == [(1, "docs", ""), (5, "question", "")]
    assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()


def test_label_profile(spark, rows):
    df = spark.createDataFrame(
        [issue(1, "a", ["Bugfix", "x"]), issue(2, "a", ["x", "y"]), issue(3, "b", ["DOCS", None]),
         issue(4, "b", []), issue(5, "b", None)],
        ISSUES,
    )
    assert [tuple(r) for r in label_search(df).collect()] == [("a", "Bugfix", 1), ("b", "DOCS", 1)]
    assert rows(top_labels(df.where("repo = 'a'"), 2), "label", "n", "rank") == [
        ("Bugfix", 1, 2), ("x", 2, 1)
    ]
    assert label_counts(df).where("repo = 'b'").count() == 2


def reference_metrics(pairs, classes):
    matrix = Counter(pairs)
    out = {}
    for c in classes:
        tp = matrix[(c, c)]
        fp = sum(matrix[(a, c)] for a in classes if a != c)
        fn = sum(n for (a, p), n in matrix.items() if a == c and p != c)
        p = tp / (tp + fp) if tp + fp else 0.0
        r = tp / (tp + fn) if tp + fn else 0.0
        out[c] = (tp, fp, fn, p, r, 2 * p * r / (p + r) if p + r else 0.0)
    return out


@pytest.fixture
def judged(spark):
    rng = random.Random(9)
    actual = [rng.choice(CLASSES[:4] + ["bug"] * 5) for _ in range(400)]  # no record is 'other'
    predicted = [a if rng.random() < 0.7 else rng.choice([*CLASSES, "spam"]) for a in actual]
    gold = spark.createDataFrame([(i, a, "r", f"t{i}") for i, a in enumerate(actual)],
                                 "issue_id long, gold_label string, repo string, title string")
    preds = spark.createDataFrame(
        [(i, p, i / 400, "v2") for i, p in enumerate(predicted)]
        + [(i, "bug", 0.5, "v3") for i in range(400)] + [(999, "bug", 0.5, "v2")],
        "issue_id long, predicted_type string, confidence double, classifier_version string",
    )
    return gold, preds, list(zip(actual, predicted))


def test_metrics_against_plain_counts(spark, judged):
    gold, preds, pairs = judged
    matrix = metrics.label_pairs(gold, preds.where("classifier_version = 'v2'"), "gold_label")
    want = reference_metrics(pairs, CLASSES)
    got = {r["class"]: tuple(r)[1:] for r in metrics.class_metrics(matrix).collect()}
    assert got == want
    f1 = sum(want[c][5] for c in CLASSES) / 5
    assert metrics.macro_f1(matrix).first()[0] == f1
    four = metrics.macro_f1(matrix, averaged=CLASSES[:4]).first()[0]
    assert four == sum(want[c][5] for c in CLASSES[:4]) / 4
    acc = metrics.accuracy(matrix).first()
    assert (acc["correct"], acc["total"]) == (sum(a == p for a, p in pairs), 400)
    assert acc["unexpected"] == sum(p == "spam" for _, p in pairs)


def test_confusion_is_dense(spark, judged):
    gold, preds, pairs = judged
    matrix = metrics.label_pairs(gold, preds.where("classifier_version = 'v2'"), "gold_label")
    dense = {(r["actual"], r["predicted"]): r["n"] for r in metrics.confusion(matrix).collect()}
    assert len(dense) == 25 and dense[("other", "bug")] == 0
    assert all(dense[k] == n for k, n in Counter(pairs).items() if k[1] != "spam")
    wide = {r["actual"]: r.asDict() for r in metrics.confusion_wide(matrix).collect()}
    assert all(wide[a][p] == n for (a, p), n in dense.items())


def test_compare_versions(spark, judged):
    gold, preds, _ = judged
    got = {r["classifier_version"]: r for r in metrics.compare_versions(gold, preds, "v2").collect()}
    assert got["v2"]["accepted"] is None and got["v3"]["accepted"] is False
    other = metrics.compare_versions(gold, preds, "v3").where("classifier_version = 'v2'").first()
    assert other["accepted"] is True


def test_nothing_joined_gives_null_accuracy(spark, judged):
    gold, preds, _ = judged
    empty = metrics.label_pairs(gold.limit(0), preds, "gold_label")
    assert metrics.accuracy(empty).first()["accuracy"] is None
    assert [r["f1"] for r in metrics.class_metrics(empty).collect()] == [0.0] * 5


def test_error_listing(spark, judged):
    gold, preds, pairs = judged
    errors = metrics.error_listing(gold, preds.where("classifier_version = 'v2'"), "gold_label", None)
    got = [r["confidence"] for r in errors.collect()]
    assert got == sorted((i / 400 for i, (a, p) in enumerate(pairs) if a != p), reverse=True)
    top = metrics.error_listing(gold, preds, "gold_label", 3)
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_agreement(spark):
    issues = spark.createDataFrame(
        [issue(1, "a", ["bug"]), issue(2, "a", ["docs"]), issue(3, "a", ["bug", "docs"])], ISSUES
    )
    classes = spark.createDataFrame(
        [(1, "bug", 0.4, "v1"), (1, "docs", 0.9, "v2"), (2, "docs", 0.5, "v2"), (3, "bug", 0.5, "v2"),
         (2, None, None, "v2")],
        "issue_id long, issue_type string, confidence double, classifier_version string",
    )
    assert tuple(metrics.agreement(issues, classes).first()) == (2, 4, 0.5)
    assert tuple(metrics.agreement(issues, classes, version="v1").first()) == (1, 1, 1.0)
    assert metrics.agreement(issues.limit(0), classes).first()["agreement"] is None
    wrong = metrics.agreement_mismatches(issues, classes).collect()
    assert [tuple(r) for r in wrong] == [(1, "t1", "bug", "docs", 0.9)]


def test_token_stats_need_rows(spark):
    df = spark.createDataFrame([(10,), (20,), (None,)], "input_tokens int")
    assert tuple(metrics.token_stats(df).first()) == (30, 15.0)
    with pytest.raises(Exception, match="no predictions found"):
        metrics.token_stats(df.limit(0)).collect()


def test_report(spark):
    issues = spark.createDataFrame([issue(i, "ab"[i % 2], []) for i in range(30)], ISSUES)
    classes = spark.createDataFrame(
        [(i, "bug" if i % 3 else "docs", i / 30, "v2") for i in range(25)] + [(1, "bug", 0.1, "v1")],
        "issue_id long, issue_type string, confidence double, classifier_version string",
    )
    usage = spark.createDataFrame(
        [(1, "v2", 1000, 0.000042), (1, "v2", 500, 0.000021), (1, "v1", 9, 1.0)],
        "issue_id long, classifier_version string, input_tokens int, estimated_cost_usd double",
    )
    report = analytics.report(issues, classes, usage, "v2")
    assert len(report) == 8
    assert tuple(report["usage"].first()) == (1500, 0.000063)
    assert tuple(report["low_confidence"].first()) == (18,)
    assert [r["number"] for r in report["lowest_examples"].collect()] == list(range(10))
    assert report["classes"].first()["issue_type"] == "bug"
    assert report["repos"].count() == 2
    nan = classes.withColumn("confidence", F.lit(float("nan")))
    assert str(analytics.avg_confidence(nan, "v2").first()["avg_confidence"]) == "nan"
    none = analytics.usage_totals(usage, "v9").first()
    assert tuple(none) == (0, 0.0)


def test_run_summary(spark):
    usage = spark.createDataFrame([(1000,), (3000,)], "input_tokens int")
    got = analytics.run_summary(usage, price=0.5).first().asDict()
    assert got == {"processed": 2, "input_tokens": 4000, "average_tokens": 2000.0, "cost_usd": 0.002,
                   "projected_cost_usd": 100.0}
    assert analytics.run_summary(usage.limit(0)).first()["processed"] == 0


@pytest.mark.parametrize("cost, total", [(1e17, 2e17), (4e-13, 8e-13)])
def test_sums_keep_their_range_and_precision(spark, cost, total):
    from triagelake.operators.analytics import usage_totals

    usage = spark.createDataFrame([("v", 1, cost), ("v", 2, cost)], "classifier_version string, input_tokens int, estimated_cost_usd double")
    assert usage_totals(usage, "v").first()["total_cost_usd"] == total


def test_one_id_with_most_rows_on_both_sides(spark, rows):
    """Nine million pairs of one id come from products of counts."""
    many = spark.range(3000)
    side = F.when(F.col("id") % 3 == 0, "a").otherwise("b")
    gold = many.select(F.lit(1).alias("issue_id"), side.alias("gold_label")).unionByName(
        many.select((F.col("id") + 2).alias("issue_id"), F.lit("a").alias("gold_label"))
    )
    preds = many.select(F.lit(1).alias("issue_id"), side.alias("predicted_type")).unionByName(
        many.select((F.col("id") + 2).alias("issue_id"), F.lit("b").alias("predicted_type"))
    )
    assert rows(metrics.label_pairs(gold, preds, "gold_label"), "actual", "predicted", "n") == [
        ("a", "a", 10**6), ("a", "b", 2 * 10**6 + 3000), ("b", "a", 2 * 10**6), ("b", "b", 4 * 10**6)
    ]
