import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from triagelake.operators.sampling import balanced_sample, review_sheet, split_parts, stratified_split

SCHEMA = "repo string, issue_id long, title string, body string, human_type string"


def records(n=900, seed=2):
    rng = random.Random(seed)
    kinds = ["bug"] * 6 + ["feature"] * 2 + ["docs", "other", None]
    repos = ["big"] * 7 + ["mid", "mid", "small", None]
    return [(rng.choice(repos), i, f"t{i}", f"b{i}", rng.choice(kinds)) for i in range(n)]


def order(key, seed=42):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest()


@pytest.mark.parametrize("n", [1, 2, 3, 10, 31, 120, 5000])
def test_balanced_sample_takes_turns(spark, rows, n):
    data = records()
    sample = balanced_sample(spark.createDataFrame(data, SCHEMA), n=n)
    want, turn = [], Counter()
    placed = []
    for repo, key, _, _, kind in sorted(data, key=lambda r: order(r[1])):
        placed.append((kind, turn[kind, repo], repo is None, repo or "", key))  # its turn within the group
        turn[kind, repo] += 1
    for kind in ("bug", "feature", "docs", "question"):
        want += [key for *_, key in sorted(p for p in placed if p[0] == kind)][:n]
    assert [r[0] for r in rows(sample, "issue_id")] == sorted(want)


def test_balanced_sample_keeps_columns_and_order_of_columns(spark):
    df = spark.createDataFrame(records(), SCHEMA)
    assert set(balanced_sample(df, n=3).columns) == set(df.columns)


@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.5, 1.0])
def test_split_is_a_partition(spark, rows, fraction):
    data = records()
    split = stratified_split(
        spark.createDataFrame(data, SCHEMA), "human_type", fraction=fraction
    )
    parts = defaultdict(list)
    for kind in ["bug", "feature", "docs", "question", "other"]:
        ids = sorted((r[1] for r in data if r[4] == kind), key=order)
        test = max(1, round(len(ids) * fraction))
        parts["test"] += ids[:test]
        parts["dev"] += ids[test:]
    dev, test = split_parts(split)
    assert [r[0] for r in rows(dev, "issue_id")] == sorted(parts["dev"])
    assert [r[0] for r in rows(test, "issue_id")] == sorted(parts["test"])
    assert "part" not in dev.columns


def test_half_is_rounded_to_even(spark):
    df = spark.range(10).select(F.col("id").alias("issue_id"), F.lit("bug").alias("gold_label"))
    assert split_parts(stratified_split(df))[1].count() == 2  # 2.5
    assert split_parts(stratified_split(df.where("issue_id < 6")))[1].count() == 2  # 1.5


def test_review_sheet(spark, rows):
    data = [r for r in records(300) if r[4] in ("bug", "docs")]
    eval_set = spark.createDataFrame(data, SCHEMA)
    issues = spark.createDataFrame(
        [(r[1], r[1] + 5, ["a", None, "b"]) for r in data if r[1] != data[0][1]],
        "id long, number long, labels array<string>",
    )
    predictions = eval_set.select("issue_id", F.lit("bug").alias("predicted_type"), F.lit(0.5).alias("confidence"))
    sheet = review_sheet(eval_set, issues, predictions, 20)
    got = sheet.collect()
    want = []
    for kind in ("bug", "docs"):
        ids = [r[1] for r in data if r[4] == kind and r[1] != data[0][1]]
        want += sorted(ids, key=lambda k: hashlib.md5(str(k).encode()).hexdigest())[:20]
    assert sorted(r["issue_id"] for r in got) == sorted(want)
    assert {r["github_labels"] for r in got} == {"a|b"} and {r["gold_label"] for r in got} == {""}
    assert Counter(r["number"] - r["issue_id"] for r in got) == {5: len(got)}
    listed = [(r["weak_label"], r["repo"] or "", r["issue_id"]) for r in got]
    assert listed == sorted(listed)


def test_split_does_not_shuffle_the_rows(spark):
    df = spark.createDataFrame(records(), SCHEMA)
    plan = stratified_split(df, "human_type")._jdf.queryExecution().executedPlan().toString()
    # the cut is a written table of known size: the rows meet it in one broadcast join
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
