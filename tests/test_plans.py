"""The plans that matter at scale: pruned scans, early limits, no Python where none is needed."""

import re

import pytest
from pyspark.sql import functions as F

from triagelake.operators import sampling
from triagelake.plans import model, queries as q


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(text):
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text)]


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(q.low_confidence(spark, sf_dir))
    assert "EqualTo(l_linestatus,F)" in text
    assert scanned(text) == [{"l_quantity", "l_linestatus"}]


def test_sampling_and_splitting_read_no_texts(spark, sf_dir):
    for query in (q.balanced_sample, q.stratified_split):
        assert all("text" not in columns for columns in scanned(plan(query(spark, sf_dir))))


def test_deciding_what_is_pending_reads_texts_once(spark, sf_dir):
    texts = [columns for columns in scanned(plan(q.pending(spark, sf_dir))) if "text" in columns]
    assert len(texts) == 1


def test_groups_are_limited_before_the_shuffle(spark, sf_dir):
    text = plan(q.top_labels(spark, sf_dir))
    assert re.search(r"WindowGroupLimit .*_lane.*Partial", text)
    assert re.search(r"WindowGroupLimit .*Final", text)


@pytest.mark.parametrize("n", [3, 2000])
def test_a_sample_shuffles_counts_and_no_keys(spark, sf_dir, n):
    rows = model.order_issues(spark, sf_dir).select(
        F.col("id").alias("issue_id"), "repo", F.col("state").alias("human_type"))
    keys = sampling.balanced_keys(rows, n=n, classes=["open", "closed"])
    text = plan(keys)
    assert "Exchange hashpartitioning" not in text and "Window" not in text and "BroadcastHashJoin" in text
    assert keys.count() == 2 * n


def test_titles_are_fetched_for_the_first_rows_only(spark, sf_dir):
    text = plan(q.lowest_examples(spark, sf_dir))
    assert "Exchange hashpartitioning" not in text


@pytest.mark.parametrize("name", ["mismatches", "lowest_examples", "pending_first"])
def test_top_rows_without_a_full_sort(spark, sf_dir, name):
    assert "TakeOrderedAndProject" in plan(q.QUERIES[name](spark, sf_dir))


def test_python_only_where_a_scorer_is_called(spark, sf_dir):
    for name in ("batch_score", "resume_scores"):
        assert "MapInPandas" in plan(q.QUERIES[name](spark, sf_dir))
    for name in ("keyword_score", "scoring_request", "class_metrics", "quality_suite", "map_labels"):
        text = plan(q.QUERIES[name](spark, sf_dir))
        assert "Python" not in text and "Pandas" not in text


def test_label_map_needs_no_shuffle(spark, sf_dir):
    from triagelake.operators.labels import weak_labels

    rows = model.eval_set(spark, sf_dir).select(
        "repo", F.col("issue_id").alias("id"), "title", "body", F.array("human_type").alias("labels")
    )
    text = plan(weak_labels(rows, model.LABEL_MAP))
    assert "Exchange hashpartitioning" not in text and "explode" not in text


def test_few_keys_are_sent_to_the_texts(spark, tmp_path):
    from triagelake.operators.incremental import pending
    from triagelake.operators.ingest import new_records

    made = spark.range(200).select(
        F.lit("r").alias("repo"), "id", F.lit("t").alias("title"), F.lit("b").alias("body"),
        F.lit("c").alias("created_at"), F.lit("u").alias("updated_at"),
    )
    made.write.parquet(str(tmp_path / "issues"))
    issues = spark.read.parquet(str(tmp_path / "issues"))
    done = spark.range(190).select(
        F.col("id").alias("issue_id"), F.lit("u").alias("issue_updated_at"), F.lit("v").alias("classifier_version")
    )
    left = pending(issues, done, "v")
    assert "Exchange hashpartitioning" not in plan(left) and "BroadcastHashJoin" in plan(left)
    assert left.count() == 10
    new = new_records(issues, issues.where("id < 150"))
    assert "SortAggregate" not in plan(new) and new.count() == 50


def test_collecting_reads_each_table_once(spark, sf_dir):
    from triagelake.operators import ingest

    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(q.new_records(spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert text.count("FileScan") == 2 and text.count("Exchange hashpartitioning") == 2
    assert re.search(r"Exchange.*\n.*WindowGroupLimit", text)  # one row of a key in each task moves
    orders = model.order_issues(spark, sf_dir)
    text = plan(ingest._seen_keys(orders, orders.where("state = 'pending'")))
    assert text.count("FileScan") == 2 and text.count("Exchange") == 1
    taken = plan(q.capped_ingest(spark, sf_dir))
    assert taken.count("orders.parquet") == 1  # what is stored is known from the written keys


def shuffled(node):
    """(columns, rows written) of every exchange of an executed plan."""
    if node.nodeName() == "AdaptiveSparkPlan":
        return shuffled(node.executedPlan())
    if node.nodeName().endswith("QueryStage"):
        return shuffled(node.plan())
    children = node.children()
    below = [x for i in range(children.size()) for x in shuffled(children.apply(i))]
    if node.nodeName() == "Exchange":
        below.append((node.output().toString(), node.metrics().apply("shuffleRecordsWritten").value()))
    return below


def test_texts_that_are_scored_do_not_move(spark, tmp_path):
    from triagelake.operators.incremental import unscored_rows

    spark.range(20_000).select(
        F.col("id").alias("issue_id"), F.repeat(F.md5(F.col("id").cast("string")), F.lit(9)).alias("body")
    ).unionByName(spark.createDataFrame([(None, "n")], "issue_id long, body string")).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    done = spark.range(20_000).where("id % 50 > 0").select(F.col("id").alias("issue_id"))
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    }
    before = {name: spark.conf.get(name, None) for name in limits}
    for name, value in limits.items():
        spark.conf.set(name, value)
    try:
        left = unscored_rows(rows, done)
        query = left._jdf.queryExecution()
        assert "might_contain" in query.executedPlan().toString()
        assert left._jdf.collectAsList().size() == 401
        moved = [n for columns, n in shuffled(query.executedPlan()) if "body" in columns]
        assert len(moved) == 1 and 401 <= moved[0] < 0.05 * 20_000
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_times_of_other_versions_are_not_grouped(spark):
    """Classifications of an id in other versions are one entry of a task, whatever their times; all are counted."""
    from triagelake.operators.quality import key_violations

    issues = spark.createDataFrame([(1, "t7"), (2, None)], "id long, updated_at string").coalesce(1)
    rows = spark.range(1000).coalesce(1).select(
        F.lit(1).cast("long").alias("issue_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("issue_updated_at"),
        F.when(F.col("id") < 10, "v").when(F.col("id") < 900, "w").alias("classifier_version"),
    )
    found = key_violations(issues, rows, "v")
    assert sorted(tuple(r) for r in found.collect()) == [
        ("Classification IDs missing from issues", 0), ("Duplicate classification issue IDs", 1),
        ("Duplicate issue IDs", 0), ("Stale V classifications", 9),
    ]
    text = found._jdf.queryExecution().analyzed().toString()
    assert re.search(r"CASE WHEN .*classifier_version.* THEN issue_updated_at", text)  # grouped by no other time
