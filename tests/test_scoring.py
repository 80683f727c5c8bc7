import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from triagelake.functions.columns import (
    estimated_tokens,
    parsed_response,
    repo_directory,
    repo_from_path,
    repo_name,
    repo_owner,
    scoring_request,
)
from triagelake.functions.fixed import CRITERIA
from triagelake.operators.scoring import (
    exchange,
    keyword_score,
    keyword_score_versions,
    keyword_scorer,
    resume_scores,
    score,
    usage_rows,
)
from triagelake.schemas import CLASSIFICATION, PREDICTION

TERMS = {"bug": ["crash", "fails"], "docs": ["typo", "crash"], "question": ["how"]}
TEXTS = [
    "It crashes. CRASH! fails, fails",
    "how to fix a typo? how",
    "étype typo-typo typoé",
    "nothing here",
    "",
    None,
    "x" * 5000 + " how",
    "crash",
]


def frame(spark):
    return spark.createDataFrame(
        [(i, "t", t, "u") for i, t in enumerate(TEXTS)],
        "id long, title string, body string, updated_at string",
    )


def test_keyword_score(spark):
    got = [tuple(r) for r in keyword_score(frame(spark), TERMS).orderBy("id")
           .select("choice", "confidence", "input_tokens").collect()]
    assert got == [
        ("bug", 0.75, 8),  # crash counts for both of its classes
        ("question", 2 / 3, 6),
        ("docs", 1.0, 6),
        ("other", 0.0, 4),
        ("other", 0.0, 1),
        ("other", 0.0, 1),
        ("question", 1.0, 1252),  # the whole text is searched and sent
        ("bug", 0.5, 2),
    ]


def test_versions_share_one_pass(spark, rows):
    versions = {"v2": TERMS, "v3": {"bug": ["fails"], "docs": ["nothing"]}}
    both = keyword_score_versions(frame(spark), versions)
    for version, terms in versions.items():
        one = both.where(F.col("classifier_version") == version)
        assert rows(one, "id", "choice", "confidence") == rows(
            keyword_score(frame(spark), terms), "id", "choice", "confidence"
        )
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    with pytest.raises(ValueError):
        keyword_score(frame(spark), {"bug": ["Crash!"]})


def test_batch_scorer_agrees_with_the_native_one(spark, rows):
    df = frame(spark)  # with a long text, and a word of two classes
    scored = score(df, keyword_scorer(TERMS), "v2", "m", CRITERIA["v2"], F.lit("2026-01-01").cast("timestamp"))
    native = keyword_score(df, TERMS)
    assert rows(scored, "issue_id", "issue_type", "confidence", "input_tokens") == rows(
        native, "id", "choice", "confidence", "input_tokens"
    )
    assert scored.columns == CLASSIFICATION.fieldNames()
    assert [f.dataType for f in scored.schema] == [f.dataType for f in CLASSIFICATION]
    cost = scored.where("issue_id = 0").first()["estimated_cost_usd"]
    assert cost == 8 / 1_000_000 * 0.042
    assert usage_rows(scored).count() == scored.count()


def test_request_document(spark):
    df = spark.createDataFrame([(None, "ü" * 4001)], "title string, body string")
    for chars, sent in ((4000, 4000), (None, 4001)):
        request = scoring_request(F.col("title"), F.col("body"), "m", CRITERIA["v3"], chars)
        doc = json.loads(df.select(request).first()[0])
        assert doc["state"] == {"title": "", "body": "ü" * sent}
    assert doc["questions"]["issue_type"]["type"] == "choice"
    assert list(doc["questions"]["issue_type"]["criteria"]) == ["bug", "feature", "docs", "question", "other"]
    assert doc["model"] == "m"


def test_response_without_tokens_is_an_error(spark):
    good = '{"answers":{"issue_type":{"choice":"bug","confidence":0.5}},"usage":{"input_tokens":7}}'
    df = spark.createDataFrame([(good,)], "r string")
    assert tuple(df.select(parsed_response(F.col("r"))).first()[0]) == ("bug", 0.5, 7)
    for bad in ('{"answers":{"issue_type":{"choice":"bug","confidence":0.5}}}', "{}"):
        with pytest.raises(Exception, match="without usage.input_tokens"):
            spark.createDataFrame([(bad,)], "r string").select(parsed_response(F.col("r"))).collect()


def test_client_is_made_once_per_task(spark):
    def factory():
        made = []
        made.append(object())
        return lambda requests: pd.Series([f"{id(made[0])}"] * len(requests))

    df = spark.range(1000).repartition(2).select("id", F.lit("q").alias("request"))
    assert exchange(df, factory).select("response").distinct().count() <= 2


def test_few_requests_are_objects_at_once(spark):
    """A scorer gets the requests of a task in small parts, in order, and all other columns pass."""

    def factory():
        return lambda requests: pd.Series([f"{len(requests)}"] * len(requests), index=requests.index)

    df = spark.range(1000).repartition(1).select(
        "id", F.array(F.lit("a"), F.lit(None)).alias("tags"), F.lit("q").alias("request"),
        F.timestamp_seconds("id").alias("at"),
    )
    got = exchange(df, factory)
    assert got.columns == ["id", "tags", "at", "response"]
    assert max(int(r[0]) for r in got.select("response").distinct().collect()) <= 256
    assert got.drop("response").exceptAll(df.drop("request")).count() == 0 and got.count() == 1000


def test_estimated_tokens(spark):
    df = spark.createDataFrame([("",), (None,), ("abc",), ("abcd",), ("é" * 9000,)], "b string")
    assert [r[0] for r in df.select(estimated_tokens(F.col("b"))).collect()] == [1, 1, 1, 2, 2251]
    assert [r[0] for r in df.select(estimated_tokens(F.col("b"), 4000)).collect()] == [1, 1, 1, 2, 1001]


def test_both_scoring_routes_agree_on_all_documents(spark, sf_dir):
    from triagelake.plans.queries import QUERIES

    native, batch = (QUERIES[q](spark, sf_dir) for q in ("keyword_score", "batch_score"))
    assert native.exceptAll(batch).count() == 0 and batch.exceptAll(native).count() == 0


def test_a_scorer_runs_once_in_an_upsert(spark, tmp_path):
    from triagelake.sources import tables

    calls = spark.sparkContext.accumulator(0)

    def factory():
        answer = keyword_scorer(TERMS)()

        def counted(requests):
            calls.add(len(requests))
            return answer(requests)

        return counted

    scored = score(frame(spark), factory, "v2", "m", CRITERIA["v2"])
    assert tables.upsert_latest(spark.createDataFrame([], CLASSIFICATION), scored).count() == len(TEXTS)
    assert calls.value == len(TEXTS)


def test_repository_names(spark):
    paths = [("/d/own_a_b/x.json",), ("s3://k/raw/dir=own_name/x.json",), ("/d/plain/x.json",)]
    df = spark.createDataFrame(paths, "p string").select(repo_from_path(F.col("p")).alias("r"))
    assert [r[0] for r in df.collect()] == ["own/a_b", "own/name", "plain"]
    one = df.limit(1).select(repo_owner(F.col("r")), repo_name(F.col("r")), repo_directory(F.col("r")))
    assert tuple(one.first()) == ("own", "a_b", "own_a_b")


def test_resume_scores(spark, rows):
    todo = spark.createDataFrame([(1, "t", "crash"), (2, "t", "how"), (3, "t", None)],
                                 "issue_id long, title string, body string")
    done = spark.createDataFrame([(1, "v2"), (2, "v1")], "issue_id long, classifier_version string")
    got = resume_scores(todo, done, keyword_scorer(TERMS), "v2", "m", CRITERIA["v2"], parallel=2)
    assert rows(got, "issue_id", "predicted_type") == [(2, "question"), (3, "other")]
    assert got.columns == PREDICTION.fieldNames()
