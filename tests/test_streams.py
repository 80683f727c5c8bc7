from pyspark.sql import functions as F

from tests.test_sources import land, node, page
from triagelake.operators.ingest import normalise
from triagelake.operators.scoring import classification_rows, keyword_score, usage_rows
from triagelake.schemas import CLASSIFICATION, ISSUE
from triagelake.streaming.streams import current_state, ingest_stream, record_table, score_stream, score_table

TERMS = {"bug": ["crash"], "docs": ["typo"]}


def run_ingest(spark, tmp_path, checkpoint="c", **caps):
    ingest_stream(
        spark, str(tmp_path / "in"), str(tmp_path / "raw"), str(tmp_path / checkpoint), **caps
    ).awaitTermination()
    return record_table(spark, str(tmp_path / "raw")).read()


def test_ingest_stream_is_restartable(spark, tmp_path, rows):
    land(tmp_path / "in", "a_b", page([node(1), node(2), node(2)]), page([node(2), node(3)]))
    assert rows(run_ingest(spark, tmp_path), "repo", "id") == [("a/b", 1), ("a/b", 2), ("a/b", 3)]
    # later pages overlap the stored ones; the same checkpoint reads new files only
    land(tmp_path / "in", "c_d", page([node(1), node(9)]))
    assert run_ingest(spark, tmp_path).count() == 5
    # a new checkpoint reads everything again and adds nothing
    assert run_ingest(spark, tmp_path, "c2").count() == 5


def test_batches_of_few_files(spark, tmp_path, rows):
    land(tmp_path / "in", "a_b", *[page([node(i), node(i + 1)]) for i in range(4)])
    stored = run_ingest(spark, tmp_path, max_files=1)
    assert rows(stored, "id") == [(0,), (1,), (2,), (3,), (4,)]
    assert stored.select("run_id").distinct().count() == 4


def forget_commit(checkpoint, batch):
    """Make a finished batch look as if the driver was lost before it was committed."""
    for file in (checkpoint / "commits").glob(f"*{batch}*"):
        file.unlink()


def test_repeated_batch_replaces_itself(spark, tmp_path, rows):
    land(tmp_path / "in", "a_b", page([node(1), node(2)]))
    run_ingest(spark, tmp_path)
    forget_commit(tmp_path / "c", 0)
    stored = run_ingest(spark, tmp_path)
    assert rows(stored, "id") == [(1,), (2,)]
    assert stored.select("run_id").distinct().count() == 1


def test_ingest_stream_caps(spark, tmp_path, rows):
    caps = {"repo_caps": {"a/b": 3, "c/d": 5}, "total_cap": 4}
    land(tmp_path / "in", "a_b", page([node(i, createdAt=f"2026-01-0{i}") for i in range(1, 6)]))
    land(tmp_path / "in", "c_d", page([node(i) for i in range(20, 24)]))
    got = rows(run_ingest(spark, tmp_path, **caps), "repo", "id")
    assert got == [("a/b", 3), ("a/b", 4), ("a/b", 5), ("c/d", 20)]
    land(tmp_path / "in", "e_f", page([node(99)]))
    assert run_ingest(spark, tmp_path, **caps).count() == 4


def test_score_stream(spark, tmp_path, rows):
    source, scored = str(tmp_path / "issues"), str(tmp_path / "scored")
    calls = []

    def classify(work):
        calls.append(work.count())
        s = keyword_score(work, TERMS).select(
            F.col("id").alias("issue_id"), F.col("updated_at").alias("issue_updated_at"),
            "choice", "confidence", "input_tokens",
        )
        return classification_rows(s, "v2", "m")

    def run():
        score_stream(
            spark.readStream.schema(ISSUE).parquet(source), classify, scored,
            str(tmp_path / "c"), "v2",
        ).awaitTermination()
        return score_table(spark, scored).read()

    def put(*items):
        data = [(i, "r", i, "t", body, "open", "c", u, None, []) for i, body, u in items]
        spark.createDataFrame(data, ISSUE).write.mode("append").parquet(source)

    put((1, "crash", "u1"), (2, "typo", "u1"), (1, "crash", "u0"))
    assert rows(current_state(run()), "issue_id", "issue_type") == [(1, "bug"), (2, "docs")]
    put((1, "typo", "u2"), (2, "typo", "u1"), (3, "x", "u1"))  # 1 was edited, 2 was not
    ledger = run()
    assert rows(current_state(ledger), "issue_id", "issue_type", "issue_updated_at") == [
        (1, "docs", "u2"), (2, "docs", "u1"), (3, "other", "u1")
    ]
    assert calls == [2, 2]
    assert usage_rows(ledger).count() == 4  # the replaced prediction's cost is kept
    # the last batch again after a crash: it is not scored twice
    forget_commit(tmp_path / "c", 1)
    assert run().count() == 4
    assert calls == [2, 2]


def test_current_state_has_one_row_per_record(spark):
    data = [(1, "bug", 0.1, "u", 1, "m", v, 0.1, None) for v in ("v1", "v2")]
    df = spark.createDataFrame(data, CLASSIFICATION)
    assert current_state(df).count() == 1


def test_normalise_after_stream(spark, tmp_path):
    land(tmp_path / "in", "a_b", page([node(1)]))
    got = normalise(run_ingest(spark, tmp_path)).first()
    assert got["repo"] == "a/b" and got["labels"] == ["bug", "x"]
