import pytest
from pyspark.sql import functions as F

from tests.test_sources import land, node, page
from triagelake.functions.fixed import CRITERIA
from triagelake.operators.quality import QualityError
from triagelake.operators.scoring import keyword_scorer, score
from triagelake.plans.triage import TriageRun, run_triage, stored_issues
from triagelake.schemas import CLASSIFICATION
from triagelake.sources.tables import read_ledger

TERMS = {"bug": ["crash"], "docs": ["typo"], "question": ["how"], "feature": ["add"]}


def labelled(i, body, label, **changes):
    return node(i, body=body, labels={"nodes": [{"name": label}]}, **changes)


def make(tmp_path, run_id, **changes):
    def classify(work):
        return score(work, keyword_scorer(TERMS), "v2", "m", CRITERIA["v2"])

    settings = dict(
        landing=str(tmp_path / "in"), root=str(tmp_path / "out"), run_id=run_id, version="v2",
        classify=classify, repo_caps={"a/b": 10, "c/d": 10}, total_cap=100,
    )
    return TriageRun(**{**settings, **changes})


def test_run_and_continue(spark, tmp_path, rows):
    land(tmp_path / "in", "a_b", page([labelled(1, "crash", "bug"), labelled(2, "typo", "bug")]))
    land(tmp_path / "in", "c_d", page([labelled(3, "how", "question"), node(4, body="add")]))
    report = run_triage(spark, make(tmp_path, "r1"))
    assert {r["status"] for r in report["checks"].collect()} == {"PASS"}
    assert tuple(report["coverage"].first()) == (4, 4, 100.0)
    assert tuple(report["agreement"].first())[:2] == (2, 3)
    assert [r["number"] for r in report["mismatches"].collect()] == [2]
    assert report["run"].first()["processed"] == 4
    # the same run again repeats nothing, the next one takes only what is new
    run_triage(spark, make(tmp_path, "r1"))
    land(tmp_path / "in", "e_f", page([node(9)]))  # no cap of its own
    land(tmp_path / "in", "c_d2", page([]))
    land(tmp_path / "in", "a_b", page([labelled(5, "crash", "bug")]))
    report = run_triage(spark, make(tmp_path, "r2"))
    assert report["run"].first()["processed"] == 2
    assert rows(stored_issues(spark, str(tmp_path / "out")), "id") == [(1,), (2,), (3,), (4,), (5,), (9,)]


def test_budget_holds_over_runs(spark, tmp_path):
    land(tmp_path / "in", "a_b", page([labelled(i, "crash" * 100, "bug") for i in range(1, 9)]))
    per_record = 126 / 1e6 * 0.042
    limit = {"cap_usd": per_record * 2.5, "reserve_usd": 0.0}
    run_triage(spark, make(tmp_path, "r1", **limit))
    ledger = read_ledger(spark, str(tmp_path / "out/scored"), CLASSIFICATION)
    assert ledger.count() == 3  # the third one was started below the cap
    run_triage(spark, make(tmp_path, "r2", **limit))
    assert read_ledger(spark, str(tmp_path / "out/scored"), CLASSIFICATION).count() == 3


def test_gate_stops_the_run(spark, tmp_path):
    land(tmp_path / "in", "a_b", page([labelled(1, "crash", "bug", state="WEIRD")]))
    with pytest.raises(QualityError, match="Invalid issue states: 1"):
        run_triage(spark, make(tmp_path, "r1"))


def test_edits_are_taken_and_scored_again(spark, tmp_path, rows):
    land(tmp_path / "in", "a_b", page([labelled(1, "crash", "bug"), labelled(2, "typo", "docs")]))
    run_triage(spark, make(tmp_path, "r1"))
    edit = labelled(1, "typo", "bug", updatedAt="2026-02-01T00:00:00Z")
    land(tmp_path / "in", "a_b", page([edit, labelled(2, "typo", "docs")]))
    assert run_triage(spark, make(tmp_path, "r2"))["run"].first()["processed"] == 0  # skipped
    report = run_triage(spark, make(tmp_path, "r3", refresh=True))
    assert report["run"].first()["processed"] == 1
    assert rows(report["agreement"])[0][:2] == (1, 2)
    assert report["usage"].first()["total_tokens"] == 6
