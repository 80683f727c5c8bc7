"""The whole chain: collect, normalise, score within the budget, check, evaluate, report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triagelake.functions.columns import estimated_tokens
from triagelake.functions.fixed import (
    CLASSES,
    MAX_COST_USD,
    RESERVE_USD,
    WEAK_CLASSES,
)
from triagelake.operators import analytics, metrics
from triagelake.operators.incremental import admitted_pending
from triagelake.operators.ingest import (
    edited_records,
    ingest,
    latest_per_key,
    normalise,
    records,
)
from triagelake.operators.quality import gate, quality_suite
from triagelake.operators.scoring import usage_rows
from triagelake.schemas import CLASSIFICATION
from triagelake.session import materialise
from triagelake.sources.pages import scan_pages
from triagelake.sources.tables import append_ledger, has_run, read_ledger
from triagelake.streaming.streams import STORED, current_state


@dataclass(frozen=True)
class TriageRun:
    """What one run works on. ``classify`` turns (id, title, body, updated_at) rows into rows of
    the classifications table; repeating a run with the same ``run_id`` repeats no finished step."""

    landing: str
    root: str
    run_id: str
    version: str
    classify: Callable[[DataFrame], DataFrame]
    repo_caps: dict[str, int] | None = None  # REPO_CAPS and TOTAL_CAP are values to give
    total_cap: int | None = None
    cap_usd: float = MAX_COST_USD
    reserve_usd: float = RESERVE_USD
    classes: tuple[str, ...] = tuple(CLASSES)
    weak_classes: tuple[str, ...] = tuple(WEAK_CLASSES)
    multi_line: bool = True
    refresh: bool = False  # also take edits of stored records; they are then scored again


def stored_issues(spark: SparkSession, root: str) -> DataFrame:
    """The issues of all runs: stored records, each replaced by its last edit if it has one.
    A view over the stored files; nothing is rewritten when records are added."""
    key = ["repo", "id"]
    raw = read_ledger(spark, f"{root}/raw", STORED).drop("run_id")
    edits = latest_per_key(read_ledger(spark, f"{root}/edits", STORED).drop("run_id"), key)
    kept = raw.join(edits.select(*key), key, "left_anti")
    return normalise(kept.unionByName(edits))


def collect(spark: SparkSession, run: TriageRun) -> DataFrame:
    """Append the run's new records, and its edits if wanted; gives the issues of all runs."""
    raw, edits = f"{run.root}/raw", f"{run.root}/edits"
    if has_run(spark, raw, run.run_id) and (not run.refresh or has_run(spark, edits, run.run_id)):
        return stored_issues(spark, run.root)
    incoming = materialise(records(scan_pages(spark, run.landing, run.multi_line)))  # parsed once
    stored = read_ledger(spark, raw, STORED).where(F.col("run_id") != run.run_id)
    if run.refresh and not has_run(spark, edits, run.run_id):
        before = stored.unionByName(read_ledger(spark, edits, STORED))
        append_ledger(edited_records(incoming, before), edits, run.run_id)
    if not has_run(spark, raw, run.run_id):
        taken = ingest(incoming, stored, run.repo_caps, run.total_cap)
        append_ledger(taken, raw, run.run_id)
    return stored_issues(spark, run.root)


def classify(spark: SparkSession, run: TriageRun, issues: DataFrame) -> DataFrame:
    """Score what is pending and affordable; gives all scored rows, which are the ledger.

    Costs are estimated before scoring. A scorer that counts tokens in another way may overshoot
    by the difference within one run; the next run starts from the recorded cost, so split the
    work into runs small enough for ``reserve_usd`` to absorb it.
    """
    scored = f"{run.root}/scored"
    if not has_run(spark, scored, run.run_id):
        earlier = read_ledger(spark, scored, CLASSIFICATION)
        work = admitted_pending(
            issues,
            current_state(earlier),
            run.version,
            estimated_tokens(F.col("body")),
            usage=usage_rows(earlier),
            cap=run.cap_usd,
            reserve=run.reserve_usd,
        )
        append_ledger(run.classify(work), scored, run.run_id)
    return read_ledger(spark, scored, CLASSIFICATION)


def run_triage(spark: SparkSession, run: TriageRun) -> dict[str, DataFrame]:
    """One run of all stages. Raises when a quality check fails, before anything is reported."""
    issues = collect(spark, run)
    scored = classify(spark, run, issues)
    # written once for all parts, which need no texts
    state, issues = materialise(current_state(scored)), materialise(issues.drop("body"))
    usage = usage_rows(scored)
    checks = quality_suite(issues, state, run.version, list(run.classes))
    gate(checks)
    weak = list(run.weak_classes)
    return {
        "checks": checks,
        "agreement": metrics.agreement(issues, state, weak),
        "agreement_counts": metrics.agreement_counts(issues, state, weak),
        "mismatches": metrics.agreement_mismatches(issues, state, weak),
        "run": analytics.run_summary(usage_rows(scored.where(F.col("run_id") == run.run_id))),
        **analytics.report(issues, state, usage, run.version),
    }
