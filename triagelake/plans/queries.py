"""Every operator as a query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triagelake.functions.columns import (
    estimated_tokens,
    parsed_response,
    repo_name,
    repo_owner,
    scoring_request,
    scoring_response,
)
from triagelake.functions.fixed import BODY_CHARS, CRITERIA
from triagelake.operators import analytics, ingest, incremental, labels, metrics, quality, sampling
from triagelake.operators.scoring import (
    classification_rows,
    exchange,
    keyword_score,
    keyword_scorer,
    resume_scores as resume,
    score,
    usage_rows,
)
from triagelake.plans import model as m
from triagelake.plans.triage import TriageRun, run_triage
from triagelake.schemas import (
    CLASSIFICATION,
    CLASSIFICATION_BASE,
    ISSUE,
    USAGE,
    ensure_columns,
)
from triagelake.session import scratch_path
from triagelake.sources import pages, sheets, tables
from triagelake.sources.buckets import BucketedTable
from triagelake.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]

V = m.VERSION
KNOWN = [*m.LANGUAGES, "other"]
# Parameters of the queries over order lines: current version and allowed classes.
LINE_VERSION = "F"
LINE_CLASSES = ["A", "N"]
LOW, EXAMPLES = 0.6, 10
BUDGET = {"cap": 0.0095, "reserve": 0.002}
PENDING_BUDGET = {"cap": 0.0100, "reserve": 0.002}
ORDER_BUDGET = {"cap": 100.0, "reserve": 5.0}
ORDER_CAPS = {
    "1-URGENT": 4_000,
    "2-HIGH": 2_000,
    "3-MEDIUM": 1_000,
    "4-NOT SPECIFIED": 12_000,
    "5-LOW": 1_000_000,
}
TOTAL_CAP, LOW_TOTAL_CAP = 62_000, 8_000
SEARCH_TERMS = ["qual", "tox", "e"]
SAMPLE, REVIEW, TOP = 50, 100, 3


def _joined_labels(issues: DataFrame) -> DataFrame:
    return issues.withColumn("labels", F.array_join("labels", "|"))


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    rows = m.table(spark, sf, "documents").select(F.col("doc_id").alias("issue_id"), "text")
    return keyword_score(rows, m.TERMS[V], "text").drop("text")


# Sources, sinks and tables


def ingest_pages(spark: SparkSession, sf: str) -> DataFrame:
    nodes = pages.scan_pages(spark, m.land_pages(spark, sf), multi_line=False)
    return ingest.records(nodes).withColumn("labels", F.array_join("labels.name", "|"))


def landing_states(spark: SparkSession, sf: str) -> DataFrame:
    """The page whose number is the length of its directory's name is a repository's last one."""
    landed = m.land_pages(spark, sf, has_next=F.col("page") != F.length("dir"))
    return pages.landing_states(spark, landed, multi_line=False)


def normalise_issues(spark: SparkSession, sf: str) -> DataFrame:
    raw = scratch_path(spark, "raw")
    stored = m.issues(spark, sf).withColumn(
        "labels", F.transform("labels", lambda x: F.struct(x.alias("name")))
    )
    pages.write_raw(stored, raw)
    return _joined_labels(ingest.normalise(pages.scan_raw(spark, raw)))


def existing_counts(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.existing_counts(m.order_issues(spark, sf))


def _stored_orders(spark: SparkSession, sf: str) -> DataFrame:
    return m.order_issues(spark, sf).where(F.col("state") == "pending")


def new_records(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.new_records(m.order_issues(spark, sf), _stored_orders(spark, sf))


def capped_ingest(spark: SparkSession, sf: str) -> DataFrame:
    taken = ingest.ingest(
        m.order_issues(spark, sf), _stored_orders(spark, sf), ORDER_CAPS, TOTAL_CAP
    )
    return taken.select("repo", "id", "created_at")


def capped_ingest_total(spark: SparkSession, sf: str) -> DataFrame:
    taken = ingest.ingest(
        m.order_issues(spark, sf), _stored_orders(spark, sf), ORDER_CAPS, LOW_TOTAL_CAP
    )
    return taken.select("repo", "id", "created_at")


def ingest_stream(spark: SparkSession, sf: str) -> DataFrame:
    table = scratch_path(spark, "stored")
    streams.ingest_stream(
        spark, m.land_pages(spark, sf), table, scratch_path(spark, "offsets"), multi_line=False
    ).awaitTermination()
    stored = streams.record_table(spark, table).read().drop("run_id")
    return stored.withColumn("labels", F.array_join("labels.name", "|"))


def score_stream(spark: SparkSession, sf: str) -> DataFrame:
    source, scored = scratch_path(spark, "issues"), scratch_path(spark, "scored")
    m.issues(spark, sf).write.parquet(source)

    def classify(rows: DataFrame) -> DataFrame:
        return score(rows, keyword_scorer(m.TERMS[V]), V, m.MODEL, CRITERIA[V], m.now())

    streams.score_stream(
        spark.readStream.schema(ISSUE).parquet(source), classify, scored,
        scratch_path(spark, "offsets"), V,
    ).awaitTermination()
    state = streams.current_state(streams.score_table(spark, scored).read())
    return state.drop("classified_at")


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    sheet = scratch_path(spark, "sheet")
    rows = (
        m.eval_set(spark, sf, "weak_label")
        .join(m.predictions(spark, sf).drop("input_tokens", "classifier_version"), "issue_id")
        .select(
            "issue_id", "repo", (F.col("issue_id") + 1).alias("number"), "title", "body",
            F.col("weak_label").alias("github_labels"), "weak_label", "predicted_type",
            "confidence", F.lit("").alias("gold_label"),
        )
    )
    sheets.write_sheet(rows, sheet)
    return sheets.read_sheet(spark, sheet)


def schema_evolve(spark: SparkSession, sf: str) -> DataFrame:
    old = m.line_classifications(spark, sf).select(*CLASSIFICATION_BASE.fieldNames())
    return ensure_columns(old, CLASSIFICATION).drop("classified_at")


def raw_arrays(spark: SparkSession, sf: str) -> DataFrame:
    raw = pages.scan_raw_batches(spark, m.land_arrays(spark, sf), "*/*.txt")
    return _joined_labels(ingest.normalise(raw))


def repo_parts(spark: SparkSession, sf: str) -> DataFrame:
    full = F.concat(F.lit("org/"), F.col("source"))
    return m.table(spark, sf, "documents").select(
        "doc_id", repo_owner(full).alias("owner"), repo_name(full).alias("name")
    )


def replace_table(spark: SparkSession, sf: str) -> DataFrame:
    name = f"issues_{uuid.uuid4().hex}"
    for rows in (_stored_orders(spark, sf), m.order_issues(spark, sf)):  # the second run replaces the first
        tables.replace_table(rows, name)
    return spark.table(name)


def stored_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """A table that is not there yet, then rows of three columns, then rows of all columns."""
    path = scratch_path(spark, "classified")
    lines = m.line_classifications(spark, sf)
    current = F.col("classifier_version") == LINE_VERSION
    before = tables.read_or_empty(spark, path, CLASSIFICATION)
    lines.where(~current).select(*CLASSIFICATION_BASE.fieldNames()).write.parquet(path)
    scored = lines.where(current).withColumnRenamed("issue_type", "choice")
    new = classification_rows(scored, LINE_VERSION, m.MODEL, m.now())
    new.write.mode("append").parquet(path)
    rows = before.unionByName(tables.read_or_empty(spark, path, CLASSIFICATION))
    return rows.withColumn("classified_at", F.col("classified_at").cast("string"))


def stored_times(spark: SparkSession, sf: str) -> DataFrame:
    """Rows stored without a time get that of the run: one for all of them, a timestamp, of today."""
    path = scratch_path(spark, "classified")
    current = m.line_classifications(spark, sf).where(F.col("classifier_version") == LINE_VERSION)
    classification_rows(current.withColumnRenamed("issue_type", "choice"), LINE_VERSION, m.MODEL).write.parquet(path)
    stored = tables.read_or_empty(spark, path, CLASSIFICATION)
    age = F.current_timestamp() - F.col("classified_at")
    recent = (age >= F.expr("INTERVAL '0' SECOND")) & (age < F.expr("INTERVAL '1' DAY"))
    times = stored.agg(F.min("classified_at").alias("first"), F.max("classified_at").alias("last"))
    one = times.select(F.col("first") == F.col("last")).scalar()
    return stored.groupBy("issue_type").agg(
        F.count("*").alias("n"),
        F.count_if(recent).alias("n_recent"),
        F.max(F.typeof("classified_at")).alias("kind"),
        F.bool_and(one).alias("one_time"),
    )


def usage_ledger(spark: SparkSession, sf: str) -> DataFrame:
    ledger = BucketedTable(spark, scratch_path(spark, "usage"), USAGE, ["issue_id"])
    rows = usage_rows(m.classifications(spark, sf))
    for run in ("run-1", "run-1"):  # the repeated run adds nothing
        ledger.append(rows, run)
    return ledger.read().drop("run_id", "classified_at")


def upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    state = BucketedTable(spark, scratch_path(spark, "state"), CLASSIFICATION, ["issue_id"])
    state.append(m.classifications(spark, sf), "before")
    scored = keyword_score(
        m.issues(spark, sf).where(F.col("state") == "open"), m.TERMS["v3"]
    ).select(
        F.col("id").alias("issue_id"),
        F.col("choice").alias("issue_type"),
        "confidence",
        F.col("updated_at").alias("issue_updated_at"),
        "input_tokens",
        F.lit(m.MODEL).alias("model"),
        F.lit("v3").alias("classifier_version"),
        F.lit(0.0).alias("estimated_cost_usd"),
        m.now().alias("classified_at"),
    )
    state.upsert(scored, "classified_at", "v3")
    return state.read().select(
        "issue_id", "issue_type", "confidence", "issue_updated_at", "classifier_version"
    )


def resume_pending(spark: SparkSession, sf: str) -> DataFrame:
    done = m.classifications(spark, sf).select("issue_id", "classifier_version")
    left = incremental.unscored_rows(m.eval_set(spark, sf), done, V)
    return left.select("issue_id", "repo", "title", "human_type")


def resume_scores(spark: SparkSession, sf: str) -> DataFrame:
    done = m.classifications(spark, sf).select("issue_id", "classifier_version")
    return resume(
        m.eval_set(spark, sf), done, keyword_scorer(m.TERMS[V]), V, m.MODEL, CRITERIA[V]
    )


def edited_records(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as updates of their order, which are edits when later than the order."""
    orders = m.order_issues(spark, sf).select("repo", "id", "updated_at")
    updates = m.line_classifications(spark, sf).select(
        F.col("issue_id").alias("id"), F.col("issue_updated_at").alias("updated_at")
    )
    incoming = updates.join(orders.select("repo", "id"), "id")
    return ingest.edited_records(incoming.select("repo", "id", "updated_at"), orders)


# Scoring


def pending(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.pending(m.issues(spark, sf), m.classifications(spark, sf), V)


def pending_first(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.pending(m.issues(spark, sf), m.classifications(spark, sf), V, limit=20)


def pending_orders(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.pending(
        m.order_issues(spark, sf), m.line_classifications(spark, sf), LINE_VERSION
    )


def budget_admit(spark: SparkSession, sf: str) -> DataFrame:
    rows = m.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    admitted = incremental.admit_within_budget(rows, estimated_tokens(F.col("text")), V, **BUDGET)
    return admitted.select("id", estimated_tokens(F.col("text")).alias("input_tokens"))


def budget_admit_orders(spark: SparkSession, sf: str) -> DataFrame:
    rows = m.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice")
    spent = m.line_classifications(spark, sf).where(F.col("confidence") > 1)
    tokens = F.floor("o_totalprice")
    admitted = incremental.admit_within_budget(
        rows, tokens, LINE_VERSION, usage=spent, **ORDER_BUDGET
    )
    return admitted.select("id", tokens.alias("input_tokens"))


def admitted_pending(spark: SparkSession, sf: str) -> DataFrame:
    state = m.classifications(spark, sf)
    return incremental.admitted_pending(
        m.issues(spark, sf), state, V, estimated_tokens(F.col("body")),
        usage=usage_rows(state.where(F.col("issue_type") == "other")), **PENDING_BUDGET,
    )


def native_keyword_score(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf)


def batch_score(spark: SparkSession, sf: str) -> DataFrame:
    requests = m.table(spark, sf, "documents").select(
        F.col("doc_id").alias("issue_id"),
        scoring_request(F.lit(""), F.col("text"), m.MODEL, CRITERIA[V]).alias("request"),
    )
    answers = exchange(requests, keyword_scorer(m.TERMS[V]))
    return answers.select("issue_id", parsed_response(F.col("response")).alias("a")).select(
        "issue_id", "a.*"
    )


def request_parts(spark: SparkSession, sf: str) -> DataFrame:
    request = m.issues(spark, sf).select(
        "id", scoring_request(F.col("title"), F.col("body"), m.MODEL, CRITERIA[V], BODY_CHARS).alias("r")
    )
    parts = {
        "model": "$.model",
        "title": "$.state.title",
        "body": "$.state.body",
        "question": "$.questions.issue_type.instructions",
        "other": "$.questions.issue_type.criteria.other",
    }
    return request.select(
        "id", *[F.get_json_object("r", path).alias(name) for name, path in parts.items()]
    )


def response_parts(spark: SparkSession, sf: str) -> DataFrame:
    answers = _scored(spark, sf).select(
        "issue_id",
        scoring_response(F.col("choice"), F.col("confidence"), F.col("input_tokens")).alias("r"),
    )
    return answers.select("issue_id", parsed_response(F.col("r")).alias("a")).select(
        "issue_id", "a.*"
    )


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.run_summary(usage_rows(m.classifications(spark, sf)))


def cost_projection(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.cost_projection(m.predictions(spark, sf))


# Labels and samples


def exact_label_class(spark: SparkSession, sf: str) -> DataFrame:
    human = labels.exact_label_class(F.col("labels"), m.LANGUAGES)
    return m.issues(spark, sf).select("id", human.alias("human_type"))


def map_labels(spark: SparkSession, sf: str) -> DataFrame:
    return labels.weak_labels(m.issues(spark, sf), m.LABEL_MAP).drop("body")


def label_counts(spark: SparkSession, sf: str) -> DataFrame:
    return labels.label_counts(m.issues(spark, sf))


def label_search(spark: SparkSession, sf: str) -> DataFrame:
    return labels.label_search(m.issues(spark, sf), SEARCH_TERMS)


def top_labels(spark: SparkSession, sf: str) -> DataFrame:
    return labels.top_labels(m.issues(spark, sf), TOP)


def balanced_sample(spark: SparkSession, sf: str) -> DataFrame:
    rows = m.eval_set(spark, sf).drop("title", "body")
    return sampling.balanced_sample(rows, n=SAMPLE, classes=m.LANGUAGES)


def balanced_sample_orders(spark: SparkSession, sf: str) -> DataFrame:
    rows = m.table(spark, sf, "orders").select("o_orderstatus", "o_custkey", "o_orderkey")
    return sampling.balanced_sample(
        rows, "o_orderstatus", "o_custkey", "o_orderkey", n=2_000, classes=["F", "O", "P"]
    )


def sample_profile(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.sample_profile(balanced_sample(spark, sf))


def gold_review(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.review_sheet(
        m.eval_set(spark, sf), m.issues(spark, sf), m.predictions(spark, sf), REVIEW, m.LANGUAGES
    )


def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    gold = m.eval_set(spark, sf, "gold_label").select("issue_id", "gold_label")
    return sampling.stratified_split(gold, classes=m.LANGUAGES)


def stratified_split_orders(spark: SparkSession, sf: str) -> DataFrame:
    rows = m.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.stratified_split(
        rows, "o_orderstatus", "o_orderkey", 0.25, ["F", "O", "P"]
    )


# Quality


def quality_suite(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_suite(
        m.issues(spark, sf), m.classifications(spark, sf), V, ["en", "fr", "other"]
    )


def quality_suite_lines(spark: SparkSession, sf: str) -> DataFrame:
    known = m.order_issues(spark, sf).where(F.col("state") != "pending")
    return quality.quality_suite(
        known, m.line_classifications(spark, sf), LINE_VERSION, LINE_CLASSES
    )


def gate(spark: SparkSession, sf: str) -> DataFrame:
    return quality.failures(quality_suite(spark, sf))


def triage(spark: SparkSession, sf: str) -> DataFrame:
    """The whole chain over the landed issues that pass the gate: counts of its report."""

    def classify(work: DataFrame) -> DataFrame:
        return score(work, keyword_scorer(m.TERMS[V]), V, m.MODEL, CRITERIA[V], m.now())

    run = TriageRun(
        m.land_pages(spark, sf, m.sound_issues(spark, sf)), scratch_path(spark, "triage"), "run-1", V,
        classify, cap_usd=1e9, classes=tuple(KNOWN), weak_classes=tuple(m.LANGUAGES), multi_line=False,
    )
    report = run_triage(spark, run)
    agreed = report["agreement"].select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).alias("n")) for c in ("correct", "total")]))
    )
    parts = {
        "agreement": agreed,
        "classes": report["classes"].select(F.col("issue_type").alias("name"), "n"),
        "repos": report["repos"].select(F.col("repo").alias("name"), "n"),
        "states": report["states"].select(F.col("state").alias("name"), "n"),
        "processed": report["run"].select(F.lit("run-1").alias("name"), F.col("processed").alias("n")),
    }
    named = [df.select(F.lit(part).alias("part"), "name", "n") for part, df in parts.items()]
    return reduce(DataFrame.unionByName, named)


def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_keys(m.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def orphans(spark: SparkSession, sf: str) -> DataFrame:
    known = m.order_issues(spark, sf).where(F.col("state") != "pending")
    return quality.orphans(m.line_classifications(spark, sf), known).select(
        "issue_id", "issue_type", "input_tokens", "classifier_version"
    )


def stale(spark: SparkSession, sf: str) -> DataFrame:
    found = quality.stale(m.classifications(spark, sf), m.issues(spark, sf), V)
    return found.select("issue_id", "issue_updated_at", "updated_at")


# Agreement and metrics


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.label_pairs(m.eval_set(spark, sf), m.predictions(spark, sf))


def agreement(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.agreement(m.issues(spark, sf), m.classifications(spark, sf), m.LANGUAGES)


def agreement_counts(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.agreement_counts(m.issues(spark, sf), m.classifications(spark, sf), m.LANGUAGES)


def agreement_mismatches(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.agreement_mismatches(
        m.issues(spark, sf), m.classifications(spark, sf), m.LANGUAGES
    )


def mismatches(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.error_listing(m.eval_set(spark, sf), m.predictions(spark, sf), k=5)


def mismatch_list(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.error_listing(m.eval_set(spark, sf), m.predictions(spark, sf), k=None)


def confusion(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion(_pairs(spark, sf), m.LANGUAGES, KNOWN)


def confusion_wide(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.confusion_wide(_pairs(spark, sf), m.LANGUAGES, KNOWN)


def accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.accuracy(_pairs(spark, sf), actual=m.LANGUAGES)


def class_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.class_metrics(_pairs(spark, sf), classes=m.LANGUAGES)


def macro_f1(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.macro_f1(_pairs(spark, sf), classes=m.LANGUAGES)


def token_stats(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.token_stats(m.predictions(spark, sf))


def compare_versions(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.compare_versions(
        m.eval_set(spark, sf, "gold_label"), m.predictions(spark, sf, list(m.TERMS)), V,
        classes=m.LANGUAGES,
    )


# Report


def coverage(spark: SparkSession, sf: str) -> DataFrame:
    return quality.coverage(m.issues(spark, sf), m.classifications(spark, sf), V)


def coverage_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return quality.coverage(
        m.order_issues(spark, sf), m.line_classifications(spark, sf), LINE_VERSION, distinct=True
    )


def coverage_lines(spark: SparkSession, sf: str) -> DataFrame:
    return quality.coverage(
        m.order_issues(spark, sf), m.line_classifications(spark, sf), LINE_VERSION
    )


def usage_totals(spark: SparkSession, sf: str) -> DataFrame:
    totals = analytics.usage_totals(m.line_classifications(spark, sf), LINE_VERSION)
    return totals.withColumn("total_cost_usd", F.round("total_cost_usd", 6))  # sums differ by their order


def repo_counts(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.counts_by(m.order_issues(spark, sf), "repo")


def state_counts(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.counts_by(m.order_issues(spark, sf), "state")


def class_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = analytics.of_version(m.line_classifications(spark, sf), LINE_VERSION)
    return analytics.counts_by(rows, "issue_type")


def avg_confidence(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.avg_confidence(m.line_classifications(spark, sf), LINE_VERSION)


def low_confidence(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.low_confidence(m.line_classifications(spark, sf), LINE_VERSION, LOW)


def lowest_examples(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.lowest_examples(
        m.order_issues(spark, sf), m.line_classifications(spark, sf), LINE_VERSION, LOW, EXAMPLES
    )


QUERIES: dict[str, Query] = {
    "pending": pending,
    "pending_first": pending_first,
    "pending_orders": pending_orders,
    "ingest_pages": ingest_pages,
    "landing_states": landing_states,
    "normalise_issues": normalise_issues,
    "existing_counts": existing_counts,
    "new_records": new_records,
    "capped_ingest": capped_ingest,
    "capped_ingest_total": capped_ingest_total,
    "ingest_stream": ingest_stream,
    "score_stream": score_stream,
    "csv_roundtrip": csv_roundtrip,
    "schema_evolve": schema_evolve,
    "raw_arrays": raw_arrays,
    "repo_parts": repo_parts,
    "replace_table": replace_table,
    "stored_evolution": stored_evolution,
    "stored_times": stored_times,
    "usage_ledger": usage_ledger,
    "upsert_latest": upsert_latest,
    "resume_pending": resume_pending,
    "resume_scores": resume_scores,
    "edited_records": edited_records,
    "budget_admit": budget_admit,
    "budget_admit_orders": budget_admit_orders,
    "admitted_pending": admitted_pending,
    "keyword_score": native_keyword_score,
    "batch_score": batch_score,
    "scoring_request": request_parts,
    "scoring_response": response_parts,
    "run_summary": run_summary,
    "cost_projection": cost_projection,
    "exact_label_class": exact_label_class,
    "map_labels": map_labels,
    "label_counts": label_counts,
    "label_search": label_search,
    "top_labels": top_labels,
    "balanced_sample": balanced_sample,
    "balanced_sample_orders": balanced_sample_orders,
    "sample_profile": sample_profile,
    "gold_review": gold_review,
    "stratified_split": stratified_split,
    "stratified_split_orders": stratified_split_orders,
    "quality_suite": quality_suite,
    "quality_suite_lines": quality_suite_lines,
    "gate": gate,
    "triage": triage,
    "duplicate_keys": duplicate_keys,
    "orphans": orphans,
    "stale": stale,
    "agreement": agreement,
    "agreement_counts": agreement_counts,
    "agreement_mismatches": agreement_mismatches,
    "mismatches": mismatches,
    "mismatch_list": mismatch_list,
    "confusion": confusion,
    "confusion_wide": confusion_wide,
    "accuracy": accuracy,
    "class_metrics": class_metrics,
    "macro_f1": macro_f1,
    "token_stats": token_stats,
    "compare_versions": compare_versions,
    "coverage": coverage,
    "coverage_lines": coverage_lines,
    "coverage_distinct": coverage_distinct,
    "usage_totals": usage_totals,
    "repo_counts": repo_counts,
    "state_counts": state_counts,
    "class_counts": class_counts,
    "avg_confidence": avg_confidence,
    "low_confidence": low_confidence,
    "lowest_examples": lowest_examples,
}
