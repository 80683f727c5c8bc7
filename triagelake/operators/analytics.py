"""The report: coverage, usage, distributions and the least certain classifications."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.functions.columns import token_cost
from triagelake.functions.fixed import (
    LOW_CONFIDENCE,
    LOWEST_EXAMPLES,
    PRICE_PER_MILLION_TOKENS,
    TOTAL_CAP,
)
from triagelake.operators.quality import coverage
from triagelake.session import materialise, only_keys


def counts_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key, most frequent first."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), *[F.col(k).asc_nulls_last() for k in keys])
    )


def of_version(df: DataFrame, version: str) -> DataFrame:
    return df.where(F.col("classifier_version") == version)


def usage_totals(usage: DataFrame, version: str) -> DataFrame:
    """(total_tokens, total_cost_usd) of a version, 0 without ledger rows."""
    return of_version(usage, version).agg(
        F.coalesce(F.sum(F.col("input_tokens").cast("long")), F.lit(0)).alias("total_tokens"),
        F.coalesce(F.sum("estimated_cost_usd"), F.lit(0.0)).alias("total_cost_usd"),
    )


def avg_confidence(classifications: DataFrame, version: str) -> DataFrame:
    """Mean confidence per class, three decimals."""
    return (
        of_version(classifications, version)
        .groupBy("issue_type")
        .agg(F.round(F.avg("confidence"), 3).alias("avg_confidence"))
        .orderBy(F.col("avg_confidence").desc_nulls_last(), F.col("issue_type").asc_nulls_last())
    )


def low_confidence(
    classifications: DataFrame, version: str, threshold: float = LOW_CONFIDENCE
) -> DataFrame:
    return (
        of_version(classifications, version)
        .where(F.col("confidence") < threshold)
        .agg(F.count("*").alias("n"))
    )


def lowest_examples(
    issues: DataFrame, classifications: DataFrame, version: str,
    threshold: float = LOW_CONFIDENCE, k: int = LOWEST_EXAMPLES,
) -> DataFrame:
    """The ``k`` least confident classifications with their records.

    The k first ones are found on the narrow classifications, ``k`` a task, without a shuffle of rows. Titles are
    then fetched for their ids only. Where some of them have no record, more are taken, eight times as
    many each time, until k are found or none is left.
    """
    order = [F.col("confidence").asc_nulls_last(), "issue_id", "issue_type"]
    unsure = of_version(classifications, version).where(F.col("confidence") < threshold).select(
        "issue_id", "issue_type", "confidence")
    titles, take = issues.select(F.col("id").alias("issue_id"), "number", "title"), k
    while True:
        first = materialise(unsure.orderBy(*order).limit(take))
        found = materialise(only_keys(titles, first.select("issue_id").distinct()))
        known = first.join(found, "issue_id")
        if known.limit(k).count() >= k or first.count() < take:
            break
        take *= 8
    return known.orderBy(*order, "number").limit(k).select("number", "title", "issue_type", "confidence")


def run_summary(
    usage: DataFrame, records: int = TOTAL_CAP, price: float = PRICE_PER_MILLION_TOKENS
) -> DataFrame:
    """Totals of one scoring run from its ledger rows, and the projected cost of ``records``."""
    totals = usage.agg(
        F.count("*").alias("processed"),
        F.coalesce(F.sum(F.col("input_tokens").cast("long")), F.lit(0)).alias("input_tokens"),
    )
    average = F.when(F.col("processed") > 0, F.col("input_tokens") / F.col("processed"))
    return totals.select(
        "processed",
        "input_tokens",
        average.alias("average_tokens"),
        token_cost(F.col("input_tokens"), price).alias("cost_usd"),
        token_cost(average * F.lit(records), price).alias("projected_cost_usd"),
    )


def cost_projection(
    predictions: DataFrame, records: int = TOTAL_CAP, price: float = PRICE_PER_MILLION_TOKENS
) -> DataFrame:
    """What scoring ``records`` would cost at the mean number of tokens seen so far."""
    mean = F.avg("input_tokens")
    return predictions.agg(
        mean.alias("average_tokens"),
        token_cost(mean * F.lit(records), price).alias("projected_cost_usd"),
    )


def report(
    issues: DataFrame, classifications: DataFrame, usage: DataFrame, version: str,
    threshold: float = LOW_CONFIDENCE,
) -> dict[str, DataFrame]:
    """The parts of the analytics report, each a lazy DataFrame."""
    return {
        "coverage": coverage(issues, classifications, version),
        "usage": usage_totals(usage, version),
        "classes": counts_by(of_version(classifications, version), "issue_type"),
        "confidence": avg_confidence(classifications, version),
        "states": counts_by(issues, "state"),
        "repos": counts_by(issues, "repo"),
        "low_confidence": low_confidence(classifications, version, threshold),
        "lowest_examples": lowest_examples(issues, classifications, version, threshold),
    }
