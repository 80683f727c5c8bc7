"""What is left to score, and how much of it the budget admits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake.functions.columns import token_cost
from triagelake.functions.fixed import MAX_COST_USD, PRICE_PER_MILLION_TOKENS, RESERVE_USD
from triagelake.operators.ranking import running_total_cut
from triagelake.schemas import USAGE
from triagelake.session import literal_table, materialise, only_keys

#: Repetitions of a record that are listed from one row.
BLOCK = 10_000


def pending_states(issues: DataFrame, classifications: DataFrame, version: str) -> DataFrame:
    """(id, updated_at, outdated) of the records to score: those without a classification, with
    ``outdated`` 1, and those with classifications of another update time or another version,
    with the number of them.

    What is up to date is counted per (id, update time) over both tables, and set against the
    number of classifications per id. Copies, or a long history, of one id never meet as pairs.
    """
    known = classifications.where(F.col("issue_id").isNotNull())
    current = F.col("classifier_version").eqNullSafe(F.lit(version)).cast("int")
    stamps = issues.select(
        "id", "updated_at", F.lit(1).alias("issue"), F.lit(0).alias("current")
    ).unionByName(
        known.select(
            F.col("issue_id").alias("id"), F.col("issue_updated_at").alias("updated_at"),
            F.lit(0).alias("issue"), current.alias("current"),
        )
    )
    per_stamp = stamps.groupBy("id", "updated_at").agg(
        F.max("issue").alias("issue"), F.sum("current").alias("current")
    )
    per_id = known.groupBy("issue_id").agg(F.count("*").alias("listed"))
    outdated = F.when(F.col("listed").isNull(), 1).otherwise(F.col("listed") - F.col("current"))
    return (
        per_stamp.where(F.col("issue") == 1)
        .join(per_id, F.col("id") == F.col("issue_id"), "left")
        .select("id", "updated_at", outdated.alias("outdated"))
        .where(F.col("outdated") > 0)
    )


def pending(
    issues: DataFrame, classifications: DataFrame, version: str, limit: int | None = None
) -> DataFrame:
    """(id, title, body, updated_at) of the records to score, once per outdated classification.

    Which they are is decided on ids and times (``pending_states``) and written, so that Spark knows
    how many there are before it meets the texts. A long outdated history is cut in blocks of
    ``BLOCK`` repetitions first, rows of their own: no array grows with the history.
    """
    columns = ["id", "title", "body", "updated_at"]
    states = pending_states(issues, classifications, version)
    if limit is not None:  # the first records, and no more repetitions of one than are asked for
        first = states.orderBy(F.col("id").asc_nulls_last()).limit(limit)
        states = first.withColumn("outdated", F.least("outdated", F.lit(limit)))
    states = materialise(states)
    last_block = F.floor((F.col("outdated") - 1) / BLOCK)
    blocks = states.select("*", F.explode(F.sequence(F.lit(0), last_block)).alias("block")).select(
        "id", "updated_at",
        F.least(F.lit(BLOCK), F.col("outdated") - F.col("block") * BLOCK).alias("times"),
    ).alias("s")
    same = F.col("i.id").eqNullSafe(F.col("s.id")) & F.col("i.updated_at").eqNullSafe(
        F.col("s.updated_at")
    )
    found = issues.select(*columns).alias("i").join(blocks, same).select("i.*", "times")
    listed = found.select(*columns, F.explode(F.sequence(F.lit(1), F.col("times")))).drop("col")
    return listed if limit is None else listed.orderBy(F.col("id").asc_nulls_last()).limit(limit)


def unscored(rows: DataFrame, done: DataFrame, version: str | None = None) -> DataFrame:
    """Rows whose issue_id has no prediction yet (of ``version``, if given)."""
    if version is not None:
        done = done.where(F.col("classifier_version") == version)
    return rows.join(done.select("issue_id").distinct(), "issue_id", "left_anti")


def unscored_rows(rows: DataFrame, done: DataFrame, version: str | None = None) -> DataFrame:
    """As `unscored`, for rows with texts that do not lie in buckets of the id: which ids are left is found
    from ids alone and written, and the texts are then filtered by them."""
    return only_keys(rows, materialise(unscored(rows.select("issue_id").distinct(), done, version)))


def recorded_spend(usage: DataFrame, version: str) -> DataFrame:
    """One row (classifier_version, spent) with the ledger's cost of a version, 0 without rows."""
    return (
        usage.where(F.col("classifier_version") == version)
        .agg(F.coalesce(F.sum("estimated_cost_usd"), F.lit(0.0)).alias("spent"))
        .select(F.lit(version).alias("classifier_version"), "spent")
    )


def _key_costs(costs: DataFrame, key: str, version: str) -> DataFrame:
    """(classifier_version, key, tokens) with one row per key, written once."""
    per_key = costs.groupBy(key).agg(F.sum("tokens").alias("tokens"))
    return materialise(per_key.select(F.lit(version).alias("classifier_version"), key, "tokens"))


def _last_affordable(
    key_costs: DataFrame, key: str, version: str, usage: DataFrame | None, cap: float,
    reserve: float, price: float,
) -> Column:
    if usage is None:
        usage = literal_table(key_costs.sparkSession, USAGE, [])
    spent = recorded_spend(usage, version).select("spent").scalar()

    def affordable(before: Column) -> Column:
        return spent + before * F.lit(price) / F.lit(1e6) < F.lit(cap) - F.lit(reserve)

    cut = running_total_cut(
        key_costs, ["classifier_version"], [key], F.col("tokens"), affordable
    )
    return cut.select("cut").scalar()


def budget_cut(
    costs: DataFrame,
    version: str,
    usage: DataFrame | None = None,
    cap: float = MAX_COST_USD,
    reserve: float = RESERVE_USD,
    price: float = PRICE_PER_MILLION_TOKENS,
    key: str = "id",
) -> Column:
    """The last key, in key order, started while spend so far is below ``cap - reserve``.

    ``costs`` has columns ``key`` and ``tokens`` (integers, not negative; rows of equal key are
    admitted together). It is evaluated once; the pairs are then ranged and totalled. The result
    is a scalar subquery: NULL when nothing is admitted.
    """
    key_costs = _key_costs(costs, key, version)
    return _last_affordable(key_costs, key, version, usage, cap, reserve, price)


def admit_within_budget(
    rows: DataFrame, tokens: Column, version: str, key: str = "id", **budget
) -> DataFrame:
    """The rows, in ``key`` order, that the budget admits; ``tokens`` is the cost of a row before
    it is scored. Texts are read once for the costs; the cut then filters the scan."""
    costs = rows.select(key, tokens.alias("tokens"))
    return rows.where(F.col(key) <= budget_cut(costs, version, key=key, **budget))


def admitted_pending(
    issues: DataFrame,
    classifications: DataFrame,
    version: str,
    tokens: Column,
    usage: DataFrame | None = None,
    cap: float = MAX_COST_USD,
    reserve: float = RESERVE_USD,
    price: float = PRICE_PER_MILLION_TOKENS,
) -> DataFrame:
    """Pending records the budget admits, each once however many classifications are outdated.

    Costs are taken at the scan, so that no text passes a join to find out what is pending. The
    texts are then read for the admitted ids, up to the cut.
    """
    states = pending_states(issues, classifications, version).alias("s")
    sized = issues.select("id", "updated_at", tokens.alias("tokens")).alias("i")
    same = (F.col("i.id") == F.col("s.id")) & F.col("i.updated_at").eqNullSafe(
        F.col("s.updated_at")
    )
    key_costs = _key_costs(sized.join(states, same).select("i.id", "tokens"), "id", version)
    cut = _last_affordable(key_costs, "id", version, usage, cap, reserve, price)
    admitted = materialise(key_costs.where(F.col("id") <= cut).select("id"))
    last = admitted.agg(F.max("id")).first()[0]  # one value, so that the scan can skip files
    rows = issues.select("id", "title", "body", "updated_at").where(F.col("id") <= F.lit(last))
    return only_keys(rows, admitted)
