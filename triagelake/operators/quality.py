"""Data quality checks: every violation count from one pass per table and one shuffle on the id."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake.functions.columns import any_of, ratio
from triagelake.functions.fixed import CLASSES, REQUIRED_FIELDS, STATES
from triagelake.operators.joins import HEAVY, balanced_join

# Names of the checks, in report order.
DUPLICATE_ISSUES = "Duplicate issue IDs"
MISSING_FIELDS = "Missing required issue fields"
INVALID_STATES = "Invalid issue states"
ORPHANS = "Classification IDs missing from issues"
DUPLICATE_CLASSIFICATIONS = "Duplicate classification issue IDs"
INVALID_CLASSES = "Invalid {version} classes"
INVALID_CONFIDENCE = "Invalid {version} confidence values"
STALE = "Stale {version} classifications"


class QualityError(Exception):
    """At least one check failed."""


@dataclass(frozen=True)
class RowCheck:
    """A check that looks at single rows: ``violated`` is true for a bad row."""

    name: str
    violated: Column


def outside(column: str, allowed: list[str]) -> Column:
    """Not one of ``allowed``, or NULL."""
    return ~F.col(column).isin(allowed) | F.col(column).isNull()


def out_of_range(column: str, low: float, high: float) -> Column:
    """Below ``low``, above ``high`` or NULL; NaN counts as above."""
    c = F.col(column)
    return (c < low) | (c > high) | c.isNull()


def issue_checks(required: list[str] = REQUIRED_FIELDS, states: list[str] = STATES) -> list[RowCheck]:
    return [
        RowCheck(MISSING_FIELDS, any_of([F.col(c).isNull() for c in required])),
        RowCheck(INVALID_STATES, outside("state", states)),
    ]


def classification_checks(version: str, classes: list[str] = CLASSES) -> list[RowCheck]:
    current = F.col("classifier_version") == version
    name = version.upper()
    return [
        RowCheck(INVALID_CLASSES.format(version=name), current & outside("issue_type", classes)),
        RowCheck(INVALID_CONFIDENCE.format(version=name), current & out_of_range("confidence", 0, 1)),
    ]


def row_violations(df: DataFrame, checks: list[RowCheck]) -> DataFrame:
    """(check, violations) for any number of row checks, in one pass without a shuffle of rows."""
    counted = df.agg(*[F.count_if(c.violated).alias(f"c{i}") for i, c in enumerate(checks)])
    listed = F.array(
        *[
            F.struct(F.lit(c.name).alias("check"), F.col(f"c{i}").alias("violations"))
            for i, c in enumerate(checks)
        ]
    )
    return counted.select(F.inline(listed))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """How many keys occur more than once; NULL counts as a key."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > 1)
        .agg(F.count("*").alias("violations"))
    )


def orphans(classifications: DataFrame, issues: DataFrame) -> DataFrame:
    """Classifications of records that do not exist."""
    ids = issues.select(F.col("id").alias("issue_id"))
    return classifications.join(ids, "issue_id", "left_anti")


def stale(
    classifications: DataFrame, issues: DataFrame, version: str, heavy: int = HEAVY
) -> DataFrame:
    """Classifications of ``version`` older than the record's last edit. An id with very many of them is
    dealt over several tasks."""
    c = classifications.where(F.col("classifier_version") == version)
    i = issues.select(F.col("id").alias("issue_id"), "updated_at")
    outdated = ~F.col("issue_updated_at").eqNullSafe(F.col("updated_at"))
    return balanced_join(c, i, "issue_id", outdated, heavy).select(*c.columns, "updated_at")


def key_violations(issues: DataFrame, classifications: DataFrame, version: str) -> DataFrame:
    """Duplicate ids of both tables, orphans and stale rows, from one grouping of both tables.

    The tables are counted per (id, update time) before they meet, so an id with very many rows
    shrinks to a few counts. Stale rows are pairs of equal id and different time: all pairs of an
    id less the pairs of equal time, which needs products of counts and no pairs. The time of a classification
    of another version is in no such pair and is left out, so that those of an id are one entry of a task.
    """
    current = F.coalesce(F.col("classifier_version") == version, F.lit(False))
    stamps = issues.select(
        "id", F.col("updated_at").alias("stamp"),
        F.lit(1).alias("i"), F.lit(0).alias("c"), F.lit(0).alias("v"),
    ).unionByName(
        classifications.select(
            F.col("issue_id").alias("id"), F.when(current, F.col("issue_updated_at")).alias("stamp"),
            F.lit(0).alias("i"), F.lit(1).alias("c"), current.cast("int").alias("v"),
        )
    )
    per_stamp = stamps.groupBy("id", "stamp").agg(
        F.sum("i").alias("i"), F.sum("c").alias("c"), F.sum("v").alias("v")
    )
    per_id = per_stamp.groupBy("id").agg(
        F.sum("i").alias("i"),
        F.sum("c").alias("c"),
        F.sum("v").alias("v"),
        F.sum(F.col("i") * F.col("v")).alias("same"),
    )
    unknown = F.col("id").isNull() | (F.col("i") == 0)
    outdated = F.when(F.col("id").isNotNull(), F.col("i") * F.col("v") - F.col("same"))
    counted = per_id.agg(
        F.count_if(F.col("i") > 1).alias("duplicate_issues"),
        F.coalesce(F.sum(F.when(unknown, F.col("c"))), F.lit(0)).alias("orphans"),
        F.count_if(F.col("c") > 1).alias("duplicate_classifications"),
        F.coalesce(F.sum(outdated), F.lit(0)).alias("stale"),
    )
    names = {
        "duplicate_issues": DUPLICATE_ISSUES,
        "orphans": ORPHANS,
        "duplicate_classifications": DUPLICATE_CLASSIFICATIONS,
        "stale": STALE.format(version=version.upper()),
    }
    listed = [
        F.struct(F.lit(name).alias("check"), F.col(column).alias("violations"))
        for column, name in names.items()
    ]
    return counted.select(F.inline(F.array(*listed)))


def quality_suite(
    issues: DataFrame,
    classifications: DataFrame,
    version: str,
    classes: list[str] = CLASSES,
    states: list[str] = STATES,
    required: list[str] = REQUIRED_FIELDS,
    extra: list[tuple[DataFrame, list[RowCheck]]] = (),
) -> DataFrame:
    """(check, violations, status) of the eight checks, plus any ``extra`` row checks."""
    found = key_violations(issues, classifications, version)
    tables = [
        (issues, issue_checks(required, states)),
        (classifications, classification_checks(version, classes)),
        *extra,
    ]
    for df, checks in tables:
        found = found.unionByName(row_violations(df, checks))
    status = F.when(F.col("violations") == 0, "PASS").otherwise("FAIL")
    return found.select("check", "violations", status.alias("status"))


def coverage(
    issues: DataFrame, classifications: DataFrame, version: str, distinct: bool = False
) -> DataFrame:
    """(classified, total, coverage): classifications of ``version`` per hundred records.

    Rows are counted, so copies may bring the share above 100; ``distinct`` counts ids instead.
    """

    def rows(key: str) -> Column:
        return F.countDistinct(key) if distinct else F.count("*")

    none = F.lit(0).cast("bigint")
    total = issues.agg(rows("id").alias("n")).select(none.alias("c"), "n")
    current = classifications.where(F.col("classifier_version") == version)
    done = current.agg(rows("issue_id").alias("c")).select("c", none.alias("n"))
    both = total.unionByName(done).agg(
        F.sum("c").alias("classified"), F.sum("n").alias("total")
    )
    share = ratio(F.col("classified"), F.col("total")) * 100
    return both.select("classified", "total", share.alias("coverage"))


def failures(results: DataFrame) -> DataFrame:
    """The checks that fail a run."""
    return results.where(F.col("violations") > 0).select("check", "violations")


def gate(results: DataFrame) -> list[str]:
    """Raise when a check failed; returns the names of the checks that ran."""
    rows = results.select("check", "violations").collect()  # one row per check
    failed = [f"{r['check']}: {r['violations']:,}" for r in rows if r["violations"]]
    if failed:
        raise QualityError(f"Quality checks failed: {len(failed)}\n" + "\n".join(failed))
    return [r["check"] for r in rows]
