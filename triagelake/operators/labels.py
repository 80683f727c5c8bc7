"""Repository labels: exact classes, mapped classes and label profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triagelake.functions.columns import any_of, text_or_empty
from triagelake.functions.fixed import LABEL_MAP, LABEL_TERMS, LABELS_PER_REPO, WEAK_CLASSES
from triagelake.operators.ranking import first_per_group
from triagelake.session import literal_table

_MAP = T.StructType(
    [
        T.StructField("repo", T.StringType()),
        T.StructField("_classes", T.MapType(T.StringType(), T.StringType())),
    ]
)


def exact_label_class(labels: Column, classes: list[str] = WEAK_CLASSES) -> Column:
    """The class whose name is the record's only label, else NULL."""
    return F.coalesce(*[F.when(labels == F.array(F.lit(c)), F.lit(c)) for c in classes])


def weak_labels(
    issues: DataFrame, label_map: dict[str, dict[str, str]] = LABEL_MAP
) -> DataFrame:
    """Records whose labels stand for exactly one class, as (repo, issue_id, title, body, class).

    The map is a parameter with one row per repository; each record looks its labels up in it,
    so nothing is exploded, grouped or shuffled.
    """
    rows = [(repo, list(classes.items())) for repo, classes in label_map.items()]
    maps = literal_table(issues.sparkSession, _MAP, rows)
    mapped = F.array_compact(
        F.array_distinct(
            F.transform(F.col("labels"), lambda label: F.try_element_at(F.col("_classes"), label))
        )
    )
    return (
        issues.join(maps, "repo")
        .select("repo", F.col("id").alias("issue_id"), "title",
                text_or_empty(F.col("body")).alias("body"), mapped.alias("_mapped"))
        .where(F.size("_mapped") == 1)
        .select("repo", "issue_id", "title", "body", F.col("_mapped")[0].alias("human_type"))
    )


def label_counts(issues: DataFrame) -> DataFrame:
    """Records per (repo, label); records without labels count nowhere."""
    return (
        issues.select("repo", F.explode("labels").alias("label"))
        .groupBy("repo", "label")
        .agg(F.count("*").alias("n"))
    )


def label_search(issues: DataFrame, terms: list[str] = LABEL_TERMS) -> DataFrame:
    """Counts of the labels whose name contains one of the terms, whatever the case."""
    found = any_of([F.lower("label").contains(t) for t in terms])
    return (
        issues.select("repo", F.explode("labels").alias("label"))
        .where(found)
        .groupBy("repo", "label")
        .agg(F.count("*").alias("n"))
        .orderBy("repo", F.col("n").desc(), "label")
    )


def top_labels(issues: DataFrame, n: int = LABELS_PER_REPO) -> DataFrame:
    """The most frequent labels of each repository, all repositories at once."""
    return first_per_group(
        label_counts(issues), ["repo"], [F.col("n").desc(), F.col("label").asc()], n
    )
