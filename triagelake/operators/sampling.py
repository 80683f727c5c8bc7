"""Samples and splits that come out the same on every run and every cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from triagelake.functions.fixed import (
    CLASSES,
    REVIEW_PER_CLASS,
    SAMPLE_PER_CLASS,
    SEED,
    TEST_FRACTION,
    WEAK_CLASSES,
)
from triagelake.operators.ranking import first_per_group, order_hash, running_total_cut
from triagelake.session import materialise, only_keys


def _quotas(sizes: DataFrame, class_col: str, group: list[str], n: int) -> DataFrame:
    """(class, group..., size, quota): how many rows each group gives when ``n`` of a class are taken in turns.

    All groups give as many as the fullest round that fits, and the first groups in order one more. The round
    follows from how many groups there are of each size up to ``n``: at most n + 1 rows a class.
    """
    by_size = sizes.groupBy(class_col, F.least("size", F.lit(n + 1)).alias("s")).agg(F.count("*").alias("c"))
    earlier = Window.partitionBy(class_col).orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(class_col).orderBy("s").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levels = by_size.select(
        class_col, "s",
        F.coalesce(F.sum(F.col("s") * F.col("c")).over(earlier), F.lit(0)).alias("ended"),  # rows of smaller groups
        F.sum("c").over(later).alias("open"),
    ).where(F.col("ended") + F.col("s") * F.col("open") > n)
    rounds = materialise(
        levels.groupBy(class_col).agg(F.min(F.struct("s", "ended", "open")).alias("level")).select(
            class_col,
            F.expr(f"({n} - level.ended) div level.open").alias("turns"),
            (F.lit(n) - F.col("level.ended")).alias("_left"), F.col("level.open").alias("_open"),
        ).select(class_col, "turns", (F.col("_left") - F.col("turns") * F.col("_open")).alias("extra"))
    )
    known = sizes.join(rounds, class_col, "left")
    one_more = first_per_group(
        known.where(F.col("size") > F.col("turns")).select(class_col, *group, "extra"),
        [class_col], [F.col(c) for c in group], n,
    ).where(F.col("rank") <= F.col("extra")).select(class_col, *group, F.lit(1).alias("more"))
    quota = F.least(F.col("size"), F.coalesce("turns", "size")) + F.coalesce("more", F.lit(0))
    return known.join(one_more, [class_col, *group], "left").select(class_col, *group, "size", quota.alias("quota"))


def balanced_keys(
    rows: DataFrame,
    class_col: str = "human_type",
    group_col: str = "repo",
    key: str = "issue_id",
    n: int = SAMPLE_PER_CLASS,
    classes: list[str] = WEAK_CLASSES,
    seed: int = SEED,
) -> DataFrame:
    """The keys of a balanced sample; see ``balanced_sample``."""
    group = ["_none", "_group"]  # a NULL group comes last
    kind = rows.schema[group_col].dataType
    day = isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))
    other = F.lit("" if isinstance(kind, T.StringType) else "1970-01-01" if day else 0).cast(kind)
    narrow = rows.where(F.col(class_col).isin(classes)).select(
        F.col(class_col), F.col(group_col).isNull().alias("_none"),
        F.coalesce(F.col(group_col), other).alias("_group"),
        F.col(key), order_hash(key, seed).alias("_hash"),
    )
    sizes = materialise(narrow.groupBy(class_col, *group).agg(F.count("*").alias("size")))
    quotas = materialise(_quotas(sizes, class_col, group, n).where(F.col("quota") > 0))
    # Only groups that give some of their rows need a cut in their hash order.
    cut_groups = quotas.where(F.col("quota") < F.col("size"))
    cut = running_total_cut(
        narrow.join(cut_groups.select(class_col, *group), [class_col, *group], "left_semi"),
        [class_col, *group], ["_hash", key], F.lit(1), lambda before: before < F.col("quota"),
        limits=cut_groups.select(class_col, *group, "quota"), bucket=F.substring("_hash", 1, 4),
    )
    limits = materialise(quotas.join(cut, [class_col, *group], "left").select(class_col, *group, "cut"))
    place = F.struct(F.col("_hash"), F.col(key))
    return narrow.join(limits, [class_col, *group]).where(F.col("cut").isNull() | (place <= F.col("cut"))).select(key)


def balanced_sample(
    rows: DataFrame,
    class_col: str = "human_type",
    group_col: str = "repo",
    key: str = "issue_id",
    n: int = SAMPLE_PER_CLASS,
    classes: list[str] = WEAK_CLASSES,
    seed: int = SEED,
) -> DataFrame:
    """Up to ``n`` rows per class, taken from its groups in turn until they run out.

    Turn ``r`` takes the r-th row of every group in hash order. How many rows a group gives follows from the
    sizes of the groups, and which ones from one hash per group, found by counting hash prefixes: neither
    rows nor keys are ranked or shuffled. The rows are fetched for at most ``n`` keys per class. ``key`` must be unique.
    """
    return only_keys(rows, materialise(balanced_keys(rows, class_col, group_col, key, n, classes, seed)))


def sample_profile(sample: DataFrame, class_col: str = "human_type", group_col: str = "repo") -> DataFrame:
    """(class, group, n): how many rows of each class a drawn sample took from each group."""
    return sample.groupBy(class_col, group_col).agg(F.count("*").alias("n"))


def review_choice(
    eval_set: DataFrame,
    issues: DataFrame,
    predictions: DataFrame,
    n: int = REVIEW_PER_CLASS,
    classes: list[str] = WEAK_CLASSES,
) -> DataFrame:
    """The records of a review sheet, without their texts."""
    predicted = eval_set.where(F.col("human_type").isin(classes)).select(
        "issue_id", "human_type"
    ).join(predictions.select("issue_id", "predicted_type", "confidence"), "issue_id").join(
        issues.select(F.col("id").alias("issue_id")), "issue_id", "left_semi"
    )
    chosen = materialise(first_per_group(
        predicted.withColumn("_hash", order_hash("issue_id")),
        ["human_type"],
        [F.col("_hash"), F.col("issue_id")],
        n,
    ))
    # numbers and labels for the chosen records only
    details = issues.select(F.col("id").alias("issue_id"), "number", "labels")
    return chosen.join(only_keys(details, chosen.select("issue_id")), "issue_id")


def review_sheet(
    eval_set: DataFrame,
    issues: DataFrame,
    predictions: DataFrame,
    n: int = REVIEW_PER_CLASS,
    classes: list[str] = WEAK_CLASSES,
) -> DataFrame:
    """The sheet reviewers fill in: up to ``n`` predicted records per weak class. The texts are
    fetched for the chosen records only."""
    chosen = materialise(review_choice(eval_set, issues, predictions, n, classes))
    texts = eval_set.select("issue_id", "repo", "title", "body")
    return (
        texts.join(chosen, "issue_id")
        .select(
            "issue_id",
            "repo",
            "number",
            "title",
            "body",
            F.array_join("labels", "|").alias("github_labels"),
            F.col("human_type").alias("weak_label"),
            "predicted_type",
            "confidence",
            F.lit("").alias("gold_label"),
        )
        .orderBy("weak_label", "repo", "issue_id")
    )


def stratified_split(
    rows: DataFrame,
    class_col: str = "gold_label",
    key: str = "issue_id",
    fraction: float = TEST_FRACTION,
    classes: list[str] = CLASSES,
    seed: int = SEED,
) -> DataFrame:
    """Add ``part``: per class, in hash order, the first ``fraction`` (at least one row) is
    'test', the rest 'dev'. Rows of other or no class are left out.

    The rows are neither sorted nor shuffled: per class one cut hash is found from counts of
    hash prefixes, and each row is compared with it.
    """
    known = rows.where(F.col(class_col).isin(classes))
    narrow = known.select(class_col, order_hash(key, seed).alias("_hash"), key)
    sizes = narrow.groupBy(class_col).agg(
        F.greatest(F.lit(1), F.bround(F.count("*") * F.lit(fraction), 0)).alias("_test")
    )
    cut = running_total_cut(
        narrow,
        [class_col],
        ["_hash", key],
        F.lit(1),
        lambda before: before < F.col("_test"),
        limits=sizes,
        bucket=F.substring("_hash", 1, 4),
    )
    place = F.struct(order_hash(key, seed).alias("_hash"), F.col(key))
    return known.join(materialise(cut), class_col).select(
        *rows.columns, F.when(place <= F.col("cut"), "test").otherwise("dev").alias("part")
    )


def split_parts(split: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(dev, test) of a split."""
    dev = split.where(F.col("part") == "dev").drop("part")
    return dev, split.where(F.col("part") == "test").drop("part")
