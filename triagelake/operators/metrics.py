"""Agreement, confusion matrices and classifier metrics, as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from triagelake.functions.columns import ratio
from triagelake.functions.fixed import CLASSES, ERRORS_SHOWN, WEAK_CLASSES
from triagelake.operators.joins import HEAVY, balanced_join
from triagelake.operators.labels import exact_label_class
from triagelake.session import literal_table, materialise, only_keys

_GRID = T.StructType(
    [T.StructField("actual", T.StringType()), T.StructField("predicted", T.StringType())]
)


def exact_labels(issues: DataFrame, classes: list[str] = WEAK_CLASSES) -> DataFrame:
    """(id, number, title, repo, human_type) of records with exactly one, known label."""
    return issues.select(
        "id", "number", "title", "repo",
        exact_label_class(F.col("labels"), classes).alias("human_type"),
    ).where(F.col("human_type").isNotNull())


def _count_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """How often every combination of the other columns occurs (``n``) when both meet on issue_id.

    Equal rows of an id are counted before they meet, so an id with very many rows on both
    sides shrinks to a few counts, and their products stand for the pairs.
    """
    one = left.groupBy(*left.columns).agg(F.count("*").alias("_left"))
    other = right.groupBy(*right.columns).agg(F.count("*").alias("_right"))
    classes = [c for c in [*left.columns, *right.columns] if c != "issue_id"]
    return one.join(other, "issue_id").groupBy(*classes).agg(
        F.sum(F.col("_left") * F.col("_right")).alias("n")
    )


def agreement_counts(
    issues: DataFrame, classifications: DataFrame, classes: list[str] = WEAK_CLASSES,
    version: str | None = None,
) -> DataFrame:
    """(human_type, predicted_type, n) over classified records with an exact label class."""
    labelled = exact_labels(issues, classes).select(F.col("id").alias("issue_id"), "human_type")
    predicted = _of_version(classifications, version).select(
        "issue_id", F.col("issue_type").alias("predicted_type")
    )
    return _count_pairs(labelled, predicted).orderBy("human_type", F.col("n").desc(), "predicted_type")


def agreement(
    issues: DataFrame, classifications: DataFrame, classes: list[str] = WEAK_CLASSES,
    version: str | None = None,
) -> DataFrame:
    """(correct, total, agreement); the share is NULL when nothing is labelled."""
    counts = agreement_counts(issues, classifications, classes, version)
    same = F.col("human_type") == F.col("predicted_type")
    return counts.agg(
        F.coalesce(F.sum(F.when(same, F.col("n"))), F.lit(0)).alias("correct"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    ).select(
        "correct", "total",
        F.when(F.col("total") > 0, F.col("correct") / F.col("total")).alias("agreement"),
    )


def _first_errors(
    reference: DataFrame, predictions: DataFrame, actual: str, predicted: str, details: list[str],
    k: int | None, heavy: int,
) -> DataFrame:
    """Wrong predictions with ``details`` of the record, most confident first.

    They are found, and the first ``k`` taken, on ids and classes; an id with very many predictions is dealt over
    several tasks. The details are fetched for what is left.
    """
    classes = reference.select("issue_id", actual).distinct()
    wrong = balanced_join(
        predictions.select("issue_id", predicted, "confidence"), classes, "issue_id",
        F.col(actual) != F.col(predicted), heavy)
    order = [F.col("confidence").desc_nulls_last(), F.col("issue_id")]
    whole = reference.select("issue_id", actual, *details)
    if k is None:
        more = [c for c in whole.columns if c not in ("issue_id", actual)]
        records = whole.select("issue_id", F.struct(actual, *more).alias("_record"))
        same = F.col(f"_record.{actual}").eqNullSafe(F.col(actual))
        return balanced_join(wrong, records, "issue_id", same, heavy).select(
            "issue_id", actual, predicted, "confidence", *[F.col(f"_record.{c}").alias(c) for c in more]
        ).orderBy(*order)
    first = materialise(wrong.orderBy(*order).limit(k))
    records = only_keys(whole, materialise(first.select("issue_id", actual).distinct()))
    return first.join(records, ["issue_id", actual]).orderBy(*order).limit(k)


def agreement_mismatches(
    issues: DataFrame, classifications: DataFrame, classes: list[str] = WEAK_CLASSES,
    k: int | None = None, version: str | None = None, heavy: int = HEAVY,
) -> DataFrame:
    """Records whose classification differs from their label, most confident first."""
    labelled = exact_labels(issues, classes).withColumnRenamed("id", "issue_id")
    c = _of_version(classifications, version)
    return _first_errors(labelled, c, "human_type", "issue_type", ["number", "title"], k, heavy).select(
        "number", "title", "human_type", "issue_type", "confidence")


def error_listing(
    reference: DataFrame, predictions: DataFrame, actual: str = "human_type",
    k: int | None = ERRORS_SHOWN, heavy: int = HEAVY,
) -> DataFrame:
    """Wrong predictions with the record's repository and title, most confident first."""
    return _first_errors(reference, predictions, actual, "predicted_type", ["repo", "title"], k, heavy).select(
        actual, "predicted_type", "confidence", "repo", "title")


def label_pairs(
    reference: DataFrame, predictions: DataFrame, actual: str = "human_type", by: list[str] = ()
) -> DataFrame:
    """(by..., actual, predicted, n) over the records both sides know."""
    return _count_pairs(
        reference.select("issue_id", F.col(actual).alias("actual")),
        predictions.select("issue_id", *by, F.col("predicted_type").alias("predicted")),
    ).select(*by, "actual", "predicted", "n")


def confusion(
    pairs: DataFrame, actual: list[str] = CLASSES, predicted: list[str] = CLASSES
) -> DataFrame:
    """The dense matrix (actual, predicted, n) with zeros for pairs that do not occur."""
    grid = literal_table(pairs.sparkSession, _GRID, [(a, p) for a in actual for p in predicted])
    return grid.join(pairs, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("n", F.lit(0)).alias("n")
    )


def confusion_wide(
    pairs: DataFrame, actual: list[str] = CLASSES, predicted: list[str] = CLASSES
) -> DataFrame:
    """One row per actual class, one column per predicted class."""
    return (
        confusion(pairs, actual, predicted)
        .groupBy("actual")
        .pivot("predicted", predicted)
        .agg(F.sum("n"))
        .na.fill(0)
    )


def _sum_if(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))


def _totals(pairs: DataFrame, by: list[str], classes: list[str]) -> DataFrame:
    """Per group one row with the sums all metrics come from: (tp, row, column) of each class
    as ``_classes`` and correct, total, unexpected. One grouping of the pairs, no joins."""
    actual, predicted = F.col("actual"), F.col("predicted")
    known = pairs.where(actual.isin(classes))
    per_class = [
        F.struct(
            F.lit(c).alias("class"),
            _sum_if((actual == c) & (predicted == c)).alias("tp"),
            _sum_if(actual == c).alias("row"),
            _sum_if(predicted == c).alias("column"),
        )
        for c in classes
    ]
    sums = [
        F.array(*per_class).alias("_classes"),
        _sum_if(actual == predicted).alias("correct"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        _sum_if(~predicted.isin(classes)).alias("unexpected"),
    ]
    return known.groupBy(*by).agg(*sums) if by else known.agg(*sums)


def _f1(entry: Column) -> Column:
    p = ratio(entry["tp"], entry["column"])
    r = ratio(entry["tp"], entry["row"])
    return ratio(2 * p * r, p + r)


def _accuracy() -> Column:
    return F.when(F.col("total") > 0, F.col("correct") / F.col("total")).alias("accuracy")


def accuracy(pairs: DataFrame, by: list[str] = (), actual: list[str] = CLASSES) -> DataFrame:
    """(by..., correct, total, unexpected, accuracy) over pairs with a known actual class.

    Predictions outside ``actual`` count as wrong and are shown as ``unexpected`` too.
    """
    return _totals(pairs, by, actual).select(
        *by, "correct", "total", "unexpected", _accuracy()
    )


def class_metrics(pairs: DataFrame, by: list[str] = (), classes: list[str] = CLASSES) -> DataFrame:
    """(by..., class, tp, fp, fn, precision, recall, f1) of every class, 0 where undefined."""
    rows = _totals(pairs, by, classes).select(*by, F.explode("_classes").alias("c"))
    c = F.col("c")
    return rows.select(
        *by,
        c["class"].alias("class"),
        c["tp"].alias("tp"),
        (c["column"] - c["tp"]).alias("fp"),
        (c["row"] - c["tp"]).alias("fn"),
        ratio(c["tp"], c["column"]).alias("precision"),
        ratio(c["tp"], c["row"]).alias("recall"),
        _f1(c).alias("f1"),
    )


def _mean_f1(classes: list[str]) -> Column:
    """Mean F1 of ``_classes``, added in the order of the class list: sums of doubles depend
    on their order."""
    chosen = F.filter("_classes", lambda c: c["class"].isin(classes))
    total = F.aggregate(chosen, F.lit(0.0), lambda acc, c: acc + _f1(c))
    return (total / len(classes)).alias("macro_f1")


def macro_f1(
    pairs: DataFrame, by: list[str] = (), classes: list[str] = CLASSES,
    averaged: list[str] | None = None,
) -> DataFrame:
    """(by..., macro_f1): the plain mean of the F1 of ``averaged`` (by default all ``classes``)."""
    return _totals(pairs, by, classes).select(*by, _mean_f1(averaged or classes))


def token_stats(predictions: DataFrame) -> DataFrame:
    """(total_tokens, average_tokens) of all predictions; an empty table is an error."""
    totals = predictions.agg(
        F.sum(F.col("input_tokens").cast("long")).alias("total_tokens"),
        F.avg("input_tokens").alias("average_tokens"),
    )
    missing = F.raise_error(F.lit("no predictions found"))
    return totals.select(
        F.coalesce("total_tokens", missing.cast("long")).alias("total_tokens"), "average_tokens"
    )


def compare_versions(
    gold: DataFrame, predictions: DataFrame, baseline: str, actual: str = "gold_label",
    classes: list[str] = CLASSES,
) -> DataFrame:
    """Accuracy and macro F1 of every classifier version, side by side.

    ``accepted`` tells whether a version beats ``baseline`` in both; NULL for it itself.
    """
    by = ["classifier_version"]
    rated = _totals(label_pairs(gold, predictions, actual, by), by, classes).select(
        *by, "correct", "total", _accuracy(), _mean_f1(classes)
    )
    every = Window.partitionBy()  # one row per classifier version
    is_base = F.col("classifier_version") == baseline

    def beats(column: str) -> Column:
        return F.col(column) > F.max(F.when(is_base, F.col(column))).over(every)

    accepted = F.when(~is_base, beats("accuracy") & beats("macro_f1"))
    return rated.withColumn("accepted", accepted)


def _of_version(classifications: DataFrame, version: str | None) -> DataFrame:
    if version is None:
        return classifications
    return classifications.where(F.col("classifier_version") == version)
