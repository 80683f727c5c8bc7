"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake.session import materialise

#: Rows of one key, on one side, that are left to one task.
HEAVY = 100_000


def heavy_keys(left: DataFrame, right: DataFrame, key: str, heavy: int = HEAVY) -> DataFrame:
    """(key, salts): the keys with more than ``heavy`` rows in ``left`` that ``right`` has too, and among how many
    salts they are dealt. At most one row for ``heavy`` rows, written, so that Spark knows its size."""
    counted = left.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > heavy)
    salts = F.ceil(F.col("n") / heavy).cast("int").alias("salts")
    return materialise(counted.select(key, salts).join(right.select(key), key, "left_semi"))


def balanced_join(left: DataFrame, right: DataFrame, key: str, condition: Column | None = None,
                  heavy: int = HEAVY) -> DataFrame:
    """The inner join of two sides that share only ``key``; ``condition`` is applied to the joined rows.

    Rows of a heavy key of ``left`` are dealt over salts and the rows of ``right`` of that key are copied to
    each, so that no task meets more than about ``heavy`` rows of ``left`` at one key. Heavy keys are found by counting;
    all other rows have the salt 0. Of two heavy sides the caller gives the larger one as ``left``.
    """
    keys = heavy_keys(left, right, key, heavy)
    dealt = left.join(keys, key, "left").withColumn(
        "_salt", F.when(F.col("salts").isNull(), F.lit(0)).otherwise(
            F.pmod(F.monotonically_increasing_id(), F.col("salts")).cast("int"))
    ).drop("salts")
    copied = right.join(keys, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts") - 1, F.lit(0))))
    ).drop("salts")
    joined = dealt.join(copied, [key, "_salt"]).drop("_salt")
    return joined if condition is None else joined.where(condition)
