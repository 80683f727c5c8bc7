"""Exact selection inside groups that never brings a whole group into one task."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from triagelake.session import materialise

#: Narrow rows of a group that one task puts in order.
IN_ONE_TASK = 1_000_000


def order_hash(key: str, seed: int | None = None) -> Column:
    """A reproducible pseudo-random order: it depends on the key only, not on partitioning."""
    text = F.col(key).cast("string")
    return F.md5(text if seed is None else F.concat(F.lit(f"{seed}:"), text))


def first_per_group(
    df: DataFrame, group: list[str], order: list[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group with their rank, as ``row_number() <= n`` gives them.

    A group is first cut to ``n`` rows per lane (a set of input partitions), then over the
    lanes, so a group holding a third of all rows is sorted by many tasks. The lanes
    do not influence the result; ``order`` must be a total order within a group.
    """
    lanes = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_lane = Window.partitionBy(*group, "_lane").orderBy(*order)
    per_group = Window.partitionBy(*group).orderBy(*order)
    return (
        df.withColumn("_lane", F.spark_partition_id() % lanes)
        .withColumn(rank, F.row_number().over(per_lane))
        .where(F.col(rank) <= n)
        .drop("_lane")
        .withColumn(rank, F.row_number().over(per_group))
        .where(F.col(rank) <= n)
    )


def _range_totals(rows: DataFrame, group: list[str], of: str) -> DataFrame:
    """(group..., _low, _high, _start, _total, _rows) of key ranges: the values of ``_range``, or those
    of a range partitioning. Ranges are described by their keys, so that no later step depends on
    partition numbers."""
    sums = [
        F.max("_start").alias("_start"), F.sum("_weight").alias("_total"), F.count("*").alias("_rows")
    ]
    if of == "_range":
        totals = rows.groupBy(*group, F.col("_range").alias("_low")).agg(*sums)
        return totals.withColumn("_high", F.col("_low"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *group, "_key").withColumn("_part", F.spark_partition_id())
    return ranged.groupBy(*group, "_part").agg(
        F.min("_key").alias("_low"), F.max("_key").alias("_high"), *sums
    ).drop("_part")


def running_total_cut(
    rows: DataFrame,
    group: list[str],
    key: list[str],
    weight: Column,
    admit: Callable[[Column], Column],
    limits: DataFrame | None = None,
    descending: bool = False,
    bucket: Column | None = None,
    in_one_task: int = IN_ONE_TASK,
) -> DataFrame:
    """Per group the ``cut``: the key of the last row that a running total still admits, as the
    key column itself or, of several, a struct of them.

    Rows are taken in ``key`` order and a row is admitted while ``admit`` holds for the total
    weight of the rows before it. ``weight`` must not be negative, so the admitted rows are a
    prefix and one key per group describes them.
    ``limits`` has one row per group with columns ``admit`` may read. Rows without a key are left out.

    Instead of one ordered window per group, key ranges are totalled first, the small table of
    ranges is accumulated, and only the one range in which a group's cut lies goes on: while it has
    more than ``in_one_task`` rows it is cut in ranges again, then it is looked at row by row. Where it
    has a single key, that key is the cut. The first ranges come from ``bucket``, a column that grows
    with the key, or from a range partitioning on (group, key), which also splits hot groups and keys.
    ``rows`` should be narrow and cheap to read: it is read for the ranges and for the cut.
    """
    place = F.col(key[0]) if len(key) == 1 else F.struct(*key)
    rows = rows.select(
        *group, place.alias("_key"), weight.cast("long").alias("_weight"),
        F.lit(0).cast("long").alias("_start"), *([] if bucket is None else [bucket.alias("_range")]),
    ).where(F.col("_key").isNotNull())
    of = "_key" if bucket is None else "_range"

    def before(order: str, weights: str) -> Column:
        direction = F.col(order).desc() if descending else F.col(order).asc()
        earlier = Window.partitionBy(*group).orderBy(direction).rowsBetween(
            Window.unboundedPreceding, -1
        )
        return F.col("_start") + F.coalesce(F.sum(weights).over(earlier), F.lit(0))

    last = F.min if descending else F.max
    last_by = F.min_by if descending else F.max_by
    found, most = [], None
    while True:
        totals = _range_totals(rows, group, of).withColumn("_before", before("_low", "_total"))
        totals = totals.drop("_start", "_total")
        if limits is not None:
            totals = totals.join(limits, group)
        described = [c for c in totals.columns if c not in group]
        # Written: its size is then known when Spark chooses the join with the rows.
        cut_range = materialise(
            totals.where(admit(F.col("_before")))
            .groupBy(*group)
            .agg(last_by(F.struct(*described), F.col("_low")).alias("_cut"))
            .select(*group, "_cut.*")
        )
        one_key = F.lit(of == "_key") & (F.col("_low") == F.col("_high"))
        settled, largest = cut_range.agg(F.count_if(one_key), F.max(F.when(~one_key, F.col("_rows")))).first()
        if settled:
            found.append(cut_range.where(one_key).select(*group, F.col("_low").alias("cut")))
        open_range = cut_range.where(~one_key) if settled else cut_range
        inside = rows.drop("_start").join(open_range, group).where(
            F.col(of).between(F.col("_low"), F.col("_high"))
        )
        earlier_most, most = most, largest or 0
        if most <= in_one_task or most == earlier_most:
            break
        rows = materialise(inside.select(*group, "_key", "_weight", F.col("_before").alias("_start")))
        of = "_key"
    row_by_row = (
        inside.withColumnRenamed("_before", "_start")
        .withColumn("_before", before("_key", "_weight"))
        .where(admit(F.col("_before")))
        .groupBy(*group)
        .agg(last("_key").alias("cut"))
    )
    return reduce(DataFrame.unionByName, [*found, row_by_row] if most or not found else found)
