import random
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from triagelake.operators.ranking import first_per_group, order_hash, running_total_cut


def skewed(n=3000, seed=1):
    """Rows (grp, key, other, weight); one group holds most rows, keys repeat across groups."""
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < 0.6 else f"g{rng.randrange(5)}", i, rng.randrange(4), rng.randrange(9))
        for i in rng.sample(range(10 * n), n)
    ]


@pytest.mark.parametrize("n", [1, 7, 1500])
def test_first_per_group_is_row_number(spark, rows, n):
    data = skewed()
    df = spark.createDataFrame(data, "grp string, key long, other int, weight int").repartition(7)
    got = rows(first_per_group(df, ["grp"], [F.col("other").desc(), F.col("key")], n), "grp", "key", "rank")
    want = []
    for g, members in groupby(sorted(data), key=lambda r: r[0]):
        ordered = sorted(members, key=lambda r: (-r[2], r[1]))
        want += [(g, r[1], i) for i, r in enumerate(ordered[:n], 1)]
    assert got == sorted(want)


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("limit", [0, 1, 2, 500, 10**9])
def test_cut_is_the_flat_running_total(spark, rows, limit, descending):
    data = skewed()
    df = spark.createDataFrame(data, "grp string, key long, other int, weight int")
    limits = df.select("grp").distinct().withColumn("lim", F.lit(limit))
    cut = running_total_cut(
        df, ["grp"], ["other", "key"], F.col("weight"), lambda b: b < F.col("lim"), limits, descending
    )
    got = {r["grp"]: (r["cut"]["other"], r["cut"]["key"]) for r in cut.collect()}
    want = {}
    for g, members in groupby(sorted(data), key=lambda r: r[0]):
        before = 0
        for r in sorted(members, key=lambda r: (r[2], r[1]), reverse=descending):
            if before < limit:
                want[g] = (r[2], r[1])
            before += r[3]
    assert got == want


def test_cut_with_buckets_equals_cut_with_ranges(spark, rows):
    df = spark.createDataFrame(skewed(), "grp string, key long, other int, weight int").withColumn(
        "h", order_hash("key", 3)
    )
    limits = df.groupBy("grp").agg((F.count("*") / 3).alias("lim"))

    def cut(bucket):
        return running_total_cut(
            df, ["grp"], ["h", "key"], F.lit(1), lambda b: b < F.col("lim"), limits, bucket=bucket
        )

    assert rows(cut(None), "grp", "cut.h") == rows(cut(F.substring("h", 1, 4)), "grp", "cut.h")


def test_equal_keys_and_one_hot_key(spark, rows):
    """A key that holds a third of all rows is admitted as a whole or not at all."""
    data = [("g", 5)] * 400 + [("g", k) for k in range(10)] + [("g", k) for k in range(100, 900)]
    df = spark.createDataFrame(data, "grp string, key long")
    limits = spark.createDataFrame([("g", 20)], "grp string, lim long")
    cut = running_total_cut(df, ["grp"], ["key"], F.lit(1), lambda b: b < F.col("lim"), limits)
    assert rows(cut, "cut") == [(5,)]


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("bucketed", [False, True])
def test_ranges_are_cut_again_until_they_are_small(spark, rows, descending, bucketed):
    """With ten rows to a task, and one key with a third of a group's rows."""
    data = [(g, 700 if i % 3 else i, 1 + i % 2) for g, n in (("hot", 4000), ("g", 30)) for i in range(n)]
    df = spark.createDataFrame(data, "grp string, key long, weight int").repartition(5)
    for limit in (37, 3000):
        limits = spark.createDataFrame([("hot", limit), ("g", limit)], "grp string, lim long")
        cut = running_total_cut(
            df, ["grp"], ["key"], F.col("weight"), lambda b: b < F.col("lim"), limits, descending,
            F.floor(F.col("key") / 1000) if bucketed else None, in_one_task=10,
        )
        want = []
        for g, members in groupby(data, key=lambda r: r[0]):
            before, last = 0, None
            for r in sorted(members, key=lambda r: r[1], reverse=descending):
                if before < limit:
                    last = r[1]
                before += r[2]
            want.append((g, last))
        assert rows(cut, "grp", "cut") == sorted(want)


def test_partitions_do_not_change_results(spark, rows):
    data = skewed()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    try:
        for parts in ("1", "3", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            df = spark.createDataFrame(data, "grp string, key long, other int, weight int")
            seen.append(rows(first_per_group(df, ["grp"], [F.col("key")], 40), "grp", "key", "rank"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2]
