"""State tables on plain Parquet: snapshots that are replaced, ledgers that grow.

No directory that is being read is overwritten. A snapshot is complete once Spark has written
its ``_SUCCESS`` file, so readers see the previous one until then, also when a writer is lost.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triagelake.schemas import ensure_columns
from triagelake.session import literal_table, materialise


def _complete(spark: SparkSession, root: str, pattern: str) -> list[str]:
    """Names of the directories below ``root``, on any Hadoop file system, that match the glob
    pattern and were written completely."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(root, f"{pattern}/_SUCCESS")
    found = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob)
    return sorted(status.getPath().getParent().getName() for status in found or [])


def read_snapshot(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The current state, with columns added to ``schema`` since as NULL; empty before the
    first write."""
    done = _complete(spark, root, "v*")
    if not done:
        return literal_table(spark, schema, [])
    return ensure_columns(spark.read.parquet(f"{root}/{done[-1]}"), schema)


def write_snapshot(df: DataFrame, root: str) -> int:
    """Write the next state beside the current one; it replaces it when it is complete."""
    done = _complete(df.sparkSession, root, "v*")
    version = int(done[-1][1:]) + 1 if done else 0
    df.write.mode("overwrite").parquet(f"{root}/v{version:08d}")
    return version


def read_ledger(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All rows of the completely appended runs, with their ``run_id``."""
    full = T.StructType([*schema.fields, T.StructField("run_id", T.StringType())])
    runs = [f"{root}/{name}" for name in _complete(spark, root, "run_id=*")]
    if not runs:
        return literal_table(spark, full, [])
    return spark.read.schema(full).option("basePath", root).parquet(*runs)


def has_run(spark: SparkSession, root: str, run_id: str) -> bool:
    """Whether the rows of a run have been appended completely."""
    return bool(_complete(spark, root, f"run_id={run_id}"))


def append_ledger(df: DataFrame, root: str, run_id: str) -> None:
    """Append the rows of one run. A repeated run replaces its own rows and no others, so a
    retry cannot count a cost twice."""
    if not re.fullmatch(r"[A-Za-z0-9._-]+", run_id):
        raise ValueError(f"run_id not usable as a directory name: {run_id!r}")
    df.write.mode("overwrite").parquet(f"{root}/run_id={run_id}")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, or no rows while it does not exist."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop_path):
        return literal_table(spark, schema, [])
    return ensure_columns(spark.read.option("mergeSchema", True).parquet(path), schema)


def upsert_latest(current: DataFrame, new: DataFrame, key: str = "issue_id") -> DataFrame:
    """``current`` with the rows of ``new`` in place of all rows, of any version, of their keys.

    Of several new rows of a key the one classified last stays. ``new`` is computed once and written,
    for it is read twice: a scorer in it would otherwise answer, and be paid, twice.
    """
    new = materialise(new)
    order = ["classified_at", *[c for c in new.columns if c not in (key, "classified_at")]]
    latest = new.groupBy(key).agg(F.max(F.struct(*order)).alias("_row")).select(
        key, *[F.col(f"_row.{c}") for c in order]
    )
    kept = current.join(new.select(key), key, "left_anti")
    return kept.unionByName(latest)


def replace_table(df: DataFrame, name: str) -> None:
    """CREATE OR REPLACE a catalog table from a query that does not read it."""
    df.write.mode("overwrite").saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """A catalog table bucketed and sorted by ``key``: joins of two such tables on it need no
    shuffle. Each bucket is written by one task."""
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(name)
    )
