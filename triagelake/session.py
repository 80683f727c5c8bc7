"""Small session helpers: reliable checkpoints, scratch paths and literal tables."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def shared_dir(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``; where that is unset, one in the
    warehouse, which all executors share too."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints")
    return named or sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/triagelake/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` once and go on from what was written, which survives the loss of executors.

    A Parquet table below the checkpoint folder: smaller than a checkpoint of rows, and later
    steps read only the columns they need. ``compression`` is that of the session unless given.
    """
    path = scratch_path(df.sparkSession, "step")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def only_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The ``rows`` whose key columns occur in ``keys``, a written table of keys. NULL is a key too.

    Spark knows the size of a written table: below ``spark.sql.autoBroadcastJoinThreshold`` bytes the keys
    are sent to the rows, which are then only scanned; otherwise both sides are shuffled by key, the rows after
    a Bloom filter of the keys. Catalyst plans that filter for joins with a side that looks chosen, hence
    the comparison, which every key passes. Its limits are those below
    ``spark.sql.optimizer.runtime.bloomFilter``: rows of 10 GB or more, keys of up to 10 MB, and 8 megabits
    for a million keys (2 in 100 other rows pass; more with more keys) unless they are raised. The exact join follows.
    """
    named = keys.select(*[F.col(c).alias(f"_key_{c}") for c in keys.columns])
    chosen = named.where(F.xxhash64(*named.columns) >= F.lit(-(1 << 63)))
    same = [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in keys.columns]
    return rows.join(chosen, same, "left_semi")


def literal_table(spark: SparkSession, schema: T.StructType, rows: list[tuple]) -> DataFrame:
    """A small table of parameters. Its exact size is known to Catalyst, which broadcasts it
    when it lies below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it when not."""
    columns = list(zip(*rows)) if rows else [[] for _ in schema.fields]
    arrow = to_arrow_schema(schema)
    table = pa.table([pa.array(c, t) for c, t in zip(columns, arrow.types)], schema=arrow)
    return spark.createDataFrame(table, schema)
