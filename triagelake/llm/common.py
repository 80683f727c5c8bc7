"""Reading tables and running column functions over Arrow batches."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from triagelake.session import scratch_path

#: Rows turned into Python objects at once, which bounds a task's memory by this many long texts.
ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_columns(
    df: DataFrame, read: list[str], add: str | T.StructType, make: Callable[[], Callable],
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """``df`` with the columns of ``add``, computed from the columns ``read``.

    ``make()`` runs once per task and returns a function from lists (one per read column) to a
    list per added column. An added column takes the place of one of the same name. All other
    columns pass through as Arrow data and never become Python objects.
    """
    added = T._parse_datatype_string(add) if isinstance(add, str) else add
    names = {f.name for f in added.fields}
    passed = [f for f in df.schema.fields if f.name not in names and f.name not in drop]
    replaced = {f.name: f for f in added.fields}
    order = [replaced.get(f.name, f) for f in df.schema.fields if f.name not in drop]
    order += [f for f in added.fields if f.name not in df.columns]
    out = T.StructType(order)
    arrow = to_arrow_schema(out)
    passed_names = [f.name for f in passed]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                made = work(*[rows.column(c).to_pylist() for c in read])
                cells = {
                    f.name: pa.array(values, arrow.field(f.name).type)
                    for f, values in zip(added.fields, made)
                }
                cells |= {c: rows.column(c).cast(arrow.field(c).type) for c in passed_names}
                yield pa.RecordBatch.from_arrays([cells[f.name] for f in out.fields], schema=arrow)

    return df.mapInArrow(run, out)


def share_file(spark: SparkSession, data: bytes, name: str) -> str:
    """Write ``data`` below the shared folder and have every executor fetch it; the name under which
    ``SparkFiles.get`` finds it there. Executors that join later fetch it too."""
    path = scratch_path(spark, name)
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    try:
        for at in range(0, len(data), 1 << 22):
            out.write(bytearray(data[at : at + (1 << 22)]))
    finally:
        out.close()
    sc.addFile(path)
    return path.rsplit("/", 1)[1]


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def crc32_mod(column: str, n: int):
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def tokenizer_file(name: str) -> str:
    """The place of an installed public vocabulary file, on whatever machine this runs."""
    import public_tokenizers

    path = public_tokenizers.path(name)
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    return path
