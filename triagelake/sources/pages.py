"""Landing zone of nested API pages and the raw batches stored from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triagelake.functions.columns import repo_from_path
from triagelake.schemas import PAGE, RAW

NODES = PAGE["data"].dataType["repository"].dataType["issues"].dataType["nodes"].dataType


def page_nodes(pages: DataFrame) -> DataFrame:
    """(repo, node) per record of each page; a page that carries errors, or no list of records, fails the job."""
    checked = F.when(
        F.size("errors") > 0,
        F.raise_error(F.to_json("errors")).cast(PAGE["data"].dataType),
    ).otherwise(F.col("data"))
    nodes = F.col("data.repository.issues.nodes")
    listed = F.coalesce(
        nodes, F.raise_error(F.concat(F.lit("page without records: "), F.coalesce("repo", F.lit("?")))).cast(NODES)
    )
    return pages.select("repo", checked.alias("data")).select("repo", F.explode(listed).alias("node"))


def _repo_of_file() -> Column:
    return repo_from_path(F.col("_metadata.file_path"))


def _read_pages(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    pages = (
        spark.read.schema(PAGE).option("multiLine", multi_line).option("mode", "FAILFAST")
        .json(f"{path}/*/*.json")
    )
    return pages.withColumn("repo", _repo_of_file())


def _states(pages: DataFrame) -> DataFrame:
    following = F.coalesce(F.col("data.repository.issues.pageInfo.hasNextPage"), F.lit(True))
    counted = pages.groupBy("repo").agg(F.count("*").alias("pages"), F.count_if(~following).alias("last_pages"))
    return counted.withColumn("finished", F.col("last_pages") > 0)


def landing_states(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """(repo, pages, last_pages, finished): a repository whose pages all name a next page has not landed
    as a whole. A page without that information counts as one with a next page; pages do not name
    their predecessor, so one that is absent between others does not show."""
    return _states(_read_pages(spark, path, multi_line))


def scan_pages(
    spark: SparkSession, path: str, multi_line: bool = True, finished: bool = False
) -> DataFrame:
    """Nodes of the page documents below ``path``, one directory ``owner_name`` per repository.

    Documents over several lines are read whole, one task per file; pages stored one per line
    (``multi_line=False``) are split like any text. With ``finished``, a repository that has not landed as
    a whole fails the job; without it, a walk may stop early, as one under a cap does.
    """
    pages = _read_pages(spark, path, multi_line)
    if finished:
        cut = _states(pages).where(~F.col("finished")).agg(F.min("repo").alias("repo")).scalar()
        stop = F.raise_error(F.concat(F.lit("landing is not finished: "), cut)).cast(PAGE["data"].dataType)
        pages = pages.withColumn("data", F.when(cut.isNotNull(), stop).otherwise(F.col("data")))
    return page_nodes(pages)


def stream_pages(
    spark: SparkSession, path: str, multi_line: bool = True, max_files: int | None = None
) -> DataFrame:
    """The same nodes as a stream; a page is read once, when its file appears. ``max_files``
    bounds the files of one batch, for instance of the first one over a full landing zone."""
    reader = spark.readStream.schema(PAGE).option("multiLine", multi_line).option("mode", "FAILFAST")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    pages = reader.json(f"{path}/*/*.json")
    return page_nodes(pages.withColumn("repo", _repo_of_file()))


def write_raw(records: DataFrame, path: str, mode: str = "append") -> None:
    """Store raw records as JSON, one directory ``repo=...`` per repository."""
    records.write.mode(mode).partitionBy("repo").json(path)


def scan_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw records stored by ``write_raw``; ``repo`` comes from the directories, which also
    prune reads of single repositories."""
    schema = T.StructType([*RAW.fields, T.StructField("repo", T.StringType())])
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def scan_raw_batches(spark: SparkSession, path: str, files: str = "*/*.json") -> DataFrame:
    """Raw records kept as one JSON array per file in directories named ``owner_name``."""
    return (
        spark.read.schema(RAW).option("multiLine", True).option("mode", "FAILFAST")
        .json(f"{path}/{files}")
        .withColumn("repo", _repo_of_file())
    )
