"""The data model over the given tables: where each query takes its issues and predictions.

Two sets of tables play the same part. ``documents`` (with ``orders`` and ``labels``) give issues
with texts; ``orders`` and ``lineitem`` give large tables with many rows per key.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triagelake.functions.columns import repo_directory, token_cost
from triagelake.functions.fixed import REQUIRED_FIELDS, STATES
from triagelake.operators.scoring import keyword_score, keyword_score_versions
from triagelake.session import scratch_path

LANGUAGES = ["en", "fr", "de", "es"]
# Two versions of the keyword scorer: the second knows fewer words.
TERMS = {
    "v2": {
        "en": ["the", "and", "of"],
        "fr": ["le", "la", "ou"],
        "de": ["der", "und", "die"],
        "es": ["el", "los", "que"],
    },
    "v3": {"en": ["the", "and"], "fr": ["le", "ou"], "de": ["der", "und"], "es": ["el", "que"]},
}
VERSION = "v2"
MODEL = "keywords"
# Sources 0 to 15 have a label map; one half also reads the quality mark as English.
LABEL_MAP = {
    f"src{i}": {"en": "english", "fr": "romance", "es": "romance", "de": "german"}
    | ({"quality": "english"} if i < 8 else {})
    for i in range(16)
}
CLASSIFIED_AT = "2026-01-01 00:00:00"


# Schemas of the given tables; a known schema saves reading footers to plan.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def now() -> Column:
    return F.lit(CLASSIFIED_AT).cast("timestamp")


def order_state() -> Column:
    return (
        F.when(F.col("o_orderstatus") == "O", "open")
        .when(F.col("o_orderstatus") == "F", "closed")
        .otherwise("pending")
    )


def _issue_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    orders = table(spark, sf_dir, "orders")
    labels = table(spark, sf_dir, "labels")
    return documents.join(orders, F.col("doc_id") == F.col("o_orderkey")).join(
        labels, "doc_id", "left"
    )


def _issue_columns() -> list[Column]:
    changed = F.col("o_orderdate").cast("string")
    return [
        F.col("doc_id").alias("id"),
        F.col("source").alias("repo"),
        (F.col("doc_id") + 1).alias("number"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("body"),
        order_state().alias("state"),
        changed.alias("created_at"),
        changed.alias("updated_at"),
        F.when(F.col("o_orderstatus") == "F", changed).alias("closed_at"),
        F.array_compact(
            F.array(
                F.col("lang"),
                F.when(F.col("quality") == 1, "quality"),
                F.when(F.col("toxic") == 1, "toxic"),
            )
        ).alias("labels"),
    ]


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _issue_rows(spark, sf_dir).select(*_issue_columns())


def classifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword classifications of the issues: low priority ones have none, unspecified ones are
    out of date, medium ones come from version v1."""
    priority = F.col("o_orderpriority")
    # scored at the scan: no text passes a join
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("issue_id"), "text")
    scored = keyword_score(documents, TERMS[VERSION], "text").drop("text")
    orders = table(spark, sf_dir, "orders").where(priority != "5-LOW")
    return scored.join(orders, F.col("issue_id") == F.col("o_orderkey")).select(
        "issue_id",
        F.col("choice").alias("issue_type"),
        "confidence",
        F.when(priority == "4-NOT SPECIFIED", "before")
        .otherwise(F.col("o_orderdate").cast("string"))
        .alias("issue_updated_at"),
        "input_tokens",
        F.lit(MODEL).alias("model"),
        F.when(priority == "3-MEDIUM", "v1").otherwise(VERSION).alias("classifier_version"),
        token_cost(F.col("input_tokens")).alias("estimated_cost_usd"),
        now().alias("classified_at"),
    )


def eval_set(spark: SparkSession, sf_dir: str, actual: str = "human_type") -> DataFrame:
    """Documents with their language as the reference class."""
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("repo"),
        F.col("doc_id").alias("issue_id"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("body"),
        F.col("lang").alias(actual),
    )


def predictions(spark: SparkSession, sf_dir: str, versions: list[str] = (VERSION,)) -> DataFrame:
    """Keyword predictions for all documents; several versions share one scan of the texts."""
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("issue_id"), F.col("text").alias("body")
    )
    scored = keyword_score_versions(documents, {v: TERMS[v] for v in versions})
    return scored.select(
        "issue_id", F.col("choice").alias("predicted_type"), "confidence", "input_tokens",
        "classifier_version",
    )


def order_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as issues: the priority is the repository."""
    changed = F.col("o_orderdate").cast("string")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("repo"),
        F.col("o_custkey").alias("number"),
        F.concat(F.lit("Order of customer "), F.col("o_custkey").cast("string")).alias("title"),
        F.col("o_orderstatus").alias("body"),
        order_state().alias("state"),
        changed.alias("created_at"),
        changed.alias("updated_at"),
    )


def line_classifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as classifications of their order, many per order."""
    tokens = F.floor("l_extendedprice").cast("int")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("issue_id"),
        F.col("l_returnflag").alias("issue_type"),
        (F.col("l_quantity") / F.lit(45.0)).alias("confidence"),
        F.col("l_shipdate").cast("string").alias("issue_updated_at"),
        tokens.alias("input_tokens"),
        F.lit(MODEL).alias("model"),
        F.col("l_linestatus").alias("classifier_version"),
        token_cost(tokens).alias("estimated_cost_usd"),
    )


def sound_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The issues that pass the checks of single rows."""
    whole = [F.col(c).isNotNull() for c in REQUIRED_FIELDS]
    return issues(spark, sf_dir).where(reduce(and_, whole, F.col("state").isin(STATES)))


def land_arrays(spark: SparkSession, sf_dir: str) -> str:
    """Write the issues as raw records, one JSON array per file; returns the path."""
    path = scratch_path(spark, "arrays")
    record = F.struct(
        "id", "number", "title", "body", "state", "created_at", "updated_at", "closed_at",
        F.transform("labels", lambda x: F.struct(x.alias("name"))).alias("labels"),
    )
    arrays = (
        issues(spark, sf_dir)
        .select(
            repo_directory(F.concat(F.lit("org/"), F.col("repo"))).alias("dir"),
            F.floor(F.col("id") / 1000).alias("page"),
            record.alias("record"),
        )
        .groupBy("dir", "page")
        .agg(F.to_json(F.collect_list("record")).alias("value"))
    )
    arrays.select("dir", "value").write.partitionBy("dir").option("maxRecordsPerFile", 1).text(path)
    return path


def land_pages(
    spark: SparkSession, sf_dir: str, rows: DataFrame | None = None, has_next: Column | None = None
) -> str:
    """Write the issues, or ``rows`` like them, as API pages, up to 100 per page, one page per line;
    returns the path. ``has_next`` tells by ``dir`` and ``page`` which pages name a next one (none)."""
    path = scratch_path(spark, "landing")
    node = F.struct(
        F.col("id").alias("databaseId"),
        "number",
        "title",
        "body",
        F.upper("state").alias("state"),
        F.col("created_at").alias("createdAt"),
        F.col("updated_at").alias("updatedAt"),
        F.col("closed_at").alias("closedAt"),
        F.struct(
            F.transform("labels", lambda x: F.struct(x.alias("name"))).alias("nodes")
        ).alias("labels"),
    )
    pages = (
        (issues(spark, sf_dir) if rows is None else rows)
        .select(
            repo_directory(F.concat(F.lit("org/"), F.col("repo"))).alias("dir"),
            F.floor(F.col("id") / 100).alias("page"),
            node.alias("node"),
        )
        .groupBy("dir", "page")
        .agg(F.collect_list("node").alias("nodes"))
    )
    following = F.lit(False) if has_next is None else has_next
    info = F.struct(following.alias("hasNextPage"), F.col("page").cast("string").alias("endCursor"))
    connection = F.struct(F.col("nodes"), info.alias("pageInfo"))
    pages.select(
        "dir", F.struct(F.struct(connection.alias("issues")).alias("repository")).alias("data")
    ).write.partitionBy("dir").json(path)
    return path
