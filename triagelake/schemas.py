"""Explicit table schemas and additive schema evolution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NAME = T.StructType([T.StructField("name", T.StringType())])

NODE = T.StructType(
    [
        T.StructField("databaseId", T.LongType()),
        T.StructField("number", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("createdAt", T.StringType()),
        T.StructField("updatedAt", T.StringType()),
        T.StructField("closedAt", T.StringType()),
        T.StructField("labels", T.StructType([T.StructField("nodes", T.ArrayType(_NAME))])),
    ]
)

PAGE = T.StructType(
    [
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField(
                        "repository",
                        T.StructType(
                            [
                                T.StructField(
                                    "issues",
                                    T.StructType(
                                        [
                                            T.StructField("nodes", T.ArrayType(NODE)),
                                            T.StructField(
                                                "pageInfo",
                                                T.StructType(
                                                    [
                                                        T.StructField("hasNextPage", T.BooleanType()),
                                                        T.StructField("endCursor", T.StringType()),
                                                    ]
                                                ),
                                            ),
                                        ]
                                    ),
                                )
                            ]
                        ),
                    ),
                    T.StructField(
                        "rateLimit",
                        T.StructType(
                            [
                                T.StructField("cost", T.LongType()),
                                T.StructField("remaining", T.LongType()),
                                T.StructField("resetAt", T.StringType()),
                            ]
                        ),
                    ),
                ]
            ),
        ),
        T.StructField(
            "errors", T.ArrayType(T.StructType([T.StructField("message", T.StringType())]))
        ),
    ]
)

# One stored record as the collector writes it; `repo` comes from the directory.
RAW = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("number", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("updated_at", T.StringType()),
        T.StructField("closed_at", T.StringType()),
        T.StructField("labels", T.ArrayType(_NAME)),
    ]
)

ISSUE = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("repo", T.StringType()),
        T.StructField("number", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("updated_at", T.StringType()),
        T.StructField("closed_at", T.StringType()),
        T.StructField("labels", T.ArrayType(T.StringType())),
    ]
)

CLASSIFICATION_BASE = T.StructType(
    [
        T.StructField("issue_id", T.LongType()),
        T.StructField("issue_type", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
    ]
)

CLASSIFICATION = T.StructType(
    CLASSIFICATION_BASE.fields
    + [
        T.StructField("issue_updated_at", T.StringType()),
        T.StructField("input_tokens", T.IntegerType()),
        T.StructField("model", T.StringType()),
        T.StructField("classifier_version", T.StringType()),
        T.StructField("estimated_cost_usd", T.DoubleType()),
        T.StructField("classified_at", T.TimestampType()),
    ]
)

USAGE = T.StructType(
    [
        T.StructField("issue_id", T.LongType()),
        T.StructField("classifier_version", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("input_tokens", T.IntegerType()),
        T.StructField("estimated_cost_usd", T.DoubleType()),
        T.StructField("classified_at", T.TimestampType()),
    ]
)

PREDICTION = T.StructType(
    [
        T.StructField("issue_id", T.LongType()),
        T.StructField("predicted_type", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("input_tokens", T.IntegerType()),
        T.StructField("classifier_version", T.StringType()),
    ]
)

REVIEW_SHEET = T.StructType(
    [
        T.StructField("issue_id", T.LongType()),
        T.StructField("repo", T.StringType()),
        T.StructField("number", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("github_labels", T.StringType()),
        T.StructField("weak_label", T.StringType()),
        T.StructField("predicted_type", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("gold_label", T.StringType()),
    ]
)

RESPONSE = T.StructType(
    [
        T.StructField(
            "answers",
            T.StructType(
                [
                    T.StructField(
                        "issue_type",
                        T.StructType(
                            [
                                T.StructField("choice", T.StringType()),
                                T.StructField("confidence", T.DoubleType()),
                            ]
                        ),
                    )
                ]
            ),
        ),
        T.StructField("usage", T.StructType([T.StructField("input_tokens", T.IntegerType())])),
    ]
)


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the columns of ``schema`` that ``df`` lacks, as NULL, and order them as in it."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
