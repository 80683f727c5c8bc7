"""Review sheets as CSV: texts keep their line breaks and quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triagelake.schemas import REVIEW_SHEET


# Quotes are doubled, and spaces around a text belong to it.
_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_sheet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**_OPTIONS).csv(path)


def read_sheet(spark: SparkSession, path: str, schema: T.StructType = REVIEW_SHEET) -> DataFrame:
    """Read with a fixed schema. An empty string and NULL look the same in CSV: both come back
    as NULL, except in the text columns title and body, which are made ''."""
    df = (
        spark.read.schema(schema)
        .options(**_OPTIONS, multiLine=True, mode="FAILFAST")
        .csv(path)
    )
    texts = [c for c in ("title", "body") if c in df.columns]
    return df.na.fill("", texts) if texts else df
