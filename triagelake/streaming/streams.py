"""Ingest and scoring as restartable streams.

The tables, not the state store, remember what is done: a batch keeps only records its table
lacks, and a batch that was committed is not written again. State therefore does not grow with the number
of records, and no watermark is needed. The tables lie in buckets of their key (``sources.buckets``): a batch
reads one manifest and the files of the buckets of its keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from triagelake.operators.incremental import pending
from triagelake.operators.ingest import ingest, latest_per_key, new_of_counted, records
from triagelake.schemas import CLASSIFICATION, RAW
from triagelake.session import materialise
from triagelake.sources.pages import stream_pages
from triagelake.sources.buckets import BucketedTable

STORED = T.StructType([T.StructField("repo", T.StringType()), *RAW.fields])


def _run_id(batch: DataFrame, batch_id: int) -> str:
    """A name only this batch has, also when it is repeated: the query's id is kept in its
    checkpoint, and a new checkpoint brings a new id."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{batch_id}"


def record_table(spark: SparkSession, path: str) -> BucketedTable:
    """The table an ingest stream writes."""
    return BucketedTable(spark, path, STORED, ["repo", "id"])


def score_table(spark: SparkSession, path: str) -> BucketedTable:
    """The table a scoring stream writes: its ledger."""
    return BucketedTable(spark, path, CLASSIFICATION, ["issue_id"])


def ingest_stream(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    repo_caps: dict[str, int] | None = None,
    total_cap: int | None = None,
    trigger: dict | None = None,
    multi_line: bool = True,
    max_files: int | None = None,
) -> StreamingQuery:
    """Append the records of newly landed pages to ``table``, without copies and, if given,
    under the caps."""

    def store(batch: DataFrame, batch_id: int) -> None:
        run_id, stored = _run_id(batch, batch_id), record_table(batch.sparkSession, table)
        if stored.has_run(run_id):
            return
        batch = materialise(batch, "zstd")  # the pages are parsed once
        keys = materialise(batch.groupBy("repo", "id").agg(F.count("*").alias("copies")))
        known = materialise(stored.read_for(keys).select("repo", "id"))
        if not repo_caps and total_cap is None:
            fresh = new_of_counted(batch, known, keys)
        else:  # stored records have no copies, so rows are ids
            counts = stored.read().groupBy("repo").agg(F.count("*").alias("n"))
            fresh = ingest(batch, known, repo_caps, total_cap, counts)
        stored.append(fresh, run_id, stream=True)

    return (
        records(stream_pages(spark, landing, multi_line, max_files))
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def score_stream(
    issues: DataFrame,
    classify: Callable[[DataFrame], DataFrame],
    scored: str,
    checkpoint: str,
    version: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Score new and changed records of a stream of issues rows.

    ``classify`` turns pending (id, title, body, updated_at) rows into classifications rows, which
    are appended to ``scored`` and never changed: all of them are the usage ledger, the latest
    per record is the current state (``current_state``). One write per batch, so a crash leaves
    neither a cost without a prediction nor the reverse, and a repeated batch is not scored again.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        run_id, table = _run_id(batch, batch_id), score_table(batch.sparkSession, scored)
        if table.has_run(run_id):
            return
        newest = materialise(latest_per_key(batch, ["id"]))
        known = table.read_for(newest.select(F.col("id").alias("issue_id")))
        table.append(classify(pending(newest, current_state(known), version)), run_id, stream=True)

    return (
        issues.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def current_state(scored: DataFrame) -> DataFrame:
    """At most one row per record, of whichever version: the one classified last."""
    return latest_per_key(
        scored.select(*CLASSIFICATION.fieldNames()), ["issue_id"], ["classified_at"]
    )
