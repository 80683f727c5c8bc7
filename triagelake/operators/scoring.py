"""Scoring: a native keyword scorer and any scorer that answers requests in batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake.functions.columns import (
    estimated_tokens,
    keyword_choice,
    keyword_counts,
    keyword_hits,
    parsed_response,
    scoring_request,
    token_cost,
)
from triagelake.functions.fixed import PRICE_PER_MILLION_TOKENS
from triagelake.operators.incremental import unscored_rows

# Makes the function that answers a batch of requests; called once per task, so that a
# client is opened once and not for every record.
ScorerFactory = Callable[[], Callable[[pd.Series], pd.Series]]

#: Requests that are Python objects at once, which bounds a task's memory by this many long texts.
ROWS = 256


def keyword_score(
    df: DataFrame, terms: dict[str, list[str]], text: str = "body", fallback: str = "other"
) -> DataFrame:
    """Add choice, confidence and input_tokens with column expressions only."""
    return keyword_score_versions(df, {"": terms}, text, fallback).drop("classifier_version")


def keyword_score_versions(
    df: DataFrame, versions: dict[str, dict[str, list[str]]], text: str = "body",
    fallback: str = "other",
) -> DataFrame:
    """Score with several term lists at once: one row per input row and version, with
    classifier_version, choice, confidence and input_tokens. Each text is searched once."""
    kept = df.columns
    words = {f"{version}/{name}": ws for version, terms in versions.items() for name, ws in terms.items()}
    # One step each for words, counts and choice: none is computed twice.
    hits = df.select(
        *kept,
        estimated_tokens(F.col(text)).alias("input_tokens"),
        keyword_hits(F.col(text), words).alias("_hits"),
    )
    counts = keyword_counts(F.col("_hits"), words)
    counted = hits.select(
        *kept, "input_tokens", *[n.alias(f"_n{i}") for i, n in enumerate(counts)]
    )
    column = {key: F.col(f"_n{i}") for i, key in enumerate(words)}
    chosen = {
        version: keyword_choice({name: column[f"{version}/{name}"] for name in terms}, fallback)
        for version, terms in versions.items()
    }
    if len(chosen) == 1:
        (version, choice), = chosen.items()
        return counted.select(
            *kept, F.lit(version).alias("classifier_version"), *choice, "input_tokens"
        )
    answers = [
        F.struct(F.lit(version).alias("classifier_version"), *choice)
        for version, choice in chosen.items()
    ]
    return counted.select(*kept, F.inline(F.array(*answers)), "input_tokens")


def keyword_scorer(terms: dict[str, list[str]], fallback: str = "other") -> ScorerFactory:
    """The keyword scorer as a request/response service, for tests and dry runs."""

    def factory() -> Callable[[pd.Series], pd.Series]:
        import json
        import re

        owners: dict[str, list[str]] = {}  # a word counts for each of its classes
        for name, listed in terms.items():
            for word in dict.fromkeys(listed):
                owners.setdefault(word, []).append(name)
        words = re.compile("[a-z0-9à-öø-ÿœß]+")

        def answer(request: str) -> str:
            body = json.loads(request)["state"]["body"]
            counts = dict.fromkeys(terms, 0)
            for word in words.findall(body.lower()):
                for name in owners.get(word, ()):
                    counts[name] += 1
            total = sum(counts.values())
            choice = max(counts, key=counts.get) if total else fallback
            share = counts[choice] / total if total else 0.0
            return json.dumps(
                {
                    "answers": {"issue_type": {"choice": choice, "confidence": share}},
                    "usage": {"input_tokens": len(body) // 4 + 1},
                }
            )

        return lambda requests: requests.map(answer)

    return factory


def exchange(df: DataFrame, scorer: ScorerFactory, request: str = "request") -> DataFrame:
    """Send each row's request to the scorer, ``ROWS`` at a time, and add its answer as ``response``."""
    import triagelake.operators.scoring as here

    cloudpickle.register_pickle_by_value(here)  # executors need no installed copy
    kept = [df.schema[c] for c in df.columns if c != request]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answer = scorer()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                response = pa.Array.from_pandas(answer(rows.column(request).to_pandas()), type=pa.string())
                yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in names], response], [*names, "response"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return df.mapInArrow(run, f"{fields}, response string")


def score(
    df: DataFrame,
    scorer: ScorerFactory,
    version: str,
    model: str,
    criteria: dict[str, str],
    now: Column | None = None,
    price: float = PRICE_PER_MILLION_TOKENS,
    parallel: int | None = None,
    chars: int | None = None,
) -> DataFrame:
    """Score (id, title, body, updated_at) rows; returns rows of the classifications table.

    ``parallel`` bounds the number of scorers at work at once. Whole texts are sent; ``chars`` cuts
    them where a service takes no more. The result should be written
    before it is used twice, or every request is sent twice.
    """
    requests = df.select(
        F.col("id").alias("issue_id"),
        F.col("updated_at").alias("issue_updated_at"),
        scoring_request(F.col("title"), F.col("body"), model, criteria, chars).alias("request"),
    )
    if parallel is not None:
        requests = requests.repartition(parallel)
    answers = exchange(requests, scorer).select(
        "issue_id", "issue_updated_at", parsed_response(F.col("response")).alias("a")
    )
    return classification_rows(
        answers.select("issue_id", "issue_updated_at", "a.*"), version, model, now, price
    )


def resume_scores(
    rows: DataFrame,
    done: DataFrame,
    scorer: ScorerFactory,
    version: str,
    model: str,
    criteria: dict[str, str],
    parallel: int | None = None,
    chars: int | None = None,
) -> DataFrame:
    """Predictions for the (issue_id, title, body) rows that ``done`` has none for yet, of this
    version. Append them to ``done``: a run that was cut short goes on where it stopped."""
    left = unscored_rows(rows, done, version).select(
        F.col("issue_id").alias("id"), "title", "body", F.lit(None).cast("string").alias("updated_at")
    )
    scored = score(left, scorer, version, model, criteria, parallel=parallel, chars=chars)
    return scored.select(
        "issue_id", F.col("issue_type").alias("predicted_type"), "confidence", "input_tokens",
        "classifier_version",
    )


def classification_rows(
    scored: DataFrame,
    version: str,
    model: str,
    now: Column | None = None,
    price: float = PRICE_PER_MILLION_TOKENS,
) -> DataFrame:
    """(issue_id, issue_updated_at, choice, confidence, input_tokens) as classifications."""
    return scored.select(
        "issue_id",
        F.col("choice").alias("issue_type"),
        "confidence",
        "issue_updated_at",
        "input_tokens",
        F.lit(model).alias("model"),
        F.lit(version).alias("classifier_version"),
        token_cost(F.col("input_tokens"), price).alias("estimated_cost_usd"),
        (F.current_timestamp() if now is None else now).alias("classified_at"),
    )


def usage_rows(classified: DataFrame) -> DataFrame:
    """The ledger rows of scored records."""
    return classified.select(
        "issue_id", "classifier_version", "model", "input_tokens", "estimated_cost_usd",
        "classified_at",
    )
