"""Column expressions shared by the operators."""

from __future__ import annotations

import re
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from triagelake.functions.fixed import INSTRUCTIONS, PRICE_PER_MILLION_TOKENS
from triagelake.schemas import RESPONSE

# Letters and digits of the languages the keyword scorer knows; anything else ends a word.
WORD = "a-z0-9à-öø-ÿœß"


def text_or_empty(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, 0 where the denominator is 0."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def any_of(conditions: list[Column]) -> Column:
    return reduce(or_, conditions)


def token_cost(tokens: Column, price: float = PRICE_PER_MILLION_TOKENS) -> Column:
    return tokens / F.lit(1_000_000.0) * F.lit(price)


def sent_text(body: Column, chars: int | None = None) -> Column:
    """What is sent of a text: all of it, or its first ``chars`` characters where a service sets a limit."""
    whole = text_or_empty(body)
    return whole if chars is None else F.substring(whole, 1, chars)


def estimated_tokens(body: Column, chars: int | None = None) -> Column:
    """Tokens a request for ``body`` needs: one per four characters of what is sent, at least 1."""
    return (F.floor(F.length(sent_text(body, chars)) / 4) + 1).cast("int")


def repo_from_path(path: Column) -> Column:
    """``owner/name`` from the directory ``owner_name`` or ``column=owner_name`` of a file; only
    the first ``_`` is the separator."""
    directory = F.element_at(F.split(path, "/"), -2)
    return F.regexp_replace(F.regexp_replace(directory, "^[^=]+=", ""), "^([^_]*)_", "$1/")


def repo_directory(repo: Column) -> Column:
    return F.translate(repo, "/", "_")


def repo_owner(repo: Column) -> Column:
    return F.split_part(repo, F.lit("/"), F.lit(1))


def repo_name(repo: Column) -> Column:
    return F.split_part(repo, F.lit("/"), F.lit(2))


def scoring_request(
    title: Column, body: Column, model: str, criteria: dict[str, str], chars: int | None = None
) -> Column:
    """The JSON document sent to the scorer for one record, with the whole text unless ``chars`` cuts it."""
    asked = F.create_map(*[F.lit(x) for pair in criteria.items() for x in pair])
    return F.to_json(
        F.struct(
            F.lit(model).alias("model"),
            F.struct(
                text_or_empty(title).alias("title"),
                sent_text(body, chars).alias("body"),
            ).alias("state"),
            F.struct(
                F.struct(
                    F.lit("choice").alias("type"),
                    F.lit(INSTRUCTIONS).alias("instructions"),
                    asked.alias("criteria"),
                ).alias("issue_type")
            ).alias("questions"),
        )
    )


def scoring_response(choice: Column, confidence: Column, tokens: Column) -> Column:
    """The JSON document a scorer answers with."""
    return F.to_json(
        F.struct(
            F.struct(
                F.struct(choice.alias("choice"), confidence.alias("confidence")).alias("issue_type")
            ).alias("answers"),
            F.struct(tokens.alias("input_tokens")).alias("usage"),
        )
    )


def parsed_response(response: Column) -> Column:
    """(choice, confidence, input_tokens) of a response; an answer without tokens is an error."""
    parsed = F.from_json(response, RESPONSE)
    tokens = F.coalesce(
        parsed["usage"]["input_tokens"],
        F.raise_error(F.lit("response without usage.input_tokens")).cast("int"),
    )
    return F.struct(
        parsed["answers"]["issue_type"]["choice"].alias("choice"),
        parsed["answers"]["issue_type"]["confidence"].alias("confidence"),
        tokens.alias("input_tokens"),
    )


def keyword_hits(text: Column, terms: dict[str, list[str]]) -> Column:
    """All scorer words of a text, found in one pass over it."""
    words = sorted({w for ws in terms.values() for w in ws})
    if not words or not all(re.fullmatch(f"[{WORD}]+", w) for w in words):
        raise ValueError(f"not words of lower-case letters and digits: {words}")
    pattern = f"(?<![{WORD}])({'|'.join(words)})(?![{WORD}])"
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(1))


def keyword_counts(hits: Column, terms: dict[str, list[str]]) -> list[Column]:
    """Per class the number of its words among the hits."""

    def count(words: list[str]) -> Column:
        return F.size(F.filter(hits, lambda word: word.isin(words)))

    return [count(words) for words in terms.values()]


def keyword_choice(counts: dict[str, Column], fallback: str = "other") -> list[Column]:
    """choice and confidence from the counts: the class with most hits, the first one on a tie,
    ``fallback`` without any hit; the confidence is its share of all hits."""
    top = F.greatest(*counts.values(), F.lit(0))
    choice = F.coalesce(
        *[F.when((n == top) & (n > 0), F.lit(name)) for name, n in counts.items()],
        F.lit(fallback),
    )
    confidence = ratio(top, reduce(add, counts.values()))
    return [choice.alias("choice"), confidence.alias("confidence")]
