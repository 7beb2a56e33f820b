"""Record contracts and expectations as columns of failure messages."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.functions.text import is_blank, is_falsy, is_http_url, iso_time, strip
from gazette.functions.vectors import check_dim
from gazette.schemas import (
    DOMAIN_TAGS,
    EMBEDDING_DIM,
    MAX_ENTITIES,
    RECENCY_DAYS,
    SECTIONS,
    SENTIMENTS,
    SUMMARY_MAX,
    SUMMARY_MIN,
)

FAILURES = "_failures"

# Looks a field up by name: in the row, or in a struct.
Field = Callable[[str], Column]
# Whether a field is bad (never NULL), and what to say about it.
Check = tuple[Column, Column]


def collect_failures(checks: list[Check]) -> Column:
    """All messages of the checks that failed, in order; empty if none did."""
    return F.array_compact(F.array(*[F.when(bad, message) for bad, message in checks]))


def passes(checks: list[Check]) -> Column:
    """True if no check failed; stops at the first one that does."""
    return ~reduce(lambda a, b: a | b, [bad for bad, _ in checks])


def _one_of(at: Field, name: str, allowed: tuple[str, ...]) -> Check:
    known = F.coalesce(at(name).isin(*allowed), F.lit(False))
    return ~known, F.lit(f"{name}: must be one of {', '.join(allowed)}")


def _present(at: Field, name: str) -> Check:
    return at(name).isNull(), F.lit(f"{name}: missing or unreadable")


def _not_blank(at: Field, name: str) -> Check:
    return is_blank(at(name)), F.lit(f"{name}: must not be empty or blank")


def article_checks(at: Field = F.col, blank_checks: bool = True) -> list[Check]:
    """Contract of a raw article."""
    text = _not_blank if blank_checks else _present
    return [
        text(at, "article_id"),
        text(at, "headline"),
        _present(at, "body"),
        _one_of(at, "section", SECTIONS),
        _present(at, "published_at"),
        (~is_http_url(at("source_url")), F.lit("source_url: must be an http(s) URL")),
    ]


def enriched_checks(at: Field = F.col) -> list[Check]:
    """Contract of an enriched article."""
    length = F.coalesce(F.length(strip(at("summary"))), F.lit(-1))
    blank_entity = F.coalesce(F.exists(at("entities"), is_blank), F.lit(False))
    return [
        *article_checks(at),
        _present(at, "summary"),
        (
            length.between(0, SUMMARY_MIN - 1),
            F.format_string(f"summary: must be at least {SUMMARY_MIN} characters, got %d", length),
        ),
        (
            length > SUMMARY_MAX,
            F.format_string(f"summary: must be at most {SUMMARY_MAX} characters, got %d", length),
        ),
        _present(at, "entities"),
        (
            F.coalesce(F.size(at("entities")), F.lit(0)) > MAX_ENTITIES,
            F.lit(f"entities: must have at most {MAX_ENTITIES} items"),
        ),
        (blank_entity, F.lit("entities: each must be a non-empty string")),
        _one_of(at, "sentiment", SENTIMENTS),
        _not_blank(at, "sentiment_reason"),
        _one_of(at, "domain_tag", DOMAIN_TAGS),
        _present(at, "enriched_at"),
    ]


def validated_checks(dim: int = EMBEDDING_DIM, at: Field = F.col) -> list[Check]:
    """Contract of a validated article; text lengths were checked earlier."""
    problem = check_dim(at("embedding"), dim)
    null_element = F.coalesce(F.exists(at("embedding"), lambda x: x.isNull()), F.lit(False))
    return [
        *article_checks(at, blank_checks=False),
        _present(at, "summary"),
        _present(at, "entities"),
        _one_of(at, "sentiment", SENTIMENTS),
        _present(at, "sentiment_reason"),
        _one_of(at, "domain_tag", DOMAIN_TAGS),
        _present(at, "enriched_at"),
        (problem.isNotNull(), problem),
        (null_element, F.lit("embedding: must not hold nulls")),
        _present(at, "validated_at"),
    ]


def article_failures() -> Column:
    return collect_failures(article_checks())


def enriched_failures() -> Column:
    return collect_failures(enriched_checks())


def validated_failures(dim: int = EMBEDDING_DIM) -> Column:
    return collect_failures(validated_checks(dim))


def first_missing(*fields: str) -> Column:
    """Message for the first field that is NULL or empty, NULL if all are set."""
    return F.coalesce(
        *[F.when(is_falsy(f), F.lit(f"missing required field: {f}")) for f in fields]
    )


def as_of_literal(as_of: dt.datetime | str | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


def days_before(as_of: dt.datetime | str | Column, days: int) -> Column:
    return as_of_literal(as_of) - F.make_dt_interval(F.lit(days))


def hours_before(as_of: dt.datetime | str | Column, hours: int) -> Column:
    return as_of_literal(as_of) - F.make_dt_interval(F.lit(0), F.lit(hours))


def too_old(as_of, days: int = RECENCY_DAYS, column: str = "published_at") -> Column:
    """Strictly before ``as_of - days``; a missing time is never too old."""
    return F.coalesce(F.col(column) < days_before(as_of, days), F.lit(False))


def expectation_failures(
    as_of,
    min_length: int = SUMMARY_MIN,
    max_length: int = SUMMARY_MAX,
    recency_days: int = RECENCY_DAYS,
) -> Column:
    """Every failed expectation of an enriched article.

    Length bounds are inclusive and the summary is not stripped.
    """
    length = F.length(F.coalesce(F.col("summary"), F.lit("")))
    sentiment = F.coalesce(F.col("sentiment"), F.lit(""))
    allowed = "{" + ", ".join(f"'{s}'" for s in SENTIMENTS) + "}"
    shown_time = iso_time("published_at", "+00:00")
    return collect_failures(
        [
            (
                ~length.between(min_length, max_length),
                F.concat(
                    F.lit("summary_length: "),
                    length.cast("string"),
                    F.lit(f" not in [{min_length}, {max_length}]"),
                ),
            ),
            (
                ~sentiment.isin(*SENTIMENTS),
                F.concat(F.lit("sentiment: '"), sentiment, F.lit(f"' not in {allowed}")),
            ),
            (
                too_old(as_of, recency_days),
                F.concat(
                    F.lit("recency: published_at "),
                    shown_time,
                    F.lit(f" older than {recency_days} days"),
                ),
            ),
        ]
    )


def gate_error(failures: Column) -> Column:
    """One dead-letter message for a list of failed expectations, NULL if none."""
    return F.when(
        F.size(failures) > 0,
        F.concat(F.lit("GX validation failed: "), F.concat_ws("; ", failures)),
    )


def split(df: DataFrame, failures: str = FAILURES) -> tuple[DataFrame, DataFrame]:
    """Rows without failures (column dropped) and rows with failures."""
    failed = F.size(failures) > 0
    return df.where(~failed).drop(failures), df.where(failed)


def dead_letter(
    df: DataFrame, error: Column, failed_at, stage: str | None, original: str = "value"
) -> DataFrame:
    """Add the dead-letter columns.

    ``original`` is kept as it is if present, so fields no contract knows about
    survive; otherwise the row itself is serialised.
    """
    if original not in df.columns:
        df = df.withColumn(original, F.to_json(F.struct("*")))
    return df.withColumns(
        {
            "_error": error,
            "_failed_at": as_of_literal(failed_at),
            "_failed_stage": F.lit(stage).cast("string"),
        }
    )


def project_fields(df: DataFrame, allowed: tuple[str, ...]) -> DataFrame:
    """Keep the allowed columns that exist."""
    return df.select(*[c for c in df.columns if c in allowed])
