"""The stages as functions from topic messages to topic messages.

Each takes rows shaped like ``schemas.LOG`` and returns such rows, tagged with
the topic they belong to. One query therefore writes a stage's good records and
its dead letters in one pass, and the model behind a stage runs once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.functions.text import is_falsy, iso_time, min_words
from gazette.functions.vectors import EmbedderFactory
from gazette.operators.dedup import first_seen
from gazette.operators.enrich import ModelFactory, enrich
from gazette.operators.gate import quality_gate
from gazette.operators.route import as_json, dead_value, route_section
from gazette.operators.validate import as_of_literal
from gazette.schemas import (
    ARTICLE,
    EMBEDDING_DIM,
    ENRICHED,
    LOG_ORDER,
    MIN_WORDS,
    RECENCY_DAYS,
    STAGE_GATE,
    TOPIC_ENRICHED,
    TOPIC_FAILED,
    TOPIC_VALIDATED,
    VALIDATED,
)
from gazette.sources.topics import corrupt_records, parse_records

LOG_COLUMNS = ("key", "value", "offset", "timestamp", "topic")


def readable_articles(log: DataFrame) -> DataFrame:
    """Raw messages as articles; ``_corrupt`` marks those that cannot be routed."""
    records = parse_records(log, ARTICLE)
    unusable = is_falsy("article_id") | F.col("body").isNull() | F.col("section").isNull()
    return records.withColumn("_corrupt", F.col("_corrupt") | unusable)


def route_stage(log: DataFrame, n: int = MIN_WORDS, first_of=first_seen) -> DataFrame:
    """Raw messages to section topics: first copies with enough words.

    ``first_of`` is the batch or the streaming form of the deduplication. What
    it decides on is worked out before it, so that it moves no parsed fields, and
    no values of short articles, which come out of it in no case.
    """
    records = readable_articles(log)
    order = [name for name in LOG_ORDER if name in log.columns]
    good = (
        records.where(~F.col("_corrupt"))
        .withColumn("_long_enough", min_words("body", n))
        .select(
            F.col("article_id").alias("key"),
            F.when(F.col("_long_enough"), F.col("value")).alias("value"),
            *order,
            route_section("section").alias("topic"),
            "_long_enough",
        )
    )
    routed = first_of(good, key="key", order=order, then=F.col("_long_enough"))
    return routed.select(*LOG_COLUMNS).unionByName(corrupt_records(records))


def _stage_messages(
    checked: DataFrame,
    columns: list[str],
    topic: str,
    partial: tuple[str, ...],
    failed_at,
    stage: str | None,
) -> DataFrame:
    failed = F.col("_error").isNotNull()
    extra = {name: _printable(checked, name) for name in partial}
    extra |= {"_error": F.col("_error"), "_failed_at": iso_time(as_of_literal(failed_at))}
    if stage is not None:
        extra["_failed_stage"] = F.lit(stage)
    return checked.select(
        F.col("article_id").alias("key"),
        F.when(failed, dead_value(extra)).otherwise(as_json(checked, columns)).alias("value"),
        "offset",
        as_of_literal(failed_at).alias("timestamp"),
        F.when(failed, TOPIC_FAILED).otherwise(topic).alias("topic"),
    )


def _printable(df: DataFrame, name: str) -> Column:
    return iso_time(name) if df.schema[name].dataType.typeName() == "timestamp" else F.col(name)


def enrich_stage(
    log: DataFrame, factory: ModelFactory, as_of, failed_stage: str | None = None, **options
) -> DataFrame:
    """Section topics to enriched messages or dead letters.

    By default a dead letter of this stage carries no stage name. ``options`` are those of
    ``enrich``: how much of a body the model reads, deadlines, calls at the same time.
    """
    articles = parse_records(log, ARTICLE).drop("_corrupt", "topic", "timestamp")
    checked = enrich(articles, factory, as_of, **options)
    partial = ("summary", "entities", "sentiment", "sentiment_reason", "domain_tag", "enriched_at")
    return _stage_messages(
        checked, ENRICHED.fieldNames(), TOPIC_ENRICHED, partial, as_of, failed_stage
    )


def gate_stage(
    log: DataFrame,
    factory: EmbedderFactory,
    as_of,
    dim: int = EMBEDDING_DIM,
    recency_days: int = RECENCY_DAYS,
) -> DataFrame:
    """Enriched messages to validated messages or dead letters."""
    articles = parse_records(log, ENRICHED).drop("_corrupt", "topic", "timestamp")
    checked = quality_gate(articles, factory, as_of, dim, recency_days)
    return _stage_messages(
        checked,
        VALIDATED.fieldNames(),
        TOPIC_VALIDATED,
        ("embedding", "validated_at"),
        as_of,
        STAGE_GATE,
    )


def validated_records(log: DataFrame) -> DataFrame:
    """Validated messages as rows to insert into the store."""
    return parse_records(log, VALIDATED).drop("_corrupt")
