"""The stages as running queries, each with a checkpoint of its own.

Every job reads one or more topic logs and appends to its own log, so jobs can
be stopped, restarted and scaled one by one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gazette.functions.vectors import EmbedderFactory
from gazette.operators.enrich import ModelFactory
from gazette.plans.stages import enrich_stage, gate_stage, route_stage, validated_records
from gazette.schemas import (
    EMBEDDING_DIM,
    MIN_WORDS,
    TOPIC_ENRICHED,
    TOPIC_FINANCE,
    TOPIC_RAW,
    TOPIC_TECH,
    TOPIC_VALIDATED,
    TOPIC_WORLD,
)
from gazette.sources.store import ingest_batch
from gazette.sources.topics import read_topics, stream_topics
from gazette.streaming.dedup import first_seen_ttl, no_empty_batches

EVERY_MINUTE = {"processingTime": "60 seconds"}


def start_router(
    spark: SparkSession,
    raw: str,
    routed: str,
    checkpoint: str,
    trigger=EVERY_MINUTE,
    n: int = MIN_WORDS,
) -> StreamingQuery:
    log = read_topics(spark, raw, [TOPIC_RAW], streaming=True)
    messages = route_stage(log, n, first_of=first_seen_ttl)
    with no_empty_batches(spark):
        return stream_topics(messages, checkpoint, routed, trigger)


def start_enricher(
    spark: SparkSession,
    routed: str,
    enriched: str,
    checkpoint: str,
    factory: ModelFactory,
    trigger=EVERY_MINUTE,
    as_of=None,
    **options,
) -> StreamingQuery:
    """``options`` are those of ``operators.enrich.enrich``."""
    log = read_topics(spark, routed, [TOPIC_TECH, TOPIC_FINANCE, TOPIC_WORLD], streaming=True)
    now = F.current_timestamp() if as_of is None else as_of
    return stream_topics(enrich_stage(log, factory, now, **options), checkpoint, enriched, trigger)


def start_gate(
    spark: SparkSession,
    enriched: str,
    validated: str,
    checkpoint: str,
    factory: EmbedderFactory,
    dim: int = EMBEDDING_DIM,
    trigger=EVERY_MINUTE,
    as_of=None,
) -> StreamingQuery:
    log = read_topics(spark, enriched, [TOPIC_ENRICHED], streaming=True)
    now = F.current_timestamp() if as_of is None else as_of
    return stream_topics(gate_stage(log, factory, now, dim), checkpoint, validated, trigger)


def start_ingester(
    spark: SparkSession,
    validated: str,
    store: str,
    failed: str,
    checkpoint: str,
    trigger=EVERY_MINUTE,
) -> StreamingQuery:
    """What a batch decides is kept with the checkpoint, and goes when that goes."""
    log = read_topics(spark, validated, [TOPIC_VALIDATED], streaming=True)

    def ingest(batch: DataFrame, batch_id: int) -> None:
        failed_at = dt.datetime.now(dt.timezone.utc)
        ingest_batch(batch, batch_id, store, failed, f"{checkpoint}/work", failed_at)

    writer = validated_records(log).writeStream.foreachBatch(ingest)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
