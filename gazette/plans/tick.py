"""One polling round over all sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.operators.dedup import PUBLISHED, label_qualifying
from gazette.operators.route import as_json
from gazette.operators.validate import as_of_literal
from gazette.schemas import ARTICLE, TOPIC_RAW
from gazette.sources.normalize import union_sources


def tick(
    sources: dict[str, DataFrame], seen: DataFrame | None = None, qualifies: Column | None = None
) -> DataFrame:
    """Every fetched article with its label; see ``reports.tick_stats`` for the counts."""
    return label_qualifying(union_sources(sources), seen, qualifies=qualifies)


def raw_messages(labelled: DataFrame, as_of) -> DataFrame:
    """The published articles as messages of the raw topic.

    A round publishes an id at most once, so its time orders the messages of an
    id over all rounds.
    """
    now = as_of_literal(as_of)
    published = labelled.where(F.col("label") == PUBLISHED)
    return published.select(
        F.col("article_id").alias("key"),
        as_json(published, ARTICLE.fieldNames()).alias("value"),
        F.unix_micros(now).alias("offset"),
        now.alias("timestamp"),
        F.lit(TOPIC_RAW).alias("topic"),
    )


def seen_after(labelled: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Ids seen so far: those known before and those published in this round."""
    ids = labelled.where(F.col("label") == PUBLISHED).select("article_id")
    return ids if seen is None else seen.select("article_id").unionByName(ids)
