"""From missing dates to raw messages for them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.operators.maintenance import backfill, find_gaps
from gazette.operators.route import as_json
from gazette.operators.validate import as_of_literal
from gazette.schemas import ARTICLE, GAP_HOURS, SECTIONS, TOPIC_RAW
from gazette.sources.normalize import normalize_backfill


def missed_articles(
    store: DataFrame,
    archive_pages: DataFrame,
    as_of,
    hours: int = GAP_HOURS,
    sections: Sequence[str] = SECTIONS,
    page: int | None = None,
) -> DataFrame:
    """Archived articles for the dates of the window on which nothing is stored."""
    return backfill(
        find_gaps(store, as_of, hours), normalize_backfill(archive_pages), sections, page
    )


def backfill_messages(found: DataFrame, as_of) -> DataFrame:
    """Backfilled articles as raw messages without a key.

    Their offsets are distinct and grow within each partition; no task sees all.
    """
    now: Column = as_of_literal(as_of)
    number = F.monotonically_increasing_id()
    return found.select(
        F.lit(None).cast("string").alias("key"),
        as_json(found, [*ARTICLE.fieldNames(), "source"]).alias("value"),
        (F.unix_micros(now) + number).alias("offset"),
        now.alias("timestamp"),
        F.lit(TOPIC_RAW).alias("topic"),
    )
