"""Retention, gap detection, backfill and health checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.operators.reports import covered_dates, topic_depth
from gazette.operators.validate import as_of_literal, days_before, hours_before
from gazette.schemas import (
    GAP_HOURS,
    PRUNE_DAYS,
    RETENTION_DAYS,
    SECTIONS,
    TOPIC_ENRICHED,
    TOPIC_RAW,
    TOPIC_VALIDATED,
)

WATCHED_TOPICS = (TOPIC_RAW, TOPIC_ENRICHED, TOPIC_VALIDATED)


def prune(
    store: DataFrame,
    as_of,
    days: int = PRUNE_DAYS,
    cap: int | None = None,
    key: str = "article_id",
    column: str = "published_at",
) -> tuple[DataFrame, DataFrame]:
    """``(kept, deleted)``: rows strictly older than ``days`` days are deleted.

    Rows exactly at the cutoff and rows without a time are kept. With ``cap``,
    one run deletes at most that many rows, oldest first; every row is in one of
    the two results, also where keys are null or shared. Rows equal in every
    column go or stay together, so only these may exceed the cap.
    """
    cutoff = days_before(as_of, days)
    old = F.col(column) < cutoff
    fresh = (F.col(column) >= cutoff) | F.col(column).isNull()
    if cap is not None:
        timed = isinstance(store.schema[column].dataType, T.TimestampType)
        when = F.unix_micros(column) if timed else F.col(column)
        place = F.struct(when.alias("when"), key, F.xxhash64(*store.columns).alias("row"))
        oldest = store.where(old).select(place.alias("place")).orderBy("place").limit(cap)
        last = oldest.agg(F.max("place").alias("last")).first()["last"]
        if last is None:
            old = F.lit(False)
        else:
            types = store.select(place.alias("p")).schema["p"].dataType
            bound = F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(last, types)])
            old = old & (place <= bound)
        fresh = ~F.coalesce(old, F.lit(False))
    return store.where(fresh), store.where(old)


def find_gaps(
    store: DataFrame, as_of, hours: int = GAP_HOURS, column: str = "published_at"
) -> DataFrame:
    """Dates from ``as_of - hours`` to ``as_of`` without any row after the start.

    On the first date only rows after the start count. All rows are looked at:
    a capped scan would report gaps that are none.
    """
    since = hours_before(as_of, hours)
    spine = store.sparkSession.range(1).select(
        F.explode(
            F.sequence(
                F.to_date(since), F.to_date(as_of_literal(as_of)), F.make_dt_interval(F.lit(1))
            )
        ).alias("date")
    )
    return spine.join(covered_dates(store, since, column), "date", "left_anti")


def backfill(
    gaps: DataFrame,
    archive: DataFrame,
    sections: Sequence[str] = SECTIONS,
    page: int | None = None,
) -> DataFrame:
    """All archive rows for the missing dates; with ``page``, the newest per date and section.

    ``archive`` has the backfill columns (see ``normalize_backfill``). With a
    page, the rank filter lets Spark cut each group down before the shuffle, so
    a large group does not travel whole.
    """
    wanted = archive.where(F.col("section").isin(*sections)).withColumn(
        "date", F.to_date("published_at")
    )
    missing = wanted.join(gaps.select("date"), "date", "left_semi")
    if page is None:
        return missing.drop("date")
    newest = Window.partitionBy("date", "section").orderBy(F.desc("published_at"), "article_id")
    return (
        missing.withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") <= page)
        .drop("_rank", "date")
    )


def stalled_topics(log: DataFrame, expected: Sequence[str] = WATCHED_TOPICS) -> DataFrame:
    """``name (missing)`` for expected topics the log does not know.

    ``log`` may carry rows with a NULL ``value`` for a topic that exists but has
    no messages; such a topic is ``name (empty)``. One row of a topic tells that
    there is one, so each task stops at its first.
    """
    first = []
    for topic in expected:
        rows = log.where(F.col("topic") == topic)
        for found, messages in ((rows, 0), (rows.where(F.col("value").isNotNull()), 1)):
            first.append(found.select("topic", F.lit(messages).alias("messages")).limit(1))
    known = reduce(DataFrame.unionByName, first).groupBy("topic").agg(
        F.max("messages").alias("messages")
    )
    wanted = log.sparkSession.createDataFrame([(t,) for t in expected], "topic string")
    return (
        wanted.join(known, "topic", "left")
        .where(F.coalesce("messages", F.lit(0)) == 0)
        .select(
            "topic",
            F.concat(
                "topic", F.when(F.col("messages").isNull(), " (missing)").otherwise(" (empty)")
            ).alias("problem"),
        )
    )


def assert_flowing(log: DataFrame, expected: Sequence[str] = WATCHED_TOPICS) -> None:
    """Raise if any expected topic is missing or empty."""
    problems = [row.problem for row in stalled_topics(log, expected).orderBy("topic").collect()]
    if problems:
        raise RuntimeError(f"Pipeline stall: {', '.join(problems)}")


def assert_not_empty(store: DataFrame) -> None:
    """Raise if the store holds no article."""
    if store.isEmpty():
        raise RuntimeError("The store holds no articles; ingestion may have stalled")


def expire(
    log: DataFrame, as_of, retention: dict[str, int] | None = None, column: str = "timestamp"
) -> DataFrame:
    """Messages still within their topic's retention; other topics keep all."""
    retention = RETENTION_DAYS if retention is None else retention
    topic, logged = F.col("topic"), F.col(column)
    keep = topic.isNull() | logged.isNull() | ~topic.isin(*retention)
    for name, days in retention.items():
        keep = keep | ((topic == name) & (logged >= days_before(as_of, days)))
    return log.where(keep)


__all__ = [
    "assert_flowing",
    "assert_not_empty",
    "backfill",
    "expire",
    "find_gaps",
    "prune",
    "stalled_topics",
    "topic_depth",
]
