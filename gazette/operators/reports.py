"""Feed and metric queries over stored articles, labels and topic logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.functions.numbers import percent
from gazette.operators.dedup import DUPLICATE, FILTERED, PUBLISHED
from gazette.operators.validate import days_before, hours_before

FEED_SIZE = 50
DEFAULT_TAG, DEFAULT_SENTIMENT = "Other", "Neutral"


# --- selections ---------------------------------------------------------------


def later_than(df: DataFrame, moment: Column, column: str = "published_at") -> Column:
    """Strictly after. A store has a partition for each day, of which earlier ones are not opened."""
    later = F.col(column) > moment
    if column == "published_at" and dict(df.dtypes).get("dt") == "date":
        later = (F.col("dt") >= F.to_date(moment)) & later
    return later


def published_after(df: DataFrame, moment: Column, column: str = "published_at") -> DataFrame:
    """Strictly after; rows without a time are left out."""
    return df.where(later_than(df, moment, column))


def published_before(df: DataFrame, moment: Column, column: str = "published_at") -> DataFrame:
    """Strictly before; rows without a time are left out."""
    return df.where(F.col(column) < moment)


def existing(wanted: DataFrame, store: DataFrame, key: str = "article_id") -> DataFrame:
    """The wanted ids with a flag: is the id stored?

    The store is cut down to the wanted ids before its copies are combined, and both
    sides are distinct, so no id is heavy in the join.
    """
    ids = wanted.select(key).distinct()
    known = store.select(key).join(ids, key, "left_semi").distinct()
    known = known.withColumn("stored", F.lit(True))
    return ids.join(known, key, "left").withColumn(
        "stored", F.coalesce("stored", F.lit(False))
    )


def exists(store: DataFrame, article_id: str, key: str = "article_id") -> bool:
    """Is one id stored? Exact and case sensitive."""
    return not store.where(F.col(key) == article_id).limit(1).isEmpty()


def latest(
    df: DataFrame,
    n: int = FEED_SIZE,
    column: str = "published_at",
    tie_break: str = "article_id",
) -> DataFrame:
    """The ``n`` most recent rows, newest first."""
    return df.orderBy(F.col(column).desc_nulls_last(), tie_break).limit(n)


def facet_filter(page: DataFrame, tags: Sequence[str], sentiments: Sequence[str]) -> DataFrame:
    """Rows of a feed page with one of the tags and one of the sentiments.

    It narrows a page that is already cut to size; an empty choice keeps nothing.
    """
    if not tags or not sentiments:
        return page.where(F.lit(False))
    tag = F.coalesce("domain_tag", F.lit(DEFAULT_TAG))
    sentiment = F.coalesce("sentiment", F.lit(DEFAULT_SENTIMENT))
    return page.where(tag.isin(*tags) & sentiment.isin(*sentiments))


def facets(page: DataFrame) -> DataFrame:
    """Sorted distinct tags and sentiments of a feed page."""
    return page.agg(
        F.array_sort(F.collect_set(F.coalesce("domain_tag", F.lit(DEFAULT_TAG)))).alias("tags"),
        F.array_sort(F.collect_set(F.coalesce("sentiment", F.lit(DEFAULT_SENTIMENT)))).alias(
            "sentiments"
        ),
    )


# --- counts -------------------------------------------------------------------


def count_all(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"))


def count_recent(
    df: DataFrame, as_of, hours: Sequence[int] = (24, 1), column: str = "published_at"
) -> DataFrame:
    """Rows strictly younger than each number of hours, in one pass.

    Rows dated after ``as_of`` count.
    """
    return df.where(later_than(df, hours_before(as_of, max(hours)), column)).agg(
        *[
            F.count_if(F.col(column) > hours_before(as_of, h)).alias(f"last_{h}h")
            for h in hours
        ]
    )


def count_by(df: DataFrame, column: str) -> DataFrame:
    """Rows per value; rows without a value are left out."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    )


def count_by_each(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``count_by`` for several columns in one pass: (property, value, n)."""
    pairs = [F.struct(F.lit(c).alias("property"), F.col(c).cast("string").alias("value")) for c in columns]
    return (
        df.select(F.inline(F.array(*pairs)))
        .where(F.col("value").isNotNull())
        .groupBy("property", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def ranked_counts(df: DataFrame, column: str) -> DataFrame:
    """``count_by``, largest first."""
    return count_by(df, column).orderBy(F.desc("n"), column)


def topic_depth(log: DataFrame) -> DataFrame:
    """Messages per topic."""
    return log.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


def covered_dates(df: DataFrame, since: Column, column: str = "published_at") -> DataFrame:
    """Distinct UTC dates of the rows strictly after ``since``."""
    rows = df.where(later_than(df, since, column))
    return rows.select(F.to_date(column).alias("date")).distinct()


def tick_stats(labelled: DataFrame, delivered: Column | None = None) -> DataFrame:
    """Counts of one polling round from the labels of ``label_qualifying``.

    ``delivered`` tells whether a published row reached its sink; the others
    were buffered.
    """
    label = F.col("label")
    sent = F.lit(True) if delivered is None else F.coalesce(delivered, F.lit(False))
    return labelled.agg(
        F.count(F.lit(1)).alias("fetched"),
        F.count_if(label == DUPLICATE).alias("duplicates"),
        F.count_if(label == FILTERED).alias("filtered"),
        F.count_if((label == PUBLISHED) & sent).alias("published"),
        F.count_if((label == PUBLISHED) & ~sent).alias("buffered"),
    )


def publish_counts(df: DataFrame, delivered: Column) -> DataFrame:
    """How many rows were sent and how many were buffered."""
    sent = F.coalesce(delivered, F.lit(False))
    return df.agg(F.count_if(sent).alias("sent"), F.count_if(~sent).alias("buffered"))


def pass_rate(outcomes: DataFrame, passed: Column) -> DataFrame:
    """Share of rows that passed, in percent with one decimal."""
    good = F.coalesce(passed, F.lit(False))
    return _with_rate(
        outcomes.agg(
            F.count_if(good).alias("validated"),
            F.count_if(~good).alias("failed"),
        )
    )


def _with_rate(counts: DataFrame) -> DataFrame:
    return counts.withColumn("total", F.col("validated") + F.col("failed")).withColumn(
        "pass_rate", percent(F.col("validated"), F.col("total"))
    )


def weekly_report(
    store: DataFrame,
    failed_log: DataFrame,
    as_of,
    days: int = 7,
    published: str = "published_at",
    logged: str = "timestamp",
) -> DataFrame:
    """Pass rate of the last ``days`` days.

    Stored articles count strictly after the cutoff by publication time, dead
    letters from the cutoff on by the time they were logged.
    """
    cutoff = days_before(as_of, days)
    one, zero = F.lit(1), F.lit(0)
    good = store.where(later_than(store, cutoff, published)).select(one.alias("v"), zero.alias("f"))
    bad = failed_log.where(F.col(logged) >= cutoff).select(zero.alias("v"), one.alias("f"))
    return _with_rate(
        good.unionByName(bad).agg(
            F.coalesce(F.sum("v"), F.lit(0)).alias("validated"),
            F.coalesce(F.sum("f"), F.lit(0)).alias("failed"),
        )
    )
