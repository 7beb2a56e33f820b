"""Landed raw feeds as article rows.

Every normaliser maps its feed's shape to the article columns and leaves out
rows that break the article contract, as a feed reader would skip them.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.functions.rows import computed_once
from gazette.functions.text import (
    as_col,
    at_uri_to_url,
    canonical_url,
    classify_section,
    hash16,
    lookup,
    parse_time,
    truthy,
)
from gazette.operators.validate import article_checks, as_of_literal, passes
from gazette.schemas import ACCOUNT_SECTIONS, ARTICLE, FEED_SECTIONS
from gazette.session import cut_lineage

logger = logging.getLogger(__name__)

HN_ITEM_URL = "https://news.ycombinator.com/item?id="
BACKFILL_SOURCE = "guardian-backfill"
HEADLINE_CHARS = 120


def section_of(mapping: dict[str, str], key: Column | str) -> Column:
    """Section of a feed or account; NULL for one that is not followed."""
    return lookup(mapping, key)


def _articles(raw: DataFrame, columns: dict[str, Column], keep: list[str]) -> DataFrame:
    columns["source_url"] = canonical_url(columns["source_url"])
    mapped = [columns[name].alias(name) for name in ARTICLE.fieldNames()]
    return computed_once(
        raw, mapped, *keep, where=lambda row: passes(article_checks(lambda name: row[name]))
    )


def _or(value: Column, default: Column) -> Column:
    return F.coalesce(value, default)


def normalize_guardian(
    pages: DataFrame, section: Column | str = "section", keep: list[str] | None = None
) -> DataFrame:
    """Search result pages; ``section`` is the section that was asked for.

    A headline that is there but empty is used as it is, and rejected.
    """
    keep = keep or []
    items = pages.select(
        as_col(section).alias("_section"), *keep, F.explode("response.results").alias("_item")
    )
    item, extra = (lambda n: F.col(f"_item.{n}")), (lambda n: F.col(f"_item.fields.{n}"))
    return _articles(
        items,
        {
            "article_id": item("id"),
            "headline": F.coalesce(extra("headline"), item("webTitle"), F.lit("")),
            "body": _or(extra("bodyText"), F.lit("")),
            "section": F.col("_section"),
            "published_at": parse_time(item("webPublicationDate")),
            "source_url": item("webUrl"),
        },
        keep,
    )


def normalize_rss(
    entries: DataFrame,
    as_of,
    section: Column | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Feed entries; by default ``feed`` holds the feed address.

    An entry without a usable date is dated ``as_of``.
    """
    section = section_of(FEED_SECTIONS, "feed") if section is None else section
    link = _or(F.col("link"), F.lit(""))
    return _articles(
        entries,
        {
            "article_id": F.concat(F.lit("rss/"), hash16(_or(F.col("id"), link))),
            "headline": _or(F.col("title"), F.lit("")),
            "body": F.coalesce("summary", "description", F.lit("")),
            "section": section,
            "published_at": F.coalesce(
                parse_time("published"), parse_time("updated"), as_of_literal(as_of)
            ),
            "source_url": link,
        },
        keep or [],
    )


def normalize_hn(items: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Aggregator items that are live stories; the title decides the section."""
    story = (
        (F.col("type") == "story")
        & ~F.coalesce("dead", F.lit(False))
        & ~F.coalesce("deleted", F.lit(False))
    )
    title = _or(F.col("title"), F.lit(""))
    number = F.col("id").cast("string")
    return _articles(
        items.where(story),
        {
            "article_id": F.concat(F.lit("hn/"), number),
            "headline": title,
            "body": _or(truthy("text"), title),
            "section": classify_section(title),
            "published_at": F.timestamp_seconds(_or(F.col("time"), F.lit(0))),
            "source_url": _or(F.col("url"), F.concat(F.lit(HN_ITEM_URL), number)),
        },
        keep or [],
    )


def normalize_bluesky(
    posts: DataFrame, section: Column | None = None, keep: list[str] | None = None
) -> DataFrame:
    """Social posts; by default ``account`` holds the account's handle.

    An empty card title, card address or description counts as a missing one.
    """
    section = section_of(ACCOUNT_SECTIONS, "account") if section is None else section
    uri = _or(F.col("post.uri"), F.lit(""))
    text = _or(F.col("post.record.text"), F.lit(""))
    card = "post.embed.external"
    headline = _or(truthy(f"{card}.title"), F.substring(text, 1, HEADLINE_CHARS))
    described = F.concat(text, F.lit("\n\n"), truthy(f"{card}.description"))
    body = _or(described, text)
    return _articles(
        posts,
        {
            "article_id": F.concat(F.lit("bsky/"), hash16(uri)),
            "headline": headline,
            "body": _or(truthy(body), headline),
            "section": section,
            "published_at": parse_time("post.record.createdAt"),
            "source_url": _or(truthy(f"{card}.uri"), at_uri_to_url(uri)),
        },
        keep or [],
    )


def normalize_backfill(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Search result pages as backfill rows.

    Nothing is validated here, and the section is the item's own, which may be
    one that is not followed. An unreadable date becomes NULL.
    """
    keep = keep or []
    items = pages.select(*keep, F.explode("response.results").alias("_item"))

    def text(name: str) -> Column:
        return F.coalesce(F.col(f"_item.{name}"), F.lit(""))

    return items.select(
        text("id").alias("article_id"),
        text("webTitle").alias("headline"),
        text("fields.bodyText").alias("body"),
        text("sectionId").alias("section"),
        parse_time(text("webPublicationDate")).alias("published_at"),
        text("webUrl").alias("source_url"),
        F.lit(BACKFILL_SOURCE).alias("source"),
        *keep,
    )


# A new feed needs one entry here: a function from its landed rows to articles.
NORMALIZERS = {
    "guardian": normalize_guardian,
    "rss": normalize_rss,
    "hackernews": normalize_hn,
    "bluesky": normalize_bluesky,
}


def available_sources(loaders: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Load each source; one that cannot be read is logged and left out."""
    found = {}
    for name, load in loaders.items():
        try:
            found[name] = load()
        except AnalysisException:
            logger.exception("source %s cannot be read, going on without it", name)
    return found


def gathered_sources(loaders: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Read each source to its end and keep it on shared storage; one that fails is left out.

    Unlike ``available_sources`` this also meets what fails only while rows are read.
    """
    found = {}
    for name, load in loaders.items():
        try:
            found[name] = cut_lineage(load())
        except (PySparkException, Py4JJavaError):
            logger.exception("source %s failed, going on without it", name)
    return found


def union_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """All sources in the given order, which decides whose copy comes first.

    ``seq`` orders rows within a source; the result's ``seq`` orders them over
    all sources. It leaves 2**56 positions to each source.
    """
    merged = None
    for number, (name, df) in enumerate(sources.items()):
        part = df.withColumn("source_name", F.lit(name)).withColumn(
            "seq", F.col("seq") + F.lit(number << 56)
        )
        merged = part if merged is None else merged.unionByName(part, allowMissingColumns=True)
    return merged

