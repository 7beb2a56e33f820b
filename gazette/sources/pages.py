"""Full article bodies from landed web pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.functions.html import cap_bytes, extract_body
from gazette.functions.text import as_col, is_falsy, truthy
from gazette.operators.skew import ROWS_PER_SLICE, lookup_left

# --- fixed value: what is not fetched ------------------------------------------
SELF_POST_PREFIX = "https://news.ycombinator.com"


def body_fetchable(url: Column | str, content_type: Column | str | None = None) -> Column:
    """May this address hold an article page?"""
    address = as_col(url)
    wanted = ~is_falsy(address) & ~F.coalesce(
        address.startswith(SELF_POST_PREFIX), F.lit(False)
    )
    if content_type is None:
        return wanted
    return wanted & F.coalesce(as_col(content_type).contains("text/html"), F.lit(False))


def page_bodies(
    pages: DataFrame,
    content_type: str | None = None,
    order: str = "page_id",
    max_bytes: int | None = None,
) -> DataFrame:
    """``(url, extracted)``: the text of the first fetched copy of each page, read whole.

    Copies are told apart on two narrow columns; only the winners' pages are
    read and parsed.
    """
    usable = pages.where(body_fetchable("url", content_type))
    first = usable.groupBy("url").agg(F.min(order).alias(order))
    page = F.col("html") if max_bytes is None else cap_bytes("html", max_bytes)
    return usable.join(first, ["url", order], "left_semi").select(
        "url", extract_body(page).alias("extracted")
    )


def replace_body(
    articles: DataFrame,
    bodies: DataFrame,
    spread: str = "seq",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Articles with the extracted page text as body where there is one."""
    by_url = bodies.withColumnRenamed("url", "source_url")
    found = lookup_left(articles, by_url, "source_url", F.col(spread), rows_per_slice)
    return found.withColumn("body", F.coalesce(truthy("extracted"), F.col("body"))).drop(
        "extracted"
    )
