"""Mixing sources to target weights by systematic sampling; DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazette.llm.common import WORD, numbered, scratch

WEIGHTS = (5, 2, 1)  # by the place of a source, repeating
SHARE = 1.5  # the mix's size, as a multiple of the size of all documents
MOST = 2.0  # no source is taken more often than this
LEAST = 250  # documents in a chunk
SEED = "mix"


def size_in_words(column: str = "text") -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def md5_number(column: Column) -> Column:
    """32 bits of a text's MD5, a value that other engines can compute as well."""
    return F.conv(F.substring(F.md5(column), 1, 8), 16, 10).cast("long")


def _places(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``: 0, 1, ... by code point, null last.

    Ranges are numbered where they are sorted; only their counts meet in one window.
    """
    order = F.col("source").asc_nulls_last()
    ranged = scratch(
        sources.repartitionByRange(order)
        .sortWithinPartitions(order)
        .withColumn("_m", F.monotonically_increasing_id())
    ).withColumn("_range", F.shiftright("_m", 33))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_c"))
    offsets = counts.select("_range", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_b"))
    place = F.col("_b") + F.col("_m").bitwiseAND((1 << 33) - 1)
    return ranged.join(offsets, "_range").withColumn("place", place).drop("_m", "_range", "_b")


def targets(
    sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """``sources`` (source, source_size) with ``weight`` and ``target``.

    The mix has ``share`` times the size of all sources. A source gets its weight's
    part of it, at most ``most`` times its size; the excess goes to the others by
    weight until none is above. That is one level for all sources below their
    limit, raised until the parts add up; each round is one sum over the sources.
    """
    weight = F.element_at(F.lit(list(weights)), (F.col("place") % len(weights) + 1).cast("int"))
    rows = scratch(_places(sources).withColumn("weight", weight.cast("double")))
    limit = F.col("source_size") * most
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = limit <= F.lit(level) * F.col("weight")
        taken, free = rows.agg(
            F.sum(F.when(full, limit).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))),
        ).first()
        raised = (total * share - taken) / free if free else math.inf
        if raised <= level or not free:
            break
        level = raised
    full = limit <= F.lit(level) * F.col("weight")
    return rows.withColumn(
        "target", F.when(full | F.lit(math.isinf(level)), limit).otherwise(F.lit(level) * F.col("weight"))
    ).drop("place")


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    least: int = LEAST,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` (doc_id, source, size and more) with source_size, target and copies.

    Every document of a source is expected target / source_size times. These
    expectations are summed up along the source, in an order that spreads sizes
    evenly; one random offset a source, drawn from ``seed``, is added, and a document is
    taken once for each whole number that its part of the sum crosses. Sources
    without words have no copies to give. Equal input gives equal output.
    """
    narrow = scratch(docs.select("doc_id", "source", "size"))
    sources = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    wanted = scratch(
        targets(sources, weights, share, most).select(
            F.col("source").alias("_s"), "source_size", "target"
        )
    )
    spread = md5_number(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    ranked = numbered(docs, "source", spread, ["size", "doc_id"], narrow, least)
    rate = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    part = F.col("_rate") - F.floor("_rate")
    start = md5_number(F.concat(F.lit(seed), F.coalesce("source", F.lit("")))) / F.lit(2.0**32)
    crossed = F.floor(start + (F.col("rank") + 1) * part) - F.floor(start + F.col("rank") * part)
    return (
        ranked.join(wanted, F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("_rate", rate)
        .withColumn("copies", (F.floor("_rate") + crossed).cast("long"))
        .drop("_s", "_rate", "rank")
    )


def copies_of(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` (doc_id, text, source, ...) as often as it is taken."""
    columns = docs.columns
    mixed = mix(docs.withColumn("size", size_in_words()), **options)
    often = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return mixed.select(*columns, often.alias("_copy")).select(*columns)


SQL = f"""
WITH d AS (
    SELECT doc_id, source,
           CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size
    FROM documents),
s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n FROM d GROUP BY source),
w AS (
    SELECT *, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1
              AS INT)] AS DOUBLE) AS weight
    FROM s),
o AS (
    SELECT *, row_number() OVER (ORDER BY source_size * 2.0e0 / weight, source) AS k FROM w),
c AS (
    SELECT *, source_size * 2.0e0 AS cap,
           coalesce(sum(source_size * 2.0e0) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING
                    AND 1 PRECEDING), 0) AS taken,
           sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
           sum(source_size) OVER () * 1.5e0 AS total
    FROM o),
v AS (
    SELECT min_by((total - taken) / free, k) AS level FROM c
    WHERE cap > (total - taken) / free * weight),
t AS (
    SELECT c.source, source_size, n,
           CASE WHEN level IS NULL OR cap <= level * weight THEN cap ELSE level * weight END AS target
    FROM c CROSS JOIN v),
r AS (
    SELECT d.doc_id, d.size, t.source_size, t.target,
           coalesce(t.target / nullif(t.source_size, 0), 0) AS rate,
           CAST('0x' || substr(md5('{SEED}' || coalesce(d.source, '')), 1, 8) AS BIGINT) / 4294967296.0e0
               AS u,
           row_number() OVER (PARTITION BY d.source ORDER BY
               CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)
               % CAST(ceil(t.n / greatest({LEAST}e0, sqrt(t.n))) AS BIGINT), d.size, d.doc_id) - 1 AS i
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST((floor(rate) + floor(u + (i + 1) * (rate - floor(rate)))
             - floor(u + i * (rate - floor(rate)))) AS BIGINT) * size AS taken
FROM r
"""
