"""Key lookups that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What is broadcast is at most this many pairs of a 64-bit hash and a number,
# whatever the data holds: a few megabytes. A key that is not among the most
# frequent MAX_HEAVY has less than 1/MAX_HEAVY of the rows.
MAX_HEAVY = 100_000
# Rows of one key that a single task may be given before the key is split.
ROWS_PER_SLICE = 100_000
# A key has no more slices than this, so its attribute row has as many copies at most.
MAX_SLICES = 4096
# Rows without a key match nothing; they only need to be spread out.
NULL_SLICES = 4096


def heavy_keys(
    df: DataFrame, key: str, min_rows: int = ROWS_PER_SLICE, max_keys: int = MAX_HEAVY
) -> DataFrame:
    """Hashes of the most frequent keys with at least ``min_rows`` rows: ``(_hash, _rows)``.

    Exact, so a recomputed task finds the same keys. The count is partially
    aggregated before its shuffle, and the result is a top-k. Keys that share a
    hash are counted, and later split, together.
    """
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(F.xxhash64(key).alias("_hash"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") >= min_rows)
        .orderBy(F.desc("_rows"), "_hash")
        .limit(max_keys)
    )


def lookup_left(
    rows: DataFrame,
    attributes: DataFrame,
    key: str,
    spread: Column,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Left join of ``rows`` with ``attributes``, which has one row per key.

    The rows of a heavy key are dealt over several slices by the hash of
    ``spread`` (a deterministic expression that differs between rows of one
    key, so a recomputed task deals them the same way), and that key's single
    attribute row is repeated once per slice.
    """
    slices = F.broadcast(
        heavy_keys(rows, key, rows_per_slice).select(
            "_hash",
            F.least(F.ceil(F.col("_rows") / F.lit(rows_per_slice)), F.lit(MAX_SLICES))
            .cast("int")
            .alias("_slices"),
        )
    )
    hashed = F.xxhash64(key)
    dealt = (
        rows.withColumn("_hash", hashed)
        .join(slices, "_hash", "left")
        .withColumn(
            "_slice",
            F.when(F.col(key).isNull(), F.pmod(F.xxhash64(spread), F.lit(NULL_SLICES)))
            .when(F.col("_slices").isNotNull(), F.pmod(F.xxhash64(spread), F.col("_slices")))
            .otherwise(F.lit(0))
            .cast("int"),
        )
    )
    repeated = (
        attributes.withColumn("_hash", hashed)
        .join(slices, "_hash", "left")
        .withColumn(
            "_slice", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_slices"), F.lit(1)) - 1))
        )
    )
    return (
        dealt.drop("_hash", "_slices")
        .join(repeated.drop("_hash", "_slices"), [key, "_slice"], "left")
        .drop("_slice")
    )
