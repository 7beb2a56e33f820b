"""The three deduplication rules against row-by-row models."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from builders import LONG, SHORT, plan_of
from gazette.operators.dedup import (
    first_seen,
    first_seen_long,
    label_inserts,
    label_qualifying,
    merge_ranked,
)
from gazette.operators.reports import tick_stats
from gazette.operators.skew import heavy_keys, lookup_left
from gazette.plans.tick import seen_after


def copies(spark, rows):
    return spark.createDataFrame(
        [(i, k, LONG if good else SHORT) for i, (k, good) in enumerate(rows)],
        "seq long, article_id string, body string",
    )


def labels(df):
    return [r.label for r in df.orderBy("seq").collect()]


def tick_model(rows, seen):
    seen, out = set(seen), []
    for key, good in rows:
        if key in seen:
            out.append("duplicate")
        elif not good:
            out.append("filtered")
        else:
            seen.add(key)
            out.append("published")
    return out


def insert_model(rows, stored):
    stored, out = set(stored), []
    for key, good in rows:
        if not key:
            out.append("dead-letter")
        elif key in stored:
            out.append("skipped")
        elif not good:
            out.append("dead-letter")
        else:
            stored.add(key)
            out.append("inserted")
    return out


def first_model(rows):
    claimed, out = set(), []
    for i, (key, good) in enumerate(rows):
        if key not in claimed:
            claimed.add(key)
            if good:
                out.append(i)
    return out


def random_rows(seed, heavy=False):
    rng = random.Random(seed)
    keys = [f"k{rng.randrange(40)}" for _ in range(600)]
    if heavy:
        keys = ["hot" if rng.random() < 0.4 else k for k in keys]
    return [(k, rng.random() < 0.3) for k in keys]


def test_one_first_of_copies_that_tie(spark):
    rows = [("x", 5, "b"), ("x", 5, "a"), ("x", 5, "a"), ("x", 6, "c"), ("y", None, "d")]
    df = spark.createDataFrame(rows, "article_id string, offset long, body string")
    for order in ("offset", ("body", "offset")):
        found = first_seen(df, order=order).collect()
        assert [r.article_id for r in found].count("x") == 1
    picked = {first_seen(df.repartition(n), order="offset").first().body for n in (1, 3, 5)}
    assert len(picked) == 1
    assert first_seen(df, order="offset", then=F.col("body") == "c").count() == 0


def test_partitions_of_a_log_number_their_messages_alike(spark):
    rows = [("x", 1, 0, 0), ("x", 0, 7, 0), ("x", 0, 7, 1), ("y", None, 3, 0)]
    df = spark.createDataFrame(rows, "article_id string, partition int, offset long, at int")
    order = ("at", "partition", "offset")
    found = {(r.article_id, r.partition, r.offset) for r in first_seen(df, order=order).collect()}
    assert found == {("x", 0, 7), ("y", None, 3)}
    usable = F.lit(True)
    done = label_inserts(df, order=order, usable=usable).where("label = 'inserted'")
    assert {(r.article_id, r.partition) for r in done.collect()} == {("x", 0), ("y", None)}


@pytest.mark.parametrize("rows,expected", [
    ([("a", 1), ("a", 1)], ["published", "duplicate"]),
    ([("a", 0), ("a", 1), ("a", 0)], ["filtered", "published", "duplicate"]),
    ([("a", 0), ("a", 0)], ["filtered", "filtered"]),
])
def test_tick_sequences(spark, rows, expected):
    assert labels(label_qualifying(copies(spark, rows))) == expected


@pytest.mark.parametrize("heavy", [False, True])
def test_labels_equal_the_models(spark, heavy):
    rows = random_rows(7, heavy)
    df = copies(spark, rows)
    known = spark.createDataFrame([("k1",), ("k1",), ("k2",), ("zz",)], "article_id string")
    # 20 rows per slice: the hot key is dealt over a dozen slices.
    assert labels(label_qualifying(df, known, rows_per_slice=20)) == tick_model(rows, ["k1", "k2"])
    assert labels(label_qualifying(df, rows_per_slice=20)) == tick_model(rows, [])
    assert [r.seq for r in first_seen_long(df).orderBy("seq").collect()] == first_model(rows)
    assert first_seen(df).count() == len({k for k, _ in rows})

    rows = [(k if i % 9 else ("" if i % 2 else None), g) for i, (k, g) in enumerate(rows)]
    vectors = spark.createDataFrame(
        [(i, k, [1.0] if g else ([] if i % 2 else None)) for i, (k, g) in enumerate(rows)],
        "seq long, article_id string, embedding array<float>",
    )
    assert labels(label_inserts(vectors, known, rows_per_slice=20)) == insert_model(
        rows, ["k1", "k2"]
    )


def test_rounds_share_what_they_have_seen(spark):
    first = label_qualifying(copies(spark, [("a", 1), ("b", 0), ("c", 1)]))
    seen = seen_after(first)
    assert {r.article_id for r in seen.collect()} == {"a", "c"}
    second = label_qualifying(copies(spark, [("a", 1), ("b", 1), ("d", 1)]), seen)
    assert labels(second) == ["duplicate", "published", "published"]
    assert {r.article_id for r in seen_after(second, seen).collect()} == {"a", "b", "c", "d"}


def test_tick_stats(spark):
    seen = spark.createDataFrame([("ok/1",)], "article_id string")
    df = label_qualifying(copies(spark, [("ok/1", 1), ("ok/2", 1), ("short/1", 0)]), seen)
    assert tick_stats(df).first().asDict() == {
        "fetched": 3, "duplicates": 1, "filtered": 1, "published": 1, "buffered": 0,
    }
    assert tick_stats(df, F.lit(False)).first().buffered == 1


def test_a_bad_copy_does_not_block_a_good_one(spark):
    df = spark.createDataFrame(
        [(0, "a", None), (1, "a", [0.5]), (2, "a", None), (3, None, [0.5])],
        "seq long, article_id string, embedding array<float>",
    )
    assert labels(label_inserts(df)) == ["dead-letter", "inserted", "skipped", "dead-letter"]


def test_lookup_matches_a_plain_join_on_skewed_keys(spark):
    rows = spark.range(2000).select(
        "id",
        F.when(F.col("id") % 7 == 0, None)
        .when(F.col("id") % 3 > 0, "hot")
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50))
        .alias("k"),
    )
    attributes = spark.createDataFrame([("hot", 1), ("k1", 2), ("k33", 3)], "k string, v int")
    expected = rows.join(attributes, "k", "left").select("id", "k", "v")
    actual = lookup_left(rows, attributes, "k", F.col("id"), rows_per_slice=100)
    assert sorted(actual.select("id", "k", "v").collect(), key=str) == sorted(
        expected.collect(), key=str
    )
    hot = rows.where("k = 'hot'").select(F.xxhash64("k").alias("h"), F.count("*").over(Window.partitionBy("k")).alias("n"))
    assert heavy_keys(rows, "k", 100).collect() == hot.limit(1).collect()
    assert heavy_keys(rows, "k", 1, max_keys=3).count() == 3


def test_a_hot_key_is_spread_over_tasks(spark):
    """No task gets more than a small part of a key that holds 90% of the rows."""
    rows = spark.range(20_000).select(
        "id", F.when(F.col("id") % 10 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k")
    )
    attributes = rows.groupBy("k").agg(F.min("id").alias("v"))
    for name, value in (("autoBroadcastJoinThreshold", "-1"), ("shuffle.partitions", "16")):
        spark.conf.set(f"spark.sql.{name}", value)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup_left(rows, attributes, "k", F.col("id"), rows_per_slice=200)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in sizes) == 20_000
    assert max(r["count"] for r in sizes) < 4_000


def test_plans_hold_no_group_in_one_task(spark):
    df = copies(spark, [("a", 1), ("a", 0)])
    for result in (first_seen_long(df), label_qualifying(df), label_inserts(
        df.withColumn("embedding", F.array(F.lit(1.0)))
    )):
        plan = plan_of(result)
        assert "Window" not in plan and "CartesianProduct" not in plan
        assert "collect_list" not in plan and "NestedLoop" not in plan
        assert "partial_min" in plan


def test_merge_ranked(spark):
    def ranked(ids):
        return spark.createDataFrame([(x, i) for i, x in enumerate(ids)], "id long, position int")

    merged = merge_ranked([ranked([5, 3, 9, 8]), ranked([3, 7, 5, 1])], limit=4)
    assert [r.id for r in merged.collect()] == [5, 3, 9, 8]
    merged = merge_ranked([ranked([5, 3]), ranked([3, 7, 5, 1, 2])], limit=4)
    assert [r.id for r in merged.collect()] == [5, 3, 7, 1]
