"""Feed and metric queries, retention, gaps, health checks, the store and buffers."""

import datetime as dt
import json
import re
import shutil

import pytest
from pyspark.sql import functions as F

from builders import AS_OF, UTC, enriched, frame, plan_of
from gazette.operators.maintenance import (
    assert_flowing,
    assert_not_empty,
    backfill,
    expire,
    find_gaps,
    prune,
    stalled_topics,
)
from gazette.operators.reports import (
    count_by,
    count_recent,
    exists,
    existing,
    facet_filter,
    facets,
    latest,
    pass_rate,
    ranked_counts,
    weekly_report,
)
from gazette.schemas import VALIDATED
from gazette.sources import store as stores
from gazette.sources.topics import read_topics_since, replay_buffer, write_or_buffer


def at(days=0, hours=0, seconds=0):
    return AS_OF - dt.timedelta(days=days, hours=hours, seconds=seconds)


def times(spark, moments):
    rows = [(f"a/{i}", m) for i, m in enumerate(moments)]
    return spark.createDataFrame(rows, "article_id string, published_at timestamp")


def ids(df):
    return sorted(r.article_id for r in df.collect())


def test_latest_and_facets(spark):
    rows = spark.createDataFrame(
        [
            ("a", at(1), "AI", None),
            ("b", at(2), None, "Positive"),
            ("c", at(2), "Crypto", "Neutral"),
            ("d", None, "Climate", "Negative"),
            ("e", at(9), "Earnings", "Negative"),
        ],
        "article_id string, published_at timestamp, domain_tag string, sentiment string",
    )
    assert [r.article_id for r in latest(rows, 10).collect()] == ["a", "b", "c", "e", "d"]
    page = latest(rows, 3)
    found = facets(page).first()
    assert found.tags == ["AI", "Crypto", "Other"] and found.sentiments == ["Neutral", "Positive"]
    assert ids(facet_filter(page, ["AI", "Other"], ["Neutral", "Positive"])) == ["a", "b"]
    assert ids(facet_filter(page, ["Earnings"], ["Negative"])) == []
    assert ids(facet_filter(page, [], ["Neutral"])) == []
    assert "TakeOrderedAndProject" in plan_of(latest(rows))


def test_counts(spark):
    rows = times(spark, [at(hours=1), at(seconds=3599), at(hours=-5), at(hours=24), at(days=3), None])
    assert count_recent(rows, AS_OF).first().asDict() == {"last_24h": 3, "last_1h": 2}
    tags = spark.createDataFrame([("x",), ("y",), ("x",), (None,)], "t string")
    assert {r.t: r.n for r in count_by(tags, "t").collect()} == {"x": 2, "y": 1}
    assert [r.t for r in ranked_counts(tags, "t").collect()] == ["x", "y"]


def test_lookups_are_exact(spark):
    rows = times(spark, [at(1), at(2)])
    assert exists(rows, "a/0") and not exists(rows, "A/0") and not exists(rows, "a")
    wanted = spark.createDataFrame([("a/0",), ("a/0",), ("zz",)], "article_id string")
    assert {r.article_id: r.stored for r in existing(wanted, rows).collect()} == {
        "a/0": True, "zz": False,
    }


def test_rates(spark):
    labels = spark.createDataFrame([(1,), (1,), (0,), (None,)], "q int")
    row = pass_rate(labels, F.col("q") == 1).first()
    assert (row.validated, row.failed, row.total, row.pass_rate) == (2, 2, 4, 50.0)
    assert pass_rate(labels.limit(0), F.col("q") == 1).first().pass_rate == 0.0
    store = times(spark, [at(7), at(7, seconds=-1), at(1)])
    failed = spark.createDataFrame([(at(7),), (at(7, seconds=1),), (None,)], "timestamp timestamp")
    row = weekly_report(store, failed, AS_OF).first()
    assert (row.validated, row.failed, row.total, row.pass_rate) == (2, 1, 3, 66.7)
    assert weekly_report(store.limit(0), failed.limit(0), AS_OF).first().total == 0


def test_prune(spark):
    rows = times(spark, [at(30), at(30, seconds=1), at(45), at(60), at(1), None])
    kept, deleted = prune(rows, AS_OF)
    assert ids(deleted) == ["a/1", "a/2", "a/3"] and ids(kept) == ["a/0", "a/4", "a/5"]
    kept, deleted = prune(rows, AS_OF, cap=2)
    assert ids(deleted) == ["a/2", "a/3"] and ids(kept) == ["a/0", "a/1", "a/4", "a/5"]


def test_capped_prune_splits_by_row(spark):
    old, fresh = dt.datetime(2023, 1, 1, tzinfo=UTC), dt.datetime(2024, 1, 19, tzinfo=UTC)
    rows = spark.createDataFrame(
        [("a", old, 1), ("a", fresh, 2), (None, old, 3), ("b", old, 4), ("a", None, 5), ("b", old, 6)],
        "article_id string, published_at timestamp, n int",
    )
    for cap in (None, 0, 1, 2, 3, 9):
        kept, deleted = prune(rows, AS_OF, cap=cap)
        gone, left = [r.n for r in deleted.collect()], [r.n for r in kept.collect()]
        assert sorted(gone + left) == [1, 2, 3, 4, 5, 6]
        assert len(gone) == min(4, 9 if cap is None else cap) and {2, 5} <= set(left)


def test_gaps(spark):
    # The window starts on the 18th at noon; a row earlier that day does not count.
    rows = times(spark, [dt.datetime(2024, 1, 18, 9, tzinfo=UTC), dt.datetime(2024, 1, 19, 9, tzinfo=UTC)])
    gaps = find_gaps(rows, AS_OF)
    assert sorted(str(r.date) for r in gaps.collect()) == ["2024-01-18", "2024-01-20"]
    assert find_gaps(rows.limit(0), AS_OF).count() == 3


def test_backfill_takes_the_newest_per_date_and_section(spark):
    day = dt.datetime(2024, 1, 18, tzinfo=UTC)
    archive = spark.createDataFrame(
        [(f"{s}/{i}", s, day + dt.timedelta(minutes=i)) for s in ("world", "money", "sport") for i in range(60)]
        + [("other/1", "world", day + dt.timedelta(days=1)), ("none", "world", None)],
        "article_id string, section string, published_at timestamp",
    )
    gaps = spark.createDataFrame([(day.date(),)], "date date")
    everything = backfill(gaps, archive)
    assert everything.where("section IN ('world', 'money')").count() == everything.count() == 120
    found = backfill(gaps, archive, page=50)
    assert sorted(ids(found)) == sorted(f"{s}/{i}" for s in ("world", "money") for i in range(10, 60))
    assert "WindowGroupLimit" in plan_of(found)


def test_stalls(spark):
    log = spark.createDataFrame(
        [("raw-news", "x"), ("enriched-news", None), ("noise", "x")], "topic string, value string"
    )
    assert {r.problem for r in stalled_topics(log).collect()} == {
        "enriched-news (empty)", "validated-news (missing)",
    }
    with pytest.raises(RuntimeError, match="enriched-news .empty., validated-news .missing."):
        assert_flowing(log)
    assert_flowing(log, ["raw-news", "noise"])
    assert_not_empty(log)
    with pytest.raises(RuntimeError):
        assert_not_empty(log.limit(0))


def test_retention_and_cutoffs(spark):
    log = spark.createDataFrame(
        [("raw-news", at(1)), ("raw-news", at(1, seconds=1)), ("tech-news", at(2)),
         ("news-failed", at(8)), ("mine", at(99)), (None, at(99)), ("raw-news", None)],
        "topic string, timestamp timestamp",
    )
    kept = expire(log, AS_OF).collect()
    assert len(kept) == 5 and {r.topic for r in kept} == {"raw-news", "tech-news", "mine", None}
    since = read_topics_since(log, F.lit(at(1)).cast("timestamp"))
    assert since.count() == 1


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    times(spark, [at(1), at(40)]).withColumn("body", F.lit("x")).write.parquet(path)
    rows = spark.read.parquet(path)
    for result in (*prune(rows, AS_OF), count_recent(rows, AS_OF), find_gaps(rows, AS_OF)):
        plan = plan_of(result)
        scan = plan[plan.index("FileScan") :]
        assert "published_at" in scan.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "body" not in plan_of(count_recent(rows, AS_OF)).split("ReadSchema")[1]


# --- the store ---------------------------------------------------------------------


def validated(spark, records):
    rows = [
        {"embedding": [0.5] * 4, "validated_at": "2024-01-19T00:00:00Z", **r} for r in records
    ]
    df = frame(spark, VALIDATED, rows).withColumn("value", F.to_json(F.struct("*")))
    return df.withColumn("offset", F.monotonically_increasing_id())


def ingest(batch, batch_id, root):
    stores.ingest_batch(batch, batch_id, f"{root}/store", f"{root}/failed", f"{root}/work", AS_OF)


def test_ingest_is_idempotent_and_first_wins(spark, tmp_path):
    root = str(tmp_path)
    batch = validated(spark, [
        enriched("a/1", headline="first"), enriched("a/1", headline="second"),
        enriched("a/2", embedding=None), enriched("a/2"), enriched("", headline="no id"),
    ]).coalesce(1)
    ingest(batch, 0, root)

    def state():
        rows = stores.read_store(spark, f"{root}/store").orderBy("article_id").collect()
        dead = spark.read.parquet(f"{root}/failed").orderBy("value").collect()
        return rows, dead

    rows, dead = state()
    assert [(r.article_id, r.headline) for r in rows] == [("a/1", "first"), ("a/2", "Headline of a/2")]
    assert "body" not in rows[0].asDict() and str(rows[0].dt) == "2024-01-18"
    letters = [json.loads(d.value) for d in dead]
    assert {x["_error"] for x in letters} == {
        "missing required field: article_id", "missing or invalid embedding",
    }
    assert {x["_failed_stage"] for x in letters} == {"weaviate-ingestion"}
    assert all(x["body"] and x["_failed_at"] == "2024-01-20T12:00:00Z" for x in letters)

    # The same batch again, as after a failure between its writes.
    ingest(batch, 0, root)
    assert state() == (rows, dead)
    ingest(validated(spark, [enriched("a/1", embedding=None), enriched("a/3")]), 1, root)
    assert [r.article_id for r in state()[0]] == ["a/1", "a/2", "a/3"]
    assert len(state()[1]) == 2


def metrics_of(df):
    """What the scan of a table partitioned by bucket has read, once ``df`` has run."""
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "FileSourceScanExec" and "bucket" in node.simpleString(25):
            return f"number of files read: {node.metrics().apply('numFiles').value()}"
        else:
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return ""


def stored_ids(spark, root):
    return sorted(r.article_id for r in stores.read_store(spark, f"{root}/store").collect())


def key_ids(spark, root):
    return sorted(r.article_id for r in spark.read.parquet(stores.keys_path(f"{root}/store")).collect())


def test_a_batch_opens_only_the_buckets_of_its_ids(spark, tmp_path):
    root = str(tmp_path)
    ingest(validated(spark, [enriched(f"a/{i}") for i in range(400)]), 0, root)
    assert key_ids(spark, root) == stored_ids(spark, root)
    asked = spark.createDataFrame([("a/7",), ("a/8",), ("new",), (None,)], "article_id string")
    found = stores.stored_keys(spark, f"{root}/store", asked)
    assert sorted(r.article_id for r in found.collect()) == ["a/7", "a/8"]
    everything = spark.read.parquet(stores.keys_path(f"{root}/store"))
    assert everything.select("bucket").distinct().count() > 50
    found.collect()
    read = re.search(r"number of files read: (\d+)", metrics_of(found))
    assert int(read[1]) <= 3 < len(everything.inputFiles())


def test_a_crash_between_the_store_and_its_keys_is_repaired(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    ingest(validated(spark, [enriched("a/1")]), 0, root)
    batch = validated(spark, [enriched("a/2"), enriched("a/3")])
    whole = stores._write_keys

    def broken(*args):
        raise OSError("no more space")

    monkeypatch.setattr(stores, "_write_keys", broken)
    with pytest.raises(OSError):
        ingest(batch, 1, root)
    monkeypatch.setattr(stores, "_write_keys", whole)
    assert stored_ids(spark, root) == ["a/1", "a/2", "a/3"] and key_ids(spark, root) == ["a/1"]
    ingest(batch, 1, root)
    assert stored_ids(spark, root) == key_ids(spark, root) == ["a/1", "a/2", "a/3"]
    ingest(validated(spark, [enriched("a/3"), enriched("a/4")]), 2, root)
    assert stored_ids(spark, root) == key_ids(spark, root) == ["a/1", "a/2", "a/3", "a/4"]


def test_what_was_pruned_may_be_inserted_again(spark, tmp_path):
    root = str(tmp_path)
    old = enriched("old", published_at="2023-01-01T00:00:00Z")
    ingest(validated(spark, [old, enriched("young")]), 0, root)
    assert stores.prune_store(spark, f"{root}/store", AS_OF)["deleted_count"] == 1
    assert key_ids(spark, root) == ["young"]
    ingest(validated(spark, [old, enriched("young")]), 1, root)
    assert stored_ids(spark, root) == key_ids(spark, root) == ["old", "young"]


def test_a_store_without_keys_gets_them(spark, tmp_path):
    root = str(tmp_path)
    ingest(validated(spark, [enriched("a/1")]), 0, root)
    shutil.rmtree(stores.keys_path(f"{root}/store"))
    ingest(validated(spark, [enriched("a/1"), enriched("a/2")]), 1, root)
    assert stored_ids(spark, root) == key_ids(spark, root) == ["a/1", "a/2"]


def test_prune_store_rewrites_only_old_partitions(spark, tmp_path):
    path = str(tmp_path / "store")
    stores.ensure_store(spark, path)
    stores.ensure_store(spark, path)
    assert stores.read_store(spark, path).count() == 0
    assert stores.prune_store(spark, path, AS_OF)["deleted_count"] == 0
    moments = ["2023-12-21T11:59:59Z", "2023-12-21T12:00:00Z", "2023-12-20T12:00:00Z",
               "2023-11-01T00:00:00Z", "2024-01-19T00:00:00Z"]
    records = [enriched(f"a/{i}", published_at=m) for i, m in enumerate(moments)]
    stores.append(validated(spark, records), path)
    files = lambda: {f for f in spark.read.parquet(path).inputFiles() if "2024" in f}
    untouched = files()
    assert stores.prune_store(spark, path, AS_OF) == {
        "deleted_count": 3, "cutoff": "2023-12-21T12:00:00+00:00",
    }
    assert ids(stores.read_store(spark, path)) == ["a/1", "a/4"] and files() == untouched
    assert stores.prune_store(spark, path, AS_OF)["deleted_count"] == 0


def test_a_partition_that_empties_is_dropped(spark, tmp_path):
    path = str(tmp_path / "store")
    stores.append(validated(spark, [enriched("a/1", published_at="2023-12-21T01:00:00Z")]), path)
    assert stores.prune_store(spark, path, AS_OF)["deleted_count"] == 1
    assert stores.read_store(spark, path).count() == 0


def test_failed_writes_are_buffered_and_replayed(spark, tmp_path):
    batch = times(spark, [at(1), at(2)])
    good = write_or_buffer(lambda df: df.write.parquet(str(tmp_path / "ok")), str(tmp_path / "buf"))
    assert good(batch, 0) == {"sent": 2, "buffered": 0}

    def broken(df):
        raise ConnectionError("no broker")

    bad = write_or_buffer(broken, str(tmp_path / "buf"))
    for _ in range(2):  # a repeated batch replaces its own buffer
        assert bad(batch, 1) == {"sent": 0, "buffered": 2}
    back = replay_buffer(spark, str(tmp_path / "buf"), batch.schema)
    assert ids(back.select("article_id")) == ["a/0", "a/1"]
