"""Logs by topic and day, their retention, and the ledger of deliveries."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from builders import AS_OF, plan_of
from gazette.operators.maintenance import expire
from gazette.schemas import LOG
from gazette.sources.daylog import drop_expired, read_days, stream_days, write_days
from gazette.sources.outbox import (
    BUFFERED,
    REPLAYED,
    SENT,
    deliver_once,
    ledger,
    read_delivered,
    replay_once,
    to_log,
    waiting,
)
from gazette.sources.topics import _kafka_start, read_topics, write_topics


def logged(spark, *messages):
    """Messages of (offset, topic, time)."""
    rows = [(str(n), f"v{n}", None, n, at, topic) for n, topic, at in messages]
    return spark.createDataFrame(rows, LOG)


def before(**age):
    return AS_OF - dt.timedelta(**age)


def offsets(df):
    return sorted(r.offset for r in df.collect())


def files(root, pattern="**/*.parquet"):
    return len(list(Path(root).glob(pattern)))


# --- days --------------------------------------------------------------------------


def test_retention_frees_storage(spark, tmp_path):
    root = str(tmp_path / "a log")
    assert drop_expired(spark, root, AS_OF) == dict.fromkeys(drop_expired(spark, root, AS_OF), 0)
    for n, (topic, at) in enumerate([
        ("raw-news", before(days=3)), ("raw-news", before(days=2)),  # days before the cutoff's
        ("raw-news", before(days=1, hours=1)), ("raw-news", before(days=1)), ("raw-news", AS_OF),
        ("tech-news", before(days=2, seconds=1)), ("mine", before(days=99)), ("raw-news", None),
    ]):
        write_days(logged(spark, (n, topic, at)).coalesce(1), root)
    # one file that holds messages of both sides of the cutoff
    write_days(
        logged(spark, (8, "raw-news", before(days=1, hours=2)), (9, "raw-news", before(hours=23))).coalesce(1),
        root,
    )
    write_days(
        logged(spark, (10, "raw-news", before(days=1, hours=2)), (11, "raw-news", before(hours=24))).coalesce(1),
        root,
    )
    whole = files(root)
    freed = drop_expired(spark, root, AS_OF)
    assert freed["raw-news"] > 0 and freed["tech-news"] > 0 and freed["news-failed"] == 0
    left = offsets(read_days(spark, root))
    assert left == [3, 4, 6, 7, 8, 9, 10, 11]  # 8 and 10 share their file with newer ones
    assert files(root) < whole and not files(root, "topic=tech-news/**/*.parquet")
    assert not list(Path(root).glob("topic=raw-news/day=2024-01-18"))
    kept = offsets(expire(read_days(spark, root), AS_OF))
    assert kept == [3, 4, 6, 7, 9, 11]
    assert sum(drop_expired(spark, root, AS_OF).values()) == 0
    later = AS_OF + dt.timedelta(days=1)
    drop_expired(spark, root, later)
    assert offsets(read_days(spark, root, ["raw-news"])) == [4, 7]


def test_a_late_reader_opens_its_days(spark, tmp_path):
    root = str(tmp_path / "log")
    write_days(logged(spark, *[(n, "raw-news", before(days=n)) for n in range(5)]), root)
    recent = read_days(spark, root, ["raw-news"], since=before(days=2))
    assert offsets(recent) == [0, 1, 2]
    assert recent.columns == LOG.fieldNames()
    pruned = plan_of(recent).split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "day" in pruned and "topic" in pruned
    assert offsets(read_days(spark, root, since=AS_OF + dt.timedelta(days=9))) == []


def test_topics_from_a_moment_on(spark, tmp_path):
    root = str(tmp_path)
    write_topics(logged(spark, *[(n, "raw-news", before(days=n)) for n in range(4)]), root)
    assert offsets(read_topics(spark, root, ["raw-news"], since=before(days=2))) == [0, 1, 2]
    assert offsets(read_topics(spark, root)) == [0, 1, 2, 3]
    start = _kafka_start(dt.datetime(2024, 1, 2))
    assert start["startingTimestamp"] == "1704153600000"
    assert _kafka_start(None) == {"startingOffsets": "earliest"}


def test_retention_beside_a_running_stream(spark, tmp_path):
    root, seen, points = (str(tmp_path / n) for n in ("log", "seen", "points"))

    def run():
        source = read_days(spark, root, ["raw-news"], streaming=True)
        query = source.writeStream.format("parquet").option("checkpointLocation", points)
        query.trigger(availableNow=True).start(seen).awaitTermination()
        return offsets(spark.read.parquet(seen))

    stream = logged(spark, *[(n, "raw-news", before(hours=7 * n)) for n in range(6)]).repartition(3, "offset")
    write_days(stream, root)
    assert run() == list(range(6))
    write_days(logged(spark, (6, "raw-news", before(days=9)), (7, "raw-news", AS_OF)), root)
    drop_expired(spark, root, AS_OF)
    # Nothing comes twice; 6 was past retention before the stream came to it.
    assert run() == [0, 1, 2, 3, 4, 5, 7]


def test_a_stream_writes_days(spark, tmp_path):
    source, root, points = (str(tmp_path / n) for n in ("in", "log", "points"))
    for n in range(2):
        logged(spark, (n, "raw-news", before(days=n)), (n + 2, "mine", before(days=n))).write.mode(
            "append"
        ).parquet(source)
        query = stream_days(
            spark.readStream.schema(LOG).parquet(source), points, root, {"availableNow": True}
        )
        query.awaitTermination()
    assert offsets(read_days(spark, root)) == [0, 1, 2, 3]
    drop_expired(spark, root, AS_OF, {"raw-news": 1, "mine": 0})
    assert offsets(read_days(spark, root, ["raw-news"])) == [0, 1]
    assert offsets(read_days(spark, root)) == [0, 1, 2]  # the file of AS_OF itself stays


# --- the ledger ----------------------------------------------------------------------


def away(messages, batch):
    raise ConnectionError("the sink is away")


def notes(spark, root):
    return sorted((r.batch, r.state) for r in ledger(spark, root).collect())


def test_replaying_twice_delivers_once(spark, tmp_path):
    root = str(tmp_path)
    first, second = logged(spark, (1, "a", AS_OF), (2, "b", AS_OF)), logged(spark, (3, "a", AS_OF))
    assert deliver_once(root, "r")(first, 0) == SENT
    assert deliver_once(root, "r", away)(second, 1) == BUFFERED
    assert offsets(read_delivered(spark, root)) == [1, 2]
    assert replay_once(spark, root, away) == []  # still away
    assert [r.batch for r in waiting(spark, root).collect()] == ["r-1"]
    assert replay_once(spark, root) == ["r-1"]
    assert replay_once(spark, root) == []
    assert deliver_once(root, "r")(second, 1) == SENT  # the stream repeats its batch
    assert deliver_once(root, "other")(second, 1) == SENT  # another one has its own numbers
    assert offsets(read_delivered(spark, root)) == [1, 2, 3, 3]
    assert notes(spark, root) == [
        ("other-1", SENT), ("r-0", SENT), ("r-1", BUFFERED), ("r-1", REPLAYED),
    ]


def test_half_a_batch_is_neither_seen_nor_kept(spark, tmp_path):
    root = str(tmp_path)
    batch = logged(spark, (1, "a", AS_OF), (2, "b", AS_OF), (3, "c", None))

    def half(messages, name):
        to_log(root)(messages.where("offset < 3"), name)
        raise ConnectionError("the sink went away")

    assert deliver_once(root, "r", half)(batch, 0) == BUFFERED
    assert files(f"{root}/log") == 2 and offsets(read_delivered(spark, root)) == []
    assert replay_once(spark, root) == ["r-0"]
    assert offsets(read_delivered(spark, root)) == [1, 2, 3]


@pytest.mark.parametrize("noted", ["sent", "replayed"])
def test_a_crash_between_writing_and_noting(spark, tmp_path, noted):
    root = str(tmp_path)
    batch = logged(spark, (1, "a", AS_OF), (2, "b", AS_OF))
    if noted == "replayed":
        deliver_once(root, "r", away)(batch, 0)
    to_log(root)(batch, "r-0")  # and the driver is lost here
    assert offsets(read_delivered(spark, root)) == []
    if noted == "replayed":
        assert replay_once(spark, root) == ["r-0"]
    else:
        assert deliver_once(root, "r")(batch.where("topic = 'a'"), 0) == SENT
    # The repetition decides: nothing of the earlier try is left.
    assert offsets(read_delivered(spark, root)) == ([1, 2] if noted == "replayed" else [1])


def test_delivery_of_a_stream(spark, tmp_path):
    source, root, points = (str(tmp_path / n) for n in ("in", "out", "points"))
    for n in range(3):
        logged(spark, (n, "a", AS_OF)).write.mode("append").parquet(source)
        sink = deliver_once(root, "r", away if n == 1 else None)
        query = spark.readStream.schema(LOG).parquet(source).writeStream.foreachBatch(
            lambda df, i, sink=sink: sink(df, i) and None
        )
        query.option("checkpointLocation", points).trigger(availableNow=True).start().awaitTermination()
    assert offsets(read_delivered(spark, root)) == [0, 2]
    replay_once(spark, root)
    found = read_delivered(spark, root)
    assert offsets(found) == [0, 1, 2] and "batch" not in found.columns
    assert found.where(F.col("topic") != "a").isEmpty()
