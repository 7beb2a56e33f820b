"""Topic logs laid out by topic and day, and retention that frees their storage.

A reader that starts at a moment opens the days from it on. Retention works like
that of a broker: files go whole, once the newest message in them is past its topic's
retention, and no file is written anew. A running file stream therefore never meets
a message twice. What is past retention in a file that stays is hidden by ``expire``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gazette.schemas import LOG, RETENTION_DAYS
from gazette.session import ensure_folder, hadoop_path
from gazette.sources.topics import FILES_PER_BATCH

LAYOUT = ("topic", "day")
DAYLOG = T.StructType([*LOG.fields, T.StructField("day", T.DateType())])


def _with_day(messages: DataFrame) -> DataFrame:
    # Sessions work in UTC, so days do too. A message without a time has no day and never expires.
    return messages.withColumn("day", F.to_date("timestamp"))


def write_days(messages: DataFrame, root: str) -> None:
    """Append a batch of messages to the days of their topics."""
    _with_day(messages).write.mode("append").partitionBy(*LAYOUT).parquet(root)


def stream_days(messages: DataFrame, checkpoint: str, root: str, trigger=None) -> StreamingQuery:
    """Start a query that appends to the days of topics, exactly once."""
    writer = _with_day(messages).writeStream.format("parquet").outputMode("append")
    writer = writer.partitionBy(*LAYOUT).option("path", root).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "60 seconds"})).start()


def read_days(
    spark: SparkSession,
    root: str,
    topics: list[str] | None = None,
    since: dt.datetime | None = None,
    streaming: bool = False,
    **options: str,
) -> DataFrame:
    """Messages of the topics (all by default) logged at or after ``since``.

    Only folders of these topics and days are opened. Files that retention takes
    away in the meantime are skipped.
    """
    options = {"ignoreMissingFiles": "true", **options}
    if streaming:
        ensure_folder(spark, root)
        options = {"maxFilesPerTrigger": FILES_PER_BATCH, **options}
    log = (spark.readStream if streaming else spark.read).schema(DAYLOG).options(**options).parquet(root)
    if topics is not None:
        log = log.where(F.col("topic").isin(*topics))
    if since is not None:
        start = F.lit(since).cast("timestamp")
        log = log.where((F.col("day") >= F.to_date(start)) & (F.col("timestamp") >= start))
    return log.drop("day")


def _days(spark: SparkSession, topic_path: str) -> dict[dt.date, str]:
    """The days of a topic and their folders; as many as a log has days."""
    fs, folder = hadoop_path(spark, topic_path)
    found = {}
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        name, _, value = status.getPath().getName().partition("=")
        if name == "day" and value[:1].isdigit():
            found[dt.date.fromisoformat(value)] = status.getPath().toString()
    return found


def _unescaped(spark: SparkSession, uri: str) -> str:
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI.create(uri)).toString()


def _delete(spark: SparkSession, path: str) -> int:
    """Bytes that are free once the path is gone."""
    fs, target = hadoop_path(spark, path)
    size = fs.getContentSummary(target).getLength() if fs.exists(target) else 0
    fs.delete(target, True)
    return size


def drop_expired(
    spark: SparkSession, root: str, as_of: dt.datetime, retention: dict[str, int] | None = None
) -> dict[str, int]:
    """Delete what is past retention; returns the bytes freed by topic.

    Days before the cutoff's go as folders, unread. Of the cutoff's own day the newest
    time of each file decides, and only that column is read. Running it again
    after a failure finishes the job. Topics without retention keep all.
    """
    freed = {}
    for topic, days in (RETENTION_DAYS if retention is None else retention).items():
        cutoff = as_of - dt.timedelta(days=days)
        if cutoff.tzinfo:
            cutoff = cutoff.astimezone(dt.timezone.utc)
        old = []
        for day, path in _days(spark, f"{root}/topic={topic}").items():
            if day < cutoff.date():
                old.append(path)
            elif day == cutoff.date():
                times = spark.read.schema("timestamp timestamp").parquet(path)
                newest = times.groupBy(F.col("_metadata.file_path").alias("file")).agg(
                    F.max("timestamp").alias("newest")
                )
                past = newest.where(F.col("newest") < F.lit(cutoff).cast("timestamp"))
                old += [_unescaped(spark, row.file) for row in past.toLocalIterator()]
        freed[topic] = sum(_delete(spark, path) for path in old)
    return freed
