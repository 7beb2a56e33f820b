"""Topic logs: Kafka where the connector is installed, parquet folders otherwise.

Both forms give the same columns (``schemas.LOG``), so everything downstream is
the same for batch, file streams and Kafka.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.functions.rows import computed_once
from gazette.functions.text import is_falsy, parse_time
from gazette.schemas import LOG, TIMESTAMP_COLUMNS, TOPIC_CORRUPT, json_form
from gazette.session import ensure_folder


# A new stream over a long log works through it in batches of so many files.
FILES_PER_BATCH = "1000"


def read_topics(
    spark: SparkSession,
    root: str | None = None,
    topics: list[str] | None = None,
    streaming: bool = False,
    since: dt.datetime | None = None,
    **options: str,
) -> DataFrame:
    """Messages of the given topics, from the earliest on, or those logged at or after ``since``.

    ``root`` is a parquet log partitioned by topic. Without it the topics are
    read from Kafka with the given connection options.
    """
    reader = spark.readStream if streaming else spark.read
    if root is not None:
        if streaming:
            # A job may start before the one that feeds it has written anything.
            ensure_folder(spark, root)
            options = {"maxFilesPerTrigger": FILES_PER_BATCH, **options}
        log = reader.schema(LOG).options(**options).parquet(root)
        log = log.where(F.col("topic").isin(*topics)) if topics else log
    else:
        kafka = reader.format("kafka").option("subscribe", ",".join(topics or []))
        log = kafka.options(**_kafka_start(since)).options(**options).load().select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            "partition",
            "offset",
            "timestamp",
            "topic",
        )
    return log if since is None else read_topics_since(log, F.lit(since).cast("timestamp"))


def _kafka_start(since: dt.datetime | None) -> dict[str, str]:
    """The broker finds the offsets of a moment; partitions without later messages start at their end."""
    if since is None:
        return {"startingOffsets": "earliest"}
    since = since if since.tzinfo else since.replace(tzinfo=dt.timezone.utc)
    return {
        "startingTimestamp": str(int(since.timestamp() * 1000)),
        "startingOffsetsByTimestampStrategy": "latest",
    }


def read_topics_since(log: DataFrame, cutoff: Column) -> DataFrame:
    """Messages logged at or after ``cutoff``; the filter reaches the scan."""
    return log.where(F.col("timestamp") >= cutoff)


def parse_records(log: DataFrame, schema: T.StructType) -> DataFrame:
    """Message values as columns, beside the original text.

    ``_corrupt`` says that the value is no JSON object. A field with a wrong
    type is NULL, and so is a time that cannot be read.
    """
    shape = T.StructType(json_form(schema).fields + [T.StructField("_bad", T.StringType())])
    read = log.withColumn(
        "_r", F.from_json("value", shape, {"columnNameOfCorruptRecord": "_bad"})
    )
    unreadable = F.col("_r._bad").isNotNull() | ~F.col("value").rlike(r"^\s*\{")
    columns = [
        (parse_time(f"_r.{name}") if name in TIMESTAMP_COLUMNS else F.col(f"_r.{name}")).alias(name)
        for name in schema.fieldNames()
    ]
    columns.append(F.coalesce(unreadable, F.lit(True)).alias("_corrupt"))
    return computed_once(read, columns, *[c for c in log.columns if c != "key"])


def raise_if_corrupt(records: DataFrame) -> DataFrame:
    """Fail the job at the first record that is no JSON object or has no id."""
    bad = F.col("_corrupt") | is_falsy("article_id")
    fail = F.raise_error(F.concat(F.lit("unreadable record: "), "value")).cast("boolean")
    # As a filter, because a column nobody reads would never be worked out.
    return records.where(F.when(bad, fail).otherwise(F.lit(True)))


def corrupt_records(records: DataFrame) -> DataFrame:
    """Unreadable records as messages of their own topic."""
    return records.where(F.col("_corrupt")).select(
        F.lit(None).cast("string").alias("key"),
        "value",
        "offset",
        "timestamp",
        F.lit(TOPIC_CORRUPT).alias("topic"),
    )


def write_topics(messages: DataFrame, root: str | None = None, **options: str) -> None:
    """Append a batch of messages to their topics."""
    if root is not None:
        messages.write.mode("append").partitionBy("topic").parquet(root)
    else:
        messages.select("key", "value", "topic").write.format("kafka").options(**options).save()


def stream_topics(
    messages: DataFrame, checkpoint: str, root: str | None = None, trigger=None, **options: str
):
    """Start a query that appends to topics; the file form is exactly once."""
    writer = messages.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(**(trigger or {"processingTime": "60 seconds"}))
    if root is not None:
        return writer.format("parquet").partitionBy("topic").option("path", root).start()
    return writer.format("kafka").options(**options).start()


def write_or_buffer(write, buffer_path: str):
    """A ``foreachBatch`` function: ``write`` the batch, or buffer it as JSON.

    Succeeds or fails per batch, not per row: a failed batch is buffered whole
    under its id, so a repeated batch replaces its own buffer. The last batch's
    counts are in the function's ``counts``.
    """

    def sink(batch: DataFrame, batch_id: int = 0) -> dict[str, int]:
        from pyspark.sql import Observation

        def observed():
            seen = Observation()
            return seen, batch.observe(seen, F.count(F.lit(1)).alias("n"))

        seen, counted = observed()
        try:
            write(counted)
            sink.counts = {"sent": seen.get["n"], "buffered": 0}
        except Exception:
            seen, counted = observed()
            counted.write.mode("overwrite").json(f"{buffer_path}/batch_id={batch_id}")
            sink.counts = {"sent": 0, "buffered": seen.get["n"]}
        return sink.counts

    sink.counts = {"sent": 0, "buffered": 0}
    return sink


def replay_buffer(spark: SparkSession, buffer_path: str, schema: T.StructType) -> DataFrame:
    """Buffered rows, to be written again."""
    return spark.read.schema(schema).json(buffer_path)
