"""Delivery of batches through a ledger: each batch reaches the log once.

A batch has a folder of its own in the log, so sending it again replaces what an
earlier try left there. The ledger notes which batches were sent, buffered and
replayed. Readers see the batches that the ledger calls delivered, so half a batch is never seen.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.schemas import LOG
from gazette.session import ensure_folder, hadoop_path

logger = logging.getLogger(__name__)

SENT, BUFFERED, REPLAYED = "sent", "buffered", "replayed"
LEDGER = T.StructType([T.StructField("batch", T.StringType()), T.StructField("state", T.StringType())])
BATCHED = T.StructType([*LOG.fields, T.StructField("batch", T.StringType())])

# Writes the messages of one batch so that writing them again changes nothing.
Send = Callable[[DataFrame, str], None]


def to_log(path: str) -> Send:
    """Messages into the batch's own folder of the log, in place of what is there."""

    def send(messages: DataFrame, batch: str) -> None:
        messages.write.mode("overwrite").partitionBy("topic").parquet(f"{path}/log/batch={batch}")

    return send


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """All that was noted, (batch, state)."""
    ensure_folder(spark, f"{path}/ledger")
    return spark.read.schema(LEDGER).parquet(f"{path}/ledger")


def _note(spark: SparkSession, path: str, batch: str, state: str) -> None:
    row = spark.createDataFrame([(batch, state)], LEDGER).coalesce(1)
    row.write.mode("append").parquet(f"{path}/ledger")


def _delivered(notes: DataFrame) -> DataFrame:
    return notes.where(F.col("state").isin(SENT, REPLAYED)).select("batch").distinct()


def waiting(spark: SparkSession, path: str) -> DataFrame:
    """Batches that were buffered and not delivered since."""
    notes = ledger(spark, path)
    buffered = notes.where(F.col("state") == BUFFERED).select("batch").distinct()
    return buffered.join(_delivered(notes), "batch", "left_anti")


def deliver_once(path: str, run: str, send: Send | None = None):
    """A ``foreachBatch`` function that sends a batch, or buffers it whole where that fails.

    ``run`` sets apart queries that number their batches alike. A repeated batch
    that was delivered is left alone; one that was not is sent again. With a ``send``
    of your own, readers of that sink have to replace by batch as well.
    """
    send = send or to_log(path)

    def sink(messages: DataFrame, batch_id: int = 0) -> str:
        spark, batch = messages.sparkSession, f"{run}-{batch_id}"
        known = ledger(spark, path).where(F.col("batch") == batch)
        if not _delivered(known).isEmpty():
            return SENT
        try:
            send(messages, batch)
            state = SENT
        except Exception:
            logger.exception("Batch %s is buffered", batch)
            messages.write.mode("overwrite").parquet(f"{path}/buffer/batch={batch}")
            state = BUFFERED
        _note(spark, path, batch, state)
        return state

    return sink


def replay_once(spark: SparkSession, path: str, send: Send | None = None) -> list[str]:
    """Deliver the waiting batches; returns those delivered now.

    A batch that fails again stays. One that was written, but not noted before
    the driver was lost, is written again over itself. The buffered copy goes last.
    """
    send = send or to_log(path)
    done = []
    for (batch,) in waiting(spark, path).orderBy("batch").collect():  # names, not messages
        buffered = f"{path}/buffer/batch={batch}"
        try:
            send(spark.read.schema(LOG).parquet(buffered), batch)
        except Exception:
            logger.exception("Batch %s stays buffered", batch)
            continue
        _note(spark, path, batch, REPLAYED)
        fs, target = hadoop_path(spark, buffered)
        fs.delete(target, True)
        done.append(batch)
    return done


def read_delivered(spark: SparkSession, path: str) -> DataFrame:
    """Messages of all delivered batches; folders of others are not opened."""
    ensure_folder(spark, f"{path}/log")
    log = spark.read.schema(BATCHED).parquet(f"{path}/log")
    return log.join(_delivered(ledger(spark, path)), "batch", "left_semi").drop("batch")
