"""The article store: one parquet table partitioned by publication date."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazette.functions.text import iso_time
from gazette.operators.dedup import DEAD, INSERTED, label_inserts
from gazette.operators.maintenance import prune
from gazette.operators.route import dead_value
from gazette.schemas import (
    LOG_ORDER,
    PRUNE_DAYS,
    STAGE_INGEST,
    STORE,
    STORED_FIELDS,
    TOPIC_FAILED,
)
from gazette.session import ensure_folder, hadoop_path

KEY_BUCKETS = 64

PARTITIONED = T.StructType(STORE.fields + [T.StructField("dt", T.DateType())])


def ensure_store(spark: SparkSession, path: str) -> None:
    """Create the table if it is not there yet; otherwise do nothing."""
    ensure_folder(spark, path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The table. Its schema is fixed, so an empty one can be read too."""
    return spark.read.schema(PARTITIONED).parquet(path)


def scan(
    store: DataFrame,
    where: Column | str | None = None,
    order: Sequence[Column | str] = (),
    limit: int | None = None,
) -> DataFrame:
    """Rows of the store that pass a filter, in an order; all of them unless a limit is given."""
    rows = store if where is None else store.where(where)
    rows = rows.orderBy(*order) if order else rows
    return rows if limit is None else rows.limit(limit)


def as_stored(articles: DataFrame) -> DataFrame:
    """Only the stored properties, the vector, and an id derived from the article's."""
    return articles.select(
        *STORED_FIELDS,
        F.col("embedding").cast("array<float>").alias("embedding"),
        F.sha2("article_id", 256).alias("uuid"),
        F.to_date("published_at").alias("dt"),
    )


def append(articles: DataFrame, path: str) -> None:
    """Append rows; a date with many rows is spread over several files."""
    as_stored(articles).hint("rebalance", "dt").write.mode("append").partitionBy("dt").parquet(
        path
    )


# --- the keys of the store ------------------------------------------------------------


def keys_path(path: str) -> str:
    """Where the keys of the store at ``path`` are: beside it, in buckets by hash."""
    return f"{path.rstrip('/')}-keys"


def key_bucket(buckets: int = KEY_BUCKETS) -> Column:
    return F.pmod(F.xxhash64("article_id"), F.lit(buckets)).cast("int").alias("bucket")


def index_keys(spark: SparkSession, path: str) -> None:
    """Write the keys of all that the store holds, instead of any that were there."""
    ids = read_store(spark, path).select("article_id").where(F.col("article_id").isNotNull())
    _write_keys(ids.distinct(), path, "overwrite")


def _write_keys(ids: DataFrame, path: str, mode: str) -> None:
    keyed = ids.select("article_id", key_bucket()).hint("rebalance", "bucket")
    # row groups tell by a Bloom filter whether they hold an id
    keyed.write.mode(mode).option("parquet.bloom.filter.enabled#article_id", "true").partitionBy(
        "bucket"
    ).parquet(keys_path(path))


def stored_keys(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame:
    """Which of ``ids`` (article_id) the store holds, from the buckets of these ids alone.

    A store without keys, or whose keys were not finished, gets them first.
    """
    if not _is_written(spark, keys_path(path)):
        index_keys(spark, path)
    wanted = ids.select("article_id").where(F.col("article_id").isNotNull()).distinct()
    buckets = [r[0] for r in wanted.select(key_bucket()).distinct().collect()]  # KEY_BUCKETS at most
    keys = spark.read.schema("article_id string, bucket int").parquet(keys_path(path))
    return keys.where(F.col("bucket").isin(buckets)).select("article_id").join(wanted, "article_id", "left_semi")


def _is_written(spark: SparkSession, path: str) -> bool:
    fs, done = hadoop_path(spark, f"{path}/_SUCCESS")
    return fs.exists(done)


def _written_once(df: DataFrame, path: str) -> DataFrame:
    """``df`` as a table at ``path``, written unless an earlier run finished it."""
    spark = df.sparkSession
    if not _is_written(spark, path):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _run_token(spark: SparkSession, work_path: str) -> str:
    """A name drawn when work starts in an empty folder; batch numbers repeat, it does not."""
    drawn = spark.createDataFrame([(uuid.uuid4().hex,)], "token string")
    return _written_once(drawn, f"{work_path}/run").first()["token"]


def _drop(spark: SparkSession, path: str) -> None:
    fs, target = hadoop_path(spark, path)
    fs.delete(target, True)


def ingest_batch(
    batch: DataFrame,
    batch_id: int,
    store_path: str,
    failed_path: str,
    work_path: str,
    failed_at,
    order: Sequence[str] = LOG_ORDER,
) -> None:
    """Insert the new articles of one batch and log its dead letters.

    ``batch`` holds validated records beside their original ``value`` and ``offset``.
    Of the columns in ``order`` those count that it has; rows that tie in them
    are taken in the order in which they were written down here.

    May be run again for the same batch after any failure. Labels depend on what
    the store held before the batch, so records and labels are written to shared
    storage once per batch, and a repeated run reads them back instead of
    labelling against a store that already holds some of its rows. They are
    removed when a later batch shows that this one is done. ``work_path`` must
    belong to the stream's checkpoint: batch numbers start anew without it.
    """
    spark = batch.sparkSession
    ensure_store(spark, store_path)
    records = _written_once(
        batch.withColumn("_row", F.monotonically_increasing_id()),
        f"{work_path}/records/batch_id={batch_id}",
    )
    # The store is usually much larger than a batch, so only the buckets of its ids are opened.
    # Against a written batch Spark knows the size of its ids and can cut keys down map-side.
    ids = records.select("article_id").distinct()
    stored = stored_keys(spark, store_path, ids)
    usable = F.coalesce(F.size("embedding") > 0, F.lit(False)).alias("_usable")
    placed = [*(name for name in order if name in records.columns), "_row"]
    labels_path = f"{work_path}/labels/batch_id={batch_id}"
    repeated = _is_written(spark, labels_path)
    labels = _written_once(
        label_inserts(
            records.select("article_id", *placed, usable),
            stored,
            order=placed,
            usable=F.col("_usable"),
        ).select("_row", "label"),
        labels_path,
    )

    def labelled(label: str) -> DataFrame:
        return records.join(labels.where(F.col("label") == label), "_row", "left_semi")

    new = labelled(INSERTED)
    if repeated:  # an earlier run got past its labels and may have stored some rows
        present = read_store(spark, store_path).select("article_id")
        present = present.join(ids, "article_id", "left_semi")
        new = new.join(present, "article_id", "left_anti")
    append(new, store_path)
    # Keys come after their rows. Should that not happen, the repeated run has the same labels
    # and adds those that are not there yet.
    keys = labelled(INSERTED).select("article_id").distinct()
    if repeated:
        keys = keys.join(stored_keys(spark, store_path, keys), "article_id", "left_anti")
    _write_keys(keys, store_path, "append")

    no_id = F.coalesce(F.col("article_id"), F.lit("")) == ""
    added = {
        "_error": F.when(no_id, "missing required field: article_id").otherwise(
            "missing or invalid embedding"
        ),
        "_failed_at": iso_time(F.lit(failed_at).cast("timestamp")),
        "_failed_stage": F.lit(STAGE_INGEST),
    }
    labelled(DEAD).select(
        F.col("article_id").alias("key"),
        dead_value(added).alias("value"),
        "offset",
        F.lit(failed_at).cast("timestamp").alias("timestamp"),
    ).write.mode("overwrite").parquet(
        f"{failed_path}/topic={TOPIC_FAILED}/run={_run_token(spark, work_path)}/batch_id={batch_id}"
    )
    for kind in ("records", "labels"):
        _drop(spark, f"{work_path}/{kind}/batch_id={batch_id - 1}")


def prune_store(spark: SparkSession, path: str, as_of: dt.datetime, days: int = PRUNE_DAYS) -> dict:
    """Delete old articles from the table; returns the count and the cutoff.

    Only partitions up to the cutoff's date are read. Whole old partitions are
    dropped, and the cutoff's own partition is rewritten without its old rows.
    Running it again after a failure finishes the job.
    """
    cutoff = as_of - dt.timedelta(days=days)
    last = cutoff.date()
    due = read_store(spark, path).where(F.col("dt") <= F.lit(last))
    kept, deleted = prune(due, as_of, days)
    old = {r.dt: r.n for r in deleted.groupBy("dt").agg(F.count(F.lit(1)).alias("n")).collect()}
    staying = kept.where(F.col("dt") == F.lit(last))
    rewrite = last in old and not staying.isEmpty()
    keyed = bool(old) and _is_written(spark, keys_path(path))
    if keyed:  # they go first: without keys a batch makes them anew, of what is there then
        _drop(spark, keys_path(path))
    if rewrite:
        staying.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "dt"
        ).parquet(path)
    for date in old:
        if not (rewrite and date == last):
            _drop(spark, f"{path}/dt={date.isoformat()}")
    if keyed:
        index_keys(spark, path)  # what was deleted may be inserted again
    return {"deleted_count": sum(old.values()), "cutoff": cutoff.isoformat()}
