"""Topic logs, the buffer and the store, written to and read from shared storage."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from gazette.operators.dedup import first_seen
from gazette.operators.maintenance import assert_not_empty
from gazette.operators.route import as_json, route_section
from gazette.schemas import (
    ENRICHED,
    LOG,
    LOG_ORDER,
    TOPIC_ENRICHED,
    TOPIC_FINANCE,
    TOPIC_TECH,
)
from gazette.session import checkpoint_root
from gazette.sources.normalize import gathered_sources, union_sources
from gazette.sources.outbox import deliver_once, read_delivered, replay_once, to_log
from gazette.sources.store import ensure_store, ingest_batch, prune_store, read_store
from gazette.sources.topics import (
    parse_records,
    read_topics,
    replay_buffer,
    write_or_buffer,
    write_topics,
)
from gazette.workload.base import SQL_TOPIC, articles, enriched, query, sql, table

LOGGED = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


def folder(spark, name: str) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def as_log(rows, topic):
    """Messages of one moment, numbered by the articles' own numbers."""
    return rows.select(
        F.col("article_id").alias("key"),
        as_json(rows).alias("value"),
        F.col("seq").alias("offset"),
        F.lit(LOGGED).cast("timestamp").alias("timestamp"),
        topic.alias("topic"),
    )


def per_topic(log):
    return log.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"), F.sum("offset").alias("seq_sum")
    )


@query(
    sql(
        """SELECT article_id, seq FROM (
             SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY seq % 2, seq) AS rn
             FROM articles WHERE article_id IS NOT NULL) WHERE rn = 1""",
        "articles",
    )
)
def first_over_partitions(spark, sf_dir):
    """First copies in a log of two partitions, which number their messages alike."""
    seq = F.col("seq")
    log = articles(spark, sf_dir).select(
        "article_id",
        "seq",
        F.lit(LOGGED).cast("timestamp").alias("timestamp"),
        (seq % 2).cast("int").alias("partition"),
        F.floor(seq / 2).alias("offset"),
    )
    return first_seen(log, order=LOG_ORDER).select("article_id", "seq")


@query(
    sql(
        f"""SELECT {SQL_TOPIC} AS topic, count(*) AS n, sum(seq)::BIGINT AS seq_sum FROM articles
            WHERE {SQL_TOPIC} IN ('{TOPIC_TECH}', '{TOPIC_FINANCE}') GROUP BY 1""",
        "articles",
    )
)
def read_multi_topics(spark, sf_dir):
    """Two of the topics that the articles were written to."""
    root = folder(spark, "topics")
    rows = articles(spark, sf_dir)
    write_topics(as_log(rows, route_section("section")), root)
    return per_topic(read_topics(spark, root, [TOPIC_TECH, TOPIC_FINANCE]))


@query(
    sql(
        """SELECT seq, md5(summary) AS summary_md5, sentiment,
                  coalesce(array_to_string(entities, '|'), '') AS entities,
                  strftime(enriched_at, '%Y-%m-%d %H:%M:%S') AS enriched_at FROM enriched""",
        "articles",
        "enriched",
    )
)
def read_enriched_log(spark, sf_dir):
    """Enriched articles as messages of their topic, read back with their types."""
    root = folder(spark, "enriched")
    rows = enriched(spark, sf_dir)
    write_topics(as_log(rows, F.lit(TOPIC_ENRICHED)), root)
    return parse_records(read_topics(spark, root, [TOPIC_ENRICHED]), ENRICHED).select(
        F.col("offset").alias("seq"),
        F.md5("summary").alias("summary_md5"),
        "sentiment",
        F.coalesce(F.array_join("entities", "|"), F.lit("")).alias("entities"),
        F.date_format("enriched_at", "yyyy-MM-dd HH:mm:ss").alias("enriched_at"),
    )


@query(
    sql(
        f"""SELECT {SQL_TOPIC} AS topic, count(*) AS n, sum(seq)::BIGINT AS seq_sum
            FROM articles GROUP BY 1""",
        "articles",
    )
)
def buffer_and_replay(spark, sf_dir):
    """Every other article meets a sink that is away; the buffer brings it back."""
    root = folder(spark, "buffer")
    rows = as_log(articles(spark, sf_dir), route_section("section"))

    def away(batch):
        raise ConnectionError("the sink is away")

    def append(batch):
        write_topics(batch, f"{root}/log")

    write_or_buffer(away, f"{root}/buffer")(rows.where("offset % 2 = 1"), 0)
    write_or_buffer(append, f"{root}/buffer")(rows.where("offset % 2 = 0"), 1)
    append(replay_buffer(spark, f"{root}/buffer", LOG).drop("batch_id"))
    return per_topic(read_topics(spark, f"{root}/log"))


@query(
    sql(
        f"""SELECT {SQL_TOPIC} AS topic, count(*) AS n, sum(seq)::BIGINT AS seq_sum
            FROM articles GROUP BY 1""",
        "articles",
    )
)
def delivered_once(spark, sf_dir):
    """Four batches: one arrives, one finds the sink away, one breaks off half-way, and one
    is written but not noted; after two replays and a repetition each is there once."""
    root = folder(spark, "outbox")
    rows = as_log(articles(spark, sf_dir), route_section("section"))
    batches = [rows.where(F.col("offset") % 4 == i) for i in range(4)]

    def away(messages, batch):
        raise ConnectionError("the sink is away")

    def half(messages, batch):
        to_log(root)(messages.where("offset % 8 < 4"), batch)
        raise ConnectionError("the sink went away")

    for number, send in enumerate((None, away, half)):
        deliver_once(root, "run", send)(batches[number], number)
    to_log(root)(batches[3], "run-3")
    for _ in range(2):
        replay_once(spark, root)
        for number in (0, 3):
            deliver_once(root, "run")(batches[number], number)
    return per_topic(read_delivered(spark, root))


@query(
    sql(
        """SELECT article_id, source_url, CAST(published_at AS DATE)::VARCHAR AS dt FROM (
             SELECT a.*, row_number() OVER (PARTITION BY article_id ORDER BY seq % 2, seq) AS rn
             FROM articles a JOIN embeddings e ON e.vec_id = a.seq WHERE article_id IS NOT NULL)
           WHERE rn = 1 AND published_at >= TIMESTAMP '2024-02-10 06:00:00' - INTERVAL 30 DAY""",
        "articles",
    )
)
def ingested_store(spark, sf_dir):
    """Two batches inserted into a new store, old articles pruned from it, the rest read.

    Articles without a vector are dead letters and claim no id.
    """
    root = folder(spark, "store")
    store = f"{root}/store"
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("seq"), "embedding")
    rows = enriched(spark, sf_dir).join(vectors, "seq", "left")
    rows = rows.withColumns({"offset": F.col("seq"), "value": as_json(rows.drop("embedding"))})
    ensure_store(spark, store)
    for number in range(2):
        batch = rows.where(F.col("seq") % 2 == number)
        ingest_batch(batch, number, store, f"{root}/failed", f"{root}/work", LOGGED)
    stored = read_store(spark, store)
    assert_not_empty(stored)
    prune_store(spark, store, dt.datetime(2024, 2, 10, 6, tzinfo=dt.timezone.utc))
    return read_store(spark, store).select(
        "article_id", "source_url", F.col("dt").cast("string").alias("dt")
    )


@query(
    sql(
        """SELECT CASE seq % 3 WHEN 0 THEN 'first' ELSE 'last' END AS source_name, count(*) AS n
           FROM articles WHERE seq % 3 <> 1 GROUP BY 1""",
        "articles",
    )
)
def sources_without_the_broken(spark, sf_dir):
    """Three sources of which the second fails while it is read: the others are whole."""
    rows = articles(spark, sf_dir).select("article_id", "seq")
    fail = F.raise_error(F.concat(F.lit("cannot read "), F.col("seq").cast("string")))
    loaders = {
        "first": lambda: rows.where("seq % 3 = 0"),
        "broken": lambda: rows.where("seq % 3 = 1").withColumn("article_id", fail.cast("string")),
        "last": lambda: rows.where("seq % 3 = 2"),
    }
    merged = union_sources(gathered_sources(loaders))
    return merged.groupBy("source_name").agg(F.count(F.lit(1)).alias("n"))
